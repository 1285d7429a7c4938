"""Queries of the pipeline's own operators over the whole tables, and their SQL."""

from __future__ import annotations

from functools import wraps

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import clean, codes, grammar
from quirework.operators import grouping, hierarchy, quality, statistics, tables, textdiff
from quirework.plans.export import export_columns, export_wide
from quirework.runtime import load
from quirework.sources import readers
from quirework.streaming import resume

COLUMN = ("pub", "page", "col")
REVIEW_BELOW = 0.90


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Each printed line once, as first scanned."""
    return tables.keep_first(load(spark, d, "ocr_lines"), ("line_id",), ("scanned_at",))


def _latest(df: DataFrame, key: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (key, "loaded_at")]
    last = df.groupBy(key).agg(F.max(F.struct("loaded_at", *rest)).alias("_m"))
    return last.select(*(F.col(c) if c == key else F.col(f"_m.{c}").alias(c) for c in df.columns))


def _entries(spark: SparkSession, d: str, name: str = "classified_lines") -> DataFrame:
    return _latest(load(spark, d, name), "row_id")


def _cities(spark: SparkSession, d: str) -> DataFrame:
    return tables.keep_first(load(spark, d, "city_entries"), ("row_id",), ("loaded_at",))


def _doctors(spark: SparkSession, d: str) -> DataFrame:
    return tables.keep_first(load(spark, d, "doc_entries"), ("row_id",), ("loaded_at",))


_L = "(select * from (select *, row_number() over (partition by line_id order by scanned_at) as rn from ocr_lines) where rn = 1)"
_E = "(select * from (select *, row_number() over (partition by row_id order by loaded_at desc) as rn from classified_lines) where rn = 1)"
_EB = "(select * from (select *, row_number() over (partition by row_id order by loaded_at desc) as rn from classified_lines_b) where rn = 1)"
_C = "(select * from (select *, row_number() over (partition by row_id order by loaded_at) as rn from city_entries) where rn = 1)"
_D = "(select * from (select *, row_number() over (partition by row_id order by loaded_at) as rn from doc_entries) where rn = 1)"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None, rounded: tuple[str, ...] = ()):
    """Register a query and its SQL; the columns `rounded` are given to nine places, as sums and powers may
    differ in the last bit between engines."""

    def add(f):
        @wraps(f)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*(F.round(c, 9).alias(c) if c in rounded else c for c in df.columns)) if rounded else df

        QUERIES[f.__name__] = query
        if sql is not None:
            SQL[f.__name__] = f"select * replace ({', '.join(f'round({c}, 9) as {c}' for c in rounded)}) from ({sql})" if rounded else sql
        return query

    return add


# --- expressions over columns ---------------------------------------------------------------------------


@_query("""select doc_id, (k - 1)::int as line_no, ls[k] as line from (
  select doc_id, string_split(text, chr(10)) as ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) as k from documents)""")
def explode_lines(spark, d):
    """Texts to lines with their ordinal."""
    return load(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@_query(f"""select line_id, trim(regexp_replace(regexp_replace(regexp_replace(translate(text, '–—━:', '---;'),
  '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), '\\(([lI1])[ '']?([0-9]{{2}})\\)', '(l \\2)', 'g'), '[ \\t]{{2,}}', ' ', 'g')) as cleaned from {_L}""")
def clean_native(spark, d):
    """The part of the line cleaner that other engines can express too, wholly in the JVM."""
    c = F.translate("text", "–—━:", "---;")
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    c = F.regexp_replace(c, r"\(([lI1])[ ']?([0-9]{2})\)", "(l $2)")
    return _lines(spark, d).select("line_id", F.trim(F.regexp_replace(c, r"[ \t]{2,}", " ")).alias("cleaned"))


@_query()
def clean_full(spark, d):
    """The whole line cleaner, with compatibility normalisation."""
    return _lines(spark, d).select("line_id", clean.clean_line(F.col("text")).alias("cleaned"))


@_query()
def clean_records(spark, d):
    return load(spark, d, "documents").select("doc_id", clean.clean_record(F.col("text")).alias("cleaned"))


@_query(f"""with f as (select regexp_extract(text, '([^0-9a-zA-Z(),.''▼★;‡* &◊⊕♁△/\\-])', 1) as ch from {_L} where text is not null)
  select ch, count(*) as n_lines from f where ch <> '' group by ch""")
def unexpected_chars(spark, d):
    """The first unexpected character of each line, and how many lines have it."""
    return _lines(spark, d).select(clean.unexpected(F.col("text")).alias("ch")).where("ch <> ''").groupBy("ch").agg(F.count("*").alias("n_lines"))


@_query(f"""with w as (select line_id, text, conf, lag(text, 1) over w as before_1, lag(text, 2) over w as before_2,
    lead(text, 1) over w as after_1, lead(text, 2) over w as after_2 from {_L} window w as (partition by pub, page, col order by line_no))
  select * from w where coalesce(conf, 0) < 0.90 or regexp_matches(text, '[^0-9a-zA-Z(),.''▼★;‡* &◊⊕♁△/\\-]')""")
def review_queue(spark, d):
    """Lines to be looked at, with two lines before and after."""
    w = Window.partitionBy(*COLUMN).orderBy("line_no")
    near = _lines(spark, d).select(
        "line_id", "text", "conf", *(F.lag("text", k).over(w).alias(f"before_{k}") for k in (1, 2)), *(F.lead("text", k).over(w).alias(f"after_{k}") for k in (1, 2))
    )
    return near.where((F.coalesce("conf", F.lit(0.0)) < REVIEW_BELOW) | (clean.unexpected(F.col("text")) != ""))


@_query(f"select line_id, text from {_L} where text is distinct from '{clean.SKIPPED}'")
def readable_lines(spark, d):
    return _lines(spark, d).where(clean.is_readable(F.col("text"))).select("line_id", "text")


@_query(f"""select row_id, replace(replace(replace(replace(publication, 'New ', 'N'), 'North ', 'N'), 'South ', 'S'), 'West ', 'W')[:4] as short,
  printf('%s_%03d_%02d_%06d', replace(replace(replace(replace(publication, 'New ', 'N'), 'North ', 'N'), 'South ', 'S'), 'West ', 'W')[:4], page_number, col_no, row_id) as made,
  printf('%s_p%03d_c%03d_e%03d', publication, page_number, col_no, row_number() over (partition by publication, page_number, col_no order by row_id)) as by_column,
  printf('%s_p%02d_r00_c%03d.jpg', publication, page_number, col_no) as image from {_E}""")
def format_ids(spark, d):
    e = _entries(spark, d)
    place = (F.col("publication"), F.col("page_number"), F.col("col_no"))
    ordinal = F.row_number().over(Window.partitionBy("publication", "page_number", "col_no").orderBy("row_id"))
    return e.select(
        "row_id", codes.publication_short(F.col("publication")).alias("short"), codes.entry_id(*place, F.col("row_id")).alias("made"),
        codes.column_entry_id(*place, ordinal).alias("by_column"), codes.snippet_name(*place).alias("image"),
    )


@_query("""with k as (select distinct pub, page, col, 'scan_ocr_' || pub || '_p' || lpad(page::varchar, 2, '0') || '_r00_c' || lpad(col::varchar, 3, '0') || '.jpg' as key from ocr_lines)
  select key, pub as publication, page, 0 as row_no, col as col_no from k""")
def parse_keys(spark, d):
    """Request keys made of the columns, and read back."""
    keys = load(spark, d, "ocr_lines").select("pub", "page", "col").distinct()
    made = keys.select(F.concat(F.lit("scan_ocr_"), codes.snippet_name(F.col("pub"), F.col("page"), F.col("col"))).alias("key"))
    parsed = made.select("key", codes.parse_request_key(F.col("key")).alias("p"))
    return parsed.select("key", "p.publication", "p.page", F.col("p.row").alias("row_no"), F.col("p.col").alias("col_no"))


@_query(f"""with m as (select *, max(x + width) over (partition by pub, page) as mx, max(y + height) over (partition by pub, page) as my from {_L})
  select line_id, case when conf >= 0.99 then 'green' when conf >= 0.98 then 'yellow' when conf > 0.95 then 'orange' else 'red' end as colour,
    x::double / 1000 as sx, y::double / my * 0.99 as sy, height::double / my as sh from m""")
def drawn_lines(spark, d):
    """Lines as a viewer draws them: colour by confidence, box scaled to the page."""
    m = _lines(spark, d).withColumn("my", F.max(F.col("y") + F.col("height")).over(Window.partitionBy("pub", "page")))
    return m.select(
        "line_id", codes.confidence_colour(F.col("conf")).alias("colour"), (F.col("x") / 1000).alias("sx"),
        (F.col("y") / F.col("my") * 0.99).alias("sy"), (F.col("height") / F.col("my")).alias("sh"),
    )


_YEAR = "case when regexp_matches({y}, '^[0-9]{{4}}$') then {y}::int when regexp_matches({y}, '^[0-9]{{1,2}}$') then {y}::int + (case when {y}::int <= {p} then 1900 else 1800 end) end"


@_query(f"""select row_id, {_YEAR.format(y="trim(birth_year)", p=18)} as birth, {_YEAR.format(y="trim(license_year)", p=18)} as licence,
  {_YEAR.format(y="trim(license_year)", p=6)} as licence_1906,
  case trim(license_year) when '-1' then 'earlier' when '-2' then 'unknown' when '-3' then 'exempt' else
    case when regexp_matches(trim(license_year), '^([0-9]{{1,2}}|[0-9]{{4}})$') then 'year' else 'none' end end as status,
  coalesce(ama_member, false)::int as member, coalesce(ama_fellow, false)::int as fellow,
  case military when '▼' then 'Army Reserve' when '▼G' then 'National Guard' when '▼N' then 'Navy Reserve' else military end as corps,
  translate(specialty, '★', '*') as specialties, '="' || translate(hours, ';', ':') || '"' as hours_text from {_D}""")
def decoded_fields(spark, d):
    """Years of one, two and four digits, licence codes, flags and marks."""
    year = lambda c, p: codes.full_year(F.col(c), p)
    return _doctors(spark, d).select(
        "row_id", year("birth_year", 18).alias("birth"), year("license_year", 18).alias("licence"), year("license_year", 6).alias("licence_1906"),
        codes.licence_status(F.col("license_year")).alias("status"), codes.flag(F.col("ama_member")).alias("member"),
        codes.flag(F.col("ama_fellow")).alias("fellow"), codes.military_name(F.col("military")).alias("corps"),
        F.translate("specialty", "★", "*").alias("specialties"), codes.spreadsheet_text(F.translate("hours", ";", ":")).alias("hours_text"),
    )


@_query(f"""with s as (select row_id, trim(split_part(schools, ',', 1)) as a, regexp_replace(trim(split_part(schools, ',', 2)), '^[''"]+|[''"]+$', '', 'g') as y from {_D})
  select row_id, upper(nullif(regexp_extract(a, '(?s)^(.*)\\.([^.]*)$', 1), '')) as state, nullif(regexp_extract(a, '(?s)^(.*)\\.([^.]*)$', 2), '') as number, nullif(y, '') as year from s""")
def school_codes(spark, d):
    s = codes.school_parts(F.col("schools"))
    return _doctors(spark, d).select("row_id", s["state"].alias("state"), s["number"].alias("number"), s["year"].alias("year"))


@_query("""select event_id, json_extract_string(props, '$.' || k) as v, k from events, unnest(json_keys(props)) as t(k)""")
def json_props(spark, d):
    """Records in text to one row per field."""
    m = load(spark, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return m.select("event_id", F.explode("m").alias("k", "v"))


@_query()
def clean_json_records(spark, d):
    """Records of any shape with their keys and texts cleaned."""
    return load(spark, d, "events").select("event_id", clean.clean_json("props").alias("cleaned"))


@_query(f"select line_id, x, y, width, height from {_L}")
def boxes_read(spark, d):
    """Boxes written as lists, as records and flat in one column of JSON, and read back."""
    flat = F.struct("x", "y", "width", "height")
    forms = (F.struct(F.array("x", "y", "width", "height").alias("bbox")), F.struct(flat.alias("bbox")), flat)
    record = F.when(F.col("line_id") % 3 == 0, F.to_json(forms[0])).when(F.col("line_id") % 3 == 1, F.to_json(forms[1])).otherwise(F.to_json(forms[2]))
    return _lines(spark, d).select("line_id", readers.box_of(record).alias("b")).select("line_id", "b.*")


@_query("""select pub as pub_id, page as page_num, col as "column", printf('%s_p%02d_r00_c%03d.jpg', pub, page, col) as path, min(x) as x_offset, min(y) as y_offset from ocr_lines group by pub, page, col""")
def metadata_flattened(spark, d):
    """Nested records of publications, pages and snippets, to one row per snippet."""
    path = codes.snippet_name(F.col("pub"), F.col("page"), F.col("col")).alias("path")
    snippet = F.struct(path, F.col("x_offset"), F.col("y_offset"), F.col("col").alias("column"))
    snippets = load(spark, d, "ocr_lines").groupBy(*COLUMN).agg(F.min("x").alias("x_offset"), F.min("y").alias("y_offset"))
    pages = snippets.groupBy("pub", "page").agg(F.collect_list(snippet).alias("snippets"))
    nested = pages.groupBy(F.col("pub").alias("pub_id")).agg(F.collect_list(F.struct(F.col("page").alias("page_num"), "snippets")).alias("pages"))
    return readers.flat_metadata(nested)


@_query(f"""select pub, page, col, count(*) as n_items, sum(case when coalesce(conf, 0) < 0.9 then 1 else 0 end)::bigint as n_low from {_L} group by all""")
def answers_read(spark, d):
    """Answers of a service, one per column, as bare lists or under a name, to their items."""
    item = F.struct("text", "x", "y", "width", "height", F.col("conf").alias("confidence"))
    lists = _lines(spark, d).groupBy(*COLUMN).agg(F.collect_list(item).alias("items"))
    answer = F.when(F.col("col") == 0, F.to_json("items")).when(F.col("col") == 1, F.to_json(F.struct(F.col("items").alias("lines")))).otherwise(F.to_json(F.struct(F.col("items").alias("entries"))))
    read = lists.select(*COLUMN, F.explode(readers.response_items(answer)).alias("i"))
    low = F.coalesce("i.confidence", F.lit(0.0)) < REVIEW_BELOW
    return read.groupBy(*COLUMN).agg(F.count("*").alias("n_items"), F.count_if(low).alias("n_low"))


def _extract(batch: pd.DataFrame) -> pd.DataFrame:
    read = [grammar.read_doctor(t) for t in batch["full_text"].astype(object).where(batch["full_text"].notna(), None)]
    return pd.DataFrame({"row_id": batch["row_id"], "name": [r[0] if r else None for r in read], "license_year": [r[6] if r else None for r in read]})


@_query()
def extraction_run(spark, d):
    """Doctors' entries sent in batches to an extractor (here the grammar), those that fail kept and marked."""
    pending = _entries(spark, d).where("entry_type = 'DOC'").select("row_id", "full_text")
    answer = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("license_year", T.StringType())])
    return resume.answered(pending, answer, _extract, size=20)


# --- joins and set operations ---------------------------------------------------------------------------


@_query(f"""with p as (select entry_id, publication from doc_entries union all select entry_id, publication from city_entries)
  select row_id from {_E} e where not exists (select 1 from p where p.entry_id is not distinct from e.entry_id and p.publication is not distinct from e.publication)""")
def resume_anti(spark, d):
    """Entries that no parsed table has yet."""
    done = [load(spark, d, n).select("entry_id", "publication") for n in ("doc_entries", "city_entries")]
    return tables.unfinished(_entries(spark, d), done, [("entry_id", "entry_id"), ("publication", "publication")]).select("row_id")


@_query(f"""with c as (select distinct publication, page_number, col_no from classified_lines),
  s as (select * from c order by md5(publication || chr(31) || page_number || chr(31) || col_no || chr(31) || 'columns'), 1, 2, 3 limit 40)
  select row_id from {_E} e where exists (select 1 from s where s.publication = e.publication and s.page_number = e.page_number and s.col_no = e.col_no)""")
def sampled_entries(spark, d):
    """Entries of a reproducible sample of 40 columns."""
    key = ["publication", "page_number", "col_no"]
    columns = load(spark, d, "classified_lines").select(*key).distinct()
    chosen = tables.sample_exact(columns, 40, key, "columns")
    return _entries(spark, d).join(chosen, key, "left_semi").select("row_id")


@_query("""with a as (select distinct pub, page, col from ocr_lines), b as (select distinct publication as pub, page_number as page, col_no as col from classified_lines_b)
  select coalesce(a.pub, b.pub) as pub, coalesce(a.page::varchar, b.page) as page, coalesce(a.col, b.col) as col,
    case when b.pub is null then 'no entry' else 'no lines' end as reason
  from a full join b on a.pub = b.pub and a.page = try_cast(b.page as int) and a.col = b.col where a.pub is null or b.pub is null""")
def outer_reasons(spark, d):
    """Columns with lines but without an entry in the second system, and the other way round."""
    lines = load(spark, d, "ocr_lines").select("pub", F.col("page").cast("string").alias("page"), "col", F.col("page").alias("n"))
    other = load(spark, d, "classified_lines_b").select(
        F.col("publication").alias("pub"), F.col("page_number").alias("page"), F.col("col_no").alias("col"), F.col("page_number").try_cast("int").alias("n")
    )
    a, b = lines.select("pub", "n", "col").distinct(), other.select("pub", "n", "col", "page").distinct()
    met = a.join(b.withColumnsRenamed({"pub": "rp", "n": "rn", "col": "rc"}), (F.col("pub") == F.col("rp")) & (F.col("n") == F.col("rn")) & (F.col("col") == F.col("rc")), "full_outer")
    return met.where("pub is null or rp is null").select(
        F.coalesce("pub", "rp").alias("pub"), F.coalesce(F.col("n").cast("string"), "page").alias("page"), F.coalesce("col", "rc").alias("col"),
        F.when(F.col("rp").isNull(), "no entry").otherwise("no lines").alias("reason"),
    )


@_query("""with a as (select distinct pub, page, col from ocr_lines), b as (select distinct publication, page_number, col_no from classified_lines)
  select coalesce(a.pub, b.publication) as pub, coalesce(a.page, b.page_number) as page, coalesce(a.col, b.col_no) as col,
    case when b.publication is null then 'missing from classified' else 'added in classified' end as reason
  from a full join b on a.pub = b.publication and a.page = b.page_number and a.col = b.col_no where a.pub is null or b.publication is null""")
def column_coverage(spark, d):
    named = load(spark, d, "classified_lines").select(F.col("publication").alias("pub"), F.col("page_number").alias("page"), F.col("col_no").alias("col"))
    return tables.one_sided(load(spark, d, "ocr_lines"), named, COLUMN, ("missing from classified", "added in classified"))


@_query(f"select row_id from {_D} x where city_id is null or not exists (select 1 from city_entries c where c.entry_id = x.city_id)")
def doctors_without_city(spark, d):
    return _doctors(spark, d).join(load(spark, d, "city_entries").select(F.col("entry_id").alias("city_id")), "city_id", "left_anti").select("row_id")


@_query(f"select row_id from {_C} x where not exists (select 1 from doc_entries c where c.city_id = x.entry_id)")
def cities_without_doctor(spark, d):
    return _cities(spark, d).join(load(spark, d, "doc_entries").select(F.col("city_id").alias("entry_id")), "entry_id", "left_anti").select("row_id")


@_query(f"""with c as (select entry_id, min(name) as name, min(county_name) as county_name from {_C} group by entry_id)
  select row_id, coalesce(c.name, '') as city_name, coalesce(c.county_name, '') as county_name from {_D} x left join c on c.entry_id = x.city_id""")
def city_lookup(spark, d):
    placed = tables.look_up(_doctors(spark, d), "city_id", _cities(spark, d), "entry_id", {"city_name": "name", "county_name": "county_name"})
    return placed.select("row_id", "city_name", "county_name")


@_query(f"""with a as (select publication, page_number, col_no, count(*) as n from {_E} where entry_type = 'DOC' group by all),
  b as (select publication, page_number, col_no, count(*) as n from {_D} group by all)
  select coalesce(a.publication, b.publication) as publication, coalesce(a.page_number, b.page_number) as page_number, coalesce(a.col_no, b.col_no) as col_no,
    coalesce(a.n, 0) as count_in, coalesce(b.n, 0) as count_out from a full join b using (publication, page_number, col_no) where coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def doctor_counts(spark, d):
    """Columns whose numbers of doctors differ before and after parsing."""
    return tables.counts_differ(_entries(spark, d).where("entry_type = 'DOC'"), _doctors(spark, d), ("publication", "page_number", "col_no"), "entry_id")


@_query("""with a as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as i from events),
  b as (select user_id, event_id, row_number() over (partition by user_id order by value, event_id) as i from events)
  select a.user_id, a.i::int as position, a.event_id as by_time, b.event_id as by_value from a join b on a.user_id is not distinct from b.user_id and a.i = b.i""")
def positional_join(spark, d):
    """The i-th event of a user in time beside the i-th by value."""
    e = load(spark, d, "events").select("user_id", "event_id", "ts", "value")
    met = tables.side_by_side(e, e, ("ts", "event_id"), ("value", "event_id"), ("user_id",))
    return met.select("user_id", "position", F.col("event_id").alias("by_time"), F.col("r_event_id").alias("by_value"))


@_query("select distinct * exclude (scanned_at) from ocr_lines")
def sort_dedup(spark, d):
    """The lines of two deliveries put together, whole rows once, in reading order."""
    lines = load(spark, d, "ocr_lines").drop("scanned_at")
    return tables.sorted_distinct([lines, lines], (*COLUMN, "line_no"))


@_query("""select entry_id, publication, name, city_id, null::int as population from doc_entries union all select entry_id, publication, name, null, population from city_entries""")
def union_by_name(spark, d):
    a = load(spark, d, "doc_entries").select("entry_id", "publication", "name", "city_id")
    b = load(spark, d, "city_entries").select("population", "name", "entry_id", "publication")
    return a.unionByName(b, allowMissingColumns=True)


@_query("""select entry_id from classified_lines except (select entry_id from doc_entries union select entry_id from city_entries)""")
def ids_left_over(spark, d):
    ids = lambda n: load(spark, d, n).select("entry_id")
    return ids("classified_lines").subtract(ids("doc_entries")).subtract(ids("city_entries"))


# --- aggregates -----------------------------------------------------------------------------------------


@_query(f"""with o as (select pub, page, col, string_agg(regexp_replace(coalesce(text, ''), '[ \\t\\r\\n-]', '', 'g'), '' order by line_no) as a from {_L} group by all),
  c as (select publication as pub, page_number as page, col_no as col, string_agg(regexp_replace(coalesce(full_text, ''), '[ \\t\\r\\n-]', '', 'g'), '' order by row_id) as b from {_E} group by all)
  select pub, page, col, length(a)::int as ocr_chars, length(b)::int as entry_chars, a = b as kept from o join c using (pub, page, col)""")
def text_kept(spark, d):
    """Per column the text of its lines and of its entries, in order, without blanks and hyphens."""
    plain = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[ \t\r\n-]", "")
    a = _lines(spark, d).groupBy(*COLUMN).agg(F.array_sort(F.collect_list(F.struct("line_no", plain("text").alias("t")))).alias("s"))
    a = a.select(*COLUMN, F.array_join(F.col("s.t"), "").alias("a"))
    e = _entries(spark, d).groupBy(F.col("publication").alias("pub"), F.col("page_number").alias("page"), F.col("col_no").alias("col")).agg(
        F.array_sort(F.collect_list(F.struct("row_id", plain("full_text").alias("t")))).alias("s")
    )
    e = e.select(*COLUMN, F.array_join(F.col("s.t"), "").alias("b"))
    return a.join(e, list(COLUMN)).select(*COLUMN, F.length("a").alias("ocr_chars"), F.length("b").alias("entry_chars"), (F.col("a") == F.col("b")).alias("kept"))


@_query(f"""with n as (select publication, entry_type, count(*) as n from {_E} where not (entry_type = 'UNKNOWN' and coalesce(full_text, '') like 'NUMBER OF%') group by all)
  select publication, entry_type, n, n / sum(n) over (partition by publication)::double as share from n""", rounded=('share',))
def type_shares(spark, d):
    e = _entries(spark, d).where(~((F.col("entry_type") == "UNKNOWN") & F.coalesce(F.col("full_text").startswith("NUMBER OF"), F.lit(False))))
    n = e.groupBy("publication", "entry_type").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("publication")))


@_query("""with n as (select user_id, event_type, count(*) as n from events group by all), s as (select *, n / sum(n) over (partition by user_id)::double as share from n)
  select * from s where share > 0.4 or share < 0.1""", rounded=('share',))
def share_outliers(spark, d):
    n = load(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    s = n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("user_id")))
    return s.where((F.col("share") > 0.4) | (F.col("share") < 0.1))


@_query(f"""with p as (select distinct publication from classified_lines) select publication, count(e.row_id) as n from p left join (select * from {_E} where entry_type = 'STATE') e using (publication)
  group by publication having count(e.row_id) <> 1""")
def state_counts(spark, d):
    """Publications without exactly one state heading, those without any among them."""
    return _entries(spark, d).groupBy("publication").agg(F.count_if(F.col("entry_type") == "STATE").alias("n")).where("n <> 1")


@_query("select pub, page, col, min(x) as x, min(y) as y, max(x + width) - min(x) as width, max(y + height) - min(y) as height from ocr_lines group by all")
def column_boxes(spark, d):
    return grouping.box_union(load(spark, d, "ocr_lines"), COLUMN)


@_query(f"""select count(conf) as n, avg(conf) as mean, stddev_samp(conf) as std, min(conf) as low, quantile_cont(conf, 0.25) as q25, quantile_cont(conf, 0.5) as q50,
  quantile_cont(conf, 0.75) as q75, max(conf) as high from {_L}""", rounded=('mean', 'std', 'q25', 'q50', 'q75'))
def describe_confidence(spark, d):
    return statistics.describe(_lines(spark, d), "conf")


@_query(f"select conf, count(*) as n from {_L} where conf is not null group by conf")
def confidence_counts(spark, d):
    return _lines(spark, d).where("conf is not null").groupBy("conf").agg(F.count("*").alias("n")).orderBy("conf")


@_query("""select l_returnflag, l_linestatus, count(*) as n, count(distinct l_orderkey) as orders, sum(case when l_quantity > 30 then 1 else 0 end)::bigint as large,
  round(avg(l_discount), 6) as mean_discount, round(quantile_cont(l_quantity, 0.95), 6) as q95, round(max(l_tax) / (max(l_tax) + 1e-6), 6) as top from lineitem group by all""")
def grouped_measures(spark, d):
    """Counts, distinct and conditional counts, means and a percentile by group."""
    return load(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("orders"), F.count_if(F.col("l_quantity") > 30).alias("large"),
        F.round(F.avg("l_discount"), 6).alias("mean_discount"), F.round(F.percentile("l_quantity", F.lit(0.95)), 6).alias("q95"),
        F.round(F.max("l_tax") / (F.max("l_tax") + 1e-6), 6).alias("top"),
    )


@_query(f"""with p as (select pub, page, col, count(*) as n from {_L} group by all), m as (select pub, page, avg(n) as mean_lines, min(n) as lo, max(n) as hi from p group by all)
  select pub, page, mean_lines, greatest(mean_lines - lo, hi - mean_lines) as deviation from m""", rounded=('mean_lines', 'deviation'))
def column_deviation(spark, d):
    return statistics.column_deviation(_lines(spark, d), ("pub", "page"), "col", "line_id")


@_query(f"""with c as (select pub, page, col from ocr_lines union select publication, page_number, col_no from classified_lines), p as (select pub, page, col, count(*) as n from {_L} group by all),
  f as (select c.pub, c.page, coalesce(p.n, 0) as n from c left join p on c.pub is not distinct from p.pub and c.page is not distinct from p.page and c.col is not distinct from p.col)
  select pub, page, avg(n) as mean_lines, greatest(avg(n) - min(n), max(n) - avg(n)) as deviation from f group by all""", rounded=('mean_lines', 'deviation'))
def known_columns_deviation(spark, d):
    """As above, with the columns that only entries have counting 0 lines."""
    named = load(spark, d, "classified_lines").select(F.col("publication").alias("pub"), F.col("page_number").alias("page"), F.col("col_no").alias("col"))
    return statistics.column_deviation(_lines(spark, d), ("pub", "page"), "col", "line_id", named)


@_query("""with a as (select pub, count(distinct page) as n_pages, count(distinct (page, col)) as n_columns from ocr_lines where pub is not null group by pub),
  b as (select publication as pub, count(distinct page_number) as n_pages, count(distinct (page_number, col_no)) as n_columns from classified_lines where publication is not null group by publication)
  select coalesce(a.pub, b.pub) as pub, coalesce(a.n_pages, 0) as pages_in, coalesce(b.n_pages, 0) as pages_out, coalesce(a.n_columns, 0) as columns_in, coalesce(b.n_columns, 0) as columns_out from a full join b on a.pub = b.pub""")
def level_counts(spark, d):
    """Pages and columns of each publication before and after classification."""
    def side(name, pub, page, col, end):
        t = load(spark, d, name).where(F.col(pub).isNotNull()).groupBy(F.col(pub).alias("pub"))
        return t.agg(F.count_distinct(page).alias(f"pages_{end}"), F.count_distinct(F.struct(page, col)).alias(f"columns_{end}"))

    met = side("ocr_lines", "pub", "page", "col", "in").join(side("classified_lines", "publication", "page_number", "col_no", "out"), "pub", "full_outer")
    return met.na.fill(0, [f"{n}_{e}" for n in ("pages", "columns") for e in ("in", "out")]).select("pub", "pages_in", "pages_out", "columns_in", "columns_out")


# --- order ----------------------------------------------------------------------------------------------


@_query(f"""with s as (select row_id, entry_type, last_value(case when entry_type = 'STATE' then full_text end ignore nulls) over (order by row_id rows between unbounded preceding and current row) as state_name,
    last_value(case when entry_type = 'CITY' then entry_id end ignore nulls) over (order by row_id rows between unbounded preceding and current row) as city_id from {_E})
  select row_id, entry_type, case when entry_type = 'CITY' then state_name end as state_name, case when entry_type = 'DOC' then city_id end as city_id from s where entry_type in ('CITY', 'DOC')""")
def split_entries(spark, d):
    """Cities with their state, doctors with their city, carried forward in reading order."""
    cities, doctors = hierarchy.split_entries(_entries(spark, d))
    return cities.select("row_id", "entry_type", "state_name", F.lit(None).cast("string").alias("city_id")).unionByName(
        doctors.select("row_id", "entry_type", F.lit(None).cast("string").alias("state_name"), "city_id")
    )


@_query("""select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (order by event_id rows between unbounded preceding and current row) as last_value from events""")
def carry_forward(spark, d):
    """The last value of one kind of event, carried over all rows without any grouping."""
    e = load(spark, d, "events")
    carried = {"last_value": F.when(F.col("event_type") == "purchase", F.col("value"))}
    return hierarchy.carry_forward(e, "event_id", carried, None).select("event_id", "last_value")


@_query("""with recursive v as (select user_id, value, row_number() over (partition by user_id order by value, event_id) as i from events where user_id is not null and value is not null),
  w as (select user_id, i, value, value as last from v where i = 1
    union all select v.user_id, v.i, v.value, case when v.value > w.last + 5.0 then v.value else w.last end from w join v on v.user_id = w.user_id and v.i = w.i + 1)
  select user_id, count(distinct last)::bigint as n_peaks, max(last) as last_peak from w group by user_id""")
def spaced_peaks(spark, d):
    """Per user the values that are more than 5 above the last one taken."""
    v = load(spark, d, "events").where("user_id is not null and value is not null").groupBy("user_id").agg(F.collect_list("value").alias("v"))
    taken = v.select("user_id", grouping.spaced_peaks(F.col("v"), 5.0).alias("p"))
    return taken.select("user_id", F.size("p").cast("bigint").alias("n_peaks"), F.element_at("p", -1).alias("last_peak"))


@_query("""with n as (select distinct publication, try_cast(regexp_extract(entry_id, '([0-9]+)$', 1) as bigint) as n from (select publication, entry_id from doc_entries union all select publication, entry_id from city_entries)),
  g as (select publication, n, lead(n) over (partition by publication order by n) as nx from n where n is not null)
  select publication, n + 1 as first_missing, nx - 1 as last_missing from g where nx > n + 1""")
def sequence_gaps(spark, d):
    ids = lambda n: load(spark, d, n).select("publication", "entry_id")
    return tables.missing_numbers(ids("doc_entries").unionByName(ids("city_entries")), "entry_id", ("publication",))


@_query("select entry_id, count(*) as n from doc_entries group by entry_id having count(*) > 1")
def duplicate_ids(spark, d):
    return tables.repeated_ids(load(spark, d, "doc_entries"), "entry_id")


@_query("select row_id, entry_id, name, city_id, publication from (select *, row_number() over (partition by row_id order by loaded_at) as rn from doc_entries) where rn = 1")
def dedup_sorted(spark, d):
    """Doctors, the first arrival of each, in the order of their identifiers."""
    return _doctors(spark, d).select("row_id", "entry_id", "name", "city_id", "publication").orderBy("entry_id")


@_query(f"select row_id, publication, ((row_number() over (partition by publication order by row_id) - 1) // 20)::bigint as batch_id from {_D}")
def request_batches(spark, d):
    return tables.in_batches(_doctors(spark, d), ("row_id",), 20, ("publication",)).select("row_id", "publication", "batch_id")


@_query(f"select row_id, ((row_number() over (order by row_id) - 1) // 20)::bigint as batch_id from {_D}")
def global_batches(spark, d):
    """Requests in batches of twenty over the whole table."""
    return tables.in_batches(_doctors(spark, d).select("row_id"), ("row_id",), 20)


@_query("""with n as (select distinct try_cast(regexp_extract(entry_id, '([0-9]+)$', 1) as bigint) as n from doc_entries), g as (select n, lead(n) over (order by n) as nx from n where n is not null)
  select n + 1 as first_missing, nx - 1 as last_missing from g where nx > n + 1""")
def global_gaps(spark, d):
    """Numbers that no doctor's identifier has."""
    return tables.missing_numbers(load(spark, d, "doc_entries"), "entry_id")


# --- classification, grouping, parsing ------------------------------------------------------------------


@_query()
def line_types(spark, d):
    """Kinds of entries by the strict and by the wider grammar."""
    plain = F.regexp_replace(F.regexp_replace("full_text", r"(?<=[a-z])-\s+(?=[a-z])", ""), r"\s+", " ")
    return _entries(spark, d).select(
        "row_id", grammar.line_type(plain).alias("line_type"), grammar.wide_line_type(plain).alias("wide_type"), grammar.is_loose_city(F.col("full_text")).alias("loose_city")
    )


@_query(f"""select row_id, regexp_matches(full_text, '^[A-Z\\s]+$') as state, not regexp_matches(full_text, '^[A-Z\\s]+$') and contains(full_text, ',') and
  regexp_full_match(full_text, '([a-zA-Z\\s.,()'']+),\\s?(?:(?:([0-9,]+?)|-),\\s?)?([a-zA-Z().\\s-]+)') as city from {_E} where full_text is not null""")
def heading_types(spark, d):
    """Which entries are headings of states or of cities by the strict grammar."""
    kind = grammar.line_type(F.col("full_text"))
    return _entries(spark, d).where("full_text is not null").select("row_id", (kind == "STATE").alias("state"), (kind == "CITY").alias("city"))


@_query()
def entry_groups(spark, d):
    """Lines grouped into entries, with kinds, texts and boxes."""
    lines = _lines(spark, d).where(clean.is_readable(F.col("text")))
    return grouping.group_entries(lines.withColumn("text", clean.clean_line(F.col("text"))), kind_of=grammar.wide_line_type, mend=True)


@_query(f"""select row_id, trim(nullif(regexp_extract(full_text, '(?s)^(.+?),\\s*(?:([0-9][0-9,.]*|-)\\s*,\\s*)?([^,0-9]+?)\\.?\\s*$', 1), '')) as city,
  try_cast(regexp_replace(nullif(regexp_extract(full_text, '(?s)^(.+?),\\s*(?:([0-9][0-9,.]*|-)\\s*,\\s*)?([^,0-9]+?)\\.?\\s*$', 2), ''), '[,.]', '', 'g') as int) as population
  from {_E} where entry_type = 'CITY'""")
def city_heads(spark, d):
    """Name and population of printed cities."""
    c = _entries(spark, d).where("entry_type = 'CITY'").select("row_id", grammar.city_fields(F.col("full_text")).alias("c"))
    return c.select("row_id", "c.city", "c.population")


_CITY = "'(?s)^(.+?),\\s*(?:([0-9][0-9,.]*|-)\\s*,\\s*)?([^,0-9]+?)\\.?\\s*$'"
_POST = "'(?s)^(.*?)\\s*\\((?:(R\\.?\\s?F\\.?\\s?D\\.*|R\\.?\\s?D\\.?|P\\.?\\s?O\\.?),?\\s+)?([^()]+?)(?:\\s+(P\\.?\\s?O\\.?))?\\)$'"


@_query(f"""with c as (select row_id, full_text, nullif(regexp_extract(full_text, {_CITY}, 3), '') as county from {_E} where entry_type = 'CITY'),
  k as (select *, regexp_matches(county, {_POST}) as found, upper(regexp_replace(regexp_extract(county, {_POST}, 2) || regexp_extract(county, {_POST}, 4), '[^A-Za-z]', '', 'g')) as kind from c)
  select row_id, trim(nullif(regexp_extract(full_text, {_CITY}, 1), ''), ' ') as city, try_cast(regexp_replace(nullif(regexp_extract(full_text, {_CITY}, 2), ''), '[,.]', '', 'g') as int) as population,
    trim(case when found and kind <> '' then nullif(regexp_extract(county, {_POST}, 1), '') else county end, ' ') as county,
    case when found and kind <> '' then nullif(regexp_extract(county, {_POST}, 3), '') end as post_reference,
    case when found and kind <> '' then case when kind = 'PO' then 'PO' else 'RFD' end end as post_reference_type from k""")
def city_parse(spark, d):
    c = _entries(spark, d).where("entry_type = 'CITY'").select("row_id", grammar.city_fields(F.col("full_text")).alias("c"))
    return c.select("row_id", "c.*")


@_query()
def doctor_parse(spark, d):
    c = _entries(spark, d).where("entry_type = 'DOC'").select("row_id", grammar.doctor_fields("full_text").alias("f"))
    return c.select("row_id", "f.*")


@_query(f"""select row_id, nullif(regexp_extract(full_text, '\\(b[''\\s]?([0-9]{{2}})\\)', 1), '') as birth_year, contains(full_text, '⊕') as fellow, regexp_matches(full_text, '\\((res )?col\\.?\\)') as col,
  contains(full_text, 'not in practice') as not_in_practice, nullif(regexp_extract(full_text, '(▼[GN]?)', 1), '') as military,
  case when regexp_matches(full_text, '\\(l t\\)') then '-2' when contains(full_text, '(♁)') then '-1' when contains(full_text, '(‡)') then '-3'
    else nullif(regexp_extract(full_text, '\\([lI][\\s'']([0-9]{{2}})\\)', 1), '') end as license_year from {_E} where entry_type = 'DOC'""")
def doctor_marks(spark, d):
    """The marks of doctors that patterns alone can read."""
    t = F.col("full_text")
    some = lambda p: F.nullif(F.regexp_extract(t, p, 1), F.lit(""))
    return _entries(spark, d).where("entry_type = 'DOC'").select(
        "row_id", some(r"\(b['\s]?([0-9]{2})\)").alias("birth_year"), t.contains("⊕").alias("fellow"), t.rlike(r"\((res )?col\.?\)").alias("col"),
        t.contains("not in practice").alias("not_in_practice"), some("(▼[GN]?)").alias("military"),
        F.when(t.rlike(r"\(l t\)"), "-2").when(t.contains("(♁)"), "-1").when(t.contains("(‡)"), "-3").otherwise(some(r"\([lI][\s']([0-9]{2})\)")).alias("license_year"),
    )


# --- differences and statistics -------------------------------------------------------------------------


@_query()
def text_changes(spark, d):
    """Changes between the two systems' texts of an entry, shown in their surroundings."""
    a, b = _entries(spark, d), _entries(spark, d, "classified_lines_b").select("row_id", F.col("full_text").alias("other"))
    c = textdiff.text_changes(a.join(b, "row_id").select("row_id", "full_text", "other"), "row_id", "full_text", "other")
    return c.select(
        F.col("key").alias("row_id"), "change_no", "change",
        textdiff.in_braces(F.col("before_in"), F.col("text_in"), F.col("text_out"), F.col("after_in")).alias("text_in_context"),
        textdiff.in_braces(F.col("before_out"), F.col("text_out"), F.col("text_in"), F.col("after_out")).alias("text_out_context"),
    )


@_query()
def change_summary(spark, d):
    a, b = _entries(spark, d), _entries(spark, d, "classified_lines_b").select("row_id", F.col("full_text").alias("other"))
    return textdiff.change_summary(textdiff.text_changes(a.join(b, "row_id").select("row_id", "full_text", "other"), "row_id", "full_text", "other"))


@_query("""select distinct diff_id, trim(identifier, chr(32) || chr(9) || chr(10) || chr(13)) as identifier, trim(text_in_context, chr(32) || chr(9) || chr(10) || chr(13)) as text_in,
  trim(text_out_context, chr(32) || chr(9) || chr(10) || chr(13)) as text_out from text_differences
  where identifier is not null and trim(text_in_context, chr(32) || chr(9) || chr(10) || chr(13)) <> '' and trim(text_out_context, chr(32) || chr(9) || chr(10) || chr(13)) <> ''
    and not contains(text_in_context, chr(10)) and not contains(text_out_context, chr(10)) and not contains(identifier, '(')""")
def parse_drop_log(spark, d):
    """Reports of dropped lines written as a log, one text per row, and read back."""
    t = load(spark, d, "text_differences")
    edge = F.lit(" \t\r\n")
    ok = t.where((F.btrim("text_in_context", edge) != "") & (F.btrim("text_out_context", edge) != "") & ~F.col("text_in_context").contains("\n") & ~F.col("text_out_context").contains("\n") & ~F.col("identifier").contains("("))
    log = F.concat(F.lit("INFO: start\nERROR: 1 lines dropped for "), "identifier", F.lit(" (see below: \ntext_in: "), "text_in_context", F.lit("\ntext_out: "), "text_out_context", F.lit("\nINFO: end\n"))
    p = ok.select("diff_id", F.explode(textdiff.dropped_pairs(log)).alias("p"))
    return p.select("diff_id", "p.identifier", "p.text_in", "p.text_out").distinct()


_CELLS = ("publication", "entry_type", "full_text", "col_no")


@_query(f"""with m as (select {", ".join(f"(a.{c} is distinct from b.{c})::int as d_{c}" for c in _CELLS)} from {_E} a join {_EB} b on a.row_id = b.row_id),
  g as ({" union all ".join(f"select '{c}' as grp, count(*) as n, sum(d_{c})::bigint as n_errors from m" for c in _CELLS)}
    union all select '(cells)', count(*) * {len(_CELLS)}, sum({" + ".join(f"d_{c}" for c in _CELLS)})::bigint from m
    union all select '(rows)', count(*), sum(greatest({", ".join(f"d_{c}" for c in _CELLS)}))::bigint from m)
  select grp, n, n_errors, n_errors / n::double as error_rate, 1.96 * sqrt((n_errors / n::double) * (1 - n_errors / n::double) / n) as moe_95,
    2.17 * sqrt((n_errors / n::double) * (1 - n_errors / n::double) / n) as moe_97, 2.576 * sqrt((n_errors / n::double) * (1 - n_errors / n::double) / n) as moe_99 from g""", rounded=('error_rate', 'moe_95', 'moe_97', 'moe_99'))
def error_rates(spark, d):
    """How often cells and rows of the two systems differ, with margins of error."""
    return statistics.error_rates(_entries(spark, d), _entries(spark, d, "classified_lines_b"), "row_id", _CELLS)


@_query(f"""with m as (select {", ".join(f"(a.{c} is distinct from b.{c})::int as d_{c}" for c in _CELLS)} from {_E} a join {_EB} b on a.row_id = b.row_id),
  g as ({" union all ".join(f"select '{c}' as grp, count(*) as n, sum(d_{c})::bigint as n_errors from m" for c in _CELLS)})
  select grp, n, n_errors, pow(n_errors - n * 0.005, 2) / (n * 0.005) + pow(n * 0.005 - n_errors, 2) / (n - n * 0.005) as chi2 from g""", rounded=('chi2',))
def chi_square_statistic(spark, d):
    rates = statistics.error_rates(_entries(spark, d), _entries(spark, d, "classified_lines_b"), "row_id", _CELLS).where("grp not like '(%'")
    return statistics.chi_square(rates.select("grp", "n", "n_errors")).select("grp", "n", "n_errors", "chi2")


_ERFC = "0.0"
for _c in statistics.ERFC:
    _ERFC = f"({_ERFC} * t + ({_c}))"


@_query(f"""with m as (select {", ".join(f"(a.{c} is distinct from b.{c})::int as d_{c}" for c in _CELLS)} from {_E} a join {_EB} b on a.row_id = b.row_id),
  g as ({" union all ".join(f"select '{c}' as grp, count(*) as n, sum(d_{c})::bigint as n_errors from m" for c in _CELLS)}
    union all select '(cells)', count(*) * {len(_CELLS)}, sum({" + ".join(f"d_{c}" for c in _CELLS)})::bigint from m
    union all select '(rows)', count(*), sum(greatest({", ".join(f"d_{c}" for c in _CELLS)}))::bigint from m),
  s as (select *, pow(n_errors - n * 0.005, 2) / (n * 0.005) + pow(n * 0.005 - n_errors, 2) / (n - n * 0.005) as chi2 from g), x as (select *, sqrt(chi2 / 2) as x, 1 / (1 + sqrt(chi2 / 2) / 2) as t from s),
  p as (select *, least(1.0, t * exp({_ERFC} - x * x)) as p_value from x)
  select grp, n, n_errors, chi2, p_value, case when p_value < 0.05 then case when n_errors / n::double < 0.005 then 'lower' else 'higher' end else '' end as significant from p""", rounded=('chi2', 'p_value'))
def chi_square(spark, d):
    rates = statistics.error_rates(_entries(spark, d), _entries(spark, d, "classified_lines_b"), "row_id", _CELLS)
    return statistics.chi_square(rates.select("grp", "n", "n_errors"))


@_query(f"""with m as ({" union all ".join(f"select a.row_id, '{c}' as field, a.{c}::varchar as a, replace(b.{c}::varchar, '0.', 'O.') as b from {_E} a join {_EB} b on a.row_id = b.row_id" for c in _CELLS)}),
  x as (select *, row_number() over (partition by field order by row_id) as i from m where a is distinct from b) select row_id, field, a, b from x where i <= 10""")
def first_differences(spark, d):
    """The first ten differing values of each column, after the one easy repair (a report)."""
    a, b = _entries(spark, d), _entries(spark, d, "classified_lines_b")
    cell = lambda c: F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("a"), F.replace(F.col(f"o_{c}").cast("string"), F.lit("0."), F.lit("O.")).alias("b"))
    met = a.select("row_id", *_CELLS).join(b.select("row_id", *(F.col(c).alias(f"o_{c}") for c in _CELLS)), "row_id")
    each = met.select("row_id", F.explode(F.array(*map(cell, _CELLS))).alias("c")).select("row_id", "c.*").where(statistics.differs(F.col("a"), F.col("b")))
    return each.withColumn("i", F.row_number().over(Window.partitionBy("field").orderBy("row_id"))).where("i <= 10").drop("i")


@_query()
def tuning_pairs(spark, d):
    """Prompts and answers of doctors' entries as one record each, joined by key."""
    e = _entries(spark, d).where("entry_type = 'DOC'").select("row_id", "full_text")
    answers = _doctors(spark, d).select("row_id", F.to_json(F.struct("name", "schools", "address", "office")).alias("answer"))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.array(F.struct(F.col(c).alias("text"))).alias("parts"))
    met = e.join(answers, "row_id")
    return met.select("row_id", F.to_json(F.struct(F.array(turn("user", "full_text"), turn("model", "answer")).alias("contents"))).alias("record"))


@_query(f"""select line_id, case when conf < 0.87 then upper(text) else text end as text, case when conf < 0.87 then 1.0 else conf end as conf from {_L}""")
def manual_corrections(spark, d):
    """Texts given by a reviewer (here: in capitals, for the least certain lines) put in place."""
    lines = _lines(spark, d)
    given = lines.where("conf < 0.87").select("line_id", F.upper("text").alias("text"))
    return tables.corrected(lines, given, "line_id").select("line_id", "text", "conf")


@_query()
def quality_findings(spark, d):
    """All checks between the steps."""
    return quality.all_checks(_lines(spark, d), _entries(spark, d), _cities(spark, d), _doctors(spark, d))


_SCH = "trim(split_part(schools, ',', 1))"
_STATE = f"coalesce(upper(nullif(regexp_extract({_SCH}, '(?s)^(.*)\\.([^.]*)$', 1), '')), 'NA')"
_NO = f"coalesce(nullif(regexp_extract({_SCH}, '(?s)^(.*)\\.([^.]*)$', 2), ''), 'NA')"
_GRAD = "regexp_replace(trim(split_part(schools, ',', 2)), '^[''\"]+|[''\"]+$', '', 'g')"
_WIDE = {
    **dict.fromkeys(("unique.id.normed", "unique.id"), "upper(publication) || '_' || substr(entry_id, 6)"),
    "physician.name": "x.name", **dict.fromkeys(("race.black", "race.black.prob"), "coalesce(col, false)::int"),
    **dict.fromkeys(("orig.state", "corr.place.state", "orig.place.state"), "upper(publication)"),
    "orig.city": "coalesce(c.name, '')", "orig.county": "coalesce(c.county_name, '')", "school.state.edit": _STATE, "school.number": _NO, "school.state": _STATE,
    "graduation.date": f"coalesce(({_YEAR.format(y=_GRAD, p=18)})::varchar, '')", "ama.member": "coalesce(ama_member, false)::int",
    "license.date": _YEAR.format(y="trim(license_year)", p=18), "not.in.practice": "coalesce(not_in_practice, false)::int", "match.type": "'direct_extraction'",
    "school.code": f"case when {_STATE} <> 'NA' and {_NO} <> 'NA' then {_STATE} || '.' || {_NO} else 'NA' end", **dict.fromkeys(("school.black", "school.fraudulent"), "null::varchar"),
    "birth.date": f"coalesce(({_YEAR.format(y='trim(birth_year)', p=18)})::varchar, '')", "ama.fellow": "coalesce(ama_fellow, false)::int", "address": "address",
    "office.address": "office", "hours": "'=\"' || translate(hours, ';', ':') || '\"'", "society.memberships": "societies", "specialties": "translate(specialty, '★', '*')",
    "medical.corps": "case military when '▼' then 'Army Reserve' when '▼G' then 'National Guard' when '▼N' then 'Navy Reserve' else military end", "misc.info": "other_info",
}
_NAMES = (
    "unique.id.normed unique.id physician.name race.black race.black.prob orig.state corr.place.state orig.place.state orig.city orig.county linked.county.name "
    "linked.county.GISJOIN2 linked.county.ICPSRST linked.county.ICPSRCTY school.state.edit school.number graduation.date ama.member license.date not.in.practice doc.lat doc.lon "
    "match.source match.type school.code school.name school.city school.state school.black school.fraudulent school.lat school.lon school.dist.km birth.date ama.fellow address "
    "office.address hours society.memberships specialties medical.corps misc.info"
).split()


@_query(f"""with c as (select entry_id as eid, min(name) as name, min(county_name) as county_name from {_C} group by entry_id)
  select {", ".join(f'''{_WIDE.get(n, "''")} as "{n}"''' for n in _NAMES)} from {_D} x left join c on c.eid = x.city_id""")
def export_table(spark, d):
    assert list(export_columns()) == _NAMES
    return export_wide(_doctors(spark, d), _cities(spark, d))
