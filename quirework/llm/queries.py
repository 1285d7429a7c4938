"""Queries of the text problems, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.addresses import members, same_forms, same_locations
from quirework.llm.leaks import PASSAGE, edited_copies, leaks
from quirework.llm.lookalikes import odd_rows, one_forms
from quirework.llm.mixture import mixture
from quirework.llm.places import locate
from quirework.llm.scan_noise import entry_noise, learn, line_noise, mended, noise_kinds
from quirework.llm.truncation import rate_texts, scored, thresholds, train
from quirework.runtime import load


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, entries = load(spark, sf_dir, "ocr_lines"), load(spark, sf_dir, "classified_lines")
    model = learn(lines, entries)
    return (
        noise_kinds(line_noise(lines, model))
        .select(F.lit("ocr_lines").alias("table_name"), "key_id", "kind")
        .unionByName(
            noise_kinds(entry_noise(entries, model)).select(F.lit("classified_lines").alias("table_name"), "key_id", "kind")
        )
    )


def p3_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each entry's latest version as continuous readable text."""
    entries = load(spark, sf_dir, "classified_lines")
    return mended(entries, learn(load(spark, sf_dir, "ocr_lines"), entries))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locate(load(spark, sf_dir, "city_entries"), load(spark, sf_dir, "gazetteer"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).select("row_id", "place_id").distinct()


def p4_how(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cities found their place by a mention, by similarity, or not at all."""
    return _places(spark, sf_dir).groupBy("how").agg(F.countDistinct("row_id").alias("n_cities"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_locations(load(spark, sf_dir, "doc_entries"))


def p6_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each form of address of a town, its records, and how many other forms denote the same location."""
    found = members(load(spark, sf_dir, "doc_entries"), "row_id", "city_id", ("address", "office"))
    pairs = same_forms(found)
    ends = pairs.select("town", F.explode(F.array("form_a", "form_b")).alias("form"))
    links = ends.groupBy("town", "form").agg(F.count("*").alias("n_links"))
    counts = found.groupBy("town", "form").agg(F.count("*").alias("n_records"))
    return counts.join(links, ["town", "form"], "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = odd_rows(load(spark, sf_dir, "ocr_lines"), "line_id", "text")
    entries = odd_rows(load(spark, sf_dir, "classified_lines"), "row_id", "full_text", "loaded_at")
    return lines.select(F.lit("ocr_lines").alias("table_name"), "key_id").unionByName(
        entries.select(F.lit("classified_lines").alias("table_name"), "key_id")
    )


def p5_one_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of both tables in one form, and whether it held odd characters."""
    lines = one_forms(load(spark, sf_dir, "ocr_lines"), "line_id", "text", "scanned_at")
    entries = one_forms(load(spark, sf_dir, "classified_lines"), "row_id", "full_text", "loaded_at")
    return lines.select(F.lit("ocr_lines").alias("table_name"), "*").unionByName(
        entries.select(F.lit("classified_lines").alias("table_name"), "*")
    )


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).where(F.col("run_words") >= PASSAGE).select("doc_id", "item_id")


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that leaked, into how many documents, and the longest passage found."""
    found = _leaks(spark, sf_dir).where(F.col("run_words") >= PASSAGE)
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("run_words").alias("longest"))


def p8_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an edited or paraphrased copy of an item, and how much of it."""
    found = edited_copies(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))
    return found.select("doc_id", "item_id", "run_words", F.round("share", 6).alias("share"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))[1]


def _cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(train(load(spark, sf_dir, "documents")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cuts(spark, sf_dir).where("cut").select("doc_id", "source").distinct()


def p10_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source cuts its texts."""
    return (
        _cuts(spark, sf_dir)
        .groupBy("source")
        .agg(F.count("*").alias("n_docs"), F.count_if("cut").alias("n_cut"))
        .withColumn("cut_share", F.col("n_cut") / F.col("n_docs"))
    )


def p10_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of cut texts fitted for each language and column, and the threshold on the log-odds."""
    model = train(load(spark, sf_dir, "documents"))
    return thresholds(rate_texts(model), model, "text")


QUERIES = {
    f.__name__: f
    for f in (
        p3_found, p3_text, p4_found, p4_how, p5_found, p5_one_form, p6_found, p6_links, p8_found, p8_items, p8_edited, p9_mixture, p9_shares, p10_found, p10_sources, p10_thresholds,
    )
}

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_P8 = f"""
  with d as (select doc_id, {_WORDS} as w from documents), i as (select item_id, {_WORDS} as w from eval_items),
  dg as (select distinct doc_id, array_to_string(w[k:k+11], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from d)),
  ig as (select distinct item_id, array_to_string(w[k:k+11], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 10)) as k from i))
  select distinct doc_id, item_id from dg join ig using (g)"""

#: The characters in question as ranges, and the normal form of single letters, instead of tables.
_ODD = (
    r"[\x{FF01}-\x{FF5E}\x{FFE0}-\x{FFE6}\x{1D400}-\x{1D7FF}\x{FB00}-\x{FB06}"
    r"\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}\x{AD}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}]"
)
_LATEST = "(select row_id, full_text from (select *, row_number() over (partition by row_id order by loaded_at desc) as rn from classified_lines) where rn = 1)"


def _is_odd(text: str) -> str:
    return f"regexp_matches({text}, '{_ODD}') or regexp_matches({text}, '[\\p{{Cyrillic}}]|[\\p{{Greek}}]') or nfc_normalize({text}) <> {text}"


_P5 = f"""
  select distinct 'ocr_lines' as table_name, line_id as key_id from ocr_lines where {_is_odd("text")}
  union all select 'classified_lines', row_id from {_LATEST} where {_is_odd("full_text")}"""

SQL = {"p5_found": _P5, "p8_found": _P8}
