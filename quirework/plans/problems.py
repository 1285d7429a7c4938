"""Queries of the general problems: copies, packed fields, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators.differences import copy_differences
from quirework.operators.packed import SCHOOL, SOCIETY, unpack_fields
from quirework.operators.references import Reference, Table, direct_orphans, orphan_cascade, orphan_report
from quirework.runtime import load

#: Table, key, columns that are no fields.
COPIES = (("classified_lines", "row_id", ("entry_id",)), ("text_differences", "diff_id", ()))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        copy_differences(
            load(spark, sf_dir, name), load(spark, sf_dir, f"{name}_b"), key, version="loaded_at", ignore=ignore
        ).select(F.lit(name).alias("table_name"), "key_id", "field", "kind")
        for name, key, ignore in COPIES
    ]
    return parts[0].unionByName(parts[1])


def p1_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_found(spark, sf_dir).groupBy("table_name", "field", "kind").agg(F.count("*").alias("n"))


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpack_fields(load(spark, sf_dir, "doc_entries"), "row_id", {"schools": SCHOOL, "societies": SOCIETY})


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(spark, sf_dir).where("n >= 2").select("row_id", "field", "pos", "val").distinct()


def p2_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _values(spark, sf_dir)
        .groupBy("field", "error")
        .agg(F.count("*").alias("n_values"), F.min("val").alias("example"))
    )


def _graph(spark: SparkSession, sf_dir: str) -> tuple[dict[str, Table], list[Reference]]:
    tables = {
        "classified_lines": Table(load(spark, sf_dir, "classified_lines"), "row_id", "entry_id", "loaded_at"),
        "city_entries": Table(load(spark, sf_dir, "city_entries"), "row_id", "entry_id", "loaded_at", "deleted_at"),
        "doc_entries": Table(load(spark, sf_dir, "doc_entries"), "row_id", "entry_id", "loaded_at"),
    }
    references = [
        Reference("doc_entries", "city_id", "city_entries"),
        Reference("city_entries", "entry_id", "classified_lines"),
    ]
    return tables, references


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The direct orphans, which the cascade starts from."""
    return orphan_cascade(*_graph(spark, sf_dir), rounds=0).select("table_name", "row_id", "reason", "period").distinct()


def p7_inherited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the fixpoint: references to records that are orphaned themselves, and how far away."""
    return orphan_cascade(*_graph(spark, sf_dir)).where("depth > 0").select("table_name", "row_id", "depth", "period").distinct()


def p7_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct_orphans(*_graph(spark, sf_dir)).groupBy("table_name", "reason").agg(F.count("*").alias("n"))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(orphan_cascade(*_graph(spark, sf_dir)))


QUERIES = {
    f.__name__: f for f in (p1_found, p1_summary, p2_found, p2_errors, p7_found, p7_inherited, p7_direct, p7_report)
}


def _latest(name: str, key: str, columns: str) -> str:
    return (
        f"(select {key} as key_id, {columns} from (select *, row_number() over (partition by {key} "
        f"order by loaded_at desc) as rn from {name}) where rn = 1)"
    )


def _text(c: str) -> str:
    return f"coalesce(trim({c}, chr(32) || chr(9) || chr(10) || chr(13)), '')"


def _copies_sql(name: str, key: str, numbers: list[str], texts: list[str]) -> str:
    cols = ", ".join(numbers + texts)
    a, b = _latest(name, key, cols), _latest(f"{name}_b", key, cols)
    per = [
        f"select j.key_id, '{c}' as field from j where in_a and in_b and "
        f"(try_cast(a_{c} as double) is distinct from try_cast(b_{c} as double))"
        for c in numbers
    ] + [f"select j.key_id, '{c}' as field from j where in_a and in_b and {_text(f'a_{c}')} <> {_text(f'b_{c}')}" for c in texts]
    both = ", ".join(f"a.{c} as a_{c}, b.{c} as b_{c}" for c in numbers + texts)
    return f"""
      with j as (select coalesce(a.key_id, b.key_id) as key_id, a.key_id is not null as in_a,
                        b.key_id is not null as in_b, {both}
                 from {a} a full join {b} b on a.key_id = b.key_id)
      select '{name}' as table_name, key_id, '*' as field,
             case when in_a then 'missing_in_b' else 'missing_in_a' end as kind
      from j where not (in_a and in_b)
      union all select '{name}', key_id, field, 'differs' from ({" union all ".join(per)})"""


_P1 = (
    "select * from ("
    + _copies_sql(
        "classified_lines", "row_id", ["page_number", "col_no", "x", "y", "width", "height"],
        ["publication", "entry_type", "full_text"],
    )
    + ") union all select * from ("
    + _copies_sql("text_differences", "diff_id", [], ["identifier", "text_in_context", "text_out_context"])
    + ")"
)

_DIRECT = """
  with child as (
    select 'doc_entries' as table_name, row_id, entry_id, city_id as ref, min(loaded_at) as arrival
    from doc_entries where city_id is not null group by all
    union all
    select 'city_entries', row_id, entry_id, entry_id, min(loaded_at) from city_entries
    where entry_id is not null group by all),
  parent as (
    select 'doc_entries' as table_name, entry_id as k, min(loaded_at) as came, bool_or(deleted_at is not null) as gone
    from city_entries group by all
    union all
    select 'city_entries', entry_id, min(loaded_at), false from classified_lines group by all),
  direct as (
    select c.table_name, c.row_id, c.entry_id,
           case when k is null then 'missing' when gone then 'deleted' when came > arrival then 'late' end as reason,
           strftime(arrival, '%Y-%m') as period
    from child c left join parent p on p.table_name = c.table_name and p.k = c.ref)"""

#: The values as a regular language, where no quote or bracket is malformed.
_VALUES = {
    "schools": r"Univ\. of [^;\"]*; Med\. Faculty,\s*''[0-9]{2}|[A-Z][A-Za-z]*\.?(?:[A-Z]\.)*\s?[0-9]{1,2}(?:\s*,\s*''[0-9]{2})?",
    "societies": r"[A-G]?[0-9]{1,2}",
}
_P2 = " union all ".join(
    f"""select distinct row_id, '{f}' as field, k::int as pos, regexp_replace(vs[k], '\\s', '', 'g') as val from (
      select row_id, vs, unnest(range(1, len(vs) + 1)) as k from (select row_id, regexp_extract_all({f}, '{p}') as vs from doc_entries where {f} is not null) where len(vs) >= 2)"""
    for f, p in _VALUES.items()
)

SQL = {
    "p1_found": _P1,
    "p2_found": _P2,
    "p1_summary": f"select table_name, field, kind, count(*) as n from ({_P1}) group by all",
    "p7_found": f"{_DIRECT} select table_name, row_id, reason, period from direct where reason is not null",
    "p7_direct": f"{_DIRECT} select table_name, reason, count(*) as n from direct where reason is not null group by all",
    "p7_inherited": f"""{_DIRECT.replace("with child", "with recursive child", 1)},
      fallen as (select table_name, row_id, entry_id, 0 as depth, period from direct where reason is not null
        union select c.table_name, c.row_id, c.entry_id, f.depth + 1, strftime(c.arrival, '%Y-%m') from child c join fallen f
          on f.entry_id = c.ref and f.table_name = case c.table_name when 'doc_entries' then 'city_entries' else 'classified_lines' end
        where not exists (select 1 from direct d where d.table_name = c.table_name and d.row_id = c.row_id and d.reason is not null))
      select table_name, row_id, min(depth) as depth, min(period) as period from fallen where depth > 0 group by all""",
    "p7_report": f"""{_DIRECT},
      heirs as (select 'doc_entries' as table_name, c.row_id, 'inherited' as reason, strftime(c.arrival, '%Y-%m') as period
                from child c where c.table_name = 'doc_entries'
                and c.ref in (select entry_id from direct where table_name = 'city_entries' and reason is not null)
                and c.row_id not in (select row_id from direct where table_name = 'doc_entries' and reason is not null))
      select table_name, period, reason, count(*) as direct, 0::bigint as inherited
      from direct where reason is not null group by all
      union all select table_name, period, reason, 0::bigint, count(*) from heirs group by all""",
}
