"""Differences between two copies of one table: rows missing on a side and fields that differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.runtime import SENT, cut

#: Characters dropped around a string before it is compared: blank, tab and line ends.
OUTER = " \t\r\n"


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _text(column: Column) -> Column:
    return F.coalesce(F.btrim(column.cast("string"), F.lit(OUTER)), F.lit(""))


def _number(column: Column) -> Column:
    """Numbers in one written form; what is no number stays text, so that it differs from any number."""
    text = _text(column)
    return F.coalesce(text.try_cast("decimal(38,10)").cast("string"), text)


def copy_differences(
    left: DataFrame,
    right: DataFrame,
    key: str,
    version: str | None = None,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """One row (key_id, field, kind) per difference between the copies `left` (a) and `right` (b).

    kind is `missing_in_a` or `missing_in_b` with field `*`, or `differs` with the name of the field.
    Compared are the columns that both sides have, but the key, `version` and those in `ignore`; columns
    of one side only are no difference. Per key the row with the greatest `version` counts (a null version
    is least; among equal versions, and without `version`, the row with the greatest fingerprint). A field
    that is a number on either side is compared as a number, others as text without outer blanks, tabs and
    line ends; null equals the empty string. A null key matches no key: rows without one are a multiset on
    each side, of which each row that the other side has less often is reported as missing there, as often as
    it is missing. Empty tables are fine.

    Plan: rows are told apart by fingerprints of 128 bits of their normalised fields, so that only keys,
    versions and fingerprints are shuffled, one row per key and side and task. EXCEPT ALL is taken in both
    directions at once, as signed counts of (key, fingerprint), and the two residues are full-joined by key.
    The fields are then fetched, in a second reading, for the keys whose rows differ, and for these only; these keys
    are sent to all tasks if there are few, and joined by a shuffle else.
    Rows without a key are spread by their fingerprints.
    """
    shared = [c for c in left.columns if c in set(right.columns) and c not in {key, version, *ignore}]
    kinds = {c: (left.schema[c].dataType, right.schema[c].dataType) for c in shared}
    names = [f"f{i}" for i in range(len(shared))]

    def side(df: DataFrame) -> DataFrame:
        fields = [(_number if any(map(_is_number, kinds[c])) else _text)(df[c]).alias(n) for c, n in zip(shared, names)]
        when = df[version] if version else F.lit(None).cast("string")
        rows = df.select(df[key].alias("key_id"), when.alias("v"), *fields)
        return rows.select("*", *(F.xxhash64(F.lit(seed), *names).alias(f"h{seed}") for seed in (1, 2)))

    a, b = side(left), side(right)
    print_of = F.struct("h1", "h2")
    marked = [
        df.select("key_id", (F.struct("v", print_of.alias("h")) if df is a else F.lit(None)).alias("a"), (F.struct("v", print_of.alias("h")) if df is b else F.lit(None)).alias("b"))
        for df in (a, b)
    ]
    counting = marked[0].unionByName(marked[1]).where("key_id is not null").groupBy("key_id").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    each = F.array(*(F.struct(F.lit(sign).alias("sign"), F.col(f"{c}.h").alias("h")) for c, sign in (("a", 1), ("b", -1))))
    signed = counting.select("key_id", F.explode(each).alias("s")).where("s.h is not null")
    counted = signed.groupBy("key_id", F.col("s.h").alias("h")).agg(F.sum("s.sign").alias("n"))
    only_a = counted.where("n > 0").select(F.col("key_id"), F.col("h").alias("a"))
    only_b = counted.where("n < 0").select(F.col("key_id").alias("key_b"), F.col("h").alias("b"))
    joined = only_a.join(only_b, F.col("key_id") == F.col("key_b"), "full_outer")
    residues = cut(joined.select(F.coalesce("key_id", "key_b").alias("key_id"), "a", "b"))

    without = a.select("h1", "h2", F.lit(1).alias("sign"), "key_id").unionByName(b.select("h1", "h2", F.lit(-1).alias("sign"), "key_id")).where("key_id is null")
    unkeyed = without.groupBy("h1", "h2").agg(F.sum("sign").alias("n")).where("n <> 0")
    one_sided = residues.where("a is null or b is null").select("key_id", F.when(F.col("a").isNull(), "missing_in_a").otherwise("missing_in_b").alias("kind")).unionByName(
        unkeyed.select(F.lit(None).cast(residues.schema["key_id"].dataType).alias("key_id"), F.explode(F.array_repeat(F.when(F.col("n") < 0, "missing_in_a").otherwise("missing_in_b"), F.abs("n").cast("int"))).alias("kind"))
    )
    missing = one_sided.select("key_id", F.lit("*").alias("field"), "kind")
    if not shared:
        return missing

    changed = residues.where("a is not null and b is not null")
    few = changed.count() <= SENT

    def fetched(df: DataFrame, column: str) -> DataFrame:
        wanted = changed.select(F.col("key_id").alias("k_"), F.col(f"{column}.h1").alias("p1"), F.col(f"{column}.h2").alias("p2"))
        same = (F.col("key_id") == F.col("k_")) & (F.col("h1") == F.col("p1")) & (F.col("h2") == F.col("p2"))
        met = df.join(F.broadcast(wanted) if few else wanted, same, "left_semi")
        return met.groupBy("key_id").agg(F.max(F.struct(*names)).alias(column))

    both = fetched(a, "a").join(fetched(b, "b"), "key_id")
    fields = F.array_compact(F.array(*(F.when(F.col(f"a.{n}") != F.col(f"b.{n}"), F.lit(c)) for c, n in zip(shared, names))))
    return missing.unionByName(both.select("key_id", F.explode(fields).alias("field"), F.lit("differs").alias("kind")))
