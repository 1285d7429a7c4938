"""Relational steps over keyed tables: resume, outer comparison, lookups, order, duplicates, gaps, batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.runtime import cut


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, (left[a].eqNullSafe(right[b]) for a, b in pairs))


def unfinished(inputs: DataFrame, finished: Sequence[DataFrame], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Input rows whose key is in none of the finished tables; keys keep their types, nulls are equal."""
    done = reduce(DataFrame.unionByName, [f.select(*(b for _, b in pairs)) for f in finished]).distinct()
    return inputs.join(done, _same(inputs, done, pairs), "left_anti")


def one_sided(left: DataFrame, right: DataFrame, keys: Sequence[str], reasons: tuple[str, str]) -> DataFrame:
    """Distinct keys that one side lacks, with the reason: reasons[0] if the right one does."""
    a = left.select(*keys).distinct().withColumn("_a", F.lit(True))
    b = right.select(*keys).distinct().withColumn("_b", F.lit(True))
    b2 = b.select(*(F.col(k).alias(f"_r_{k}") for k in keys), "_b")
    met = a.join(b2, reduce(lambda x, y: x & y, (a[k].eqNullSafe(b2[f"_r_{k}"]) for k in keys)), "full_outer")
    return met.where("_a is null or _b is null").select(
        *(F.when(F.col("_a"), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in keys),
        F.when(F.col("_b").isNull(), reasons[0]).otherwise(reasons[1]).alias("reason"),
    )


def look_up(df: DataFrame, key: str, table: DataFrame, table_key: str, columns: Mapping[str, str], default: str = "", unique: bool = False) -> DataFrame:
    """`df` with columns of a table, `default` where the key is not in it or is null. Of rows of one key the least
    counts; with `unique`, a key with differing rows is an error when the result is read. Spark broadcasts the
    table if it is small, and shuffles otherwise."""
    row = F.struct(*columns.values())
    one = table.groupBy(F.col(table_key).alias("_k")).agg(F.min(row).alias("_v"), F.max(row).alias("_w"))
    if unique:
        clash = F.raise_error(F.concat(F.lit(f"several rows of {table_key} "), F.col("_k").cast("string")))
        one = one.withColumn("_v", F.when(F.col("_v").eqNullSafe(F.col("_w")) | F.col("_k").isNull(), F.col("_v")).otherwise(clash))
    met = df.join(one, df[key] == one["_k"], "left")
    return met.select(*(df[c] for c in df.columns), *(F.coalesce(F.col(f"_v.{src}").cast("string"), F.lit(default)).alias(n) for n, src in columns.items()))


def counts_differ(left: DataFrame, right: DataFrame, keys: Sequence[str], counted: str) -> DataFrame:
    """Groups whose numbers of non-null `counted` differ, a group absent on a side counting 0."""
    a = left.groupBy(*keys).agg(F.count(counted).alias("count_in"))
    b = right.groupBy(*(F.col(k).alias(f"_r_{k}") for k in keys)).agg(F.count(counted).alias("count_out"))
    met = a.join(b, reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"_r_{k}"]) for k in keys)), "full_outer")
    n_in, n_out = F.coalesce("count_in", F.lit(0)), F.coalesce("count_out", F.lit(0))
    return met.where(n_in != n_out).select(*(F.coalesce(k, f"_r_{k}").alias(k) for k in keys), n_in.alias("count_in"), n_out.alias("count_out"))


def sorted_distinct(parts: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """All parts together, whole rows once, in order."""
    return reduce(DataFrame.unionByName, parts).distinct().orderBy(*order)


def repeated_ids(df: DataFrame, key: str) -> DataFrame:
    """Identifiers that stand in several rows, and in how many."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by `order`, chosen by a map-side aggregate; ties by the rest of the row."""
    rest = [c for c in df.columns if c not in order and c not in keys]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_f"))
    return first.select(*(F.col(c) if c in keys else F.col(f"_f.{c}").alias(c) for c in df.columns))


def missing_numbers(df: DataFrame, key: str, group: Sequence[str] = ()) -> DataFrame:
    """Runs (group, first_missing, last_missing) absent between the numbers that end the identifiers;
    identifiers without digits at the end are passed over."""
    n = F.regexp_extract(key, "([0-9]+)$", 1).try_cast("bigint")
    numbers = df.select(*group, n.alias("n")).where("n is not null").distinct()
    if group:
        parts, keys = numbers, list(group)
    else:
        # Without a group, ranges of the numbers: each begins behind the last number of the one before.
        parts, keys = _ranged(numbers, ["n"]), ["_part"]
        ends = parts.groupBy("_part").agg(F.max("n").alias("n")).select((F.col("_part") + 1).alias("_part"), "n")
        parts = parts.unionByName(ends)
    gaps = parts.withColumn("next", F.lead("n").over(Window.partitionBy(*keys).orderBy("n"))).where("next > n + 1")
    return gaps.select(*group, (F.col("n") + 1).alias("first_missing"), (F.col("next") - 1).alias("last_missing"))


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`df` in ranges of an order, numbered without a gap in `_part`, written once so that the ranges stay."""
    laid = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    # One row for each task.
    numbers = laid.select("_p").distinct().withColumn("_part", F.row_number().over(Window.orderBy("_p")))
    return laid.join(F.broadcast(numbers), "_p").drop("_p")


def in_batches(df: DataFrame, order: Sequence[str], size: int, within: Sequence[str] = ()) -> DataFrame:
    """`df` with batch_id, counting from 0, of `size` rows each in order. Without groups the rows are numbered in
    ranges of the order, each going on from the rows of those before, so that no task holds them all."""
    if within:
        return df.withColumn("batch_id", F.floor((F.row_number().over(Window.partitionBy(*within).orderBy(*order)) - 1) / size).cast("bigint"))
    laid = _ranged(df, order)
    counts = laid.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row for each task.
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    row = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return laid.join(F.broadcast(before), "_part").withColumn("batch_id", F.floor((F.col("_before") + row - 1) / size).cast("bigint")).drop("_part", "_before")


def side_by_side(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str], within: Sequence[str]) -> DataFrame:
    """The i-th row of each group on the left beside the i-th on the right, by the given orders; rows without
    a partner stay, with nulls. Columns of the right get the prefix r_."""
    a = left.withColumn("_i", F.row_number().over(Window.partitionBy(*within).orderBy(*left_order)))
    b = right.withColumn("_j", F.row_number().over(Window.partitionBy(*within).orderBy(*right_order)))
    b = b.select(*(F.col(c).alias(f"r_{c}") for c in right.columns), "_j")
    met = a.join(b, reduce(lambda x, y: x & y, [a["_i"] == b["_j"], *(a[k].eqNullSafe(b[f"r_{k}"]) for k in within)]), "full_outer")
    return met.withColumn("position", F.coalesce("_i", "_j")).drop("_i", "_j")


def corrected(lines: DataFrame, corrections: DataFrame, key: str, text: str = "text", conf: str = "conf") -> DataFrame:
    """Lines with the texts that a reviewer gave; a corrected line has confidence 1."""
    fix = corrections.groupBy(F.col(key).alias("_k")).agg(F.max(text).alias("_t"))
    met = lines.join(fix, lines[key] == fix["_k"], "left")
    given = F.col("_k").isNotNull()
    return met.select(*(
        F.when(given, F.col("_t")).otherwise(lines[c]).alias(c) if c == text
        else F.when(given, F.lit(1.0)).otherwise(lines[c]).alias(c) if c == conf else lines[c]
        for c in lines.columns
    ))


def sample_exact(df: DataFrame, n: int, key: Sequence[str], seed: str) -> DataFrame:
    """n rows (or all, if fewer), the same for the same seed: those of the least hashes of key and seed."""
    mark = F.md5(F.concat_ws("\x1f", *(F.col(k).cast("string") for k in key), F.lit(seed)))
    return df.withColumn("_m", mark).orderBy("_m", *key).limit(n).drop("_m")
