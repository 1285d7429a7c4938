"""Ordered carry-forward: every row gets the last parent before it, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(df: DataFrame, order: str, carried: Mapping[str, Column], block: str | None, reset: bool = False) -> DataFrame:
    """`df` with, for each name in `carried`, the last non-null value of its column in rows up to this one.

    order: a unique column that gives the order of all rows. block: a column whose values stand together in
    that order, such as the publication, or None. With a block, rows are filled within their block; what a
    block is left with goes to the next ones through a summary of one row per block, so that the only window
    over everything has as many rows as there are blocks. reset: begin anew with each block. Without a block,
    the rows are cut into ranges of the order instead, which stand together whatever they hold.

    Null values of the order come first; rows of one value in arbitrary order.
    """
    made = df.select("*", *(c.alias(f"_c_{n}") for n, c in carried.items()))
    if block is None:
        spark = df.sparkSession
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        cuts = df.approxQuantile(order, [k / parts for k in range(1, parts)], 0.01) if parts > 1 else []
        bound = F.array(*(F.lit(c) for c in sorted(set(cuts)))) if cuts else F.array().cast("array<double>")
        made = made.withColumn("_block", F.size(F.filter(bound, lambda b: b < F.col(order))))
        key, reset = "_block", False
    else:
        key = block
    local = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = made.select("*", *(F.last(f"_c_{n}", ignorenulls=True).over(local).alias(f"_l_{n}") for n in carried))
    if not reset:
        place = F.col(order)
        summary = made.groupBy(F.col(key).alias("_key")).agg(
            F.min(place).alias("_at"),
            *(F.max_by(F.col(f"_c_{n}"), F.when(F.col(f"_c_{n}").isNotNull(), place)).alias(f"_e_{n}") for n in carried),
        )
        before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        entering = summary.select("_key", *(F.last(f"_e_{n}", ignorenulls=True).over(before).alias(f"_b_{n}") for n in carried))
        filled = filled.join(entering, F.col(key).eqNullSafe(F.col("_key")), "left")
        values = {n: F.coalesce(F.col(f"_l_{n}"), F.col(f"_b_{n}")) for n in carried}
    else:
        values = {n: F.col(f"_l_{n}") for n in carried}
    return filled.select(*(F.col(c) for c in df.columns if c not in carried), *(v.alias(n) for n, v in values.items()))


def split_entries(entries: DataFrame, order: str = "row_id", kind: str = "entry_type", reset: bool = False) -> tuple[DataFrame, DataFrame]:
    """(cities with their state_name, doctors with their city_id) of entries in reading order, which have
    `publication`, `entry_id` and `full_text`. Other entries are left out. With `reset` parents are not
    carried into the next publication; without, rows are cut into even ranges of the order, so that a
    publication of any size is spread."""
    parents = {
        "state_name": F.when(F.col(kind) == "STATE", F.col("full_text")),
        "city_id": F.when(F.col(kind) == "CITY", F.col("entry_id")),
    }
    full = carry_forward(entries, order, parents, "publication" if reset else None, reset)
    return full.where(F.col(kind) == "CITY").drop("city_id"), full.where(F.col(kind) == "DOC").drop("state_name")
