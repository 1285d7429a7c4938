"""Grouping of printed lines into entries: local decisions for every line, then one fold per column."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.grammar import CITY, DOC_FULL, DOC_TO_ADDR, DOC_TO_OFF, STATE, UNKNOWN, line_type

FINAL = (STATE, CITY, DOC_FULL)
PERHAPS = (DOC_TO_ADDR, DOC_TO_OFF)


#: The end of a line that breaks a word in small letters, and how a word goes on.
BROKEN, GOES_ON = r"(?<=[a-zà-öø-ÿ])-\s*$", r"^\s*[a-zà-öø-ÿ]"


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lines in order, with `ordinal` counting from 1 in each column and `size`, those reached by starting at
    the first of a column and going on by each one's size; `ordinal` then counts these. Nothing but the next
    ordinal is carried from batch to batch."""
    due, n = 1, 0
    for b in batches:
        at, counted = [], []
        for k, (o, size) in enumerate(zip(b.column("ordinal").to_pylist(), b.column("n_lines").to_pylist())):
            if o == 1:
                due, n = 1, 0
            if o == due:
                due, n = o + size, n + 1
                at.append(k)
                counted.append(n)
        taken = b.take(pa.array(at, pa.int64()))
        yield taken.set_column(taken.schema.get_field_index("ordinal"), "ordinal", pa.array(counted, pa.int32()))


def group_entries(
    lines: DataFrame,
    column: Sequence[str] = ("pub", "page", "col"),
    order: str = "line_no",
    text: str = "text",
    most: int = 4,
    kind_of: Callable[[Column], Column] = line_type,
    box: Sequence[str] | None = ("x", "y", "width", "height"),
    mend: bool = False,
) -> DataFrame:
    """Entries (column keys, ordinal, n_lines, entry_type, full_text, box) of the lines of each column.

    For each line the prefixes of up to `most` lines from it are classified. The first prefix of a final kind
    is an entry; else, if a prefix may be complete and the next one is neither final nor there, the shorter
    one is; else, if the last prefix may be complete, it is; else the line alone is UNKNOWN. The entries are
    then taken from the first line on, each starting behind the one before, so that every line belongs to
    exactly one entry. Null texts count as empty lines. With `mend`, a word in small letters that is broken
    at the end of a line is joined when the next one goes on in small letters; else lines are joined by blanks.

    Plan: one shuffle by column, sorted once for the windows and for the walk through the lines, which holds one
    batch whatever the size of a column. What an entry is made of stands beside its first line already, so
    nothing is shuffled or joined again.
    """
    keys = list(column)
    window = Window.partitionBy(*keys).orderBy(order)
    own = lines.withColumn("_t", F.coalesce(F.col(text), F.lit(""))).withColumn("ordinal", F.row_number().over(window))
    boxes = list(box) if box else []
    edges = [] if not box else [("x", F.col(boxes[0]), F.least), ("y", F.col(boxes[1]), F.least), ("_r", F.col(boxes[0]) + F.col(boxes[2]), F.greatest), ("_b", F.col(boxes[1]) + F.col(boxes[3]), F.greatest)]
    ahead = lambda c, k: F.lead(c, k).over(window) if k else c
    own = own.select(
        *keys, "ordinal", *(ahead(F.col("_t"), k).alias(f"_l{k}") for k in range(most)), *(ahead(c, k).alias(f"_{n}{k}") for n, c, _ in edges for k in range(most))
    )
    # concat, unlike concat_ws, is null as soon as a line is missing.
    for k in range(most):
        if not k:
            joined = F.col("_l0")
        else:
            before, line = F.col(f"_p{k - 1}"), F.col(f"_l{k}")
            joined = F.concat(before, F.lit(" "), line)
            if mend:
                joined = F.when(before.rlike(BROKEN) & line.rlike(GOES_ON), F.concat(F.regexp_replace(before, BROKEN, ""), F.ltrim(line))).otherwise(joined)
        own = own.withColumn(f"_p{k}", joined)
    # A longer prefix is classified only where the shorter ones leave it open.
    for k in range(most):
        kind = kind_of(F.col(f"_p{k}"))
        if k:
            seen = F.col(f"_k{k - 1}")
            decided = seen.isNull() | seen.isin(*FINAL)
            if k > 1:
                decided = decided | (F.col(f"_k{k - 2}").isin(*PERHAPS) & ~seen.isin(*FINAL))
            kind = F.when(~decided, kind)
        own = own.withColumn(f"_k{k}", kind)
    size = kind = None
    for k in range(most):
        this = F.col(f"_k{k}")
        for holds, n, name in ((this.isin(*FINAL), k + 1, this), *(((F.col(f"_k{k - 1}").isin(*PERHAPS), k, F.lit(DOC_FULL)),) if k else ())):
            size = F.when(holds, n) if size is None else size.when(holds, n)
            kind = F.when(holds, name) if kind is None else kind.when(holds, name)
    last = F.col(f"_k{most - 1}").isin(*PERHAPS)
    sized = own.withColumn("n_lines", size.when(last, most).otherwise(1)).withColumn("entry_type", kind.when(last, DOC_FULL).otherwise(UNKNOWN))
    by_size = lambda of: F.element_at(F.array(*(of(k) for k in range(most))), F.col("n_lines"))
    out = [by_size(lambda k: F.col(f"_p{k}")).alias("full_text")]
    if box:
        edge = {n: by_size(lambda k, n=n, pick=pick: pick(*(F.col(f"_{n}{j}") for j in range(k + 1))) if k else F.col(f"_{n}0")) for n, _, pick in edges}
        out += [edge["x"].alias("x"), edge["y"].alias("y"), (edge["_r"] - edge["x"]).alias("width"), (edge["_b"] - edge["y"]).alias("height")]
    ready = sized.select(*keys, "ordinal", "n_lines", "entry_type", *out)
    return ready.mapInArrow(_starts, ready.schema)


def spaced_peaks(values: Column, gap: Column | int | float) -> Column:
    """Of an array of numbers, in ascending order, each that is more than `gap` above the last one taken."""
    space = F.lit(gap) if not isinstance(gap, Column) else gap
    start = F.filter(values, lambda _: F.lit(False))
    return F.aggregate(
        F.array_sort(values), start,
        lambda acc, v: F.when((F.size(acc) == 0) | (v > F.element_at(acc, -1) + space), F.concat(acc, F.array(v))).otherwise(acc),
    )


def box_union(df: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y", width: str = "width", height: str = "height") -> DataFrame:
    """The smallest box around the boxes of each key."""
    return df.groupBy(*keys).agg(
        F.min(x).alias("x"), F.min(y).alias("y"),
        (F.max(F.col(x) + F.col(width)) - F.min(x)).alias("width"), (F.max(F.col(y) + F.col(height)) - F.min(y)).alias("height"),
    )
