"""Differences between two texts, character by character, with their surroundings."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.clean import pad_to

#: Characters of context on each side. Fixed value.
CONTEXT = 10
CHANGE = "array<struct<change:string,text_in:string,text_out:string,before_in:string,after_in:string,before_out:string,after_out:string>>"


def _changes(a: str, b: str, junk: bool) -> list[dict[str, str]]:
    out = []
    for tag, i, j, k, m in SequenceMatcher(None, a, b, autojunk=junk).get_opcodes():
        if tag != "equal":
            out.append({
                "change": tag, "text_in": a[i:j], "text_out": b[k:m],
                "before_in": a[max(0, i - CONTEXT) : i], "after_in": a[j : j + CONTEXT],
                "before_out": b[max(0, k - CONTEXT) : k], "after_out": b[m : m + CONTEXT],
            })
    return out


def text_changes(pairs: DataFrame, key: str, text_in: str, text_out: str, junk: bool = True) -> DataFrame:
    """One row per change between the two texts of a row: its key, ordinal, kind (replace, delete, insert), the
    changed parts and their surroundings. Equal texts never leave the JVM; null counts as empty. With `junk`, as printed
    reports have it, characters that make up over a hundredth of a text of 200 characters or more are not matched
    by themselves; without it, all are."""
    a, b = F.coalesce(F.col(text_in), F.lit("")), F.coalesce(F.col(text_out), F.lit(""))
    unequal = pairs.select(F.col(key).alias("key"), a.alias("a"), b.alias("b")).where("a <> b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("change", "text_in", "text_out", "before_in", "after_in", "before_out", "after_out")
        for batch in batches:
            at, no, cols = [], [], {n: [] for n in names}
            for k, (x, y) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                for i, c in enumerate(_changes(x, y, junk), 1):
                    at.append(k)
                    no.append(i)
                    for n in names:
                        cols[n].append(c[n])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at, pa.int64())), pa.array(no, pa.int32()), *(pa.array(cols[n], pa.string()) for n in names)],
                ["key", "change_no", *names],
            )

    kind = pairs.schema[key].dataType.simpleString()
    return unequal.mapInArrow(
        run,
        f"key {kind}, change_no int, change string, text_in string, text_out string, before_in string, after_in string, before_out string, after_out string",
    )


def in_braces(before: Column, changed: Column, other: Column, after: Column) -> Column:
    """A change shown in its surroundings, in braces, padded to the length of its counterpart."""
    return F.concat(before, F.lit("{"), pad_to(changed, other), F.lit("}"), after)


def change_summary(changes: DataFrame) -> DataFrame:
    """Each kind of change, how often it occurs, and the first example by key and ordinal."""
    first = F.min_by(F.struct("text_in", "text_out"), F.struct("key", "change_no"))
    return changes.groupBy("change").agg(F.count("*").alias("n"), first.alias("f")).select("change", "n", F.col("f.text_in").alias("example_in"), F.col("f.text_out").alias("example_out"))


def dropped_pairs(log: Column) -> Column:
    """array<struct<identifier, text_in, text_out>> of the reports of dropped lines in a log, each of which
    begins a line with ERROR."""
    pattern = r"(?s)(?:\A|(?<=\n))ERROR:(?:(?!\nERROR:).)*?dropped for\s*((?:(?!\nERROR:).)*?)\s*\((?:(?!\nERROR:).)*?:\s*text_in:\s*((?:(?!\nERROR:).)*?)\ntext_out:\s*([^\n]*)(?:\n|\z)"
    take = [F.transform(F.regexp_extract_all(log, F.lit(pattern), F.lit(k)), lambda x: F.btrim(x, F.lit(" \t\r\n"))) for k in (1, 2, 3)]
    return F.transform(F.arrays_zip(take[0].alias("a"), take[1].alias("b"), take[2].alias("c")), lambda z: F.struct(z["a"].alias("identifier"), z["b"].alias("text_in"), z["c"].alias("text_out")))
