"""Checks between the steps of the pipeline, all of one form: check, severity, place, expected, observed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.operators.statistics import column_deviation
from quirework.operators.tables import counts_differ, missing_numbers, one_sided, repeated_ids

#: Bounds of the checks. Fixed values.
COLUMNS_PER_PAGE, MOST_DEVIATION, HEIGHT_SHARE = 3, 8, 0.3
LEAST_DOCTORS, MOST_DOCTORS = 0.69, 0.94
COLUMN = ("pub", "page", "col")


def _finding(df: DataFrame, check: str, severity: str, place: Column, expected: Column, observed: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), place.cast("string").alias("place"),
        expected.cast("string").alias("expected"), observed.cast("string").alias("observed"),
    )


def _at(*columns: str) -> Column:
    return F.concat_ws(".", *(F.col(c).cast("string") for c in columns))


def columns_per_page(lines: DataFrame) -> DataFrame:
    """Pages with another number of columns than printed."""
    n = lines.groupBy("pub", "page").agg(F.countDistinct("col").alias("n")).where(F.col("n") != COLUMNS_PER_PAGE)
    return _finding(n, "columns_per_page", "error", _at("pub", "page"), F.lit(COLUMNS_PER_PAGE), F.col("n"))


def uneven_columns(lines: DataFrame, key: str = "line_id") -> DataFrame:
    """Pages on which a column has far more or fewer lines than the mean."""
    once = lines.select(*COLUMN, key).distinct()
    far = column_deviation(once, ("pub", "page"), "col", key).where(F.col("deviation") > MOST_DEVIATION)
    return _finding(far, "uneven_columns", "error", _at("pub", "page"), F.lit(MOST_DEVIATION), F.round("deviation", 1))


def line_heights(lines: DataFrame, key: str = "line_id") -> DataFrame:
    """Columns whose height per line is far from the mean of all; columns without lines are left out."""
    per = lines.groupBy(*COLUMN).agg(
        F.floor((F.max(F.col("y") + F.col("height")) - F.min("y")) / F.nullif(F.countDistinct(key), F.lit(0))).alias("px")
    )
    mean = per.agg(F.avg("px")).first()[0] or 0.0
    far = per.where(F.abs(F.col("px") - mean) > HEIGHT_SHARE * mean)
    return _finding(far, "line_heights", "warning", _at(*COLUMN), F.lit(round(mean, 1)), F.col("px"))


def column_coverage(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """Columns that only the lines or only the entries have."""
    named = entries.select(F.col("publication").alias("pub"), F.col("page_number").alias("page"), F.col("col_no").alias("col"))
    off = one_sided(lines, named, COLUMN, ("missing from classified", "added in classified"))
    return _finding(off, "column_coverage", "error", _at(*COLUMN), F.lit("both"), F.col("reason"))


def one_state(entries: DataFrame) -> DataFrame:
    """Publications without exactly one state heading, those with none among them."""
    n = entries.groupBy("publication").agg(F.count_if(F.col("entry_type") == "STATE").alias("n")).where("n <> 1")
    return _finding(n, "one_state", "error", F.col("publication"), F.lit(1), F.col("n"))


def unknown_entries(entries: DataFrame) -> DataFrame:
    """Publications with entries of no known kind but the line that counts the physicians."""
    odd = (F.col("entry_type") == "UNKNOWN") & ~F.coalesce(F.col("full_text").startswith("NUMBER OF"), F.lit(False))
    n = entries.groupBy("publication").agg(F.count_if(odd).alias("n")).where("n > 0")
    return _finding(n, "unknown_entries", "error", F.col("publication"), F.lit(0), F.col("n"))


def doctor_share(entries: DataFrame) -> DataFrame:
    """Publications in which doctors are an unusual share of doctors and cities."""
    share = entries.where(F.col("entry_type").isin("DOC", "CITY")).groupBy("publication").agg(
        F.avg((F.col("entry_type") == "DOC").cast("double")).alias("share")
    )
    odd = share.where((F.col("share") > MOST_DOCTORS) | (F.col("share") < LEAST_DOCTORS))
    return _finding(odd, "doctor_share", "warning", F.col("publication"), F.lit(f"{LEAST_DOCTORS}-{MOST_DOCTORS}"), F.round("share", 4))


def repeated(parsed: DataFrame, key: str = "entry_id") -> DataFrame:
    return _finding(repeated_ids(parsed, key), "repeated_ids", "error", F.col(key), F.lit(1), F.col("n"))


def gaps(parsed: DataFrame, key: str = "entry_id", group: tuple[str, ...] = ()) -> DataFrame:
    found = missing_numbers(parsed, key, group)
    return _finding(found, "missing_numbers", "warning", F.col("first_missing"), F.lit("present"), F.col("last_missing") - F.col("first_missing") + 1)


def parsed_counts(entries: DataFrame, parsed: DataFrame, kind: str) -> DataFrame:
    """Columns whose numbers of entries of a kind differ before and after parsing."""
    keys = ("publication", "page_number", "col_no")
    off = counts_differ(entries.where(F.col("entry_type") == kind), parsed, keys, "entry_id")
    return _finding(off, f"parsed_{kind.lower()}", "error", _at(*keys), F.col("count_in"), F.col("count_out"))


def all_checks(lines: DataFrame, entries: DataFrame, cities: DataFrame, doctors: DataFrame) -> DataFrame:
    """Every finding of every check. Tables are to have each key once."""
    ids = doctors.select("publication", "entry_id").unionByName(cities.select("publication", "entry_id"))
    parts = [
        columns_per_page(lines), uneven_columns(lines), line_heights(lines), column_coverage(lines, entries), one_state(entries),
        unknown_entries(entries), doctor_share(entries), repeated(ids), gaps(ids, group=("publication",)),
        parsed_counts(entries, cities, "CITY"), parsed_counts(entries, doctors, "DOC"),
    ]
    return reduce(DataFrame.unionByName, parts)
