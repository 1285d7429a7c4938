"""Sinks: JSON and CSV as the pipeline hands them on, tables that are appended to, and side outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def write_json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """One record per line, characters as they are; fails if the target is there unless appending."""
    df.write.mode("append" if append else "errorifexists").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line; nulls are empty; an existing target is not overwritten."""
    df.write.mode("errorifexists").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def append_table(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Rows added to a Parquet table, the schema kept in the files, so that nothing repeats a header."""
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def split_output(df: DataFrame, good: Column, path: str, bad_path: str, bad_text: str) -> None:
    """Good rows to a table, the texts of the others to a side file."""
    df.where(good).write.mode("errorifexists").parquet(path)
    df.where(~good | good.isNull()).select(bad_text).where(f"`{bad_text}` is not null").write.mode("errorifexists").text(bad_path)


def make_empty(df: DataFrame, path: str) -> None:
    """An empty table with the schema of `df`, if there is none yet."""
    df.limit(0).write.mode("ignore").parquet(path)
