"""The steps of the pipeline that ask a service: reading columns, classifying their lines, parsing entries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.sources.readers import response_items

LINE = "line_no int, text string, x int, y int, width int, height int, confidence double"
Table = Callable[[SparkSession], DataFrame]


def _answer(*keys: str) -> T.StructType:
    return T.StructType([*(T.StructField(k, T.StringType()) for k in keys), T.StructField("answer", T.StringType()), T.StructField("finish_reason", T.StringType())])


@dataclass
class OcrStep:
    """Snippets of columns (pub, page, col, path), one request each, to lines."""

    snippets: Table
    done: Table
    keys: Sequence[tuple[str, str]] = (("pub", "pub"), ("page", "page"), ("col", "col"))
    answer: T.StructType = field(default_factory=lambda: _answer("key"))

    def inputs(self, spark: SparkSession) -> DataFrame:
        return self.snippets(spark)

    def finished(self, spark: SparkSession) -> DataFrame:
        return self.done(spark)

    def requests(self, pending: DataFrame) -> DataFrame:
        key = F.concat_ws("|", "pub", F.col("page").cast("string"), F.col("col").cast("string"))
        return pending.select(key.alias("key"), F.concat(F.lit("Read the printed lines of "), "path").alias("prompt"))

    def lines(self, answers: DataFrame) -> DataFrame:
        """The lines of the answers, numbered as they come."""
        k = F.split("key", r"\|")
        place = [F.element_at(k, 1).alias("pub"), F.element_at(k, 2).try_cast("int").alias("page"), F.element_at(k, 3).try_cast("int").alias("col")]
        each = answers.select(*place, F.posexplode(response_items(F.col("answer"))).alias("line_no", "i"))
        return each.select("pub", "page", "col", "line_no", "i.text", "i.x", "i.y", "i.width", "i.height", "i.confidence")


@dataclass
class ClassifyStep:
    """Columns of lines (pub, page, col, line_no, text), all lines of a column in one request, to entries."""

    source: Table
    done: Table
    keys: Sequence[tuple[str, str]] = (("key", "key"),)
    answer: T.StructType = field(default_factory=lambda: _answer("key"))

    def inputs(self, spark: SparkSession) -> DataFrame:
        key = F.concat_ws("|", "pub", F.col("page").cast("string"), F.col("col").cast("string"))
        numbered = F.concat(F.col("line_no").cast("string"), F.lit(": "), F.coalesce("text", F.lit("")))
        lines = self.source(spark).groupBy(key.alias("key")).agg(F.array_sort(F.collect_list(F.struct("line_no", numbered.alias("t")))).alias("ls"))
        return lines.select("key", F.array_join(F.col("ls.t"), "\n").alias("prompt"))

    def finished(self, spark: SparkSession) -> DataFrame:
        return self.done(spark)

    def requests(self, pending: DataFrame) -> DataFrame:
        return pending.select("key", "prompt")


@dataclass
class EntryStep:
    """Entries of one kind (entry_id, publication, entry_type, full_text), some in a request, to their fields."""

    source: Table
    done: Table
    kind: str = "DOC"
    keys: Sequence[tuple[str, str]] = (("entry_id", "entry_id"), ("publication", "publication"))
    answer: T.StructType = field(default_factory=lambda: _answer("entry_id", "publication"))

    def inputs(self, spark: SparkSession) -> DataFrame:
        return self.source(spark).where(F.col("entry_type") == self.kind)

    def finished(self, spark: SparkSession) -> DataFrame:
        return self.done(spark)

    def requests(self, pending: DataFrame) -> DataFrame:
        return pending.select("entry_id", "publication", F.col("full_text").alias("prompt"))
