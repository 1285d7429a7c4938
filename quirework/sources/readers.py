"""Sources with explicit schemas: nested and flat JSON, CSV, whole texts, images, older box forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE = "pub string, page int, col int, text string, conf double, x int, y int, width int, height int"
ENTRY = "publication string, page_number int, col_no int, entry_type string, full_text string, x int, y int, width int, height int"
METADATA = "source_pdf string, pub_id string, pages array<struct<page_num:int, snippets:array<struct<path:string, x_offset:int, y_offset:int, column:int>>>>"
#: The column that takes a record that cannot be read.
BAD = "_bad"


def _with_place(df: DataFrame) -> DataFrame:
    """Where a record stood: its file, the block within it, and a number that grows within a block."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_no"))


def read_json_lines(spark: SparkSession, path: str, schema: str = LINE) -> DataFrame:
    """Records of one line each, in `schema`; blank lines are passed over; a record that cannot be read has
    its text in `_bad`. With the columns _file, _block, _no, whose order is that of the input."""
    return _with_place(spark.read.schema(f"{schema}, {BAD} string").option("columnNameOfCorruptRecord", BAD).option("mode", "PERMISSIVE").json(path))


def with_order(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Number the rows from 1 in input order, by sums of the rows of the blocks before: no row moves."""
    from pyspark.sql import Window

    own = Window.partitionBy("_file", "_block").orderBy("_no")
    numbered = df.withColumn("_own", F.row_number().over(own))
    sizes = df.groupBy("_file", "_block").agg(F.count("*").alias("_size"))
    before = sizes.select(
        F.col("_file").alias("_f"), F.col("_block").alias("_b"),
        F.coalesce(F.sum("_size").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    met = numbered.join(before, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return met.withColumn(name, F.col("_before") + F.col("_own")).drop("_own", "_f", "_b", "_before", "_file", "_block", "_no")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Nested page-image records, one JSON document per file."""
    return spark.read.schema(METADATA).option("multiLine", True).json(path)


def flat_metadata(nested: DataFrame) -> DataFrame:
    """One row per image; publications and pages without images stay, with nulls; missing numbers are 0."""
    pages = nested.select(F.coalesce("pub_id", F.lit("Unknown")).alias("pub_id"), F.explode_outer("pages").alias("p"))
    snippets = pages.select("pub_id", F.coalesce("p.page_num", F.lit(0)).alias("page_num"), F.explode_outer("p.snippets").alias("s"))
    zero = lambda c: F.coalesce(f"s.{c}", F.lit(0)).alias(c)
    return snippets.select("pub_id", "page_num", zero("column"), F.col("s.path").alias("path"), zero("x_offset"), zero("y_offset"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line, quotes doubled within quotes, and line ends within fields."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """One row (path, text) per file."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_images(spark: SparkSession, path: str, least_kb: float = 0.8) -> DataFrame:
    """Images (path, length, content) but those too small to hold text."""
    return spark.read.format("binaryFile").load(path).where(F.col("length") / 1024 >= least_kb).select("path", "length", "content")


def missing_images(metadata: DataFrame, images: DataFrame) -> DataFrame:
    return metadata.join(images.select("path"), "path", "left_anti")


def box_of(record: Column) -> Column:
    """struct(x, y, width, height) of a record's JSON text in which the box is a list, a record, or flat."""
    v = F.try_parse_json(record)

    def take(k: int, name: str) -> Column:
        return F.coalesce(
            F.try_variant_get(v, f"$.bbox[{k}]", "int"), F.try_variant_get(v, f"$.bbox.{name}", "int"), F.try_variant_get(v, f"$.{name}", "int")
        ).alias(name)

    return F.struct(*(take(k, n) for k, n in enumerate(("x", "y", "width", "height"))))


RESPONSE_LINE = T.ArrayType(
    T.StructType(
        [T.StructField("text", T.StringType())]
        + [T.StructField(n, T.IntegerType()) for n in ("x", "y", "width", "height")]
        + [T.StructField("confidence", T.DoubleType())]
    )
)


def response_items(text: Column, item: T.ArrayType = RESPONSE_LINE, names: tuple[str, ...] = ("lines", "entries")) -> Column:
    """The items of a service's answer: a bare list, or a record that holds one under one of the names. Null if
    the text is no JSON or holds no list."""
    bare = F.when(F.btrim(text).startswith("["), F.from_json(text, item))
    held = [F.from_json(text, T.StructType([T.StructField(n, item)])).getField(n) for n in names]
    return F.coalesce(bare, *held)
