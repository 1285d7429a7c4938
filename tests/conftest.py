import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def rows():
    """The rows of a frame as a sorted list of tuples."""

    def of(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return of


#: Names that operators use inside; as columns of the inputs they must not get in the way.
CLASHING = "key_id kind field n pos val row grp chars odds h gram form town how score part start before rn key table_name period ref arrival line shape kinds spike same ratio".split()
SAMPLE = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def odd_folders(spark, tmp_path_factory):
    """Copies of the smallest data: without any rows, and with rows of nulls and columns with clashing names."""
    if not SAMPLE.exists():
        pytest.skip("no test data")
    from pyspark.sql import functions as F

    root = tmp_path_factory.mktemp("odd")
    plain = {"gazetteer", "eval_items", "mix_targets", "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"}
    for path in SAMPLE.glob("*.parquet"):
        t = spark.read.parquet(str(path))
        t.limit(0).write.parquet(f"{root}/empty/{path.name}")
        nulls = spark.range(2).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema.fields))
        more = {} if path.stem in plain else {c: F.lit("x") for c in CLASHING if c not in t.columns}
        t.unionByName(nulls).withColumns(more).write.parquet(f"{root}/nulls/{path.name}")
    return {k: f"{root}/{k}" for k in ("empty", "nulls")}
