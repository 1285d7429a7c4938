"""Session helpers shared by all operators: table loading and shared-folder checkpoints."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, so that they find it wherever they
    run and whatever their search path is."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quirework-code-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of a data folder."""
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: spark.checkpoint.dir of the session, which a cluster sets to a
    folder all executors share. Where nothing is set, a temporary one if the executors are threads of
    this process (tests, one machine); on a cluster that is an error."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", "") or sc.getConf().get("spark.checkpoint.dir", "")
    if not folder and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = folder or tempfile.mkdtemp(prefix="quirework-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """`df` materialised in the shared checkpoint folder, with its lineage cut there; a lost
    executor costs nothing, as the files are on the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Entries of a table that is sent to all tasks, at most; beyond it the table is joined by a shuffle.
SENT = 500_000


def attach(df: DataFrame, table: DataFrame, on: list[str], weight: Column | None = None, sent: int = SENT) -> DataFrame:
    """`df` with the columns of `table`, which has one row for each value of `on`; nulls where it has none. The
    table is sent to all tasks if it has at most `sent` rows, or entries by `weight`, which is counted; else
    both sides are shuffled, and tasks that one key makes large are split by the engine."""
    table = cut(table)
    size = table.agg(F.sum(F.coalesce(weight, F.lit(0)) + 1 if weight is not None else F.lit(1))).first()[0] or 0
    return df.join(F.broadcast(table) if size <= sent else table, on, "left")
