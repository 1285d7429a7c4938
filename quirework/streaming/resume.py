"""Incremental work: steps whose requests go out in batches, resumed from what is finished, and file streams."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.operators.tables import in_batches, unfinished

#: Takes a batch of requests and gives as many answers; runs on the executors.
Extractor = Callable[[pd.DataFrame], pd.DataFrame]


class Step(Protocol):
    """A step of extraction: what it reads, what is done, and how requests and answers look."""

    keys: Sequence[tuple[str, str]]
    answer: T.StructType

    def inputs(self, spark: SparkSession) -> DataFrame: ...
    def finished(self, spark: SparkSession) -> DataFrame: ...
    def requests(self, pending: DataFrame) -> DataFrame: ...


@dataclass
class Backoff:
    """Waiting between polls: doubled after every second poll that brought nothing, up to a limit, and back to
    the first wait as soon as something came."""

    first: float = 60.0
    most: float = 3600.0
    idle: int = 0
    wait: float = field(init=False)

    def __post_init__(self) -> None:
        self.wait = self.first

    def after(self, progress: bool) -> float:
        if progress:
            self.idle, self.wait = 0, self.first
        else:
            self.idle += 1
            if self.idle % 2 == 0 and self.wait < self.most:
                self.wait = min(self.wait * 2, self.most)
        return self.wait


class Busy(Exception):
    """The service asks to come back later."""


@dataclass
class BatchRunner:
    """Runs a step over all that is pending. A request that fails `attempts` times gives a row with `failed`
    true instead of an answer, so that it is kept and can be sent again, and never blocks the others."""

    step: Step
    extract: Extractor
    size: int = 20
    attempts: int = 2
    backoff: Backoff = field(default_factory=Backoff)
    sleep: Callable[[float], None] = time.sleep

    def pending(self, spark: SparkSession) -> DataFrame:
        return unfinished(self.step.inputs(spark), [self.step.finished(spark)], self.step.keys)

    def run(self, spark: SparkSession, order: Sequence[str], most: int | None = None) -> DataFrame:
        todo = self.step.requests(self.pending(spark))
        if most is not None:
            todo = todo.orderBy(*order).limit(most)
        return answered(todo, self.step.answer, self.extract, self.size, self.attempts, self.backoff, self.sleep)


def answered(
    requests: DataFrame, answer: T.StructType, extract: Extractor, size: int = 20, attempts: int = 2,
    backoff: Backoff | None = None, sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """The requests' answers and `failed`; batches of at most `size` go to the extractor within each task. An answer
    whose finish_reason is another than STOP counts as failed and keeps what it has."""
    names = [f.name for f in answer.fields]
    schema = T.StructType([*answer.fields, T.StructField("failed", T.BooleanType())])
    shared = [n for n in names if n in requests.columns]

    def ask(batch: pd.DataFrame) -> pd.DataFrame:
        waiting = backoff or Backoff()
        for left in range(attempts, 0, -1):
            try:
                raw = extract(batch)
                # An answer that ended for another reason than STOP is set apart.
                bad = raw["finish_reason"].fillna("STOP").ne("STOP").to_numpy() if "finish_reason" in raw else False
                got = raw.reindex(columns=names)
                got["failed"] = bad
                return got
            except Busy:
                sleep(waiting.after(False))
            except Exception:  # noqa: BLE001 - a poisoned record must not end the job
                if left == 1:
                    break
        lost = batch[shared].reindex(columns=names)
        lost["failed"] = True
        return lost

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), size):
                yield ask(frame.iloc[k : k + size].reset_index(drop=True))

    return requests.mapInPandas(run, schema)


def numbered_batches(requests: DataFrame, order: Sequence[str], size: int, within: Sequence[str] = ()) -> DataFrame:
    return in_batches(requests, order, size, within)


def _written(spark: SparkSession, target: str) -> DataFrame | None:
    """The table at a path, None if nothing is there yet; any other error of reading is one."""
    try:
        return spark.read.parquet(target)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def continued(extract: Extractor, text: str = "answer", prompt: str = "prompt", reason: str = "finish_reason", most: int = 3) -> Extractor:
    """An extractor that asks on where an answer was cut off for its length: the prompt with the answer so far is
    sent again, up to `most` times, and what comes is put behind it. An answer that ended for another reason than
    STOP keeps it."""

    def ask(batch: pd.DataFrame) -> pd.DataFrame:
        got = extract(batch).reset_index(drop=True)
        for _ in range(most):
            open_ = got.index[got[reason] == "MAX_TOKENS"]
            if not len(open_):
                break
            again = batch.loc[open_].copy()
            again[prompt] = again[prompt] + got.loc[open_, text].fillna("")
            more = extract(again.reset_index(drop=True)).set_index(open_)
            got.loc[open_, text] = got.loc[open_, text].fillna("") + more[text].fillna("")
            got.loc[open_, reason] = more[reason]
        return got

    return ask


def in_waves(
    spark: SparkSession, pending: Callable[[DataFrame | None], DataFrame], ask: Callable[[DataFrame], DataFrame], target: str, order: Sequence[str], size: int = 20, in_flight: int = 100,
) -> int:
    """Work in waves: each sends the next in_flight * size pending requests in order, appends the answers to
    `target`, and makes room for as many as were finished. `pending` gives what is left, from what is written (None
    before the first wave); it is asked again after each wave, so that a run that stops goes on where it was. A wave
    that brings no row ends the run. The number of waves."""
    waves = 0
    while True:
        before = _written(spark, target)
        wave = pending(before).orderBy(*order).limit(in_flight * size)
        answers = ask(wave)
        known = before.count() if before is not None else 0
        answers.write.mode("append").parquet(target)
        if _written(spark, target).count() == known:
            return waves
        waves += 1


def follow_files(
    spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame],
    keys: Sequence[str], files_at_once: int = 100,
) -> None:
    """Takes up JSON files as they arrive, transforms them, and appends the rows whose key the target does not
    have. Restarts go on from the checkpoint; a batch that is repeated after a failure adds nothing twice, as
    it is compared with the target."""

    def add(batch: DataFrame, _: int) -> None:
        new = transform(batch).dropDuplicates(list(keys))
        known = _written(batch.sparkSession, target)
        if known is not None:
            new = unfinished(new, [known], [(k, k) for k in keys])
        new.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).json(source)
    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def failed_rows(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers, rows to be sent again)."""
    return answers.where(~F.col("failed")).drop("failed"), answers.where("failed")
