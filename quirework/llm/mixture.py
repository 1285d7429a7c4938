"""Mixing sources to target weights: exact token budgets by distributed prefix sums over a random order."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.runtime import SENT, cut

#: Folder of the public tokenizers' files, and the vocabulary used; parameters of every operator here.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"


@functools.cache
def _encoding(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, text: str = "text", keep: tuple[str, ...] = (), path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """Columns `keep` and n_tokens, the tokens of `text` by the public tokenizer at `path`; null counts 0."""
    kind = df.select(*keep, F.lit(0).cast("bigint").alias("n_tokens")).schema
    for f in kind.fields:
        f.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        for b in batches:
            texts = b.column(text).to_pylist()
            n = [len(encoding.encode_ordinary(t)) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(n, pa.int64())], [*keep, "n_tokens"])

    return df.select(*keep, text).mapInArrow(run, kind)


def _prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums of n_tokens per range and source (`key`) within a partition sorted by these, on top of `before`."""
    carry: tuple[object, int] = (None, 0)
    for b in batches:
        if not b.num_rows:
            continue
        n = b.column("n_tokens").to_numpy(zero_copy_only=False)
        before = b.column("before").to_numpy(zero_copy_only=False)
        codes = b.column("key").dictionary_encode()
        which = codes.indices.to_numpy(zero_copy_only=False)
        names = codes.dictionary.to_pylist()
        total = np.cumsum(n)
        new = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
        base = np.zeros(len(n), np.int64)
        base[new] = np.diff(np.r_[0, total[new] - n[new]])
        start = total - n - np.cumsum(base)
        first = names[which[0]]
        if carry[0] == first:
            head = slice(0, new[1] if len(new) > 1 else len(n))
            start[head] += carry[1]
        carry = (names[which[-1]], int(start[-1] + n[-1]))
        cols = [b.column(c) for c in ("doc_id", "source", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(start + before)], ["doc_id", "source", "n_tokens", "start"])


def mixture(
    documents: DataFrame,
    targets: DataFrame,
    total: int | None = None,
    seed: int = 17,
    path: str = f"{TOKENIZERS}/{VOCABULARY}",
    sent: int = SENT,
) -> tuple[DataFrame, DataFrame]:
    """The mixture (doc_id, source, n_tokens, times) and the shares reached per source.

    documents: doc_id, source, text. targets: source, target_share, max_repeats, one row per source.
    `total` tokens are to be mixed; without it, the largest total at which every source that has tokens
    and a positive target can give its share without using a document more than max_repeats times. A
    source's budget is target_share / (shares of the sources that have tokens) of it: whole passes over
    the source, then the documents of a random order up to the budget, the one that crosses it being
    taken if the cut comes closer so. If a given `total` asks too much of a source, it gives all it may
    and the report says so. Sources without a target or without a row in `documents` are reported with
    no tokens mixed. Null sources and null targets count as none; ties of the random key are broken by
    doc_id; repeated rows of a document are one each.

    Plan: one range shuffle by (source, hash), so that a source of any size is spread over many tasks;
    sums per task and source give each task's start, and the running sums are made within the tasks.
    """
    # Written once, as the ranges are found in a pass of their own over what is to be ranged.
    counted = cut(with_tokens(documents, keep=("doc_id", "source"), path=path).where("source is not null"))
    laid = cut(
        counted.withColumn("r", F.xxhash64("doc_id", F.lit(seed)))
        .repartitionByRange("source", "r", "doc_id")
        .sortWithinPartitions("source", "r", "doc_id")
        .select("doc_id", "source", "n_tokens", "r", F.spark_partition_id().alias("part"))
    )
    parts = laid.groupBy("part", "source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    by_source = Window.partitionBy("source")
    parts = parts.withColumn(
        "before", F.sum("tokens").over(by_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    )
    parts = cut(parts.select("part", "source", F.coalesce("before", F.lit(0)).cast("bigint").alias("before"), "tokens", "docs"))
    sums = parts.groupBy("source").agg(F.sum("tokens").alias("have"), F.sum("docs").alias("docs"))
    wanted = targets.where("source is not null").select(
        "source",
        F.coalesce(F.col("target_share"), F.lit(0.0)).alias("target_share"),
        F.coalesce(F.col("max_repeats"), F.lit(0)).alias("max_repeats"),
    )
    plan = sums.join(wanted, "source", "full_outer").select(
        "source",
        F.coalesce("have", F.lit(0)).alias("have"),
        F.coalesce("docs", F.lit(0)).alias("docs"),
        F.coalesce("target_share", F.lit(0.0)).alias("target_share"),
        F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"),
    )
    usable = (F.col("have") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    shares, most = plan.agg(
        F.sum(F.when(usable, F.col("target_share"))), F.min(F.when(usable, F.col("have") * F.col("max_repeats") / F.col("target_share")))
    ).first()  # one row of two numbers
    size = F.lit(float(total) if total is not None else (most or 0.0) * (shares or 0.0))
    plan = plan.withColumn("asked", F.when(usable, size * F.col("target_share") / F.lit(shares or 1.0)).otherwise(F.lit(0.0)))
    plan = plan.withColumn("budget", F.least("asked", F.col("have") * F.col("max_repeats").cast("double")))
    plan = plan.withColumn("passes", F.when(usable, F.floor(F.col("budget") / F.col("have") + 1e-9)).otherwise(F.lit(0))).withColumn(
        "rest", F.greatest(F.col("budget") - F.col("passes") * F.col("have"), F.lit(0.0))
    )
    # A row for each task and source, at most tasks + sources rows, as the tasks are ranges of sources. While they
    # are few they are sent, and nothing moves; else the ranges are put in order again behind the join.
    begins = parts.select("part", "source", "before")
    if begins.count() <= sent:
        met = laid.join(F.broadcast(begins), ["part", "source"])
    else:
        met = laid.join(begins, ["part", "source"]).repartition("part").sortWithinPartitions("part", "source", "r", "doc_id")
    started = met.select("doc_id", "source", "n_tokens", "before", F.concat_ws(" ", "part", "source").alias("key"))
    kind = laid.select("doc_id", "source", "n_tokens", F.lit(0).cast("bigint").alias("start")).schema
    for f in kind.fields:
        f.nullable = True
    summed = started.mapInArrow(_prefix, kind)
    chosen = summed.join(plan.select("source", "passes", "rest", "max_repeats"), "source").select(
        "doc_id", "source", "n_tokens",
        (F.col("passes") + F.when(F.col("start") + F.col("n_tokens") / 2.0 < F.col("rest"), 1).otherwise(0))
        .cast("int").alias("times"), "max_repeats",
    )
    mixed = chosen.select("doc_id", "source", "n_tokens", F.least("times", "max_repeats").alias("times")).where("times > 0")
    used = mixed.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("times")).alias("mixed_tokens"), F.count("*").alias("mixed_docs"),
        F.max("times").alias("most_used"),
    )
    all_tokens = used.agg(F.sum("mixed_tokens")).scalar()
    shares = (
        plan.join(used, "source", "left")
        .select(
            "source", "target_share", "max_repeats", F.col("docs").alias("source_docs"), F.col("have").alias("source_tokens"),
            F.coalesce("mixed_docs", F.lit(0)).alias("mixed_docs"),
            F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
            F.coalesce("most_used", F.lit(0)).alias("most_used"),
            F.coalesce(F.col("mixed_tokens") / all_tokens, F.lit(0.0)).alias("reached_share"),
            (F.col("target_share") > 0).__and__(F.coalesce("mixed_tokens", F.lit(0)) + 0.5 < F.col("asked") - F.col("have") / F.greatest("docs", F.lit(1))).alias("short"),
        )
    )
    return mixed, shares
