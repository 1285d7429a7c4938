"""Evaluation texts leaking into training text: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.runtime import SENT, cut

#: Words are the longest stretches of letters and digits, in lower case.
BREAK = r"[^\p{L}\p{N}]+"
#: Words of a seed. Any passage of `PASSAGE` words holds PASSAGE - SEED + 1 of them, the rarest of which is used.
SEED = 5
PASSAGE = 12
#: An edited copy is a document whose alignment with an item has so much of the score of a whole copy; and words of
#: its seeds.
EDITED, EDITED_SEED = 0.6, 3
#: Scores of the alignment.
MATCH, MISMATCH, GAP = 2, -1, -2
#: Pairs whose words are held at once, and cells that are aligned at once.
PAIRS = 500
CELLS = 400_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), BREAK), lambda w: w != "")


def _grams(w: Column, size: int = SEED) -> Column:
    last = F.size(w) - size
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(F.slice(w, i + 1, size))),
    ).otherwise(F.array().cast("array<bigint>"))


def align(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of word-id arrays (document, item): the Smith-Waterman score of the best local alignment,
    and the most consecutive words of the item that stand together in the document. All pairs advance
    together, one document word at a time; gaps in the item are a running maximum."""
    n = len(pairs)
    wide, tall = max(len(b) for _, b in pairs), max(len(a) for a, _ in pairs)
    item = np.full((n, wide), -2, np.int32)
    doc = np.full((tall, n), -1, np.int32)
    for k, (a, b) in enumerate(pairs):
        item[k, : len(b)] = b
        doc[: len(a), k] = a
    score, run = np.zeros((n, wide + 1), np.int32), np.zeros((n, wide + 1), np.int32)
    best, longest = np.zeros(n, np.int32), np.zeros(n, np.int32)
    slope = GAP * np.arange(wide + 1, dtype=np.int32)
    for row in doc:
        same = item == row[:, None]
        step = np.where(same, MATCH, MISMATCH)
        new = np.zeros_like(score)
        np.maximum(score[:, :-1] + step, 0, out=new[:, 1:])
        np.maximum(new[:, 1:], score[:, 1:] + GAP, out=new[:, 1:])
        score = np.maximum.accumulate(new - slope, axis=1) + slope
        run[:, 1:] = np.where(same, run[:, :-1] + 1, 0)
        np.maximum(best, score.max(axis=1), out=best)
        np.maximum(longest, run.max(axis=1), out=longest)
    return best, longest


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Some pairs at a time, as their texts become lists of words.
    for b in (b.slice(k, PAIRS) for b in batches for k in range(0, b.num_rows, PAIRS)):
        ids: dict[str, int] = {}
        pairs = []
        for doc, item in zip(b.column("doc_words").to_pylist(), b.column("item_words").to_pylist()):
            code = lambda ws: np.array([ids.setdefault(w, len(ids)) for w in ws], np.int32)
            pairs.append((code(doc), code(item)))
        order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][0]))
        best, longest = np.zeros(len(pairs), np.int32), np.zeros(len(pairs), np.int32)
        at = 0
        while at < len(order):
            end, wide = at, 0
            while end < len(order) and (end == at or (wide := max(wide, len(pairs[order[end]][1]))) * (end - at + 1) <= CELLS // 64):
                end += 1
            part = order[at:end]
            best[part], longest[part] = align([pairs[k] for k in part])
            at = end
        share = best / np.array([MATCH * max(1, len(i)) for _, i in pairs])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("item_id"), pa.array(longest), pa.array(share)],
            ["doc_id", "item_id", "run_words", "share"],
        )


def leaks(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """Rows (doc_id, item_id, run_words, share) of documents and test items that may have leaked into them:
    run_words is the most consecutive words of the item standing together in the document, share the
    alignment score against that of a whole copy. Every pair with run_words >= PASSAGE is among them;
    pairs below are those that share a seed by chance or are edited copies.

    Seeds: of each window of PASSAGE words of an item the word n-gram found in fewest documents, counted
    over the whole corpus; a document that holds the window holds the seed. Windows whose rarest n-gram is
    in no document need none. Null, empty and too short texts give no row; repeated rows give one; items
    of the same text are each reported. The documents' n-grams are reduced to those of the items before
    anything is shuffled; which join does this is left to Spark, which broadcasts the items only if small.
    """
    own, docs = _worded(documents, items, doc_id, item_id, text)
    places = own.select("item_id", F.size("item_words").alias("n"), F.posexplode(_grams(F.col("item_words"))).alias("pos", "gram"))
    grams = docs.where(F.size("doc_words") >= PASSAGE).select("doc_id", F.explode(F.array_distinct(_grams(F.col("doc_words")))).alias("gram"))
    hits = cut(grams.join(places.select("gram").distinct(), "gram", "left_semi"))
    counts = hits.groupBy("gram").agg(F.count("*").alias("df"))
    ranked = places.join(counts, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    window = Window.partitionBy("item_id").orderBy("pos").rowsBetween(0, PASSAGE - SEED)
    seeds = (
        ranked.withColumn("rare", F.min(F.struct("df", "gram")).over(window))
        .where((F.col("pos") <= F.col("n") - PASSAGE) & (F.col("rare.df") > 0))
        .select("item_id", F.col("rare.gram").alias("gram"))
        .distinct()
    )
    return _aligned(_sent(hits, seeds, "gram").select("doc_id", "item_id").distinct(), documents, own, doc_id, text)


def edited_copies(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", least: float = EDITED
) -> DataFrame:
    """Rows (doc_id, item_id, run_words, share) of the documents that hold an edited or paraphrased copy of an item:
    their best alignment has at least the share `least`, from 0.6 on, of the score of a whole copy.

    No copy is missed: with a share of s, an item of n words has matched words and breaks in them such that at
    least (2 * s - 1) * n - 2 of its places begin a run of EDITED_SEED words that the document holds too, for s = 0.6 a fifth
    of its words but two; the pairs that share so many are aligned, whatever is common or rare. Items of fewer
    than PASSAGE words, and null and empty texts, give no row.
    """
    if least < EDITED:
        raise ValueError(f"a share under {EDITED} leaves too few words in a row to be found by")
    own, docs = _worded(documents, items, doc_id, item_id, text)
    places = own.select("item_id", F.size("item_words").alias("n"), F.posexplode(_grams(F.col("item_words"), EDITED_SEED)).alias("pos", "gram"))
    grams = docs.where(F.size("doc_words") >= EDITED_SEED).select("doc_id", F.explode(F.array_distinct(_grams(F.col("doc_words"), EDITED_SEED))).alias("gram"))
    hits = cut(_sent(grams, places.select("gram").distinct(), "gram", "left_semi").distinct())
    shared = _sent(hits, places, "gram").groupBy("doc_id", "item_id", "n").agg(F.count("*").alias("held"))
    candidates = shared.where(F.col("held") >= F.greatest(F.lit(1), F.ceil(F.lit(2 * least - 1) * F.col("n") - 2 - 1e-9))).select("doc_id", "item_id")
    return _aligned(candidates, documents, own, doc_id, text).where(F.col("share") >= least)


def _worded(documents: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    own = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("item_words")).where(F.size("item_words") >= PASSAGE).distinct()
    return own, documents.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("doc_words"))


def _sent(many: DataFrame, few: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join whose smaller side, made of the items, is sent to all tasks if it is small, so that a frequent word
    sequence makes no task large; beyond that both sides are shuffled, and large tasks split by the engine."""
    few = cut(few)
    return many.join(F.broadcast(few) if few.count() <= SENT else few, on, how)


def _aligned(candidates: DataFrame, documents: DataFrame, own: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The candidates (doc_id, item_id) with the longest run of words in common and the share of the score."""
    texts = documents.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("doc_text"))
    met = texts.join(candidates, "doc_id").join(own, "item_id")
    pairs = met.select("doc_id", "item_id", words(F.col("doc_text")).alias("doc_words"), "item_words")
    kind = candidates.select("doc_id", "item_id", F.lit(0).alias("run_words"), F.lit(0.0).alias("share")).schema
    for f in kind.fields:
        f.nullable = True
    return pairs.mapInArrow(_score, kind).distinct()
