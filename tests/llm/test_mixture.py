from collections import defaultdict

from pyspark.sql import functions as F

from quirework.llm.mixture import mixture, with_tokens

DOCS = "doc_id bigint, source string, text string, start bigint, part int"
TARGETS = "source string, target_share double, max_repeats int"


def _documents(spark):
    rows = [(k, "big", f"the text number {k} of a large source with some words", 0, 0) for k in range(900)]
    rows += [(1000 + k, "small", f"few texts {k}", 0, 0) for k in range(40)]
    rows += [(2000, "unwanted", "x y z", 0, 0), (2001, None, "a b", 0, 0), (2002, "small", None, 0, 0), (2003, "small", "", 0, 0)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def test_shares_repeats_and_report(spark):
    docs = _documents(spark)
    targets = spark.createDataFrame([("big", 0.75, 2), ("small", 0.15, 3), ("absent", 0.1, 2), (None, 0.5, 2)], TARGETS)
    mixed, shares = mixture(docs, targets)
    got = {r.source: r for r in shares.collect()}
    assert abs(got["big"].reached_share - 0.75 / 0.9) < 0.01 and abs(got["small"].reached_share - 0.15 / 0.9) < 0.01
    assert got["small"].most_used == 3 and got["absent"].mixed_tokens == 0 and got["unwanted"].mixed_docs == 0 and set(got) == {"big", "small", "absent", "unwanted"}
    used = defaultdict(int)
    for r in mixed.collect():
        assert 1 <= r.times <= (2 if r.source == "big" else 3)
        used[r.source] += r.times * r.n_tokens
    assert used == {s: got[s].mixed_tokens for s in ("big", "small")}
    again = {(r.doc_id, r.times) for r in mixture(docs.repartition(2), targets)[0].collect()}
    assert again == {(r.doc_id, r.times) for r in mixed.collect()}
    joined = mixture(docs, targets, sent=0)
    assert again == {(r.doc_id, r.times) for r in joined[0].collect()} and sorted(map(str, joined[1].collect())) == sorted(map(str, shares.collect()))


def test_given_total_and_the_order_of_the_cut(spark):
    docs = _documents(spark)
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 1)], TARGETS)
    mixed, shares = mixture(docs, targets, total=2000)
    got = {r.source: r for r in shares.collect()}
    assert abs(got["big"].mixed_tokens - 1000) <= 7 and got["small"].short and got["small"].mixed_tokens == got["small"].source_tokens
    sizes = {r.doc_id: r.n_tokens for r in with_tokens(docs, keep=("doc_id",)).collect()}
    order = docs.where("source = 'big'").select("doc_id", F.xxhash64("doc_id", F.lit(17)).alias("r")).orderBy("r", "doc_id").collect()
    want, start = [], 0
    for r in order:
        if start + sizes[r.doc_id] / 2 < 1000:
            want.append(r.doc_id)
        start += sizes[r.doc_id]
    assert sorted(r.doc_id for r in mixed.where("source = 'big'").collect()) == sorted(want)


def test_empty(spark):
    targets = spark.createDataFrame([("big", 0.5, 1)], TARGETS)
    mixed, shares = mixture(_documents(spark).limit(0), targets)
    assert mixed.count() == 0 and shares.first().reached_share == 0.0
    assert mixture(_documents(spark), targets.limit(0))[0].count() == 0
