import random

from pyspark.sql import functions as F

from quirework.operators import hierarchy


def _naive(rows, reset):
    state = city = pub = None
    out = []
    for k, p, kind, text in rows:
        if reset and p != pub:
            state = city = None
        pub = p
        if kind == "STATE":
            state = text
        elif kind == "CITY":
            city = f"id{k}"
        out.append((k, state, city))
    return out


def test_two_phases_equal_one_scan(spark):
    rng = random.Random(5)
    rows = []
    for p in range(6):
        for _ in range(rng.randrange(0, 15)):
            rows.append((len(rows) + 1, f"P{p}", rng.choice(["STATE", "CITY", "DOC", "DOC", "UNKNOWN"]), f"t{len(rows)}"))
    df = spark.createDataFrame(rows, "row_id int, publication string, entry_type string, full_text string").repartition(4)
    carried = {"s": F.when(F.col("entry_type") == "STATE", F.col("full_text")), "c": F.when(F.col("entry_type") == "CITY", F.concat(F.lit("id"), "row_id"))}
    for block, reset in (("publication", False), ("publication", True), (None, False)):
        got = sorted(tuple(r) for r in hierarchy.carry_forward(df, "row_id", carried, block, reset).select("row_id", "s", "c").collect())
        assert got == _naive(rows, reset), (block, reset)


def test_empty(spark):
    df = spark.createDataFrame([], "row_id int, publication string, entry_type string, full_text string, entry_id string")
    cities, doctors = hierarchy.split_entries(df)
    assert cities.count() == 0 and doctors.count() == 0
