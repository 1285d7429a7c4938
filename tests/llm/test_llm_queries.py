import pytest

from quirework.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("kind", ["empty", "nulls"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_odd_tables(spark, odd_folders, name, kind):
    rows = QUERIES[name](spark, odd_folders[kind]).count()
    assert rows > 0 if kind == "nulls" and not name.startswith("p8_") else rows == 0 or name in ("p9_shares", "p10_thresholds", *(n for n in QUERIES if kind == "nulls" and n.startswith("p8_")))


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()
