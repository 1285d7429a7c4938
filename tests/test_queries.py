import pytest

from quirework.plans import problems, reference

QUERIES = problems.QUERIES | reference.QUERIES


@pytest.mark.parametrize("kind", ["empty", "nulls"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_odd_tables(spark, odd_folders, name, kind):
    rows = QUERIES[name](spark, odd_folders[kind]).count()
    assert rows >= 0 and (kind == "nulls" or rows <= 6)


def test_every_sql_has_a_query():
    assert (problems.SQL | reference.SQL).keys() <= QUERIES.keys()
