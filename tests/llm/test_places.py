import random

import pytest

from quirework.llm.places import LIKE, Gazetteer, Place, county, locate, token_set, tokens
from quirework.llm.strings import edits, likeness

PLACES = [
    (1, "Morford Junction", "Falowick", "Alabama", None, 804), (2, "Holgate", "Quarridge", "Alabama", None, 4404), (3, "Venengate", "Stancombe", "Alabama", None, 20926),
    (4, "Venengate", "Quaringfield", "Alabama", None, 1110), (5, "Saint Lamercroft", "Lindworth", "Alabama", "Brackerfield Corners", 2427), (6, "Holgate", "Ubham", "Ohio", None, 90),
    (7, "North Holgate", "Quarridge", "Alabama", None, 33), (8, "Ormham", "Fitchawick", "New York", None, 608),
]
CASES = [
    (("MORFORD JUNC.", "Falowick", "Ala.", "Alabama", 800), 1), (("M0rford Jct.—Continued", "Co. of Falowick", None, "Alabama", None), 1), (("holgate ", None, "Ohio", "Ohio", None), 6),
    (("Holgate", "Quarridge County", "ALA", "Alabama", None), 2), (("No. Holgate (P.O.)", None, "Alabama", "Alabama", None), 7), (("Venengate", None, "Alabama", "Alabama", 1200), 4),
    (("Venengate", "Stancmobe", "Alabama", "Alabama", 1200), 3), (("Brackerfield Corners", "Lindworth", "Alabaama", "Alabama", None), 5), (("Brackerfield Corners (now Saint Lamercroft)", None, "Alabama", "Alabama", None), 5),
    (("St. Lamercrfot", "Lindworth", "State of Alabama", "Alabama", 2000), 5), (("Town of Holgate", None, "Alabama, U.S.A.", "Alabama", None), 2), (("Orrnham", "Fitchawick", "N.Y.", "New York", None), 8),
    (("Zuyczola", "Falowick", "Alabama", "Alabama", 800), 0), (("Morley Junction", "Lindworth", "Alabama", "Alabama", None), 0), (("Holgate", None, "Texas", "Texas", None), 0), ((None, None, None, None, None), 0), (("", "x", "Ohio", "Ohio", 5), 0),
    (("Residence at Holgate", None, "Alabama", "Alabama", None), 2), (("near Holgate on the river", None, "Alabama", "Alabama", None), 2), (("Holgate, Quarridge Co.", None, "Alabama", "Alabama", None), 2),
    (("Holgate Station", None, "Ala.", None, None), 2), (("a farm near North Holgate, Ala.", None, "Alabama", None, None), 7), (("x" * 5000, None, None, None, None), 0),
    (("Ormham", None, None, None, None), 0), (("Ormham", "Fitchawick", None, None, None), 8),
]


def _gazetteer():
    return Gazetteer([Place(i, tuple(tokens(n)), tuple(tokens(f or "")), county(c), s, p) for i, n, c, s, f, p in PLACES])


@pytest.mark.parametrize(("row", "want"), CASES)
def test_find(row, want):
    assert _gazetteer().find(*row)[0] == want


def test_the_filter_passes_all_that_is_like():
    rng = random.Random(9)
    g = _gazetteer()
    names = [w for p in g.places for w in (p.words, p.former) if w]
    for _ in range(3000):
        w = list(rng.choice(names))
        k = rng.randrange(len(w))
        for _ in range(rng.randrange(0, 4)):
            j = rng.randrange(len(w[k]) + 1)
            w[k] = rng.choice([w[k][:j] + rng.choice("aeiornmclt1") + w[k][j:], w[k][:j] + w[k][j + 1 :], w[k][:j] + rng.choice("abcdeu") + w[k][j + 1 :], w[k][:j] + w[k][j + 1 : j + 2] + w[k][j : j + 1] + w[k][j + 2 :]]) or "x"
        if rng.random() < 0.2:
            w.insert(rng.randrange(len(w) + 1), rng.choice(["north", "springs", "ubham"]))
        want: dict[int, float] = {}
        for i, p in enumerate(g.places):
            score = max(token_set(w, list(x)) for x in (p.words, p.former) if x)
            if score >= LIKE:
                want[i] = score
        assert g.similar(None, w) == want


def test_edits():
    assert edits("abcd", "abdc", 2) == 1 and edits("abc", "axbyc", 2) == 2 and edits("abc", "xyz", 1) == 2 and edits("", "ab", 3) == 2
    assert likeness("ormham", "orrnham") > 0.8 and likeness("abc", "xyz") == 0.0


def _plain_edits(a, b):
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_edits_against_the_plain_recurrence():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 9)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))) if rng.random() < 0.5 else a[: rng.randrange(9)] + rng.choice("abc") + a[2:]
        for most in range(6):
            assert edits(a, b, most) == min(_plain_edits(a, b), most + 1), (a, b, most)


def test_locate(spark, rows):
    g = spark.createDataFrame(PLACES, "place_id int, name string, county_name string, state_name string, former_name string, population int")
    cities = [(k, *c[0], "x", 9) for k, c in enumerate(CASES)]
    schema = "row_id bigint, name string, county_name string, state_name string, publication string, population int, how string, place_id int"
    df = spark.createDataFrame(cities + cities[:3] + [(99, "x" * 100_000, None, "Ohio", "Ohio", None, "x", 1)], schema)
    assert rows(locate(df, g), "row_id", "place_id") == sorted([(k, w) for k, (_, w) in enumerate(CASES)] + [(99, 0)], key=repr)
    assert locate(df.limit(0), g).count() == 0 and {r.place_id for r in locate(df, g.limit(0)).collect()} == {0}
