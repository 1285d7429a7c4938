import random

import printed
from pyspark.sql import functions as F

from quirework.functions.grammar import CITY, DOC_FULL, DOC_TO_ADDR, DOC_TO_OFF, STATE, UNKNOWN, line_type
from quirework.operators import grouping

BOX = "pub string, page int, col int, line_no int, text string, x int, y int, width int, height int"


def _lines(spark, columns):
    data = [("P", 1, c, k, t, 10 + k, 100 * k, 50, 20) for c, lines in enumerate(columns) for k, t in enumerate(lines)]
    return spark.createDataFrame(data, BOX)


def _printed(rng):
    """Entries of one column as printed, each broken behind some of its semicolons into four lines at most."""
    entries = []
    for _ in range(rng.randrange(1, 9)):
        if rng.random() < 0.25:
            entries.append([rng.choice([printed.city(rng), printed.word(rng).upper(), "—"])])
            continue
        lines = [""]
        for part in printed.doctor(rng)[0]:
            lines[-1] = f"{lines[-1]} {part}".strip()
            if part.endswith(";") and len(lines) < 4 and rng.random() < 0.6:
                lines.append("")
        entries.append([x for x in lines if x])
    return entries


def test_entries_are_put_together_as_printed(spark):
    rng = random.Random(8)
    columns = [_printed(rng) for _ in range(40)]
    got = grouping.group_entries(_lines(spark, [sum(c, []) for c in columns])).orderBy("col", "ordinal").collect()
    for c, entries in enumerate(columns):
        own = [r for r in got if r.col == c]
        assert [r.full_text for r in own] == [" ".join(e) for e in entries]
        first = 0
        for r, e in zip(own, entries):
            assert (r.n_lines, r.x, r.y, r.width, r.height) == (len(e), 10 + first, 100 * first, 50 + len(e) - 1, 100 * (len(e) - 1) + 20)
            first += len(e)


def test_broken_words_are_joined(spark):
    lines = _lines(spark, [["Kes, Ida-◊; (l 04); of-", "fice, 7 Elm St.; 9-11", "Kes, Al-◊; (l 04); 7 KES-", "MOOR St.; 9-11", "Wex, Al- (l"]])
    got = grouping.group_entries(lines, mend=True).orderBy("ordinal").collect()
    assert [(r.full_text, r.n_lines) for r in got] == [("Kes, Ida-◊; (l 04); office, 7 Elm St.; 9-11", 2), ("Kes, Al-◊; (l 04); 7 KES- MOOR St.; 9-11", 2), ("Wex, Al- (l", 1)]


def _greedy(kinds, n, most=4):
    """The rule by brute force: `kinds[a, b]` is the kind of lines a to b."""
    a = 0
    while a < n:
        size, kind = 1, UNKNOWN
        for b in range(a, min(n, a + most)):
            k = kinds[a, b]
            if k in (STATE, CITY, DOC_FULL):
                size, kind = b - a + 1, k
                break
            if b > a and kinds[a, b - 1] in (DOC_TO_ADDR, DOC_TO_OFF):
                size, kind = b - a, DOC_FULL
                break
            if k in (DOC_TO_ADDR, DOC_TO_OFF) and b in (n - 1, a + most - 1):
                size, kind = b - a + 1, DOC_FULL
        yield a, size, kind
        a += size


def test_any_lines_against_brute_force(spark):
    rng = random.Random(3)
    parts = [x for _ in range(12) for e in _printed(rng) for x in e] + ["", None, "??", "1455.", "x" * 30_000]
    columns = [[rng.choice(parts) for _ in range(rng.randrange(1, 14))] for _ in range(40)]
    got = grouping.group_entries(_lines(spark, columns)).orderBy("col", "ordinal").collect()
    spans = [(c, a, b, " ".join(t or "" for t in lines[a : b + 1])) for c, lines in enumerate(columns) for a in range(len(lines)) for b in range(a, min(len(lines), a + 4))]
    typed = spark.createDataFrame(spans, "c int, a int, b int, t string").select("c", "a", "b", line_type(F.col("t")).alias("k")).collect()
    for c, lines in enumerate(columns):
        own = [r for r in got if r.col == c]
        want = list(_greedy({(r.a, r.b): r.k for r in typed if r.c == c}, len(lines)))
        assert [(r.n_lines, r.entry_type) for r in own] == [(s, k) for _, s, k in want]
        assert [r.full_text for r in own] == [" ".join(t or "" for t in lines[a : a + s]) for a, s, _ in want]


def test_empty(spark):
    assert grouping.group_entries(spark.createDataFrame([], BOX)).count() == 0


def test_spaced_peaks(spark):
    df = spark.createDataFrame([([5.0, 1.0, 2.0, 9.0, 6.5],), ([],)], "v array<double>")
    assert [r[0] for r in df.select(grouping.spaced_peaks(F.col("v"), 3)).collect()] == [[1.0, 5.0, 9.0], []]
