import time
from datetime import datetime as dt

import pytest

from quirework.operators.differences import copy_differences
from quirework.operators.packed import SCHOOL, SOCIETY, Packed, unpack_fields
from quirework.operators.references import Reference, Table, direct_orphans, orphan_cascade, orphan_report

A = "id bigint, n int, t string, at timestamp_ntz, extra string, key_id int"
B = "id bigint, n string, t string, at timestamp_ntz, row int"
D1, D2, D3 = dt(2025, 1, 1), dt(2025, 2, 1), dt(2025, 3, 1)


def test_differences_of_copies(spark, rows):
    a = spark.createDataFrame(
        [(1, 5, " x ", D1, "e", 1), (1, 7, "old", D1, "e", 1), (2, 3, None, D1, "e", 1), (3, 1, "a", D1, "e", 1), (3, 1, "a", D1, "e", 1), (4, 2, "old", D1, "e", 1), (4, 9, "new", D2, "e", 1), (6, 1, "ä", D1, None, 1)],
        A,
    )
    b = spark.createDataFrame(
        [(1, "007", "old\r\n", D2, 1), (2, "3.0", "", D1, 1), (4, "9", "new", D2, 1), (5, "1", "b", D1, 1), (6, "x", "ä", D1, 1)], B
    )
    got = rows(copy_differences(a, b, "id", "at").select("key_id", "field", "kind"))
    assert got == sorted([(3, "*", "missing_in_b"), (5, "*", "missing_in_a"), (6, "n", "differs"), (6, "t", "differs")], key=repr)


def test_differences_of_empty_tables_and_null_keys(spark, rows):
    a, b = spark.createDataFrame([], A), spark.createDataFrame([], B)
    assert copy_differences(a, b, "id", "at").count() == 0
    one = spark.createDataFrame([(None, 1, "x", D1, None, 1), (1, None, None, None, None, 1)], A)
    assert rows(copy_differences(one, b, "id", "at")) == sorted([(None, "*", "missing_in_b"), (1, "*", "missing_in_b")], key=repr)
    same = spark.createDataFrame([(None, "1", "x", D1, 1), (1, "", " ", D2, 1)], B)
    assert copy_differences(one, same, "id", "at").count() == 0


def test_rows_without_a_key_are_a_multiset(spark, rows):
    a = spark.createDataFrame([(None, 1, "x", D1, "", 1)] * 3 + [(None, 2, "y", D2, "", 1), (7, 1, "x", D1, "", 1)], A)
    b = spark.createDataFrame([(None, "1", "x", D3, 1), (None, "4", "z", D1, 1), (None, "4", "z", D2, 1)], B)
    want = [(None, "*", "missing_in_a")] * 2 + [(None, "*", "missing_in_b")] * 3 + [(7, "*", "missing_in_b")]
    assert rows(copy_differences(a, b, "id", "at")) == sorted(want, key=repr)
    assert rows(copy_differences(a, b.limit(0), "id", "at")) == sorted([(None, "*", "missing_in_b")] * 4 + [(7, "*", "missing_in_b")], key=repr)


def test_tables_that_share_no_field(spark, rows):
    a, b = spark.createDataFrame([(1, 2), (3, 4)], "id int, p int"), spark.createDataFrame([(1, 2)], "id int, q int")
    assert rows(copy_differences(a, b, "id")) == [(3, "*", "missing_in_b")]


def test_differences_of_very_long_texts(spark, rows):
    a = spark.createDataFrame([(1, 1, "x" * 300_000, D1, "", 1)], A)
    b = spark.createDataFrame([(1, "1", "x" * 299_999 + "y", D1, 1)], B)
    assert rows(copy_differences(a, b, "id", "at")) == [(1, "t", "differs")]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Tex.5,'82, Miss.7,'79", ["Tex.5,'82", "Miss.7,'79"]), ("Ark.11, Mass.4,'87", ["Ark.11", "Mass.4,'87"]), ("O.3,'15; Ark.8, '02", ["O.3,'15", "Ark.8,'02"]),
        ('"Univ. of Yarhurst; Med. Faculty, \'72","Fla. 6,\'78"', ["Univ.ofYarhurst;Med.Faculty,'72", "Fla.6,'78"]), ("Colo.2,'91\nArk.2,'09", ["Colo.2,'91", "Ark.2,'09"]),
        ("Univ. of Dun; Med. Faculty, '72 / N.Y.3,'68", ["Univ.ofDun;Med.Faculty,'72", "N.Y.3,'68"]), ("Ga.2,'13;;Pa.13,'72;", ["Ga.2,'13", "Pa.13,'72"]),
        ("Ia.7,'77 and Ore.5,'12 + O.4,'95", ["Ia.7,'77", "Ore.5,'12", "O.4,'95"]), ("◊", []), ("△", []), ("", []), ('"Ga.2,\'13', ["Ga.2,'13"]), ("S.C.10,'84|Ark.2, '99", ["S.C.10,'84", "Ark.2,'99"]),
    ],
)
def test_schools(text, want):
    assert [v.text for v in Packed(SCHOOL).parse(text)] == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("(A44,34)", ["A44", "34"]), ("(B37)(C27)", ["B37", "C27"]), ("[F56/13/G6]", ["F56", "13", "G6"]), ("C5 2", ["C5", "2"]), ("(C39, E32 and B46)", ["C39", "E32", "B46"]),
        ("( and D42)", ["D42"]), ('"(D35,G15)"', ["D35", "G15"]), ("A36|C19|", ["A36", "C19"]), ("B40; D11 & 7", ["B40", "D11", "7"]), ("((((((((((A1", ["A1"]), ("(" * 3000 + "A1,B2", ["A1", "B2"]), ("[" * 45 + "A1" + "]" * 45, ["A1"]),
        ("(" * 20_000 + "A1" + ")" * 20_000, ["A1"]), ("(" * 20_000 + "A1)", ["A1"]), ('"(' * 5000 + "A1)", ["A1"]),
    ],
)
def test_societies(text, want):
    assert [v.text for v in Packed(SOCIETY).parse(text)] == want


def test_nested_values_have_no_error():
    assert Packed(SOCIETY).parse("[" * 45 + "A1,B2" + "]" * 45)[0].error is None
    assert [v.error for v in Packed(SOCIETY).parse("((A1)")] == ["stray_bracket"]


def test_long_fields_take_time_in_proportion():
    began = time.time()
    name = "Univ. of " + "Wex " * 500
    assert [v.text for v in Packed(SCHOOL).parse(f"{name}; Med. Faculty, '72, Fla.6,'78")] == [f"{name}; Med. Faculty, '72".replace(" ", ""), "Fla.6,'78"]
    for text in ("Aa " * 100_000, "Aa " * 100_000 + ";" + "Bb " * 100_000, "Fla.6,'78, " * 30_000, "A. " * 100_000, "([" * 50_000 + "A1" + ")" * 50_000):
        assert Packed(SCHOOL).parse(text)
    assert time.time() - began < 20


def test_packed_errors_and_positions(spark, rows):
    df = spark.createDataFrame([(1, '"Ga.2,\'13, Pa.1', "(A1,??"), (2, None, ""), (3, "◊", "(B2)")], "row_id bigint, schools string, societies string")
    got = rows(unpack_fields(df, "row_id", {"schools": SCHOOL, "societies": SOCIETY}).select("row_id", "field", "pos", "n", "val", "error"))
    assert got == sorted(
        [
            (1, "schools", 1, 2, "Ga.2,'13", "stray_quote"), (1, "schools", 2, 2, "Pa.1", None), (1, "societies", 1, 2, "A1", "stray_bracket"),
            (1, "societies", 2, 2, "??", "unknown_form"), (3, "societies", 1, 1, "B2", None),
        ],
        key=repr,
    )
    assert unpack_fields(df.limit(0), "row_id", {"schools": SCHOOL}).count() == 0


def _graph(spark, lines, cities, doctors):
    s = "row_id bigint, entry_id string, ref string, at timestamp_ntz, gone timestamp_ntz"
    t = {n: Table(spark.createDataFrame(r, s), "row_id", "entry_id", "at", "gone") for n, r in (("lines", lines), ("cities", cities), ("doctors", doctors))}
    return t, [Reference("doctors", "ref", "cities"), Reference("cities", "ref", "lines")]


def test_orphans(spark, rows):
    lines = [(1, "l1", None, D1, None), (2, "l2", None, D3, None)]
    cities = [(1, "c1", "l1", D1, None), (2, "c2", "l9", D2, None), (3, "c3", "l1", D1, D3), (4, "c4", "l2", D1, None), (5, "c5", None, D1, None)]
    doctors = [
        (1, "d1", "c1", D1, None), (2, "d2", "c2", D2, None), (3, "d3", "c3", D2, None), (4, "d4", "c9", D3, None), (4, "d4", "c9", D2, None), (5, "d5", None, D1, None),
        (6, "d6", "c4", D2, None), (7, "d7", "c1", dt(2024, 12, 31), None), (8, "d8", "", D1, None),
    ]
    t, refs = _graph(spark, lines, cities, doctors)
    want = [
        ("doctors", 3, "deleted", "2025-02"), ("doctors", 4, "missing", "2025-02"), ("doctors", 7, "late", "2024-12"), ("doctors", 8, "missing", "2025-01"),
        ("cities", 2, "missing", "2025-02"), ("cities", 4, "late", "2025-01"),
    ]
    assert rows(direct_orphans(t, refs), "table_name", "row_id", "reason", "period") == sorted(want, key=repr)
    full = orphan_cascade(t, refs)
    assert rows(full.where("depth > 0"), "table_name", "row_id", "reason", "depth") == [("doctors", 2, "inherited", 1), ("doctors", 6, "inherited", 1)]
    assert rows(orphan_report(full).where("reason = 'inherited'"), "table_name", "period", "direct", "inherited") == [("doctors", "2025-02", 0, 2)]


def test_hot_keys_are_split_without_a_change(spark, rows):
    at = [dt(2025, 1, 1 + k % 28) for k in range(600)]
    doctors = [(k, f"d{k}", "c1" if k % 3 else f"c{k % 7}", at[k], None) for k in range(600)]
    cities = [(1, "c1", "l1", dt(2025, 1, 15), None), (2, "c2", "l1", D1, D2), (3, "c3", "l9", D1, None)]
    t, refs = _graph(spark, [(1, "l1", None, D1, None)], cities, doctors)
    whole = rows(direct_orphans(t, refs))
    assert len(whole) > 200 and rows(direct_orphans(t, refs, hot=10)) == whole


def test_orphans_in_a_circle_and_empty(spark):
    s = "row_id bigint, entry_id string, ref string, at timestamp_ntz"
    loop = Table(spark.createDataFrame([(1, "a", "b", D1), (2, "b", "a", D1), (3, "c", "x", D1), (4, "d", "c", D1), (5, "e", "d", D1)], s), "row_id", "entry_id", "at")
    got = orphan_cascade({"t": loop}, [Reference("t", "ref", "t")]).select("row_id", "depth").collect()
    assert sorted((r[0], r[1]) for r in got) == [(3, 0), (4, 1), (5, 2)]
    none = Table(spark.createDataFrame([], s), "row_id", "entry_id", "at")
    assert orphan_cascade({"t": none}, [Reference("t", "ref", "t")]).count() == 0
