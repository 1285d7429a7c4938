import random

import numpy as np
import pytest

from quirework.llm.addresses import ABBREVIATED, FORBIDDEN, MOST, alignment_cost, bands, form, same_forms, same_locations, members

SAME = [
    ("1824 S. Stonecipher Rd.", "Stonecpiher Road S., 1824"), ("1321 12th St.", "1321 TWELFTH Street"), ("2264 17 Pl.", "2264 Seventeenth"), ("1057 1/2 Belvoir St", "Belvoir Str., 1057 ½, rear"),
    ("P.O. Box 142", "Box 142"), ("P. O. 142", "Post Office Box 142"), ("R.D. 2, Box 5", "RD2 Box 5"), ("R.F.D. No. 2, Box 44", "Rural Route 2, Box 44"), ("Rm. 150, Mechanics Building", "MECHANCIS Bldg."),
    ("Vandermark Nat. Bank Bldg", "447 Vandermark Natl. Bk. Building"), ("No. 1630 N. Twentieth", "1630 20 th Ave. North, Fort Dun"), ("No. Hollister Rd., 5", "5 N Hollistr Road (res.)"), ("12 Rd., 1238", "1238 12th Rd."),
    ("2310 Osteman Road", "2310 E. Osterman Rd."), ("1974 Quincefield Ave W. (res.)", "1974 W. Quincefield Ave."), ("Guaranty Hosp., 9", "Guaranty Hospital, Room 3"), ("12 Ft. Wash. Ave.", "12 Fort Washington Av."), ("7 Mt. Hollister St.", "7 Mount Holister"),
]
OTHER = [
    ("2282 18th Blvd.", "2282 18th St."), ("1057 1/2 Belvoir St", "1057 Belvoir St"), ("849 S. 5th St.", "849 N. 5th St."), ("P.O. Box 142", "P.O. Box 14"), ("R.D. 2, Box 5", "R.D. 3, Box 5"),
    ("Harlow Bldg.", "Harlow Block"), ("Harlow Trust Bldg.", "Harlow Bldg."), ("Harlow Block", "Juniper Block"), ("12 6th St.", "12 16th St."), ("5 Vantage St.", "6 Vantage St."), ("9 Wexmoor St.", "9 Belvoir St."), ("142 Oak St.", "Box 142"),
]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(a, b):
    assert alignment_cost(form(a), form(b)) <= MOST and (form(a) == form(b) or np.equal(*bands([form(a), form(b)])[0].reshape(2, -1)).any())


def test_costs_of_abbreviations():
    assert alignment_cost("street|12|||ft wash|avenue", "street|12|||fort washington|avenue") == 2 * ABBREVIATED
    assert alignment_cost("street|12||n|oak|st", "street|12||north|oak|street") == 2 * ABBREVIATED
    assert alignment_cost("street|12||n|oak|st", "street|12||south|oak|street") >= FORBIDDEN


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other(a, b):
    assert alignment_cost(form(a), form(b)) >= FORBIDDEN


def test_unreadable():
    assert form("  ") is None and form(";,") is None and form("rear") is None
    form("x" * 50_000)


def test_recall_of_the_bands_against_brute_force(spark):
    rng = random.Random(6)
    # Names that no data has, so that nothing is fitted to them.
    names = ["".join(rng.choice(["bar", "cle", "dor", "fen", "gul", "hasp", "ilm", "kerr", "lo", "mund", "pra", "sti"]) for _ in range(rng.randrange(2, 5))).capitalize() for _ in range(60)]

    def spoil(n):
        k = rng.randrange(1, len(n) - 1)
        return rng.choice([n, n[:k] + n[k + 1 :], n[:k] + n[k] + n[k:], n[:k] + n[k + 1] + n[k] + n[k + 2 :], n[:k] + rng.choice("aeiorn") + n[k + 1 :]])

    data = [(k, "t1" if k % 3 else "t2", f"{rng.randrange(1, 12)} {rng.choice(['', 'N. ', 'S. '])}{spoil(rng.choice(names))} {rng.choice(['St.', 'Ave.', ''])}", None) for k in range(1500)]
    df = spark.createDataFrame(data, "row_id bigint, city_id string, address string, office string")
    found = members(df, "row_id", "city_id", ("address", "office"))
    forms = {(r.town, r.form) for r in found.collect()}
    want = {(t, *sorted((f, g))) for t, f in forms for u, g in forms if t == u and f < g and alignment_cost(f, g) <= MOST}
    got = {tuple(r) for r in same_forms(found).select("town", "form_a", "form_b").collect()}
    assert got <= want and len(got) / len(want) >= 0.97, len(got) / len(want)


def test_rows(spark, rows):
    schema = "row_id bigint, city_id string, address string, office string, form string, town string"
    df = spark.createDataFrame(
        [
            (1, "c", "12 Oak St.", "Box 7", "f", "t"), (2, "c", "Oak Street, 12", None, "f", "t"), (3, "c", "", "12 Oka St.", "f", "t"), (3, "c", "", "12 Oka St.", "f", "t"),
            (4, "d", "12 Oak St.", None, "f", "t"), (5, None, "12 Oak St.", None, "f", "t"), (6, "c", "P.O. Box 7", "P.O. 7", "f", "t"), (7, "c", None, " ", "f", "t"),
        ],
        schema,
    )
    want = [
        (1, "address", 2, "address"), (1, "address", 3, "office"), (2, "address", 3, "office"), (1, "office", 6, "address"), (1, "office", 6, "office"),
    ]
    assert rows(same_locations(df)) == sorted(want)
    assert same_locations(df.limit(0)).count() == 0
