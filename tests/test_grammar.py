import random
import time

import printed
import pytest
from pyspark.sql import functions as F

from quirework.functions import grammar
from quirework.functions.grammar import CITY, DOC_FULL, DOC_START, DOC_TO_ADDR, STATE, UNKNOWN


def _kinds(spark, lines, of):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(lines)], "k int, t string")
    got = {r.k: r.kind for r in df.select("k", of(F.col("t")).alias("kind")).collect()}
    return [(t, got[k]) for k, (t, _) in enumerate(lines)]


def test_line_types(spark):
    rng = random.Random(4)
    lines = [printed.line(rng) for _ in range(400)] + [("", UNKNOWN), (None, None), ("x" * 5000, UNKNOWN)]
    assert _kinds(spark, lines, grammar.line_type) == lines
    assert {k for _, k in lines} == {STATE, CITY, DOC_START, DOC_TO_ADDR, grammar.DOC_TO_OFF, DOC_FULL, UNKNOWN, None}


def test_lines_of_any_length(spark):
    rng = random.Random(5)
    lines = []
    for size in (1_958, 2_038, 5_000, 60_000):
        street = "1 " + "Wex " * (size // 4) + "St."
        for office, kind in ((False, DOC_TO_ADDR), (True, grammar.DOC_TO_OFF)):
            parts = printed.doctor(rng, False, False, False)[0]
            lines += [("; ".join([" ".join(parts), f"office, {street}" if office else street]), kind), ("; ".join([" ".join(parts), street, "9-11"]), DOC_FULL)]
        lines.append((f"{printed.name(rng)}-{', '.join(printed.school(rng) for _ in range(size // 9))}; (l 04)", DOC_FULL))
    assert _kinds(spark, lines, grammar.line_type) == lines and _kinds(spark, lines, grammar.wide_line_type) == lines


def test_loose_city(spark):
    df = spark.createDataFrame([("Arc11ia, 925, Bienvile.",), ("A, b", ), ("POOLE, W.; 1, x, y",)], "t string")
    assert [r[0] for r in df.select(grammar.is_loose_city(F.col("t"))).collect()] == [True, False, False]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Harwick, 312,457, Orland", ("Harwick", 312457, "Orland", None, None)),
        ("Marlby, -, Dunn.", ("Marlby", None, "Dunn", None, None)),
        ("HOBURN, 263, Falwick (RD Thackford).", ("HOBURN", 263, "Falwick", "Thackford", "RFD")),
        ("Cromhurst, 2,693, Falwick (P.O. Ingcroft)", ("Cromhurst", 2693, "Falwick", "Ingcroft", "PO")),
        ("Cromhurst, Falwick (Ingcroft P.O.)", ("Cromhurst", None, "Falwick", "Ingcroft", "PO")),
        ("", (None, None, None, None, None)),
    ],
)
def test_city_fields(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert tuple(df.select(grammar.city_fields(F.col("t")).alias("c")).select("c.*").first()) == want


def test_doctor_fields():
    d = grammar.read_doctor("KIRKEN, ROBERT HENRY (b'62) ⊕-Ill.11,'04, N.Y.5,'77; (l 13); 508 W. 6th Ave.; office, Trust Bldg., Room 610; 9-11;30; (C10,E7); Path★; ▼G; Supt., Yar Hospital")
    assert d[0] == "KIRKEN, ROBERT HENRY" and d[1] and d[2] and not d[3] and d[4] == "62"
    assert d[5] == ["Ill.11,'04", "N.Y.5,'77"] and d[6] == "13" and d[7] is False
    assert d[8:14] == ("508 W. 6th Ave.", "Trust Bldg., Room 610", "9-11;30", "C10,E7", "Path★", "▼G") and d[14] == "Supt., Yar Hospital"
    d = grammar.read_doctor("Hobwick, Ezra (col.)-◊; (♁); not in practice")
    assert d[1] is False and d[3] and d[5] == [] and d[6] == "-1" and d[7]
    assert grammar.read_doctor("Marks, L. H.-Kan.2,'84; (l t); R. D. 2")[6] == "-2"
    assert grammar.read_doctor(None) is None and grammar.read_doctor("no dash") is None and grammar.read_doctor("") is None


def test_doctor_udf_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "KAY, A.-Ala.2,'90; (l 91)")], "k int, t string")
    got = {r.k: r.f for r in df.select("k", grammar.doctor_fields("t").alias("f")).collect()}
    assert got[3].name == "KAY, A." and got[3].license_year == "91" and got[1].name is None and got[2].name is None


def test_wide_grammar(spark):
    rng = random.Random(6)
    wide = [
        ("ÅSKILD, CLARA L.-Wis.6,'83; (l 03)", DOC_FULL), ("VOSBY, EZRA W.-S.D.15,'12, Ky.15,'73; (l 01); 1068 S. Oak Ave.", DOC_TO_ADDR), ("Yarley-Jarvworth, Charles (b'87)-Me.9,'07; (‡); 1-3; (E15,4)", DOC_FULL),
        ("Cromland, Samuel (b'80)-Fla.6; (l 13); D", DOC_FULL), ("Jesry, Anna-Univ. of Yarhurst; Med. Faculty, '72, Fla.6,'78; (l 87)", DOC_FULL), ("Ubburn, Martha H.-△; (l 05); 508 1/2 W. 6th Ave. (res.)", DOC_TO_ADDR),
        ("Saint-Côme—Continued, 126, D'Orsay Co.", CITY), ("1455.", UNKNOWN), (None, None),
    ]
    wide += [x for x in (printed.line(rng) for _ in range(200)) if x[1] != UNKNOWN]
    assert _kinds(spark, wide, grammar.wide_line_type) == wide


def test_no_line_takes_long(spark):
    n = 60_000
    hard = ["A" * n, "A, " * (n // 3), "A b, c" * (n // 6), "A, B-Ala.1,'0" * (n // 13), "A, B-" + "Ala.1,'01, " * (n // 11), "A, B-◊; " + "1 a " * (n // 4), "A, B-◊; (l 01); " + "1-2, " * (n // 5), "A, B-◊; (A1" + ",A1" * (n // 3), "Univ. of a; " * (n // 12), "A, B-◊; " + "S, " * (n // 3), "A, B-◊; 1" + "½," * (n // 2)]
    df = spark.createDataFrame([(t,) for t in hard], "t string").coalesce(1)
    began = time.time()
    df.select(grammar.line_type(F.col("t")), grammar.wide_line_type(F.col("t"))).collect()
    assert time.time() - began < 30
