import random

import pytest
from pyspark.sql import functions as F

from quirework.llm.scan_noise import HEADER, HYPHEN, MISREAD, PAGE_NUMBER, Line, Reader, _with_edges, confused, entry_noise, judged, learn, line_noise, mended, misread_forms, noise_kinds, read_page, repair_mixed, shape, usable

SHAPES = ("9 =REGISTER =OF =PHYSICIANS", "P =Continued 9", "W — P")
FORMS = {"otfice": "office", "practicc": "practice"}
COUNTS = dict.fromkeys("Hugh NORTHOLME Selenshaw office National well known self evident cooperate co co-operate co-operate: the".split(), 2) | {"co-operate": 5}


class Known(dict):
    """The judgement of hyphens by brute force."""

    def get(self, key, default=None):
        left, right, how = key
        n = lambda w: COUNTS.get(w, 0)
        joined, hyphened = n(left + right), n(f"{left}-{right}")
        if how == "end":
            return not n(left)
        if how == "inner":
            return joined > 0 and joined >= hyphened
        if how == "capitals":
            return joined > 0 or not (n(left) and n(right))
        return joined >= hyphened if joined or hyphened else not ((n(left) or n(left.lower())) and n(right))


def _reader(ahead=900):
    r = Reader(SHAPES, FORMS, ("office", "Bldg"))
    r.judged = Known()
    r.at("Maine", ahead, ())
    return r


ENTRIES = [
    ("Kay, Hugh-Ala.2,'90; (l 91); 5 Oak St.", 0), ("Kay, Hugh-Ala.2,'90; (1 91)", MISREAD), ("KAY, HUGH (b'62) Q+-Ala.2,'90", MISREAD), ("Kay-¢; (l t)", MISREAD), ("5 Oak St.; otfice, 7 Elm 5t.", MISREAD),
    ("9 Merchaots Trust Bldg.; 13th St.; (A44,E5); RD4 Box 2", 0), ("5 Oak St.; of- fice, 7", HYPHEN), ("JOHN- SON, I.", HYPHEN), ("2 NORTH- OLME Ave.", HYPHEN), ("KAY-MOOR, H.; 8-10, 1-3", 0), ("Kay, H.- Kan.3,'84", 0),
    ("Kay, 911 REGISTER OF PHYS1CIANS Hugh", HEADER | MISREAD), ("Kay, Maine (Continued) 911 Hugh", HEADER), ("HOLGATE—MAINE", HEADER), ("Kay, H. [911] (l 91)", PAGE_NUMBER), ("— 911 —", PAGE_NUMBER), ("911", PAGE_NUMBER), ("Page 911", PAGE_NUMBER),
    ("911 Oak St.", 0), ("NUMBER OF PHYSICIANS IN MAINE, 526", 0), ("Box [77] 8", 0), ("x Se-lenshaw", HYPHEN), ("", 0), (None, 0), ("MAINE", 0), ("not in practicc", MISREAD), ("Nati- onal Bank", HYPHEN), ("a well-\nknown man", 0), ("Self-\nevident", 0), ("to co-\noperate", 0), ("co-operate", 0), ("LONG—MAINE; x", HEADER),
]


@pytest.mark.parametrize(("text", "want"), ENTRIES)
def test_entries(text, want):
    assert _reader().entry(text, 11) == want


def test_mending():
    r = _reader()
    assert r.mend("Kay, Hugh-Ala.2,'90; (1 91); 911 REGISTER OF PHYSICIANS 0ff1ce, Har-\nlow B1dg. [911] (b'62) Q+-x", 11) == "Kay, Hugh-Ala.2,'90; (l 91); office, Harlow Bldg. (b'62) ⊕-x"
    assert r.mend("911", 11) == "" and r.mend(None, 11) is None and r.mend("KAY-\nMOOR", 1) == "KAYMOOR" and r.mend("a well-\nknown man", 1) == "a well-known man"


def test_hyphens_are_judged_as_by_brute_force(spark, rows):
    parts = ["well", "known", "self", "evident", "co", "operate", "offi", "ce", "NORTH", "OLME", "Self", "Hugh", "x"]
    asked = [(a, b, how) for a in parts for b in [*parts, ""] for how in ("small", "capitals", "inner", "end")]
    words = spark.createDataFrame([(w, n) for w, n in COUNTS.items()], "w string, n bigint")
    got = judged(spark.createDataFrame(asked * 2, "lft string, rgt string, how string"), words)
    assert rows(got) == sorted(k for k in asked if Known().get(k))


def test_misread_forms_are_learnt_from_counts(spark):
    rng = random.Random(2)
    counts = {w: 4000 for w in ("farm", "the", "medicine", "physician", "Catharine", "Benjamin", "Ave")}
    counts |= {"farrn": 3, "tbe": 20, "rnedicine": 4, "physiciau": 2, "Catharinc": 5, "Benjarnin": 1, "Avc": 3, "Barnford": 900, "Fam": 100}
    for _ in range(60):  # a name that the printer misspells in all ways
        k = rng.randrange(8)
        counts.setdefault("Barnford"[:k] + rng.choice("aeiouqcmnrst") + "Barnford"[k + 1 :], rng.randrange(1, 4))
    forms, frequent = misread_forms(spark.createDataFrame(list(counts.items()), "w string, n bigint"))
    want = {"farrn": "farm", "rnedicine": "medicine", "tbe": "the", "physiciau": "physician", "Catharinc": "Catharine", "Benjarnin": "Benjamin", "Avc": "Ave"}
    assert {v: w for v, w in forms.items() if w != "Barnford"} == want and "Barnford" not in forms.values() and frequent[0] in counts
    assert misread_forms(spark.createDataFrame([], "w string, n bigint")) == ({}, ())
    assert {"rnedicine", "mcdicine"} <= set(confused("medicine"))


def test_pages_of_any_size_are_read_in_a_few_lines():
    def endless():
        for k in range(3000):
            yield Line(k, 11, k // 1000, "of-" if k % 1000 in (5, 998) else "fice" if k % 1000 in (6, 999) else "911" if k in (7, 1000) else "Kay, Hugh")

    r = _reader()
    held = most = 0
    seen = []

    def source():
        nonlocal held, most
        for x in endless():
            held += 1
            most = max(most, held)
            yield x

    for x in read_page(_with_edges(source()), r):
        held -= 1
        seen.append(x)
    assert most <= 8 and sorted(x.line_id for x in seen) == list(range(3000))
    got = {x.line_id: x.mask for x in seen if x.mask}
    assert got == {k: HYPHEN for c in range(3) for k in (1000 * c + 5, 1000 * c + 998)} | {1000: PAGE_NUMBER}


def test_parts():
    assert repair_mixed("AR1ZONA Fa1ley 0ffice 13th A44 9") == "ARIZONA Falley office 13th A44 9"
    assert shape("Register of Physicians 912 Maine", "Maine", frozenset({"Register", "Physicians"})) == "=Register =of =Physicians 9 P"
    assert usable("W — P") and usable("P — W") and usable("P =Continued 9") and not usable("P") and not usable("9") and not usable("=Page 9") and not usable("W 9")


def _of(model, column):
    return {r["_pub"]: r[column] for r in model.publications.where(F.col(column).isNotNull()).collect()}


def _book(spark):
    """Two small publications with running heads, page numbers and a few broken words."""
    lines, k = [], 0
    for p, first in (("Maine", 900), ("Ohio", 40)):
        for page in range(1, 9):
            for col in range(2):
                body = [f"Kay, Hugh-Ala.{page},'90; (l 9{col}); 5 Oak St.; of-", "fice, 7 Elm St.; 9-11", "HOLT, IDA (b'62)-Kan.2,'84; Hugh-", "Me.3,'77; after 6", "Lane, Ezra-Ga.2,'71; (l 12)", "21 Ash Ave.; until 9", "Moss, H.-Pa.1,'80; 3 Bay Rd."]
                head = [f"{first + page} REGISTER OF PHYSICIANS" if page % 2 else f"REGISTER OF PHYSICIANS—{p.upper()}"] if col == 0 else []
                foot = [str(first + page)] if col == 1 and page % 2 == 0 else []
                for no, t in enumerate(head + body + foot):
                    k += 1
                    lines.append((k, p, page, col, no, t))
    lines += [(9001, "Maine", 9, 0, 0, None), (9002, "Maine", 9, 0, 1, ""), (9003, None, None, None, 0, "x"), (9004, "Maine", 9, 0, 2, "y" * 100_000), (9005, "Maine", 9, 0, 3, "Har-"), (9005, "Maine", 9, 0, 3, "Har-")]
    return spark.createDataFrame(lines, "line_id bigint, pub string, page int, col int, line_no int, text string")


def test_a_small_book(spark, rows):
    lines = _book(spark)
    e = "row_id bigint, publication string, page_number int, full_text string, loaded_at int, kinds string"
    entries = spark.createDataFrame([(1, "Maine", 3, "Kay, 903 REGISTER OF PHYSICIANS H.", 1, "k"), (1, "Maine", 3, "Kay, H.", 2, "k"), (2, "Ohio", 4, "44", 1, "k"), (3, "Ohio", 4, None, 1, "k"), (4, "Ohio", 4, "REGISTER OF PHYSICIANS—OHIO", 1, "k")], e)
    model = learn(lines, entries)
    assert _of(model, "ahead") == {"Maine": 900, "Ohio": 40} and set(model.shapes) == {"9 =REGISTER =OF =PHYSICIANS", "=REGISTER =OF =PHYSICIANS — P"}
    found = noise_kinds(line_noise(lines, model))
    apart = learn(lines, entries, sent=0)
    assert apart.told is None and rows(noise_kinds(line_noise(lines, apart))) == rows(found) and rows(mended(entries, apart)) == rows(mended(entries, model))
    texts = {r.line_id: r.text for r in lines.collect()}
    kinds = {k: {texts[r.key_id] for r in found.where(f"kind = '{k}'").collect()} for k in ("hyphen", "header", "page_number", "misread")}
    assert len(kinds["header"]) == 8 + 2 and all("REGISTER" in t for t in kinds["header"]) and kinds["page_number"] == {str(b + p) for b in (900, 40) for p in (2, 4, 6, 8)}
    assert all(t.endswith("of-") or t == "Har-" for t in kinds["hyphen"]) and "Har-" in kinds["hyphen"] and found.where("kind = 'hyphen'").count() == 33 and not kinds["misread"]
    assert rows(noise_kinds(entry_noise(entries, model))) == [(2, "page_number"), (4, "header")]
    assert {r.row_id: r.clean for r in mended(entries, model).collect()} == {1: "Kay, H.", 2: "", 3: None, 4: ""}
    assert {r.row_id: r.clean for r in mended(entries.where("loaded_at = 1"), model).collect()} == {1: "Kay, H.", 2: "", 3: None, 4: ""}
    nothing = learn(lines.limit(0), entries.limit(0))
    assert line_noise(lines.limit(0), nothing).count() == 0 and entry_noise(entries.limit(0), nothing).count() == 0 and nothing.shapes == ()


def test_heads_of_a_small_publication_beside_a_large_one(spark, rows):
    kind = "line_id bigint, pub string, page int, col int, line_no int, text string"
    small = [(p * 10 + k, "Maine", p, 0, k, t) for p in range(1, 7) for k, t in enumerate([f"LIST OF HEALERS {900 + p}", "Kay, Hugh", "5 Oak St.", f"Moss {'abcdefg'[p] * 5}, Ida"])]
    large = spark.range(20_000).selectExpr("id + 1000 as line_id", "'Ohio' as pub", "cast(id as int) as page", "0 as col", "0 as line_no", "array_join(transform(sequence(1, 30), k -> translate(id * 30 + k + 1000, '0123456789', 'abcdefghij')), ' ') as text")
    lines = spark.createDataFrame([*small, (99, "Ohio", 1, 0, -1, "LIST OF HEALERS 12")], kind).unionByName(large)
    entries = spark.createDataFrame([(1, "Maine", 3, "Kay, 903 LIST OF HEALERS 903 H.", 1), (2, "Ohio", 3, "LIST OF HEALERS 903", 1)], "row_id bigint, publication string, page_number int, full_text string, loaded_at int")
    model = learn(lines, entries)
    assert model.shapes == () and _of(model, "own") == {"Maine": ["=LIST =OF =HEALERS 9"]} and _of(model, "ahead")["Maine"] == 900
    assert rows(noise_kinds(line_noise(lines, model)).where("kind = 'header'")) == [(p * 10, "header") for p in range(1, 7)]
    assert rows(noise_kinds(entry_noise(entries, model))) == [(1, "header")]


@pytest.mark.parametrize(("text", "want"), [("14211", PAGE_NUMBER), ("— 14211 —", PAGE_NUMBER), ("Page 14211", PAGE_NUMBER), ("Kay, H. [14211] (l 91)", PAGE_NUMBER), ("14212", 0), ("142111", 0)])
def test_page_numbers_of_five_digits(text, want):
    r = _reader()
    assert r.entry(text, 13311) == want
    assert r.mend("Kay, H. [14211] (l 91)", 13311) == "Kay, H. (l 91)"


def test_ten_thousand_publications_hide_no_head(spark, rows):
    kind = "line_id bigint, pub string, page int, col int, line_no int, text string"
    small = [(p * 10 + k, "Maine", p, 0, k, t) for p in range(1, 7) for k, t in enumerate([f"LIST OF HEALERS {900 + p}", "Kay, Hugh", "5 Oak St.", f"Moss {'abcdefg'[p] * 5}, Ida"])]
    many = spark.range(60_000).selectExpr("id + 1000 as line_id", "concat('P', id div 6) as pub", "cast(id % 6 + 1 as int) as page", "0 as col", "0 as line_no", "concat('ROLL', translate(cast(id div 6 as string), '0123456789', 'ABCDEFGHIJ'), ' OF SURGEONS ', id % 6 + 41) as text")
    lines = spark.createDataFrame(small, kind).unionByName(many)
    model = learn(lines, spark.createDataFrame([], "row_id bigint, publication string, page_number int, full_text string, loaded_at int"))
    found = noise_kinds(line_noise(lines, model)).where("kind = 'header'")
    assert rows(found.where("key_id < 1000")) == [(p * 10, "header") for p in range(1, 7)] and found.count() == 60_006


@pytest.mark.parametrize("shift", [0, 40])
def test_many_copies_of_a_book_lose_nothing(spark, rows, shift):
    """Copies under other keys at the same places, and on further pages whose printed numbers begin anew."""
    lines = _book(spark).where("line_id < 9000")
    entries = spark.createDataFrame([(1, "Maine", 3, "Kay, [903] H.", 1), (2, "Ohio", 4, "44", 1), (3, "Ohio", 4, "REGISTER OF PHYSICIANS—OHIO", 1)], "row_id bigint, publication string, page_number int, full_text string, loaded_at int")

    def found(lines, entries, sent=500_000):
        model = learn(lines, entries, sent=sent)
        return rows(noise_kinds(line_noise(lines, model))), rows(noise_kinds(entry_noise(entries, model)))

    k = spark.range(8).withColumnRenamed("id", "k")
    page = lambda c: (F.col(c) + F.col("k") * shift).cast("int")
    many = lines.crossJoin(k).withColumns({"line_id": F.col("line_id") + F.col("k") * 10_000, "page": page("page")}).drop("k")
    more = entries.crossJoin(k).withColumns({"row_id": F.col("row_id") + F.col("k") * 10, "page_number": page("page_number")}).drop("k")
    for one, got, sent, step in zip(found(lines, entries), found(many, more), found(many, more, 0), (10_000, 10)):
        assert len(one) >= 3 and got == sent == sorted(((key + step * i, kind) for key, kind in one for i in range(8)), key=repr)


def test_pieces_of_broken_words_found_alone_are_no_words(spark, rows):
    words = spark.createDataFrame([("office", 900), ("offi", 3), ("ce", 2), ("GEORGE", 40), ("GEORGETOWN", 9), ("well", 2), ("known", 5)], "w string, n bigint")
    asked = [("offi", "ce", "small")] * 7 + [("offi", "", "end"), ("offi", "", "end"), ("offi", "known", "small"), ("well", "ce", "small"), ("GEORGE", "TOWN", "capitals"), ("GEORGE", "", "end"), ("well", "known", "small")]
    got = rows(judged(spark.createDataFrame(asked, "lft string, rgt string, how string"), words))
    assert got == [("GEORGE", "TOWN", "capitals"), ("offi", "", "end"), ("offi", "ce", "small"), ("offi", "known", "small"), ("well", "ce", "small")]
