import random
import unicodedata

import pyarrow as pa
import pytest

from quirework.llm.arrow_text import code_points, to_arrow
from quirework.llm.lookalikes import flagged, normalise, normalise_array, odd_rows, one_forms, with_one_form

CASES = [
    ("plain text; 9-11, 2;30-4 ▼ ⊕ ◊ ★ † ♁ ‡ △ — é", None), ("ＷＩＬＬＩＡＭ １２", "WILLIAM 12"), ("oﬃce ﬁne", "office fine"), ("Mе.7", "Me.7"), ("ΑΒ", "AB"),
    ("a​b﻿c", "abc"), ("a b　c", "a b c"), ("é", "é"), ("Ǻx", "Ǻx"), ("Ǻ", "Ǻ"), ("𝐀ve", "Ave"), ("x́", None),
    ("e​́", "é"), ("line\nend\tx\r", None), ("½", None), ("", None), ("́", None), ("a\ń", None),
]


def _brute(text):
    """Character by character."""
    from quirework.llm.lookalikes import BLANK, INVISIBLE, tables

    t = tables()
    out = []
    for c in text:
        cp = ord(c)
        n = int(t["length"][cp])
        if int(t["start"][cp]) < 0x110000:
            out.append(c)
        else:
            s = int(t["start"][cp]) - 0x110000
            out += [chr(int(x)) for x in t["out"][s : s + n]]
        assert not (t["kind"][cp] & BLANK and out[-1] != " ") and not (t["kind"][cp] & INVISIBLE and n)
    joined: list[str] = []
    for c in out:
        one = unicodedata.normalize("NFC", joined[-1] + c) if joined else ""
        if joined and unicodedata.category(c) == "Mn" and len(one) == 1:
            joined[-1] = one
        else:
            joined.append(c)
    return "".join(joined)


@pytest.mark.parametrize(("text", "want"), CASES)
def test_one_form(text, want):
    column = pa.array([text])
    assert flagged(*code_points(column)).tolist() == [want is not None]
    assert normalise_array(column).to_pylist() == [want or text]


def test_against_brute_force_and_round_trip():
    rng = random.Random(2)
    alphabet = "ab é̈̊A＠Ａ​ оΡﬁ𝐁▼\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 12))) for _ in range(2000)] + [None]
    column = pa.array(texts)
    assert normalise_array(column).to_pylist() == [None if t is None else _brute(t) for t in texts]
    assert to_arrow(*code_points(column)).to_pylist() == [t or "" for t in texts]
    assert normalise_array(column.slice(7, 50)).to_pylist() == [_brute(t) for t in texts[7:57]]
    for k, flag in enumerate(flagged(*code_points(column))):
        assert flag == (texts[k] is not None and texts[k] != _brute(texts[k]))


def test_rows_versions_and_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, "ａ", 1, "c"), (1, "a", 2, "c"), (2, "a", 1, None), (2, "а", 2, None), (3, None, 1, "c"), (4, "", 1, "c"), (None, "ａ", 1, "c"), (5, "x" * 200_000 + "​", 1, "c"), (5, "x" * 200_000 + "​", 1, "c")],
        "id bigint, t string, v int, odd string",
    )
    assert rows(odd_rows(df, "id", "t", "v")) == sorted([(2,), (5,), (None,)], key=repr)
    assert odd_rows(df.limit(0), "id", "t").count() == 0
    got = with_one_form(df.where("id < 5"), "t")
    assert got.columns == ["id", "t", "v", "one_form", "odd"] and rows(got, "id", "one_form", "odd") == sorted(
        [(1, "a", True), (1, "a", False), (2, "a", False), (2, "a", True), (3, None, False), (4, "", False)], key=repr
    )


def test_one_form_of_every_key(spark, rows):
    df = spark.createDataFrame([(1, "ａ", 1), (1, "b", 2), (2, "plain", 1), (2, "plain", 1), (3, None, 1), (4, "", 1), (5, "а", None)], "id bigint, t string, v int")
    assert rows(one_forms(df, "id", "t", "v")) == [(1, "b", False), (2, "plain", False), (3, None, False), (4, "", False), (5, "a", True)]
    assert one_forms(df.limit(0), "id", "t", "v").count() == 0


def test_one_form_of_both_tables(spark, tmp_path, rows):
    from quirework.llm.queries import p5_one_form

    spark.createDataFrame([(1, "ﬁne", 1), (2, "fine", 1)], "line_id bigint, text string, scanned_at int").write.parquet(f"{tmp_path}/ocr_lines.parquet")
    spark.createDataFrame([(1, "x", 1), (1, "ｙ", 2)], "row_id bigint, full_text string, loaded_at int").write.parquet(f"{tmp_path}/classified_lines.parquet")
    want = [("classified_lines", 1, "y", True), ("ocr_lines", 1, "fine", True), ("ocr_lines", 2, "fine", False)]
    assert rows(p5_one_form(spark, str(tmp_path)), "table_name", "key_id", "one_form", "odd") == want


@pytest.mark.parametrize("text", ["Москва и область", "Ελλάδα", "Он сказал: «нет», и ушёл.", "See Москва, о том и речь", "Α και Ω, το πρώτο"])
def test_genuine_text_of_other_scripts_stays(text):
    cps, offsets = code_points(pa.array([text, "x"]))
    assert not flagged(cps, offsets).any() and to_arrow(*normalise(cps, offsets)).to_pylist() == [text, "x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("Mаine", "Maine"), ("Москва, Mаine", "Москва, Maine"), ("НОР", "HOP"), ("ОАК Street", "OAK Street"), ("hɑrɡ", "harg"), ("ᴀve", "ave"), ("Ꭺlma", "Alma"), ("rⲟad", "road"), ("Ⅿaine", "Maine"), ("M\u200bаine Москва", "Maine Москва"), ("о\u200bк", "ок")],
)
def test_letters_in_place_of_latin_ones(text, want):
    cps, offsets = code_points(pa.array(["Москва", text, ""]))
    assert flagged(cps, offsets).tolist() == [False, True, False] and to_arrow(*normalise(cps, offsets)).to_pylist() == ["Москва", want, ""]
