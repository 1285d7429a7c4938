"""Visually identical text with different characters: find it, and bring it to one form."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.arrow_text import code_points, per_row_any, to_arrow

#: Letters of other scripts and the Latin letters they look like. Fixed values.
CYRILLIC = "АВЕЅІЈКМНОРСТУХҮаеѕіјорсухүһԁԛԝӏѵ"
CYRILLIC_AS = "ABESIJKMHOPCTYXYaesijopcyxyhdqwlv"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿοιαρυνκϲϳ"
GREEK_AS = "ABEZHIKMNOPTYXCJoiapuvkcj"
ARMENIAN = "ՕՏԼհոսցօ"
ARMENIAN_AS = "OSLhnugo"
CHEROKEE = "ᎪᏴᏟᎠᎬᏀᎻᎥᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ"
CHEROKEE_AS = "ABCDEGHiJKLMPRSTVWZ"
COPTIC = "ⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲬⲟⲣⲥⲭ"
COPTIC_AS = "BEHIKMNOPCTXopcx"
#: Letters of the Latin script itself that stand for others in no language of the texts. Fixed values.
LATIN, LATIN_AS = "ɑɡɩıȷ", "agiij"
#: Scripts whose other letters show that a text is truly in them.
SCRIPTS = ("CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "COPTIC")

#: Forms of a character that differ in width or presentation only. Fixed values (tags of the character database).
FORM_TAGS = {"<wide>", "<narrow>", "<font>", "<small>", "<vertical>", "<initial>", "<medial>", "<final>", "<isolated>", "<circle>", "<square>", "<super>", "<sub>"}

FORM, MARK, INVISIBLE, BLANK, SCRIPT, GENUINE, PLAIN = 1, 2, 4, 8, 16, 32, 64
LIMIT = 0x110000


@functools.cache
def tables() -> dict[str, np.ndarray]:
    """kind: class bits of each code point; start, length, out: what each becomes; pair, composed: sorted
    (letter, mark) pairs and the single letter of each."""
    kind = np.zeros(LIMIT, np.uint8)
    start, length = np.arange(LIMIT, dtype=np.int64), np.ones(LIMIT, np.int64)
    out: list[int] = []
    changed: list[tuple[int, str]] = []
    pairs: dict[int, int] = {}
    looks = dict(zip(CYRILLIC + GREEK + ARMENIAN + CHEROKEE + COPTIC + LATIN, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS + CHEROKEE_AS + COPTIC_AS + LATIN_AS))
    # Small capitals, which the character database names after their letters.
    for letter in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        try:
            looks[unicodedata.lookup(f"LATIN LETTER SMALL CAPITAL {letter}")] = letter.lower()
        except KeyError:
            pass
    for cp in range(0x80, 0x30000):
        c = chr(cp)
        category = unicodedata.category(c)
        if category in ("Cn", "Cs", "Co"):
            continue
        if category == "Zs":
            kind[cp], new = BLANK, " "
        elif category in ("Cf", "Cc") and cp != 0x85 or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= cp <= 0xFE0F:
            kind[cp], new = INVISIBLE, ""
        elif c in looks:
            kind[cp], new = SCRIPT, looks[c]
        else:
            new = c
            tag, _, rest = unicodedata.decomposition(c).partition(" ")
            if tag in FORM_TAGS or tag == "<compat>" and (category[0] == "L" or category == "Nl"):
                kind[cp], new = FORM, unicodedata.normalize("NFKC", c)
            elif category == "Mn":
                kind[cp] = MARK
            elif tag and tag[0] != "<" and len(rest.split()) == 1 and unicodedata.normalize("NFC", c) == c:
                pairs[int(tag, 16) << 21 | int(rest, 16)] = cp
        if new != c:
            changed.append((cp, new))
        if category[0] in "LN" and (name := unicodedata.name(new[:1] or c, "")):
            if name.startswith("LATIN") and c not in looks:
                kind[cp] |= PLAIN
            elif c not in looks and name.startswith(SCRIPTS) and category[0] == "L":
                kind[cp] |= GENUINE
    for letter in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
        kind[ord(letter)] = PLAIN
    for cp in [*range(0x00, 0x09), 0x0B, 0x0C, *range(0x0E, 0x20), 0x7F]:
        kind[cp] = INVISIBLE
        changed.append((cp, ""))
    for cp in range(0xE0000, 0xE0200):
        kind[cp] = INVISIBLE
        changed.append((cp, ""))
    for cp, new in changed:
        start[cp], length[cp] = LIMIT + len(out), len(new)
        out += map(ord, new)
    keys = np.array(sorted(pairs), np.int64)
    return {
        "kind": kind, "start": start, "length": length, "out": np.array(out, np.uint32),
        "pair": keys, "composed": np.array([pairs[k] for k in keys.tolist()], np.uint32),
    }


def _compose(letter: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """The single letter of each (letter, mark), 0 if there is none."""
    t = tables()
    want = letter.astype(np.int64) << 21 | mark.astype(np.int64)
    at = np.minimum(np.searchsorted(t["pair"], want), len(t["pair"]) - 1)
    return np.where(t["pair"][at] == want, t["composed"][at], 0)


def _genuine(kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The letters that look like Latin ones and are none, but stand for themselves: those of a text that has other
    letters of such scripts, in words without a Latin letter. Marks and what is invisible part no words."""
    out = (kind & SCRIPT) > 0
    at = np.flatnonzero(out)
    if not len(at):
        return out
    row = np.searchsorted(offsets, at, "right") - 1
    some = per_row_any((kind & GENUINE) > 0, offsets)[row]
    out[at[~some]] = False
    if some.any():
        inside = (kind & (SCRIPT | GENUINE | PLAIN | MARK | INVISIBLE)) > 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < len(kind)]
        begins[firsts] = inside[firsts]
        word = np.cumsum(begins)
        mixed = np.bincount(word[(kind & PLAIN) > 0], minlength=int(word[-1]) + 1) > 0
        out[at[some]] = ~mixed[word[at[some]]]
    return out


def _expand(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every code point replaced by what it becomes, by gathers over a table."""
    t = tables()
    lengths, starts = t["length"][cps], t["start"][cps]
    own = _genuine(t["kind"][cps], offsets)
    if own.any():
        lengths[own], starts[own] = 1, cps[own]
    ends = np.zeros(len(cps) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    first = np.repeat(starts, lengths)
    place = np.arange(ends[-1]) - np.repeat(ends[:-1], lengths)
    source = first + place
    inside = first >= LIMIT
    new = np.where(inside, 0, first).astype(np.uint32)
    new[inside] = t["out"][source[inside] - LIMIT]
    return new, ends[offsets]


def flagged(cps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a character that only looks like the usual one."""
    if not len(cps):
        return np.zeros(len(offsets) - 1, bool)
    kind = tables()["kind"][cps]
    found = (kind & (FORM | INVISIBLE | BLANK)) > 0
    found |= ((kind & SCRIPT) > 0) & ~_genuine(kind, offsets)
    marks = np.flatnonzero(kind & MARK)
    if len(marks):
        # A mark may follow other marks or invisible characters: judge it on the text without these.
        clean, at = _expand(cps, offsets)
        kind2 = tables()["kind"][clean]
        marks2 = np.flatnonzero(kind2 & MARK)
        row = np.searchsorted(at, marks2, "right") - 1
        ok = marks2 > at[row]
        base = clean[np.maximum(marks2 - 1, 0)]
        hit = ok & (_compose(base, clean[marks2]) > 0)
        rows = np.zeros(len(offsets) - 1, bool)
        rows[row[hit]] = True
        return per_row_any(found, offsets) | rows
    return per_row_any(found, offsets)


def normalise(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one form: plain width, one blank, nothing invisible, Latin letters, single accented letters."""
    cps, offsets = _expand(cps, offsets)
    while len(cps):
        marks = np.flatnonzero(tables()["kind"][cps] & MARK)
        if not len(marks):
            break
        row = np.searchsorted(offsets, marks, "right") - 1
        inner = marks > offsets[row]
        before = cps[np.maximum(marks - 1, 0)]
        one = np.where(inner, _compose(before, cps[marks]), 0)
        if not one.any():
            break
        gone = marks[one > 0]
        cps = cps.copy()
        cps[gone - 1] = one[one > 0]
        keep = np.ones(len(cps), bool)
        keep[gone] = False
        kept = np.zeros(len(cps) + 1, np.int64)
        np.cumsum(keep, out=kept[1:])
        cps, offsets = cps[keep], kept[offsets]
    return cps, offsets


def normalise_array(column: pa.Array) -> pa.Array:
    """`normalise` on an Arrow column; nulls stay null."""
    out = to_arrow(*normalise(*code_points(column)))
    if column.null_count:
        out = pa.compute.if_else(column.is_null(), pa.scalar(None, pa.string()), out)
    return out


def with_one_form(df: DataFrame, text: str, into: str = "one_form", flag: str = "odd") -> DataFrame:
    """`df` with the text in one form in column `into`, and in `flag` whether it held characters that only
    look like the usual ones. Null texts give null and false, empty ones stay empty. Columns of these two
    names are replaced. Whole Arrow batches are mapped as code-point arrays; no shuffle."""
    keep = [c for c in df.columns if c not in (into, flag)]
    schema = df.select(*keep, F.lit("").alias(into), F.lit(False).alias(flag)).schema
    for f in schema.fields[-2:]:
        f.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(text)
            odd = flagged(*code_points(column))
            kept = [b.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, normalise_array(column), pa.array(odd)], [*keep, into, flag])

    return df.mapInArrow(run, schema)


def odd_rows(df: DataFrame, key: str, text: str, version: str | None = None) -> DataFrame:
    """The keys (key_id) whose text holds a character that only looks like the usual one: a width or
    presentation form, an accent apart from a letter it could be one with, an invisible character, a blank
    but the plain one, a look-alike letter of another script. Text that is truly in another script is none: where
    a text has other letters of it, its words without Latin letters stay as they are.

    Of several rows of a key the one with the greatest `version` counts; without it, any. Null texts are
    not found. Only keys, versions and flags are shuffled, pre-aggregated per task."""
    names = [key, text] + ([version] if version else [])
    when = F.col(version) if version else F.lit(0)
    flags = df.select(key, text, when.alias("_v"))
    kind = flags.select(F.col(key).alias("key_id"), "_v", F.lit(False).alias("odd")).schema
    for f in kind.fields:
        f.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            odd = pa.array(flagged(*code_points(b.column(text))))
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("_v"), odd], ["key_id", "_v", "odd"])

    del names
    latest = flags.mapInArrow(run, kind).groupBy("key_id").agg(F.max(F.struct("_v", "odd")).alias("m"))
    return latest.where("m.odd").select("key_id")


def one_forms(df: DataFrame, key: str, text: str, version: str) -> DataFrame:
    """Rows (key_id, one_form, odd), one for each key: its text in one form, whether or not it was odd.

    Of several rows of a key the one with the greatest `version` counts, of equal ones an odd one, as in
    `odd_rows`. Null texts give null and false, empty ones stay empty. One shuffle, of the texts by key."""
    formed = with_one_form(df.select(F.col(key).alias("key_id"), F.col(version).alias("_v"), F.col(text).alias("_t")), "_t")
    latest = formed.groupBy("key_id").agg(F.max(F.struct("_v", "odd", "one_form")).alias("m"))
    return latest.select("key_id", "m.one_form", "m.odd")
