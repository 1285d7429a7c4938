"""The grammar of directory lines: kinds of lines by anchored patterns, and the fields of cities and doctors.

Patterns are built from named blocks into positional groups (the engine's regular expressions allow no
underscore in names); GROUPS gives the place of each field.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE, CITY, DOC_START, DOC_TO_ADDR, DOC_TO_OFF, DOC_FULL, UNKNOWN = "STATE CITY DOC_START DOC_TO_ADDR DOC_TO_OFF DOC_FULL UNKNOWN".split()

#: The printed forms of the fields. Fixed values.
BIRTH = r"\(b['\s]?(\d\d)\)"
MARK = r"(?:[+*@⊕]|-?[EH]|-?P-M)?\s?-"
YEAR = r"'\s?\d\d"
SCHOOL_STATE = r"(?:[A-Z][a-z]{1,3}|[O0]|(?:N\.\s?Y|D\.\s?C|N\.\s?H|N\.\s?C|S\.\s?C))\.?"
SCHOOL_CODE = rf"{SCHOOL_STATE}\s?(?:[1-9lI]\d?\s?,?|\*)\s?(?:{YEAR}|\*)"
LICENCE = r"\((?:[lI][\s'](\d\d|t)|(♁))\)\s?;?"


def _place(first: str, letter: str, more: str, stops: str, least: int) -> str:
    """A place: `first`, then signs of `more` and `stops`, with a letter that is at least the third sign and has
    no stop and at least `least` signs behind it. Read without going back, so that texts of any length take
    time in proportion: up to the last stop if there is one, then to the first letter, then to the end."""
    other = rf"(?:(?![{letter}])[{more}])*+"
    rest = rf"[{letter}][{more}]{'*+' if not least else f'{{{least},}}+'}"
    return rf"[{first}](?:(?:[{more}]*+[{stops}])++{other}{rest}|[{more}]{other}{rest})"


PLACE = _place("A-Z1-9", "A-Za-z", r"\w\s.'&-", ",½", 1)
RURAL = r"R. ?D.?[1-9]?"
HOUR = r"[1-9]\d?(?:\s?;30)?"
HOURS = rf"(?:{HOUR}[.-]\s?{HOUR}|(?:until|after)\s?[1-9]\d?)"
SOCIETY = r"\(([A-G][1-9][A-G0-9,]*?)\)"
SPECIALTIES = "S Ob G ObG Or Pr Op A LR ALR OALR U D Pd N P NP I l T Anes CP R Path Bact PH".split()
SPECIALTY = rf"(?:{'|'.join(sorted(SPECIALTIES, key=len, reverse=True))})[*★]?"

STATE_LINE = r"[A-Z\s]+"
CITY_LINE = r"([a-zA-Z\s.,()']+),\s?(?:(?:([0-9,]+?)|-),\s?)?([a-zA-Z().\s-]+)"
LOOSE_CITY = r"\w.+?,.+?\d.+?,.+?\w.+?"


@dataclass(frozen=True)
class Blocks:
    """The blocks that a grammar puts together."""

    surname: str = r"[a-zA-Z '1]+"
    given: str = r"[a-zA-Z.,\s]+"
    school: str = SCHOOL_CODE
    no_school: str = "◊"
    licence: str = LICENCE
    place: str = PLACE
    society: str = SOCIETY
    rest: str = ""
    state_line: str = STATE_LINE
    city_line: str = CITY_LINE


_LETTER = "a-zA-ZÀ-ÖØ-öø-ÿ"
#: The printed forms with those that the strict grammar leaves out: accented and double names, states of two
#: initials, schools without a year or with a name, △ and ‡, bare society numbers, halves and remarks in
#: addresses, and an office held, at the end.
WIDE = Blocks(
    surname=rf"[{_LETTER} '1-]+?",
    given=rf"[{_LETTER}.,\s]+",
    school=rf"(?:Univ\. of [{_LETTER} ]+; Med\. Faculty, {YEAR}|(?:[A-Z][a-z]{{1,4}}|[O0]|[A-Z]\.\s?[A-Z])\.?\s?(?:\d{{1,2}}|[lI*])(?:\s?,?\s?(?:{YEAR}|\*))?)",
    no_school="[◊△]",
    licence=r"\((?:[lI][\s'](\d\d|t)|([♁‡]))\)\s?;?",
    place=_place(f"{_LETTER[3:]}1-9", _LETTER, r"\w\s.,'&/()-", "½", 0),
    society=r"\(([A-G]?\d{1,3}(?:,\s?[A-G]?\d{1,3})*+)\)",
    rest=r"(?:;?\s?Supt\.,[^;]*)?",
    city_line=rf"([{_LETTER}\s.,()'—-]+?),\s?(?:(?:([0-9,]+?)|-),\s?)?([{_LETTER}().\s'-]+)",
)


@dataclass(frozen=True)
class Patterns:
    """The start of a doctor's entry, a whole one, and the lines of states and cities."""

    start: str
    whole: str
    state_line: str
    city_line: str


def _patterns(b: Blocks) -> Patterns:
    """Repeated groups are read without going back, as what follows them can't begin within them."""
    start = (
        rf"({b.surname}),\s({b.given})\s?(?:(\(col\.\))\s?)?" + rf"(?:{BIRTH}\s?)?({MARK})\s?"
        + rf"(?:({b.school}(?:, {b.school})*+\s?;)|({b.no_school}));?\s?"
    )
    whole = (
        start + rf"(?:{b.licence})?\s?(not in practice;?\s?)?" + rf"(?:({b.place}|{RURAL});?\s?)?" + rf"(?:\s?of(?:- )?fice,\s({b.place});?\s?)?"
        + rf"(?:({HOURS}(?:[,;]\s?{HOURS}){{0,2}});? ?)?" + rf"(?:{b.society};? ?)?" + rf"(?:({SPECIALTY}(?:, ?{SPECIALTY})*+);? ?)?"
        + rf"(▼[GN]?)?({b.rest})(?<![;-])"
    )
    return Patterns(start, whole, b.state_line, b.city_line)


PATTERNS, WIDE_PATTERNS = _patterns(Blocks()), _patterns(WIDE)
#: The groups of the full pattern. Fixed by its blocks.
GROUPS = {
    "last_name": 1, "first_name": 2, "col": 3, "birth": 4, "mark": 5, "schools": 6, "no_school": 7, "licence": 8, "earlier": 9,
    "no_practice": 10, "address": 11, "office": 12, "hours": 13, "societies": 14, "specialty": 15, "military": 16, "rest": 17,
}


def _whole(line: Column, pattern: str) -> Column:
    return line.rlike(rf"(?d)\A(?:{pattern})\z")


def line_type(line: Column, patterns: Patterns = PATTERNS) -> Column:
    """The kind of a line, or of some lines joined, tried in the order of the grammar; null stays null. A whole
    entry of a doctor is read once, and its kind told from which of its last parts are there: one that ends in
    its address or in its office may go on in the next line. Texts of any length are read."""
    # What every city and every doctor has is tested first, as it costs little.
    city, doctor = line.contains(","), line.contains(",") & line.contains("-")
    last = "".join(f"${GROUPS[n]}" for n in ("hours", "societies", "specialty", "military", "rest"))
    # Where the pattern doesn't match, the line stays as it is; it has no \x01 where it does.
    parts = F.regexp_replace(line, rf"(?d)\A(?:{patterns.whole})\z", f"${GROUPS['address']}\x01${GROUPS['office']}\x01{last}")
    return (
        F.when(line.isNull(), F.lit(None).cast("string"))
        .when(_whole(line, patterns.state_line), STATE)
        .when(city & _whole(line, patterns.city_line), CITY)
        .when(
            doctor,
            F.when(
                parts != line,
                F.when(parts.rlike(r"(?s)\A[^\x01]+\x01\x01\z"), DOC_TO_ADDR).when(parts.rlike(r"(?s)\A[^\x01]*\x01[^\x01]+\x01\z"), DOC_TO_OFF).otherwise(DOC_FULL),
            ).when(line.rlike(rf"(?d)\A(?:{patterns.start})"), DOC_START).otherwise(UNKNOWN),
        )
        .otherwise(UNKNOWN)
    )


def wide_line_type(line: Column) -> Column:
    """`line_type` by the wider grammar."""
    return line_type(line, WIDE_PATTERNS)


def is_loose_city(line: Column) -> Column:
    """Whether a line looks like a city with misread characters."""
    return ~line.rlike("[⊕+*:;]") & line.rlike(rf"\A(?:{LOOSE_CITY})")


def city_fields(line: Column) -> Column:
    """struct(city, population, county, post_reference, post_reference_type) of a city line; null fields where
    a part is missing. A trailing dot of the county is dropped; population is a number."""
    take = lambda c, p, k: F.nullif(F.regexp_extract(c, p, k), F.lit(""))
    whole = r"(?s)^(.+?),\s*(?:([0-9][0-9,.]*|-)\s*,\s*)?([^,0-9]+?)\.?\s*$"
    county = take(line, whole, 3)
    reference = r"(?s)^(.*?)\s*\((?:(R\.?\s?F\.?\s?D\.*|R\.?\s?D\.?|P\.?\s?O\.?),?\s+)?([^()]+?)(?:\s+(P\.?\s?O\.?))?\)$"
    kind = F.upper(F.regexp_replace(F.concat(F.coalesce(take(county, reference, 2), F.lit("")), F.coalesce(take(county, reference, 4), F.lit(""))), r"[^A-Za-z]", ""))
    has = county.rlike(reference) & (kind != "")
    return F.struct(
        F.trim(take(line, whole, 1)).alias("city"),
        F.regexp_replace(take(line, whole, 2), "[,.]", "").try_cast("int").alias("population"),
        F.trim(F.when(has, take(county, reference, 1)).otherwise(county)).alias("county"),
        F.when(has, take(county, reference, 3)).alias("post_reference"),
        F.when(has, F.when(kind == "PO", "PO").otherwise("RFD")).alias("post_reference_type"),
    )


DOCTOR = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("name",)]
    + [T.StructField(n, T.BooleanType()) for n in ("ama_member", "ama_fellow", "col")]
    + [T.StructField("birth_year", T.StringType())]
    + [T.StructField("schools", T.ArrayType(T.StringType()))]
    + [T.StructField("license_year", T.StringType()), T.StructField("not_in_practice", T.BooleanType())]
    + [T.StructField(n, T.StringType()) for n in ("address", "office", "hours", "societies", "specialty", "military", "other_info")]
)

_TOKENS = {
    "birth": re.compile(r"\(b['\s]?(\d\d)\)"), "col": re.compile(r"\((?:col|res col)\.?\)"), "licence": re.compile(r"\([lI][\s'](\d\d|t)\)|\((♁|‡)\)"),
    "societies": re.compile(r"^\(((?:[A-G]?\d{1,2})(?:,\s?[A-G]?\d{1,2})*)\)$"), "specialty": re.compile(rf"^{SPECIALTY}(?:, ?{SPECIALTY})*$"),
    "military": re.compile(r"^▼[GN]?$"), "hours": re.compile(rf"^(?:{HOURS}|\d[\d;,.\s-]*)(?:,\s?(?:{HOURS}|[\d;.\s-]+))*$"),
    "school": re.compile(r"[A-Z][A-Za-z]*\.?(?:\s?[A-Z]\.)*\s?\d{1,2}(?:\s?,\s?'\s?\d\d)?|Univ\.[^;]*;[^,;]*,\s?'\d\d"),
    "address": re.compile(r"^(?:.*\d.*|.*\b(?:St|Ave|Av|Rd|Pl|Blvd|Bldg|Bld|Blk|Block|Hospital|Hosp|Building|Street|Avenue|Road|Place|Boulevard)\b.*|R\.? ?D\b.*|R\.?F\.?D\b.*|P\. ?O\b.*)$"),
}
_HALF_HOUR = re.compile(r"(\d);(30)\b")
LICENCE_CODES = {"t": "-2", "♁": "-1", "‡": "-3"}


def read_doctor(text: str | None) -> tuple | None:
    """The fields of a doctor's entry, read part by part: the head up to the dash, the schools, then the
    fields between semicolons by their form; what fits none is other information. Null for null and for a
    text without a dash."""
    if text is None:
        return None
    dash = re.search(r"-\s*(?=[A-Z◊△0]|$)", text)
    depth = [m for m in re.finditer(r"-\s*(?=(?:[A-Z][A-Za-z]*\.?(?:\s?[A-Z]\.)*\s?\d|Univ|◊|△|O\.\d))", text)]
    dash = depth[0] if depth else dash
    if not dash:
        return None
    head, rest = text[: dash.start()], text[dash.end() :]
    birth, col = _TOKENS["birth"].search(head), _TOKENS["col"].search(head)
    fellow = "⊕" in head
    name = re.sub(r"\s+", " ", _TOKENS["birth"].sub("", _TOKENS["col"].sub("", head)).replace("⊕", "")).strip(" +*@,")
    name = name.replace("1", "I")
    small = sum(c.islower() for c in name)
    schools: list[str] = []
    pos = 0
    while m := _TOKENS["school"].match(rest, pos):
        schools.append(re.sub(r"\s", "", m.group()))
        pos = m.end()
        gap = re.match(r"[\s,]*(?![^;]*\()", rest[pos:])
        pos += gap.end() if gap else 0
    rest = rest[pos:].lstrip("◊△ ,;")
    out: dict[str, str | None] = dict.fromkeys(("license_year", "address", "office", "hours", "societies", "specialty", "military"))
    practice, other = False, []
    if lic := _TOKENS["licence"].search(rest):
        out["license_year"] = LICENCE_CODES.get(lic.group(1) or lic.group(2), lic.group(1))
        rest = rest[: lic.start()] + rest[lic.end() :]
    rest = _HALF_HOUR.sub("\\1\x00\\2", rest)
    for part in (p.strip().replace("\x00", ";") for p in rest.split(";")):
        if not part:
            continue
        if part == "not in practice":
            practice = True
        elif re.match(r"of(?:- )?fice,", part):
            out["office"] = part.split(",", 1)[1].strip()
        elif out["societies"] is None and (m := _TOKENS["societies"].match(part)):
            out["societies"] = m.group(1)
        elif out["military"] is None and _TOKENS["military"].match(part):
            out["military"] = part
        elif out["specialty"] is None and _TOKENS["specialty"].match(part):
            out["specialty"] = part
        elif out["hours"] is None and _TOKENS["hours"].match(part):
            out["hours"] = part
        elif out["address"] is None and out["office"] is None and _TOKENS["address"].match(part):
            out["address"] = part
        else:
            other.append(part)
    return (
        name, small <= 1, fellow, col is not None, birth.group(1) if birth else None, schools, out["license_year"], practice,
        out["address"], out["office"], out["hours"], out["societies"], out["specialty"], out["military"], "; ".join(other) or None,
    )


@F.pandas_udf(DOCTOR)
def doctor_fields(texts: pd.Series) -> pd.DataFrame:
    """`read_doctor` over Arrow batches: no built-in function gives a text's fields in one pass."""
    empty = (None,) * len(DOCTOR.names)
    return pd.DataFrame([read_doctor(t) or empty for t in texts.astype(object).where(texts.notna(), None)], columns=DOCTOR.names)
