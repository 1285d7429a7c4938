"""Text cleaning as Column expressions: one cleaner for recognised lines, one for stored records."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters without a printed form; tab and line ends stay. Fixed value.
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"
#: Unicode white space, spelt out as the engine's classes are ASCII without a flag.
SPACE = r"(?U)\s"
EDGES = r"(?U)^\s+|\s+$"

#: What the line cleaner replaces, in this order, after compatibility normalisation. Fixed values.
LINE_RULES: tuple[tuple[str, str], ...] = (
    (CONTROL, ""),
    (SPACE, " "),
    (r"[-–—━]", "-"),
    (r":", ";"),
    (r"\([lI1][ ']?([0-9]{2})\)", "(l $1)"),
    (r"\([lI1][ ']?[tf†]\)", "(l t)"),
    (r" ?½|1⁄2", " 1/2"),
    (r"([^\p{L}\p{N}_])\1+", "$1"),
    (r"\([δ♂☁☉⚇⚁]\)", "(♁)"),
    (r"\(#\)", "(‡)"),
    (r"- ?[|│┇╲╰╂] ?;", "-◊;"),
    (r"- ?[┳Δ] ?;", "-△;"),
)

#: Rare characters of records and their common forms: replaced one by one, deleted, or by several. Fixed values.
ONE_FROM = "“”„«»‘’‚—–−\u00a0·•×"
ONE_TO = "\"\"\"\"\"'',--- .-x"
DELETED = "\u200b\u200c\u200d\u200e\u200f"
SEVERAL = (("…", "..."), ("©", "(c)"), ("®", "(r)"))

#: A character that is not expected in a clean line. Fixed value.
UNEXPECTED = r"[^0-9a-zA-Z(),.'▼★;‡* &◊⊕♁△/\-]"
#: The text of a line that could not be read. Fixed value.
SKIPPED = "******* KEEPS FAILING! SKIPPING FOR NOW *******"


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility normalisation, for which there is no built-in function; plain ASCII is passed through."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, EDGES, "")


def _rules(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1]), rules, text)


def clean_line(text: Column, normalise: bool = True) -> Column:
    """A recognised line in clean form; null stays null. Without `normalise` all is done in the JVM, for text
    known to be in compatibility form."""
    start = nfkc(text) if normalise else text
    return strip(_rules(strip(start), LINE_RULES))


def clean_record(text: Column, normalise: bool = True) -> Column:
    """A stored text with rare characters made common, without control characters and doubled blanks."""
    c = nfkc(text) if normalise else text
    c = F.translate(c, ONE_FROM + DELETED, ONE_TO)
    for a, b in SEVERAL:
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.regexp_replace(c, CONTROL, "")
    c = F.regexp_replace(c, r"[ \t]{2,}", " ")
    return F.regexp_replace(c, r"^[ \t]+|[ \t]+$", "")


def unexpected(text: Column) -> Column:
    """The first unexpected character of a line, '' if there is none; null for null."""
    return F.regexp_extract(text, f"({UNEXPECTED})", 1)


def is_readable(text: Column) -> Column:
    """Not the mark of an unread line; a null text passes, as nothing is known against it."""
    return ~text.eqNullSafe(F.lit(SKIPPED))


def squeeze(text: Column) -> Column:
    """The text without white space and hyphens, for comparing what two steps kept."""
    return F.regexp_replace(text, r"(?U)[\s-]", "")


def join_broken(text: Column) -> Column:
    """Words broken at line ends joined again."""
    return F.regexp_replace(text, r"-\s*\n\s*", "")


def pad_to(text: Column, other: Column) -> Column:
    """The text padded on the right to the length of the longer of the two."""
    return F.rpad(text, F.greatest(F.length(text), F.length(other)), F.lit(" "))


_RECORD_MAP = str.maketrans({**dict(zip(ONE_FROM, ONE_TO)), **dict.fromkeys(DELETED, None), **dict(SEVERAL)})
_CONTROL, _BLANKS = re.compile(CONTROL), re.compile(r"[ \t]{2,}")


def _plain(text: str) -> str:
    text = unicodedata.normalize("NFKC", text).translate(_RECORD_MAP)
    return _BLANKS.sub(" ", _CONTROL.sub("", text)).strip(" \t")


def _walk(value: Any) -> Any:
    if isinstance(value, str):
        return _plain(value)
    if isinstance(value, list):
        return [_walk(v) for v in value]
    if isinstance(value, dict):
        return {_plain(k): _walk(v) for k, v in value.items()}
    return value


@F.pandas_udf(T.StringType())
def clean_json(records: pd.Series) -> pd.Series:
    """JSON texts with all keys and all texts in them cleaned as records are, whatever their shape; numbers and
    the like stay. A text that is no JSON is cleaned as a text; null stays null."""

    def one(text: str) -> str:
        try:
            return json.dumps(_walk(json.loads(text)), ensure_ascii=False)
        except (ValueError, RecursionError):
            return _plain(text)

    return records.map(one, na_action="ignore")
