"""Several values packed in one field: a parsing expression grammar that gives one value per row."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: What may stand between two values. Fixed values.
DELIMITER = re.compile(r"(?:[\s,;/|&+]|\band\b)+")
#: Signs that hold the place of a value that is not known; they are no values. Fixed values.
SIGNS = re.compile(r"[◊△]")
QUOTE = '"'
BRACKETS = {"(": ")", "[": "]"}
BARE = re.compile(r"[^\s,;/|&+\"()\[\]◊△]+")
SPACE = re.compile(r"\s+")

#: A form of value: for a text it gives the function that tells, for a place, where such a value ends, or -1.
Form = Callable[[str], Callable[[int], int]]


def written(pattern: str) -> Form:
    """The values that a pattern describes."""
    compiled = re.compile(pattern)

    def of(text: str) -> Callable[[int], int]:
        return lambda i: m.end() if (m := compiled.match(text, i)) else -1

    return of


_LED = re.compile(r"[A-Z][^\W\d]")
_STOP = re.compile(r"[;,\"()\[\]|\d]")
_FACULTY = re.compile(r";\s*[^;,\"()\[\]|\d']*\b(?:Faculty|Dept|Department|School|Coll)\b\.?(?:\s*,\s*['’]\d{2}(?!\d))?")


def named_school(text: str) -> Callable[[int], int]:
    """A school by its name, with its faculty behind a semicolon and mostly its year. What follows the name is
    looked up once for all places before it, so that long texts take time in proportion."""
    stop = end = -1

    def at(i: int) -> int:
        nonlocal stop, end
        if not _LED.match(text, i):
            return -1
        if stop < i:
            found = _STOP.search(text, i)
            stop = found.start() if found else len(text)
            m = _FACULTY.match(text, stop)
            end = m.end() if m else -1
        return end if stop >= i + 2 else -1

    return at


_STATE = re.compile(r"[A-Z][A-Za-z]*+\.?(?:\s?[A-Z][a-z]*+\.)*+")
_NUMBER = re.compile(r"\s?\d{1,3}(?!\d)(?:\s*,\s*['’]\d{2}(?!\d))?")


def numbered_school(text: str) -> Callable[[int], int]:
    """A state abbreviation, one or more initials among them, and a number, mostly with a year. The places of one
    run of initials share what follows it, which is looked up once."""
    low = high = end = -1

    def at(i: int) -> int:
        nonlocal low, high, end
        if not low <= i < high:
            m = _STATE.match(text, i)
            if not m:
                return -1
            low, high = i, m.end()
            m = _NUMBER.match(text, high)
            end = m.end() if m else -1
        return end if "A" <= text[i] <= "Z" else -1

    return at


#: A school: named, or a state abbreviation and a number.
SCHOOL: tuple[Form, ...] = (named_school, numbered_school)
#: A society: a code or a bare number.
SOCIETY: tuple[Form, ...] = (written(r"[A-Z]{1,2}\s?\d{1,3}(?!\d)"), written(r"\d{1,3}(?!\d)"))


@dataclass(frozen=True)
class Value:
    text: str
    error: str | None


@dataclass(slots=True)
class _Open:
    """A sequence of elements that is being read: where it began, what is to close it, where it is."""

    start: int
    closing: str
    i: int
    out: list


def _flat(nested: list) -> list[Value]:
    """The values of nested lists in order; one that follows an error, held as a string, gets it."""
    out, stack, error = [], [iter(nested)], None
    while stack:
        x = next(stack[-1], None)
        if x is None:
            stack.pop()
        elif isinstance(x, list):
            stack.append(iter(x))
        elif isinstance(x, str):
            error = x
        else:
            out.append(Value(x.text, error) if error else x)
            error = None
    return out


class Packed:
    """The grammar of a packed field, its alternatives tried in order:

        field     <- delimiter* (element delimiter*)*
        element   <- quoted / bracketed / value / sign / bare
        quoted    <- '"' (element / delimiter)* '"'
        bracketed <- '(' (element / delimiter)* ')' / '[' (element / delimiter)* ']'
        value     <- one of the field's own forms, in order
        bare      <- characters up to the next delimiter, quote or bracket

    An opening quote or bracket whose closing one is missing fails; the parser goes back behind it, takes
    it for a stray character and flags the next value (`stray_quote`, `stray_bracket`). A bare value is
    flagged `unknown_form`. Values are given without white space. What was read from a place up to a closing
    sign, or that it can't be, is kept, so that going back takes no place twice for the same sign; the
    sequences that are open are on a list, so that they may be nested as deeply as the text likes.
    """

    def __init__(self, forms: Sequence[Form]):
        self.forms = tuple(forms)

    def parse(self, s: str) -> list[Value]:
        forms = [f(s) for f in self.forms]
        last = {c: s.rfind(c) for c in (QUOTE, *BRACKETS.values())}
        memo: dict[tuple[int, str], tuple[list, int] | None] = {}
        n = len(s)
        stack = [_Open(0, "", 0, [])]
        while True:
            top = stack[-1]
            i = top.i
            if top.closing and (i >= n or memo.get((i, top.closing), ()) is None):
                memo[top.start, top.closing] = None
                stack.pop()
                stack[-1].i = top.start
                stack[-1].out.append("stray_quote" if top.closing == QUOTE else "stray_bracket")
                continue
            if i >= n:
                return _flat(top.out)
            c = s[i]
            if c == top.closing:
                memo[top.start, c] = (top.out, i + 1)
                stack.pop()
                stack[-1].out.append(top.out)
                stack[-1].i = i + 1
            elif m := DELIMITER.match(s, i) or SIGNS.match(s, i):
                top.i = m.end()
            elif c == QUOTE or c in BRACKETS:
                close = QUOTE if c == QUOTE else BRACKETS[c]
                known = memo.get((i + 1, close), ()) if last[close] > i else None
                if known is None:
                    top.out.append("stray_quote" if c == QUOTE else "stray_bracket")
                    top.i = i + 1
                elif known:
                    top.out.append(known[0])
                    top.i = known[1]
                else:
                    stack.append(_Open(i + 1, close, i + 1, []))
            elif c in ")]":
                top.out.append("stray_bracket")
                top.i = i + 1
            else:
                end = next((e for f in forms if (e := f(i)) > i), -1)
                error = None if end > 0 else "unknown_form"
                top.i = end if end > 0 else BARE.match(s, i).end()
                top.out.append(Value(SPACE.sub("", s[i : top.i]), error))


def unpack_fields(df: DataFrame, key: str, fields: Mapping[str, Sequence[Form]]) -> DataFrame:
    """Rows (row key, field, pos, n, val, error) of all values of the packed `fields`.

    pos counts from 1 as written, n is the number of values of the field. Null and empty fields, and those
    of signs only, give no row. Repeated rows of the input give repeated rows. Any other column of `df` is
    left out. The text goes through Arrow batches; no shuffle.
    """
    grammars = {f: Packed(forms) for f, forms in fields.items()}
    names = list(fields)
    schema = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType), T.StructField("field", T.StringType()),
            T.StructField("pos", T.IntegerType()), T.StructField("n", T.IntegerType()),
            T.StructField("val", T.StringType()), T.StructField("error", T.StringType()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            where: list[int] = []
            cols: tuple[list, ...] = ([], [], [], [], [])
            for f in names:
                seen: dict[str, list[Value]] = {}
                for at, s in enumerate(b.column(f).to_pylist()):
                    if not s:
                        continue
                    values = seen.get(s)
                    if values is None:
                        values = seen[s] = grammars[f].parse(s)
                    for pos, v in enumerate(values, 1):
                        where.append(at)
                        for c, x in zip(cols, (f, pos, len(values), v.text, v.error)):
                            c.append(x)
            keys = b.column(key).take(pa.array(where, pa.int64()))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array(c, k) for c, k in zip(cols, kinds))], [key, "field", "pos", "n", "val", "error"]
            )

    return df.select(key, *names).mapInArrow(parse, schema)
