"""Same postal address written differently: MinHash banding on shingles, then affine-gap token alignment."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.strings import edits
from quirework.runtime import SENT, cut

#: Abbreviations of the words of an address, each with the word it stands for. Fixed values.
KINDS = {"st": "street", "str": "street", "street": "street", "ave": "avenue", "av": "avenue", "avenue": "avenue", "rd": "road", "road": "road", "pl": "place", "place": "place", "blvd": "boulevard", "boul": "boulevard", "bd": "boulevard", "boulevard": "boulevard", "sq": "square", "square": "square", "ct": "court", "court": "court", "ln": "lane", "lane": "lane", "dr": "drive", "drive": "drive", "ter": "terrace", "terr": "terrace", "terrace": "terrace", "pk": "pike", "pike": "pike", "al": "alley", "alley": "alley"}
DIRECTIONS = {"n": "north", "no": "north", "nth": "north", "north": "north", "s": "south", "so": "south", "sth": "south", "south": "south", "e": "east", "east": "east", "w": "west", "west": "west", "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest"}
BUILDINGS = {"bldg": "building", "bld": "building", "building": "building", "blk": "block", "block": "block", "hosp": "hospital", "hospital": "hospital", "hotel": "hotel", "arcade": "arcade", "theatre": "theatre", "hall": "hall"}
PARTS = {"trust": "trust", "tr": "trust", "natl": "national", "nat": "national", "nat'l": "national", "national": "national", "bank": "bank", "bk": "bank", "state": "state", "savings": "savings"}
ROOM = frozenset({"room", "rm", "rms", "rooms", "suite", "ste", "apt", "flat", "floor", "fl"})
ASIDE = frozenset({"rear", "res", "residence", "upstairs", "over"})
ONES = "zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth".split()
TENS = {"twentieth": 20, "thirtieth": 30, "fortieth": 40, "fiftieth": 50, "sixtieth": 60, "seventieth": 70, "eightieth": 80, "ninetieth": 90}
ORDINALS = {w: i for i, w in enumerate(ONES)} | TENS | {f"{t}{o}": v + i for t, v in (("twenty", 20), ("thirty", 30), ("forty", 40), ("fifty", 50)) for i, o in enumerate(ONES[:10]) if i}

TOKEN = re.compile(r"\d+(?:(?:st|nd|rd|th)\b)?|[^\W\d_]+(?:'[^\W\d_]+)?", re.IGNORECASE)
ORDINAL = re.compile(r"(\d+)(?:st|nd|rd|th)$")
HALF = re.compile(r" ?(?:½|\b1\s*/\s*2\b)")
SUFFIX = {1: "st", 2: "nd", 3: "rd"}
BOX = re.compile(r"^(?:(?:p\.?\s*o\.?|post\s*office|lock|drawer)\s*)?(?:box|drawer)\s*(?:no\.?\s*)?(\d+)\b|^(?:p\.?\s*o\.?|post\s*office)\s*(?:no\.?\s*)?(\d+)\b")
ROUTE = re.compile(r"^(?:rural\s*(?:free\s*)?(?:route|delivery)|r\.?\s*f\.?\s*d\.?|r\.?\s*d\.?|r\.?\s*r\.?|route)\s*(?:no\.?\s*)?(\d+)\s*(?:,?\s*(?:box|bx)\.?\s*(?:no\.?\s*)?(\d+))?")
HOUSE = re.compile(r"(?:no\.?\s*)?(\d+)( half)?$")

VOWELS = re.compile(r"[aeiouy]|(.)(?=\1)")

#: Bands of the MinHash and hashes of each: forms that share a third of their shingles meet with 94 %, half with 99.9 %.
BANDS, ROWS = 24, 2
#: How many shingles the house number of a street counts for, as nothing is the same place without it.
HOUSE_WEIGHT = 6
#: Abbreviations within names, each with the word it stands for. Fixed values.
NAMES = {"wash": "washington", "jeff": "jefferson", "lex": "lexington", "penn": "pennsylvania", "penna": "pennsylvania", "mass": "massachusetts", "conn": "connecticut", "ill": "illinois", "ft": "fort", "mt": "mount", "st": "saint", "pk": "park", "hts": "heights", "spg": "spring", "spgs": "springs", "ctr": "center", "univ": "university", "coll": "college", "med": "medical", "com'l": "commercial", "co": "county", "jct": "junction"}
#: Costs of the alignment: opening and extending a gap over an optional token, a misspelt name by its edits, a word
#: that is abbreviated on one side.
GAP_OPEN, GAP_EXTEND, EDIT, ABBREVIATED = 1.0, 0.25, 0.5, 0.25
FORBIDDEN = 99.0
#: Two forms denote one location if the alignment costs at most this.
MOST = 3.0


def _near(word: str, known: dict[str, str]) -> str | None:
    """The word itself or, from five letters on, the one it misspells by one edit."""
    if word in known:
        return known[word]
    if len(word) >= 5:
        for full in set(known.values()):
            if len(full) >= 5 and edits(word, full, 1) == 1:
                return full
    return None


def _suffix(n: int) -> str:
    return "th" if n % 100 in (11, 12, 13) else SUFFIX.get(n % 10, "th")


def form(text: str) -> str | None:
    """The parts of an address in a fixed order, as `kind|...`; None if nothing can be read.

    `box|number`; `route|number|box`; `building|kind|parts|name`; `street|house|half|direction|name|kind`.
    Rooms, remarks such as rear, and a town written behind are left out.
    """
    s = unicodedata.normalize("NFKC", text).replace("⁄", "/").replace("’", "'")
    s = " ".join(s.replace("\n", ";").split())
    s = HALF.sub(" half", s)
    s = re.sub(r"\([^()]*\)", " ", s)
    low = s.casefold()
    if m := ROUTE.match(low):
        return f"route|{int(m[1])}|{int(m[2]) if m[2] else ''}"
    if m := BOX.match(low):
        return f"box|{int(m[1] or m[2])}"
    segments = [x.strip(" .;") for x in re.split(r"[,;]", s)]
    segments = [x for x in segments if x and x.casefold() not in ASIDE]
    if not segments:
        return None
    printed = [TOKEN.findall(x) for x in segments]
    segments = [x.casefold() for x in segments]
    words = [[w.casefold() for w in ws] for ws in printed]
    for ws in words:
        kind = next((k for w in reversed(ws) if (k := _near(w.replace("'", "") if w not in PARTS else w, BUILDINGS))), None)
        if kind:
            parts, name, skip = set(), [], False
            for w in ws:
                if w in ROOM:
                    skip = True
                elif w[0].isdigit():
                    skip = False
                elif p := PARTS.get(w) or PARTS.get(w.replace("'", "")):
                    parts.add(p)
                elif not _near(w, BUILDINGS) and w not in ("no", "the") and not skip:
                    name.append(w)
            return f"building|{kind}|{' '.join(sorted(parts))}|{' '.join(name)}"
    house = half = ""
    rest = []
    for x, ws in zip(segments, printed):
        if not house and (m := HOUSE.match(x)) and len(segments) > 1:
            house, half = str(int(m[1])), "half" if m[2] else ""
        else:
            rest.append(ws)
    if not rest:
        return None
    as_printed = list(rest[0])
    ws = [w.casefold() for w in as_printed]
    if not house:
        if len(ws) > 1 and ws[0] == "no" and ws[1].isdigit():
            ws = ws[1:]
        if ws and ws[0].isdigit():
            house, ws = str(int(ws[0])), ws[1:]
            if ws and ws[0] == "half":
                half, ws = "half", ws[1:]
    as_printed = as_printed[len(as_printed) - len(ws) :]
    direction = kind = ""
    name: list[str] = []
    k = 0
    while k < len(ws):
        w = ws[k]
        if w.isdigit():
            # "1 st" is an ordinal, "1 St" a street, unless a kind of street comes behind it.
            if k + 1 < len(ws) and ws[k + 1] == _suffix(int(w)) and (as_printed[k + 1].islower() or any(x in KINDS for x in ws[k + 2 :])):
                k += 1
            name.append(str(int(w)))
        elif m := ORDINAL.match(w):
            name.append(str(int(m[1])))
        elif w in ASIDE:
            pass
        elif w in DIRECTIONS and not direction and (k == 0 or k == len(ws) - 1 or name):
            direction = DIRECTIONS[w]
        elif w in ORDINALS:
            name.append(str(ORDINALS[w]))
        elif not kind and (name and (q := _near(w, KINDS))):
            kind = q
        else:
            name.append(w)
        k += 1
    if not name:
        return None
    return f"street|{house}|{half}|{direction}|{' '.join(name)}|{kind}"


def _meant(name: str) -> str:
    return " ".join(NAMES.get(w, w) for w in name.split())


def _grams(name: str) -> set[str]:
    """Pairs of letters, next to each other and with one between, the name without its later vowels, and its letters
    in order: what a misspelling mostly leaves."""
    plain = _meant(name).replace(" ", "")
    if plain.isdigit():
        return {f"{plain}#{k}" for k in range(4)}
    s = f"^{plain}$"
    pairs = {s[k : k + 2] for k in range(len(s) - 1)} | {f"{s[k]}_{s[k + 2]}" for k in range(len(s) - 2)}
    return pairs | {"=" + s[1] + VOWELS.sub("", s[2:]), "~" + "".join(sorted(plain))} | {f"w{w}" for w in _meant(name).split()}


def shingles(f: str) -> set[str]:
    """Token and q-gram shingles of a form. Those of a street's name stand with the house number, which is some
    shingles itself, and those of a building's name with its kind, so that a shingle is shared by few locations
    of a town. Boxes and routes are one shingle."""
    kind, *rest = f.split("|")
    if kind in ("box", "route"):
        return {f}
    if kind == "building":
        return {f"b{rest[0]}|{g}" for g in _grams(rest[2])}
    lead = f"s{rest[0]}{rest[1]}|"
    return {lead + g for g in _grams(rest[3])} | ({f"{lead}#{k}" for k in range(HOUSE_WEIGHT)} if rest[0] else set())


_RNG = np.random.default_rng(20)
_A, _B = _RNG.integers(1, 2**61 - 1, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)
_BAND = _RNG.integers(1, 2**61 - 1, BANDS, dtype=np.uint64) | np.uint64(1)


def bands(forms: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of some forms, and which form each is of: one for each band, of its number and the least hashes of
    its rows. Forms that are one shingle meet no other form, and have no keys."""
    own = [shingles(f) for f in forms]
    some = [k for k, x in enumerate(own) if len(x) > 1]
    keys = np.zeros((len(some), BANDS), np.int64)
    for first in range(0, len(some), 512):
        part = some[first : first + 512]
        h = np.array([zlib.crc32(x) | zlib.adler32(x) << 32 for k in part for x in map(str.encode, own[k])], np.uint64)
        starts = np.cumsum([0] + [len(own[k]) for k in part[:-1]])
        least = np.empty((len(part), BANDS * ROWS), np.uint64)
        for j in range(BANDS * ROWS):
            mixed = h * _A[j] + _B[j]
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(29)
            least[:, j] = np.minimum.reduceat(mixed, starts)
        key = np.repeat(_BAND[None, :], len(part), 0)
        for k in range(ROWS):
            key = (key ^ least[:, k::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        keys[first : first + len(part)] = key.view(np.int64)
    return keys.ravel(), np.repeat(np.array(some, np.int64), BANDS)


def _tokens(f: str) -> list[tuple[str, str]]:
    """The form as (role, token) in order; empty parts are missing."""
    kind, *rest = f.split("|")
    roles = {"building": ("kind", "parts", "name"), "street": ("house", "half", "direction", "name", "street")}.get(kind, ("number",) * len(rest))
    return [(r, w) for r, w in zip(roles, rest) if w]


#: The dictionary of each role of a token.
DICTIONARIES = {"street": KINDS, "direction": DIRECTIONS, "kind": BUILDINGS, "parts": PARTS}


def _substitution(a: tuple[str, str], b: tuple[str, str]) -> float:
    """Cost of taking one token for the other: nothing for equal ones, little for one that the dictionary of its
    role knows as an abbreviation of the other, and for a misspelt name by its edits; what tells two locations
    apart (house, half, direction, kind of street or building) may not be replaced by another meaning."""
    if a == b:
        return 0.0
    if a[0] != b[0]:
        return FORBIDDEN
    if a[0] != "name":
        words = DICTIONARIES.get(a[0], {})
        return ABBREVIATED if words.get(a[1], a[1]) == words.get(b[1], b[1]) else FORBIDDEN
    one, two = a[1].split(), b[1].split()
    short = sum(v != w and NAMES.get(v, v) == NAMES.get(w, w) for v, w in zip(one, two)) if len(one) == len(two) else 0
    x, y = (_meant(a[1]).replace(" ", ""), _meant(b[1]).replace(" ", "")) if short else (a[1].replace(" ", ""), b[1].replace(" ", ""))
    if x == y:
        return ABBREVIATED * short
    if x.isdigit() or y.isdigit():
        return FORBIDDEN
    most = 2 if min(len(x), len(y)) >= 5 else 1
    d = edits(x, y, most)
    if d > most and min(len(x), len(y)) >= 8:
        d = edits(x, y, 4)
        most = 4 if max(len(x), len(y)) >= 8 else 3
    return EDIT * d + ABBREVIATED * short if d <= most else FORBIDDEN


def _optional(t: tuple[str, str]) -> bool:
    return t[0] in ("direction", "street")


def alignment_cost(f: str, g: str) -> float:
    """Affine-gap alignment of the tokens of two forms of the same sort (three states: paired, gap left,
    gap right). Only a direction and a kind of street may be missing, and not on both sides at once: a gap
    may not follow one of the other side for a token of the same role."""
    if f.split("|", 1)[0] != g.split("|", 1)[0]:
        return FORBIDDEN
    a, b = _tokens(f), _tokens(g)
    inf = FORBIDDEN
    m = [[inf] * (len(b) + 1) for _ in range(len(a) + 1)]
    x = [[inf] * (len(b) + 1) for _ in range(len(a) + 1)]
    y = [[inf] * (len(b) + 1) for _ in range(len(a) + 1)]
    m[0][0] = 0.0
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i and j:
                m[i][j] = min(m[i - 1][j - 1], x[i - 1][j - 1], y[i - 1][j - 1]) + _substitution(a[i - 1], b[j - 1])
            clash = FORBIDDEN if i and j and a[i - 1][0] == b[j - 1][0] else 0.0
            if i and _optional(a[i - 1]):
                x[i][j] = min(m[i - 1][j] + GAP_OPEN, y[i - 1][j] + GAP_OPEN + clash, x[i - 1][j] + GAP_EXTEND)
            if j and _optional(b[j - 1]):
                y[i][j] = min(m[i][j - 1] + GAP_OPEN, x[i][j - 1] + GAP_OPEN + clash, y[i][j - 1] + GAP_EXTEND)
    return min(m[-1][-1], x[-1][-1], y[-1][-1])


def members(df: DataFrame, row: str, place: str, fields: tuple[str, ...]) -> DataFrame:
    """Rows (town, row_id, field, form) of all readable, non-empty address fields with a non-null town,
    each once however often the row is repeated."""
    kind = f"town {df.schema[place].dataType.simpleString()}, row_id {df.schema[row].dataType.simpleString()}, field string, form string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, str | None] = {}
        for b in batches:
            if len(seen) > 300_000:
                seen.clear()
            at: list[int] = []
            names: list[str] = []
            forms: list[str] = []
            for f in fields:
                for k, s in enumerate(b.column(f).to_pylist()):
                    if s and s.strip():
                        if s not in seen:
                            seen[s] = form(s)
                        if seen[s]:
                            at.append(k)
                            names.append(f)
                            forms.append(seen[s])
            idx = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(place).take(idx), b.column(row).take(idx), pa.array(names, pa.string()), pa.array(forms, pa.string())],
                ["town", "row_id", "field", "form"],
            )

    return df.where(F.col(place).isNotNull()).select(row, place, *fields).mapInArrow(run, kind).distinct()


def same_forms(found: DataFrame) -> DataFrame:
    """Pairs (town, form_a, form_b), form_a < form_b, of different forms of a town that denote one location."""
    town = found.schema["town"].dataType.simpleString()
    # A form of a town is known by a number, so that no text is shuffled once for each band.
    forms = cut(found.select("town", "form").distinct().withColumn("id", F.xxhash64("town", "form")))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, at = bands(b.column("form").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("town_h").take(pa.array(at)), b.column("id").take(pa.array(at)), pa.array(keys)], ["town_h", "id", "h"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [alignment_cost(f, g) <= MOST for f, g in zip(b.column("form_a").to_pylist(), b.column("form_b").to_pylist())]
            yield b.filter(pa.array(ok, pa.bool_()))

    # Forms that no other of the town shares the house number, or the kind of building, with meet none, and boxes
    # and routes only themselves.
    kind = F.substring_index("form", "|", 1)
    lead = F.when(kind == "street", F.substring_index("form", "|", 3)).when(kind == "building", F.substring_index("form", "|", 2))
    led = forms.select(F.xxhash64("town").alias("town_h"), "id", "form", lead.alias("lead")).where("lead is not null")
    groups = cut(led.groupBy("town_h", "lead").agg(F.count("*").alias("n")).where("n > 1").select("town_h", "lead"))
    met_by = F.broadcast(groups) if groups.count() <= SENT else groups
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = led.join(met_by, ["town_h", "lead"], "left_semi").select("town_h", "id", "form").repartition(parts, "id").mapInArrow(sign, "town_h bigint, id bigint, h bigint")
    keyed = cut(signed.select(F.xxhash64("town_h", "h").alias("k"), "id"))
    # Most keys are one form's; only those of several are met.
    several = keyed.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    met = cut(keyed.join(several, "k"))
    a, b = met.withColumnRenamed("id", "id_a"), met.withColumnRenamed("id", "id_b")
    candidates = a.join(b, "k").where("id_a < id_b").select("id_a", "id_b").distinct()
    one, two = (forms.select(F.col("town").alias(f"town_{c}"), F.col("form").alias(f"form_{c}"), F.col("id").alias(f"id_{c}")) for c in "ab")
    pairs = candidates.join(one, "id_a").join(two, "id_b").where("town_a = town_b and form_a <> form_b")
    ordered = pairs.select(F.col("town_a").alias("town"), F.least("form_a", "form_b").alias("form_a"), F.greatest("form_a", "form_b").alias("form_b"))
    return ordered.mapInArrow(verify, f"town {town}, form_a string, form_b string").distinct()


def same_locations(df: DataFrame, row: str = "row_id", place: str = "city_id", fields: tuple[str, ...] = ("address", "office")) -> DataFrame:
    """Pairs (row_a, field_a, row_b, field_b), row_a < row_b, of address fields of different rows of one town
    that denote one location.

    Exact copies are collapsed first: the search runs over the distinct forms of a town, whatever number of
    rows share one. Forms meet if they agree in all hashes of a band; since a shingle holds the house number or
    the kind of building, few others do. Each meeting is verified by alignment. The rows are then joined back to the
    forms; the pairs asked for are all of a location, so this output grows with the square of its rows.
    Null towns, null, empty and unreadable fields give nothing; repeated rows count once.
    """
    found = cut(members(df, row, place, fields))
    pairs = same_forms(found)
    a = found.select("town", F.col("form").alias("form_a"), F.col("row_id").alias("row_1"), F.col("field").alias("field_1"))
    b = found.select("town", F.col("form").alias("form_b"), F.col("row_id").alias("row_2"), F.col("field").alias("field_2"))
    own = found.select("town", F.col("form").alias("form_a"), F.col("form").alias("form_b")).distinct()
    links = pairs.unionByName(own)
    met = links.join(a, ["town", "form_a"]).join(b, ["town", "form_b"])
    first = F.col("row_1") < F.col("row_2")
    return (
        met.where((F.col("row_1") != F.col("row_2")) & (first | (F.col("form_a") != F.col("form_b"))))
        .select(
            F.least("row_1", "row_2").alias("row_a"), F.when(first, F.col("field_1")).otherwise(F.col("field_2")).alias("field_a"),
            F.greatest("row_1", "row_2").alias("row_b"), F.when(first, F.col("field_2")).otherwise(F.col("field_1")).alias("field_b"),
        )
        .distinct()
    )
