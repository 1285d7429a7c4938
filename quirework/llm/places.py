"""Mapping free-entered place names to a gazetteer: automaton mentions first, then token-set similarity."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quirework.llm.strings import likeness, skeleton

#: Abbreviations before and after the own part of a place name, and words around it. Fixed values.
BEFORE = {"no": "north", "n": "north", "nth": "north", "so": "south", "s": "south", "e": "east", "w": "west", "st": "saint", "ste": "saint", "snt": "saint", "mt": "mount", "mnt": "mount", "ft": "fort", "pt": "port", "prt": "port"}
AFTER = {"spgs": "springs", "spg": "springs", "spr": "springs", "sprs": "springs", "spring": "springs", "jc": "junction", "jct": "junction", "junc": "junction", "jn": "junction", "fls": "falls", "fall": "falls", "cor": "corners", "cors": "corners", "ldg": "landing", "mls": "mills"}
GENERIC = frozenset({*BEFORE.values(), *AFTER.values()})
AROUND = re.compile(r"^(?:town|city|village|twp|township|borough) of |(?<=\w)(?:,)? (?:village|city|town|twp|township|station|p\.? ?o\.?)$")
CONTINUED = re.compile(r"\s*[—–-]+\s*c[o0]nt[il1]nued?\b\.?|\(\s*c[o0]nt[il1]nued?\.?\s*\)")
NOW = re.compile(r"\((?:now|formerly|late|see)\b\s*([^()]*)\)?")
COUNTY = re.compile(r"^(?:co|county)\.? of |[().]| (?:county|co)\.?$")
#: Digits a scanner puts for letters, next to letters only. Fixed values.
LETTER = {"0": "o", "1": "l", "5": "s", "8": "b"}
DIGIT = re.compile(r"(?<=[^\W\d_])[0158](?![0-9])|(?<![0-9])[0158](?=[^\W\d_])")
WORD = re.compile(r"[^\W_]+")
#: State abbreviations as the directory writes them, without dots. Fixed values.
STATES = {
    "ala": "Alabama", "ariz": "Arizona", "ark": "Arkansas", "cal": "California", "calif": "California", "colo": "Colorado",
    "conn": "Connecticut", "del": "Delaware", "dc": "District of Columbia", "fla": "Florida", "ga": "Georgia", "ida": "Idaho",
    "ill": "Illinois", "ind": "Indiana", "ia": "Iowa", "kan": "Kansas", "kans": "Kansas", "ky": "Kentucky", "la": "Louisiana",
    "me": "Maine", "md": "Maryland", "mass": "Massachusetts", "mich": "Michigan", "minn": "Minnesota", "miss": "Mississippi",
    "mo": "Missouri", "mont": "Montana", "neb": "Nebraska", "nebr": "Nebraska", "nev": "Nevada", "nh": "New Hampshire",
    "nj": "New Jersey", "nm": "New Mexico", "nmex": "New Mexico", "ny": "New York", "nc": "North Carolina", "nd": "North Dakota",
    "ndak": "North Dakota", "o": "Ohio", "okla": "Oklahoma", "ore": "Oregon", "oreg": "Oregon", "pa": "Pennsylvania",
    "penn": "Pennsylvania", "ri": "Rhode Island", "sc": "South Carolina", "sd": "South Dakota", "sdak": "South Dakota",
    "tenn": "Tennessee", "tex": "Texas", "ut": "Utah", "vt": "Vermont", "va": "Virginia", "wash": "Washington",
    "wva": "West Virginia", "wis": "Wisconsin", "wisc": "Wisconsin", "wyo": "Wyoming",
}
#: Similarity a name needs if the county agrees, and if no county is given.
LIKE, LIKE_ALONE = 0.66, 0.78
COUNTY_LIKE = 0.7
#: Words of a text that stand together as a name may do: those with a capital. Fixed value.
CAPITALS = re.compile(r"[^\W\d_a-zà-öø-ÿ][\w.']*(?:[ -]+[^\W\d_a-zà-öø-ÿ][\w.']*)*")
#: Letters of the codes of a name; all others count as one.
CODES = 27
#: The gazetteer is sent to every task; it must not have more places than this.
MOST_PLACES = 500_000


def fold(s: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", s).casefold().split())


def tokens(name: str) -> list[str]:
    """The words of a place name, abbreviations written out, words around the name dropped."""
    s = CONTINUED.sub(" ", fold(name))
    s = re.sub(r"\(.*?(?:\)|$)", " ", s).strip()
    s = DIGIT.sub(lambda m: LETTER[m.group()], s)
    s = AROUND.sub("", AROUND.sub("", s)).strip()
    t = WORD.findall(s.replace("'", ""))
    if len(t) > 1 and t[0] in BEFORE:
        t[0] = BEFORE[t[0]]
    if len(t) > 1:
        t[-1] = AFTER.get(t[-1], t[-1])
    return t


def county(name: str | None) -> str:
    if not name:
        return ""
    s = COUNTY.sub("", COUNTY.sub("", fold(name)).strip()).strip()
    return " ".join(WORD.findall(s))


def token_set(a: list[str], b: list[str]) -> float:
    """Token-set similarity of two names: every token's best likeness on the other side, weighted by its
    length; the own part of a name weighs more than a generic word such as mount or springs."""
    total = got = 0.0
    own_a, own_b = [t for t in a if t not in GENERIC] or a, [t for t in b if t not in GENERIC] or b
    if len(own_a) != len(own_b) and "".join(own_a) != "".join(own_b):
        joined = likeness("".join(a), "".join(b))
        return joined * 0.95
    best = min((max((likeness(x, y) for y in own_b), default=0.0) for x in own_a), default=0.0)
    if best < 0.6:
        return 0.0
    for one, other in ((a, b), (b, a)):
        for x in one:
            w = len(x) * (0.35 if x in GENERIC else 1.0)
            total += w
            got += w * max(likeness(x, y) for y in other)
    return got / total if total else 0.0


def phrases(name: str) -> list[list[str]]:
    """The names that a text may hold: what stands between signs and words in small letters, in order. A text
    without a capital has none. What is called a county is no place."""
    plain = re.sub(r"\bP\.? ?O\.?(?!\w)", " ", CONTINUED.sub(" ", unicodedata.normalize("NFKC", name)))
    found = [m.group() for part in re.split(r"[,;:()/]", plain) if not re.search(r"(?i)\b(?:co|county)\b", part) for m in CAPITALS.finditer(part)]
    return [t for t in map(tokens, found) if t]


def letters(names: list[str]) -> np.ndarray:
    """How often each letter stands in each name."""
    out = np.zeros((len(names), CODES), np.int32)
    for k, n in enumerate(names):
        for c in n:
            out[k, ord(c) - 96 if "a" <= c <= "z" else 0] += 1
    return out


def _apart(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """A lower bound of the edits, swaps of neighbours among them, from one name to each of many."""
    d = many - one
    return np.maximum(np.where(d > 0, d, 0).sum(1), np.where(d < 0, -d, 0).sum(1))


class Block:
    """The names and former names of some places, behind a filter that passes all a name can be like: by the
    letters that both must share if they are so many edits apart at most, as written and as skeletons."""

    def __init__(self, places: list[tuple[int, tuple[str, ...]]]):
        self.places = places
        own = [[t for t in w if t not in GENERIC] or list(w) for _, w in places]
        self.n_own = np.array([len(o) for o in own], np.int32)
        self.own = ["".join(o) for o in own]
        self.sides = [self._side(self.own), self._side(["".join(w) for _, w in places])]

    @staticmethod
    def _side(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return letters(names), letters([skeleton(n) for n in names]), np.array([len(n) for n in names], np.int32)

    def _near(self, name: str, side: int) -> np.ndarray:
        plain, bare, sizes = self.sides[side]
        most = np.maximum(sizes, len(name)) * 2 // 5
        return (_apart(letters([name])[0], plain) <= most) | (_apart(letters([skeleton(name)])[0], bare) <= most)

    def like(self, words: list[str]) -> dict[int, float]:
        """The places whose name or former name is like the words, and how much."""
        if not self.places or not words:
            return {}
        own = [t for t in words if t not in GENERIC] or words
        joined = "".join(own)
        same = self.n_own == len(own)
        passed = np.where(same, self._near(joined, 0) if len(own) == 1 else True, self._near("".join(words), 1))
        passed |= np.array([o == joined for o in self.own])
        out: dict[int, float] = {}
        for j in np.flatnonzero(passed):
            k, w = self.places[j]
            score = token_set(words, list(w))
            if score >= LIKE and score > out.get(k, 0.0):
                out[k] = score
        return out


@dataclass(frozen=True)
class Place:
    place_id: int
    words: tuple[str, ...]
    former: tuple[str, ...]
    county: str
    state: str
    population: int | None


@dataclass
class Gazetteer:
    """Places by state, and an automaton over all their names and aliases."""

    places: list[Place]
    by_state: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))
    states: dict[str, str] = field(default_factory=dict)
    automaton: ahocorasick.Automaton = field(default_factory=ahocorasick.Automaton)
    blocks: dict[str | None, Block] = field(default_factory=dict)
    known: dict[tuple, tuple[int, str, float]] = field(default_factory=dict)
    liked: dict[tuple, dict[int, float]] = field(default_factory=dict)
    read: dict[tuple, str | None] = field(default_factory=dict)

    def __post_init__(self) -> None:
        patterns: dict[str, list[tuple[int, bool]]] = defaultdict(list)
        for k, p in enumerate(self.places):
            self.by_state[p.state].append(k)
            self.states[" ".join(WORD.findall(fold(p.state)))] = p.state
            for words, former in ((p.words, False), (p.former, True)):
                if words:
                    patterns[f" {' '.join(words)} "].append((k, former))
        for pattern, found in patterns.items():
            self.automaton.add_word(pattern, (pattern, found))
        if patterns:
            self.automaton.make_automaton()

    def state(self, written: str | None, publication: str | None) -> str | None:
        """The state that is written, else that of the publication; None if neither can be read."""
        key = (written, publication)
        if key not in self.read:
            if len(self.read) > 200_000:
                self.read.clear()
            self.read[key] = self._state(*key)
        return self.read[key]

    def _state(self, written: str | None, publication: str | None) -> str | None:
        for s in (written, publication):
            if not s:
                continue
            plain = re.sub(r"^state of ", "", fold(s))
            plain = re.sub(r",?\s*u\.?\s*s\.?(?:\s*a\.?)?$", "", plain)
            key = " ".join(WORD.findall(plain))
            short = STATES.get(key.replace(" ", ""))
            if key in self.states:
                return self.states[key]
            if short:
                return short
            if key.title() in STATES.values():
                return key.title()
            if len(key) > 3:
                best = max(((likeness(key, k), v) for k, v in self.states.items()), default=(0.0, ""))
                if best[0] >= 0.75:
                    return best[1]
        return None

    def mentions(self, words: list[str]) -> list[tuple[int, bool]]:
        """Places whose name or alias is embedded in the words: of matches that overlap the longest counts."""
        if not len(self.automaton) or not words:
            return []
        found = sorted(
            ((end - len(pattern) + 1, end, what) for end, (pattern, what) in self.automaton.iter(f" {' '.join(words)} ")),
            key=lambda m: (m[0] - m[1], m[0]),
        )
        taken: list[tuple[int, int]] = []
        out: list[tuple[int, bool]] = []
        for a, b, what in found:
            if all(b <= x + 1 or a >= y - 1 for x, y in taken):
                taken.append((a, b))
                out += what
        return out

    def similar(self, where: str | None, words: list[str]) -> dict[int, float]:
        """The places of a state, or of all, that are like the words, and how much."""
        key = (where, *words)
        if key not in self.liked:
            if len(self.liked) > 200_000:
                self.liked.clear()
            if where not in self.blocks:
                own = range(len(self.places)) if where is None else self.by_state.get(where, ())
                self.blocks[where] = Block([(k, w) for k in own for w in (self.places[k].words, self.places[k].former) if w])
            self.liked[key] = self.blocks[where].like(words)
        return self.liked[key]

    def _mentioned(self, names: list[list[str]], where: str | None, c: str, population: int | None) -> tuple[int, str, float] | None:
        """The place that one of the names is. A name that has words over, such as a direction or what kind of
        place it is, is that of another place."""
        found: dict[int, int] = {}
        for v in names:
            for k, former in self.mentions(v):
                p = self.places[k]
                if (where is None or p.state == where) and len(v) == len(p.former if former else p.words):
                    found[k] = found.get(k, 0) + 1
        if not found:
            return None
        hits = max(found.values())
        best = max((k for k, n in found.items() if n == hits), key=lambda k: (*self._closeness(k, c, population), self.places[k].population or 0, -k))
        agree = self._closeness(best, c, population)[0]
        if where is not None and (not c or not self.places[best].county or agree >= 0.5) or agree >= COUNTY_LIKE and c:
            return self.places[best].place_id, "mention", 1.0
        return None

    def _closeness(self, k: int, cty: str, population: int | None) -> tuple[float, float]:
        p = self.places[k]
        c = likeness(cty, p.county) if cty and p.county else 0.5
        gap = 0.5
        if population and p.population:
            gap = min(population, p.population) / max(population, p.population)
        return c, gap

    def find(self, name: str | None, cty: str | None, state: str | None, publication: str | None, population: int | None) -> tuple[int, str, float]:
        """(place_id, how, score): how is `mention`, `similar` or `none` (place_id 0)."""
        key = (name, cty, state, publication, population)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[key] = self._find(*key)
        return self.known[key]

    def _find(self, name, cty, state, publication, population) -> tuple[int, str, float]:
        if not name or not name.strip():
            return 0, "none", 0.0
        where = self.state(state, publication)
        words, c = tokens(name), county(cty)
        now = NOW.search(fold(name))
        variants = [words] + ([tokens(now.group(1))] if now and now.group(1).strip() else [])
        mention = self._mentioned(variants, where, c, population)
        if mention is None and len(inner := phrases(name)) and inner != [words]:
            # Names embedded in a text, the longest first.
            longest = sorted(inner, key=len, reverse=True)
            mention = next((m for v in longest if (m := self._mentioned([v], where, c, population))), None)
        if mention is not None:
            return mention
        best_score, best_k = 0.0, -1
        scores: dict[int, float] = {}
        for v in variants:
            for k, score in self.similar(where, v).items():
                scores[k] = max(score, scores.get(k, 0.0))
        for k, score in sorted(scores.items()):
            p = self.places[k]
            agree, near = self._closeness(k, c, population)
            if where is None and not (c and agree >= COUNTY_LIKE):
                continue
            if c and p.county and agree < COUNTY_LIKE:
                if agree < 0.5 or score < 0.9:
                    continue
            if (not c or not p.county) and score < LIKE_ALONE + 0.1 * (population is not None and p.population is not None and near < 0.6):
                continue
            full = score + 0.3 * agree + 0.1 * near
            if full > best_score:
                best_score, best_k = full, k
        if best_k >= 0:
            return self.places[best_k].place_id, "similar", best_score / 1.4
        return 0, "none", 0.0


def gazetteer(places: DataFrame) -> Gazetteer:
    """The gazetteer (place_id, name, county_name, state_name, former_name, population) for the tasks; its
    size is checked, as it is sent to all of them."""
    rows = places.select("place_id", "name", "county_name", "state_name", "former_name", "population").limit(MOST_PLACES + 1).collect()
    if len(rows) > MOST_PLACES:
        raise ValueError(f"the gazetteer has more than {MOST_PLACES} places")
    return Gazetteer(
        [
            Place(r.place_id, tuple(tokens(r.name or "")), tuple(tokens(r.former_name or "")), county(r.county_name), r.state_name or "", r.population)
            for r in sorted(rows, key=lambda r: (r.place_id is None, r.place_id))
            if r.place_id is not None
        ]
    )


def locate(cities: DataFrame, places: DataFrame) -> DataFrame:
    """Rows (row_id, place_id, how, score), one for each distinct row of `cities` (row_id, name, county_name,
    state_name, publication, population): the gazetteer place of each city, 0 if it has none.

    The state is that written, read through abbreviations and misspellings, else that of the publication;
    without both, every state is looked at and the county must agree. Mentions of names and former names
    come first, of the whole value or else of what stands in it as a name, set off by signs or words in small
    letters, the longest first; of several places so named the county decides, then the population, then the
    greater place. A name that a mention leaves a word of over, as North Holgate does of Holgate, is another
    place's. Names without a mention go to the most similar place of the state whose county agrees (or is
    not given). Null and empty names have no place. The cities stay where they are; the gazetteer, a list
    of bounded size, goes to the tasks.
    """
    spark = cities.sparkSession
    shared = spark.sparkContext.broadcast(gazetteer(places).places)
    names = ["row_id", "name", "county_name", "state_name", "publication", "population"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Gazetteer(shared.value)
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("name", "county_name", "state_name", "publication", "population")]
            out = [g.find(*row) for row in zip(*cols)]
            ids, how, score = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"), pa.array(ids, pa.int32()), pa.array(how, pa.string()), pa.array(score, pa.float64())],
                ["row_id", "place_id", "how", "score"],
            )

    kind = f"row_id {cities.schema['row_id'].dataType.simpleString()}, place_id int, how string, score double"
    # Few bytes, much work: spread over all partitions, whose number the rule for small shuffles leaves alone.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return cities.select(*names).distinct().repartition(parts, "row_id").mapInArrow(run, kind)
