"""Noise in text from scanned pages: running heads, page numbers, broken words and misread characters."""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.lookalikes import normalise_array
from quirework.llm.places import STATES
from quirework.runtime import SENT, attach, cut

HYPHEN, MISREAD, HEADER, PAGE_NUMBER = 1, 2, 4, 8
KINDS = {HYPHEN: "hyphen", MISREAD: "misread", HEADER: "header", PAGE_NUMBER: "page_number"}

#: What stands for a line that could not be read. Fixed value.
SKIPPED = "******* KEEPS FAILING! SKIPPING FOR NOW *******"
#: Letters, or two, that a scanner takes for others, as their shapes are alike. Fixed values.
LETTERS = (
    ("c", "e"), ("e", "c"), ("e", "o"), ("o", "c"), ("c", "o"), ("l", "i"), ("i", "l"), ("f", "t"), ("t", "f"), ("f", "i"), ("g", "q"), ("q", "g"),
    ("n", "u"), ("u", "n"), ("h", "b"), ("b", "h"), ("d", "cl"), ("cl", "d"), ("n", "ri"), ("m", "rn"), ("rn", "m"), ("w", "vv"), ("h", "li"), ("u", "ii"),
)
#: Signs of the directory and what a scanner makes of them. Fixed values.
SIGNS = {"Q+": "⊕", "@": "⊕", "+": "⊕", "¢": "◊", "│": "◊", "|": "◊", "┃": "◊", "☉": "♁", "δ": "♁", "♂": "♁", "☁": "♁", "⚇": "♁", "⚁": "♁", "#": "‡", "Δ": "△", "∆": "△", "┳": "△", "☆": "★"}
PLAIN = r"\w\s(),.';:*&/\-—\[\]\"▼★‡◊⊕♁△½⁄!"
#: Digits a scanner puts for letters, in small and in capital words. Fixed values.
SMALL, CAPITAL = str.maketrans("0158", "olsb"), str.maketrans("0158", "OISB")
#: Letters that digits are put for, as one sign each.
PLAIN_FORM = str.maketrans("ilI1oO0sS5bB8", "1111000555888")
#: Mixed tokens that are right as they are: ordinals, societies, rural routes. Fixed values.
MIXED_OK = re.compile(r"\d+(?:st|nd|rd|th|ST|ND|RD|TH)|[A-Ga-g]\d{1,2}|RD\d{1,2}|RFD\d{1,2}")
#: Digits that are put for letters, and letters that are put for digits. Fixed values.
FOR_LETTERS, FOR_DIGITS = frozenset("0158"), frozenset("lIOoSB")
MIXED = re.compile(r"(?<![^\W_])(?=[^\W_]*\d)(?=[^\W_]*[^\W\d_])[^\W_]+")
LICENSE = re.compile(r"\([1I|!i](?= ?(?:\d\d|t)\)|$)")

#: Misread forms are looked for of words that make up this share of all words, of which there are at most
#: 1 / FREQUENT; a form is that of a word this often as frequent.
FREQUENT, RARER = 1e-4, 20
#: No printed word that is read letter by letter is longer.
LONGEST_WORD = 60
#: Words of so many letters are judged with what longer ones show.
SHORT = 3
#: A word belongs to running heads if it stands at the edge of a column in this share of its places, so many
#: times at least, and makes up this share of all words there; judged over all publications, and within each for
#: its own heads. So at most 1 / EDGE_RARE are kept of all, and as many of a publication.
EDGE_SHARE, EDGE_LEAST, EDGE_RARE = 0.2, 5, 1e-5
#: A shape of line repeats at page edges if it is found on so many pages and in this share of the edges, either of
#: all or of one publication, whose own it is then. So at most 1 / SHARE are kept, and as many of a publication.
PAGES, SHARE = 3, 2e-4
#: Pages before and behind a page that tell how far its number is ahead of it, where a publication counts anew.
NEAR = 25

#: A whole word in a text: not what a hyphen cuts off, nor what a line begins with in small letters.
WORDS = r"(?<![\p{L}\p{N}-])(?<!-\s)(?:(?<!^)\p{L}|\p{Lu})\p{L}++(?=[\s,;.)])"
#: A word with a hyphen of its own, as far as its second part is in small letters.
HYPHENATED = r"(?<![\p{L}\p{N}-])\p{L}++-\p{Ll}{2,}+(?=[\s,;.)])"
NUMBER_LINE = re.compile(r"\s*(?:([—–-]\s*)?(\d{1,5})(\s*[—–-])?|\[\s*(\d{1,5})\s*\]|(?:[Pp]age|[Pp]\.)\s*(\d{1,5})|(\d{1,5})\.)\s*")
NUMBER_INSIDE = re.compile(r"(?:[—–-]\s+(\d{1,5})\s+[—–-]|\[\s*(\d{1,5})\s*\]|(?<!\w)(?:[Pp]age|[Pp]\.)\s*(\d{1,5}))(?!\d)")
LETTERS_ONLY = re.compile(r"[^\W\d_]{2,}")
INNER_HINT = re.compile(r"-[a-zà-ÿ]")
BREAK = re.compile(r"(?<![^\W\d_])([^\W\d_]+)-(\s+|$)([^\W\d_]*)(\.?)")
INNER_BREAK = re.compile(r"(?<![^\W_])([^\W\d_]+)-([a-zà-ÿ]+)")
FIRST_WORD = re.compile(r"\s*([^\W\d_]+)")
SHAPE_TOKEN = re.compile(r"[^\W\d_]+|\d+|[\x01—]")


def confused(word: str) -> list[str]:
    """What a scanner makes of a word by taking one of its letters for another of like shape."""
    return sorted({word[: m.start()] + b + word[m.end() :] for a, b in LETTERS for m in re.finditer(a, word)} - {word})


def _confusion(form: str, word: str) -> frozenset[str]:
    """The letters that a form has in place of those of its word, either way."""
    a = next((k for k, (x, y) in enumerate(zip(form, word)) if x != y), min(len(form), len(word)))
    b = next((k for k, (x, y) in enumerate(zip(form[a:][::-1], word[a:][::-1])) if x != y), min(len(form), len(word)) - a)
    return frozenset((form[a : len(form) - b], word[a : len(word) - b]))


def neighbours(word: str) -> list[str]:
    """Patterns under which words of one length meet that differ in one letter."""
    return [f"{word[:k]}*{word[k + 1 :]}" for k in range(len(word))]


@functools.cache
def _suspect() -> re.Pattern[str]:
    return re.compile(rf"[^{PLAIN}]|Q\+|\(&\)|\([1I|!i](?= ?(?:\d\d|t)\)|$)|[^\W\d_]\d|\d[^\W\d_]")


def repair_word(w: str) -> str:
    """A mixed token with its digits read as letters, if it is a word at all."""
    letters = [c for c in w if c.isalpha()]
    if not letters or MIXED_OK.fullmatch(w):
        return w
    small = sum(c.islower() for c in letters)
    if len(letters) * 2 < len(w) and not small:
        return w
    return w.translate(SMALL) if small * 2 > len(letters) or small and not letters[0].isupper() else w.translate(CAPITAL) if not small else w[0].translate(CAPITAL) + w[1:].translate(SMALL)


def repair_mixed(text: str) -> str:
    return MIXED.sub(lambda m: repair_word(m.group()), text)


@functools.lru_cache(maxsize=4096)
def _publication(pub: str) -> str:
    """A pattern of the names of a publication: in full, in capitals, abbreviated."""
    names = [pub, pub.upper()]
    for short, state in STATES.items():
        if state == pub:
            parts = [short[:1], short[1:]] if len(short) == 2 and " " in state else ["w", "va"] if short == "wva" else [short]
            dotted = r"\.?\s?".join(p.capitalize() for p in parts)
            names += [dotted, r"\.?\s?".join(p.upper() for p in parts)]
    full = "|".join(re.escape(n) if n in (pub, pub.upper()) else n for n in sorted(names, key=len, reverse=True))
    return rf"(?<![^\W_])(?:{full})(?![^\W_])\.?"


def shape(text: str, pub: str, heads: frozenset[str]) -> str:
    """A line as the sequence of its kinds of token: the publication P, numbers 9, words of running heads and
    the short words that follow them as they are, a dash, and any other words W."""
    s = re.sub(_publication(pub), "\x01", repair_mixed(text)) if pub else repair_mixed(text)
    out: list[str] = []
    for t in SHAPE_TOKEN.findall(s):
        led = out and out[-1][0] == "=" and len(t) <= 3 and t.islower()
        k = "P" if t == "\x01" else "9" if t.isdigit() else "—" if t == "—" else f"={t}" if t in heads or led else "W"
        if k != "W" or not out or out[-1] != "W":
            out.append(k)
    return " ".join(out)


def usable(s: str) -> bool:
    """Whether a shape that repeats is a running head: more than the publication, a number, or plain words. Words
    of no head, such as the name of a place, are part of one if a dash sets them beside the publication."""
    parts = s.split(" ")
    if "W" in parts:
        return parts.count("W") == 1 and "P" in parts and "—" in parts and "9" not in parts
    if len(parts) == 2 and "9" in parts and any(p.casefold() in ("=page", "=pg", "=p") for p in parts):
        return False  # a page number
    return any(p.startswith("=") for p in parts) and sum(len(p) - 1 for p in parts if p.startswith("=")) >= 4 and len(parts) >= 2


_FUZZY = {"O": "[O0]", "o": "[o0]", "I": "[I1l]", "i": "[i1l]", "l": "[l1I]", "S": "[S5]", "s": "[s5]", "B": "[B8]"}


def _fuzzy(word: str) -> str:
    return "".join(_FUZZY.get(c, re.escape(c)) for c in word)


def _hint(s: str) -> str:
    """The longest part of a shape's words that is read without fail; the dash if it has no words."""
    runs = [(len(r), len(p), r) for p in s.split(" ") if p[0] == "=" for r in re.split("[OoIilSsB01]", p[1:])]
    return max(runs)[2] if runs and max(runs)[0] >= 2 else "" if runs else "—"


#: Pages from which page numbers are ahead by a number, by page; by none that is known, if it is None.
Turns = tuple[tuple[int, int | None], ...]


@dataclass(frozen=True)
class NoiseModel:
    """What was learnt from the corpus: shapes of running heads of all publications, misread forms of frequent
    words, and these words, all of bounded number; how often each word stands in the corpus (w, n); and for each publication how
    far its page numbers are ahead of its pages, the pages from which they are ahead by another number, if there are
    any, and the shapes that are only its own (_pub, ahead, own, turns)."""

    shapes: tuple[str, ...]
    forms: dict[str, str]
    frequent: tuple[str, ...] = ()
    words: DataFrame | None = None
    publications: DataFrame | None = None
    told: dict[str, tuple[int | None, tuple[str, ...], Turns]] | None = None

    def attached(self, df: DataFrame) -> DataFrame:
        """`df` with what is known of its publications (ahead, own, turns), if it isn't sent to the tasks."""
        if self.told is not None or self.publications is None:
            return df
        return df.join(self.publications, "_pub", "left")


#: A hyphen to be judged by the vocabulary: what stands before and behind it, and how it is judged.
Break = tuple[str, str, str]
END, SMALL_LETTERS, CAPITALS, INNER = "end", "small", "capitals", "inner"


class Reader:
    """Finds and mends the noise of texts. Hyphens that the vocabulary must judge are taken for breaks where
    `judged` says so, and are noted in `asked`."""

    def __init__(self, shapes: tuple[str, ...], forms: dict[str, str], frequent: tuple[str, ...] = (), told: dict | None = None):
        self.shapes, self.forms, self.told = shapes, forms, told
        #: Frequent words by what is left of them if digits may stand for letters.
        self.plain: dict[str, str] = {}
        for w in frequent:
            self.plain.setdefault(w.translate(PLAIN_FORM), w)
        self.heads: dict[str, re.Pattern[str] | None] = {}
        self.suspect = _suspect()
        #: For each shape characters of it that no scanner takes for others: a text without any has no running head.
        self.hints: dict[str, tuple[str, ...]] = {}
        self.asked: list[Break] = []
        self.judged: dict[Break, bool] = {}
        self.pub, self.ahead, self.own, self.turns = "", None, (), ()

    def at(self, pub: str | None, ahead: int | None, own: Sequence[str] | None, turns: Sequence | None = None) -> None:
        """The publication that the next texts are of, how far its page numbers are ahead, and its own shapes."""
        self.pub = pub or ""
        self.ahead, self.own, self.turns = self.told.get(self.pub, (None, (), ())) if self.told is not None else (ahead, tuple(own or ()), _turns(turns))

    def _pattern(self) -> re.Pattern[str] | None:
        """One pattern for all running heads of the publication, found anywhere in a text."""
        pub, out = self.pub, []
        fuzzy = "|".join(sorted({_fuzzy(n) for n in (pub, pub.upper())}, key=len, reverse=True))
        name = rf"(?:(?<![^\W_])(?:{fuzzy})(?![^\W_])|{_publication(pub)})"
        capital = r"[^\W\d_a-zà-ÿ][^\W_a-zà-ÿ]"
        for s in sorted(self.shapes + self.own, key=len, reverse=True):
            parts = s.split(" ")
            if "P" in parts and not pub:
                continue
            if "W" in parts:
                # Words of no head are those in capitals that the dash sets beside the name in capitals.
                coded = [rf"(?:{capital}*\.?\s){{0,2}}{capital}+" if x == "W" else rf"(?:{_fuzzy(pub.upper())})(?![^\W_])" if x == "P" else "—" if x == "—" else rf"(?<![^\W_]){_fuzzy(x[1:])}(?![^\W_])" for x in parts]
                out.append(r"\s?".join(coded))
                continue
            coded = [name if x == "P" else r"(?<![\w,'])[\dOIlSB]*\d[\dOIlSB]*(?![\w])" if x == "9" else "—" if x == "—" else rf"(?<![^\W_]){_fuzzy(x[1:])}(?![^\W_])" for x in parts]
            out.append(r"[\s.,()—–-]*".join(coded))
        return re.compile("|".join(f"(?:{x})" for x in out)) if out else None

    def head(self, text: str) -> re.Match[str] | None:
        if self.pub not in self.hints:
            if len(self.hints) > 1000:
                self.hints.clear()
                self.heads.clear()
            self.hints[self.pub] = tuple({_hint(s) for s in self.shapes + self.own})
        if not any(h in text for h in self.hints[self.pub]):
            return None
        if self.pub not in self.heads:
            self.heads[self.pub] = self._pattern()
        pattern = self.heads[self.pub]
        return pattern.search(text) if pattern else None

    def _expected(self, page: int | None) -> int | None:
        ahead = self.ahead
        if self.turns and page is not None:
            ahead = self.turns[max(0, bisect_right(self.turns, page, key=lambda t: t[0]) - 1)][1]
        return None if ahead is None or page is None else ahead + page

    def number_line(self, text: str, page: int | None, edge: bool) -> bool:
        """Whether the whole text is a page number. A bare number must be the one that is due on the page,
        or, where none is known, stand at the edge; a marked one may be any at the edge."""
        if len(text) > 14:
            return False
        m = NUMBER_LINE.fullmatch(repair_mixed(text)) or NUMBER_LINE.fullmatch(text)
        if not m:
            return False
        lead, plain, trail, bracket, named, dotted = m.groups()
        if plain and bool(lead) != bool(trail):
            return False
        n = int(next(x for x in (plain, bracket, named, dotted) if x))
        due = self._expected(page)
        if due is not None and n == due:
            return edge or bool(lead or bracket or named)
        marked = bool(lead or bracket or named)
        return edge and (marked or due is None and n > 1)

    def number_inside(self, text: str, page: int | None) -> re.Match[str] | None:
        due = self._expected(page)
        if due is not None and str(due) not in text:
            return None
        for m in NUMBER_INSIDE.finditer(text):
            n = int(next(x for x in m.groups() if x))
            if n == due or due is None and not m.group(1):
                return m
        return None

    def _ask(self, left: str, right: str, how: str) -> bool:
        self.asked.append((left, right, how))
        return self.judged.get((left, right, how), False)

    def broken(self, left: str, right: str, at_end: bool) -> bool:
        """Whether the hyphen between two parts of a text breaks a word."""
        if not right:
            return at_end and len(left) > 1 and self._ask(left, "", END)
        if left + right in self.forms:
            return True
        if right[0].islower():
            return self._ask(left, right, SMALL_LETTERS)
        if len(right) == 1 or len(left) == 1 and not right.isupper():
            return False
        return left.isupper() and right.isupper() and self._ask(left, right, CAPITALS)

    def inner_break(self, left: str, right: str) -> bool:
        return left[-1].islower() and self._ask(left, right, INNER)

    def misread(self, text: str, before: str = "") -> bool:
        """Whether a letter, digit or sign is not the printed one; `before` is the broken end of the line before.
        A mixed token is misread if its digits are such as are put for letters, or its letters such as are put
        for digits; others are changes of another kind."""
        for m in self.suspect.finditer(text):
            t = m.group()
            if len(t) == 2 and t[0].isalnum() and t[1].isalnum() and (t[0].isdigit() != t[1].isdigit()):
                a, b = m.start(), m.end()
                while a and text[a - 1].isalnum():
                    a -= 1
                while b < len(text) and text[b].isalnum():
                    b += 1
                token = text[a:b]
                if not MIXED_OK.fullmatch(token):
                    digits = {c for c in token if c.isdigit()}
                    if digits <= FOR_LETTERS or {c for c in token if c.isalpha()} <= FOR_DIGITS:
                        return True
                continue
            return True
        if self.forms.keys().isdisjoint(LETTERS_ONLY.findall(text)):
            return False
        for m in LETTERS_ONLY.finditer(text):
            if m.group() in self.forms and not (
                text[m.end() : m.end() + 1] in ("-", "'") or text[m.end() : m.end() + 1].isdigit() or before and not text[: m.start()].strip()
            ):
                return True
        return False

    def split_misread(self, left: str, right: str) -> tuple[bool, bool]:
        """Whether a broken word is a misread form, and in which part."""
        word = self.forms.get(left + right)
        if not word:
            return False, False
        wrong = left + right
        k = next((i for i, (x, y) in enumerate(zip(wrong, word)) if x != y), len(word))
        return k < len(left), k >= len(left)

    def entry(self, text: str | None, page: int | None) -> int:
        """The kinds of noise of an entry, but for hyphens that are to be judged."""
        if not text or text.strip() == SKIPPED:
            return 0
        mask = 0
        if self.number_line(text, page, True):
            return PAGE_NUMBER | (MISREAD if self.misread(text) else 0)
        rest = text
        while h := self.head(rest):
            mask |= HEADER
            rest = rest[: h.start()] + " " + rest[h.end() :]
        while m := self.number_inside(rest, page):
            mask |= PAGE_NUMBER
            rest = rest[: m.start()] + " " + rest[m.end() :]
        if "- " in rest or "-\n" in rest or rest.endswith("-"):
            for m in BREAK.finditer(rest):
                left, gap, right, _ = m.groups()
                if self.broken(left, right, not gap):
                    mask |= HYPHEN
                if right and any(self.split_misread(left, right)):
                    mask |= MISREAD
        if INNER_HINT.search(rest) and any([self.inner_break(*m.groups()) for m in INNER_BREAK.finditer(rest)]):
            mask |= HYPHEN
        if self.misread(text):
            mask |= MISREAD
        return mask

    def mend(self, text: str | None, page: int | None) -> str | None:
        """The entry as continuous text: furniture taken out, broken words joined, misread characters put right."""
        if text is None or text.strip() == SKIPPED:
            return None
        if self.number_line(text, page, True):
            return ""
        while h := self.head(text):
            text = text[: h.start()] + " " + text[h.end() :]
        while m := self.number_inside(text, page):
            text = text[: m.start()] + " " + text[m.end() :]
        text = BREAK.sub(lambda m: f"{m[1]}{m[3]}{m[4]}" if self.broken(m[1], m[3], not m[2]) else m[0] if m[2] == "" else f"{m[1]}-{m[3]}{m[4]}", text)
        text = INNER_BREAK.sub(lambda m: m[1] + m[2] if self.inner_break(m[1], m[2]) else m[0], text)
        text = LICENSE.sub("(l", text).replace("(&)", "(♁)")
        text = MIXED.sub(lambda m: m[0] if MIXED_OK.fullmatch(m[0]) else self.plain.get(m[0].translate(PLAIN_FORM)) or repair_word(m[0]), text)
        text = re.sub(r"[^\W\d_]+", lambda m: self.forms.get(m[0], m[0]), text)
        for wrong, sign in SIGNS.items():
            text = text.replace(wrong, sign)
        return re.sub(r"\s+", " ", text).strip()


@dataclass(slots=True)
class Line:
    line_id: int
    page: int | None
    col: int | None
    text: str | None
    edge: bool = False
    mask: int = 0
    breaks: Sequence[Break] = ()
    #: Other keys of the same line of the page.
    again: Sequence[int] = ()


def read_page(lines: Iterable[Line], reader: Reader) -> Iterator[Line]:
    """The lines of a page in reading order, with their kinds of noise and the hyphens that are to be judged. A
    hyphen at the end of a line goes with the next line that is no page furniture; until it comes, only furniture
    is passed on, so that no more than a few lines are held."""
    waiting: Line | None = None
    left = ""

    def settle(right: str) -> int:
        """What the line that was waiting becomes, and the kind that the line with the rest of the word gets."""
        reader.asked = []
        if reader.broken(left, right, True):
            waiting.mask |= HYPHEN
        first, second = reader.split_misread(left, right) if right else (False, False)
        waiting.mask |= MISREAD if first else 0
        waiting.breaks = tuple(reader.asked)
        return MISREAD if second else 0

    for x in lines:
        t = x.text or ""
        reader.asked = []
        if not t.strip() or t.strip() == SKIPPED:
            if waiting and x.text != "":
                settle("")
                yield waiting
                waiting = None
            yield x
            continue
        x.mask = PAGE_NUMBER if reader.number_line(t, x.page, x.edge) else HEADER if reader.head(t) else 0
        if x.mask:
            x.mask |= MISREAD if reader.misread(t) else 0
            yield x
            continue
        before = ""
        if waiting:
            r = FIRST_WORD.match(t)
            before = left
            x.mask |= settle(r.group(1) if r else "")
            yield waiting
            waiting = None
            reader.asked = []
        x.mask |= MISREAD if reader.misread(t, before) else 0
        stripped = t.rstrip()
        if stripped.endswith("-"):
            m = BREAK.search(stripped, max(0, len(stripped) - 40))
            while m and m.end() < len(stripped):
                m = BREAK.search(stripped, m.end())
            if m:
                waiting, left = x, m.group(1)
                continue
        elif "- " in t:
            for m in BREAK.finditer(t):
                if m.group(2) and m.group(3) and reader.broken(m.group(1), m.group(3), False):
                    x.mask |= HYPHEN
            x.breaks = tuple(reader.asked)
        yield x
    if waiting:
        settle("")
        yield waiting


def _with_edges(lines: Iterable[Line]) -> Iterator[Line]:
    """The lines, the two first and last of each column and those of the page marked as its edges. A line without
    a page has none."""
    near: deque[Line] = deque()  # up to two lines before, the line, and two behind it
    at = 0
    source = iter(lines)
    done = False
    while True:
        while not done and len(near) < at + 3:
            x = next(source, None)
            done = x is None
            if x is not None:
                near.append(x)
        if at >= len(near):
            return
        x = near[at]
        two_before = near[at - 2].col if at >= 2 else None
        two_behind = near[at + 2].col if at + 2 < len(near) else None
        inner = at >= 1 and at + 1 < len(near) and two_before == x.col and two_behind == x.col
        x.edge = x.page is not None and not inner
        yield x
        if at == 2:
            near.popleft()
        else:
            at += 1


def learn(lines: DataFrame, entries: DataFrame, sent: int = SENT) -> NoiseModel:
    """The model of all lines (pub, page, col, line_no, text) and entries (full_text).

    Counts run over all rows. What reaches the driver is bounded by the parameters above: shapes of running heads
    of all publications (1 / SHARE) and the words in them (1 / EDGE_RARE), and misread forms of frequent words
    (at most 1 / FREQUENT words). The vocabulary stays distributed, and so does what is known of single
    publications, unless it is at most `sent` entries, which are then sent to the tasks.
    """
    texts = lines.select(F.col("text").alias("t")).unionByName(entries.select(F.col("full_text").alias("t")))
    hyphened = F.when(F.col("t").contains("-"), F.regexp_extract_all("t", F.lit(HYPHENATED), F.lit(0))).otherwise(F.array().cast("array<string>"))
    each = texts.where("t is not null").select(F.explode(F.concat(F.regexp_extract_all("t", F.lit(WORDS), F.lit(0)), hyphened)).alias("w"))
    counted = cut(each.groupBy("w").agg(F.count("*").alias("n")))
    words = counted.where("n > 1")
    column = ("pub", "page", "col")
    ends = lines.where("text is not null").groupBy(*column).agg(
        F.min(F.struct("line_no", "text")).alias("first"), F.max(F.struct("line_no", "text")).alias("last"), F.count("*").alias("rows")
    )
    pub = F.coalesce("pub", F.lit("")).alias("_pub")
    # How often each line of a column is repeated, under the same or other keys: the edges stand as often.
    times = F.greatest(F.lit(1.0), F.coalesce(F.col("rows") / (F.col("last.line_no") - F.col("first.line_no") + 1), F.lit(1.0))).alias("times")
    edges = cut(ends.select(pub, "page", times, F.explode(F.array("first.text", "last.text")).alias("text")))
    word = F.explode(F.regexp_extract_all("text", F.lit(r"(?<!\p{L})\p{L}{2,}+"), F.lit(0))).alias("w")
    at_edge = cut(edges.select("_pub", "times", word).groupBy("_pub", "w").agg(F.count("*").alias("e"), F.sum("times").alias("all_e")))
    totals = at_edge.groupBy("_pub").agg(F.sum("e").alias("words"))
    least = max(EDGE_LEAST, EDGE_RARE * (totals.agg(F.sum("words")).first()[0] or 0))
    often = at_edge.groupBy("w").agg(F.sum("e").alias("e")).where(F.col("e") >= least).select("w")
    often_own = at_edge.join(totals, "_pub").where(F.col("e") >= F.greatest(F.lit(EDGE_LEAST), EDGE_RARE * F.col("words")))
    seen = lines.select(pub, word).join(often.union(often_own.select("w")).distinct(), "w", "left_semi").groupBy("_pub", "w").agg(F.count("*").alias("n"))
    placed = cut(seen.join(at_edge, ["_pub", "w"], "left").na.fill(0, ["e", "all_e"]))
    mostly = F.col("all_e") >= EDGE_SHARE * F.col("n")
    heads = frozenset(r[0] for r in placed.groupBy("w").agg(F.sum("all_e").alias("all_e"), F.sum("n").alias("n")).join(often, "w").where(mostly).select("w").collect())
    heads_own = placed.where(mostly).join(often_own.select("_pub", "w"), ["_pub", "w"]).groupBy("_pub").agg(F.collect_list("w").alias("ws"))

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[str | None, frozenset[str]] = (None, heads)
        for b in batches:
            out: list[tuple[str, str, str, int | None, int | None]] = []
            own_words = b.column("ws")
            for k, (t, p, g) in enumerate(zip(normalise_array(b.column("text")).to_pylist(), b.column("_pub").to_pylist(), b.column("page").to_pylist())):
                if not t:
                    continue
                if known[0] != p:
                    known = p, heads | frozenset(own_words[k].as_py() or ())
                s = shape(t, p, heads)
                own = shape(t, p, known[1]) if len(known[1]) > len(heads) else s
                ahead = None
                if g is not None and (s == "9" or usable(s) or usable(own)):
                    numbers = re.findall(r"\d+", repair_mixed(t))
                    ahead = int(numbers[0]) - g if len(numbers) == 1 and len(numbers[0]) < 6 else None
                out.append((s, own, p, g, ahead))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else ((), (), (), (), ()), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                ["shape", "own", "_pub", "page", "ahead"],
            )

    led = attach(edges, heads_own, ["_pub"], F.size("ws")).select("text", "_pub", "page", "ws")
    shaped = cut(led.mapInArrow(shapes, "shape string, own string, _pub string, page bigint, ahead bigint"))
    n_edges = shaped.count()
    repeated = (
        shaped.groupBy("shape").agg(F.count("*").alias("n"), F.countDistinct("_pub", "page").alias("pages"))
        .where((F.col("pages") >= PAGES) & (F.col("n") >= SHARE * n_edges)).select("shape").collect()
    )
    shared = sorted({r[0] for r in repeated if usable(r[0])})
    in_own = shaped.groupBy("_pub").agg(F.count("*").alias("edges"))
    parts = F.split("shape", " ")
    # `usable` again, in the JVM: the shapes of single publications are many.
    letters = F.aggregate(F.filter(parts, lambda x: x.startswith("=")), F.lit(0), lambda a, x: a + F.length(x) - 1)
    plain = F.array_contains(parts, "W")
    dashed = (F.size(F.filter(parts, lambda x: x == "W")) == 1) & F.array_contains(parts, "P") & F.array_contains(parts, "—") & ~F.array_contains(parts, "9")
    numbered = (F.size(parts) == 2) & F.array_contains(parts, "9") & F.exists(parts, lambda x: F.lower(x).isin("=page", "=pg", "=p"))
    repeated_own = (
        shaped.select("_pub", "page", F.explode(F.array_distinct(F.array("shape", "own"))).alias("shape"))
        .groupBy("_pub", "shape").agg(F.count("*").alias("n"), F.countDistinct("page").alias("pages")).join(in_own, "_pub")
        .where((F.col("pages") >= PAGES) & (F.col("n") >= SHARE * F.col("edges")))
        .where(F.when(plain, dashed).otherwise(~numbered & (letters >= 4) & (F.size(parts) >= 2))).where(~F.col("shape").isin(shared))
        .groupBy("_pub").agg(F.sort_array(F.collect_list("shape")).alias("own"))
    )
    votes = shaped.where("ahead is not null").groupBy("_pub", "ahead").agg(F.count("*").alias("n"))
    best = votes.groupBy("_pub").agg(F.max(F.struct("n", "ahead")).alias("b")).where("b.n > 1").select("_pub", "b.ahead")
    publications = cut(best.join(repeated_own, "_pub", "full_outer").join(_counted_anew(shaped, best), "_pub", "left"))
    size = publications.agg(F.sum(F.coalesce(F.size("own"), F.lit(0)) + F.coalesce(F.size("turns"), F.lit(0)) + 1)).first()[0] or 0
    told = {r["_pub"]: (r.ahead, tuple(r.own or ()), _turns(r.turns)) for r in publications.collect()} if size <= sent else None
    return NoiseModel(tuple(shared), *misread_forms(counted.where(~F.col("w").contains("-"))), words, publications, told)


def _turns(turns: Sequence | None) -> Turns:
    return tuple((t["page"], t["ahead"]) for t in turns or ())


def _counted_anew(shaped: DataFrame, best: DataFrame) -> DataFrame:
    """Rows (_pub, turns) of the publications whose page numbers are not ahead by their usual number (_pub, ahead) on
    all pages: (page, ahead) from where on another number holds, null where none is known.

    A page with numbers, none of them the usual one, counts otherwise if its number is found again NEAR it, and the
    usual one not more than twice as often there; if no number is found twice there, none is known."""
    pages = shaped.where("ahead is not null").groupBy("_pub", "page", "ahead").agg(F.count("*").alias("n")).join(best.withColumnRenamed("ahead", "usual"), "_pub")
    around = Window.partitionBy("_pub").orderBy("page").rangeBetween(-NEAR, NEAR)
    near = F.sum("n").over(Window.partitionBy("_pub", "ahead").orderBy("page").rangeBetween(-NEAR, NEAR))
    as_usual = F.col("ahead") == F.col("usual")
    met = pages.withColumn("near", near).withColumn("usual_near", F.coalesce(F.sum(F.when(as_usual, F.col("n"))).over(around), F.lit(0)))
    met = met.withColumn("known_near", F.max("near").over(around) > 1)
    each = met.groupBy("_pub", "page", "usual").agg(
        F.max(F.when(as_usual, True)).alias("usually"), F.max(F.struct("near", "ahead")).alias("m"), F.max("usual_near").alias("usual_near"), F.max("known_near").alias("known")
    )
    none = F.lit(None).cast("bigint")
    other = (F.col("m.near") > 1) & (2 * F.col("m.near") >= F.col("usual_near"))
    told = F.when(F.col("usually").isNotNull(), F.col("usual")).when(other, F.col("m.ahead")).when(F.col("usual_near") > 0, F.col("usual")).otherwise(none)
    settled = each.where("usually is not null or m.near > 1 or not known").select("_pub", "page", "usual", told.alias("ahead"))
    before = Window.partitionBy("_pub").orderBy("page")
    # A page between two that are told goes with the nearer one.
    half = F.coalesce(F.floor((F.col("page") - F.lag("page").over(before)) / 2), F.lit(0))
    turned = settled.withColumns({"page": F.col("page") - half, "first": F.row_number().over(before) == 1, "was": F.lag("ahead").over(before)}).where(F.col("first") | ~F.col("was").eqNullSafe(F.col("ahead")))
    turns = turned.groupBy("_pub").agg(F.sort_array(F.collect_list(F.struct("page", "ahead"))).alias("turns"), F.max(~F.col("ahead").eqNullSafe(F.col("usual"))).alias("anew"))
    return turns.where("anew").select("_pub", "turns")


def misread_forms(counted: DataFrame) -> tuple[dict[str, str], tuple[str, ...]]:
    """Misread forms of frequent words, with the word of each, and the frequent words, most frequent first, from
    the counts (w, n) of all words.

    A form differs from its word by letters of like shape and is RARER times as rare. Whether it is the scanner's
    is learnt from the word: if the words that are one letter away from it and as rare differ mostly by letters
    of like shape, they are misread; a word that is also found with any other letter put in is misspelt by the
    printer, as names of streets and places are, and its forms are left alone. Words of SHORT letters or fewer are
    near to too many others to tell; of them those forms count as well whose letters longer words had taken for
    each other.
    """
    total = counted.agg(F.sum("n")).first()[0] or 0
    counted = counted.where(F.length("w") <= LONGEST_WORD)
    frequent = {r.w: r.n for r in counted.where(F.col("n") >= max(RARER, FREQUENT * total)).collect() if any(c.islower() for c in r.w)}
    if not frequent:
        return {}, ()
    spark = counted.sparkSession
    forms = [(v, w, n) for w, n in frequent.items() for v in confused(w) if v not in frequent or RARER * frequent[v] <= n]
    near = [(p, w, n) for w, n in frequent.items() for p in neighbours(w)]
    kind = "p string, w string, n bigint"
    # Both tables are made of at most 1 / FREQUENT words, one row for each place in them.
    found = counted.select(F.col("w").alias("p"), F.col("n").alias("m")).join(F.broadcast(spark.createDataFrame(forms, kind)), "p").where(F.col("m") * RARER <= F.col("n"))
    length = F.length("w")
    patterns = F.transform(F.sequence(F.lit(1), length), lambda k: F.concat(F.substr("w", F.lit(1), k - 1), F.lit("*"), F.substr("w", k + 1)))
    others = (
        counted.select(F.col("w").alias("v"), F.col("n").alias("m"), F.explode(patterns).alias("p")).join(F.broadcast(spark.createDataFrame(near, kind)), "p")
        .where((F.col("v") != F.col("w")) & (F.lower("v") != F.lower("w")) & (F.col("m") * RARER <= F.col("n"))).select("v", "w", "m").distinct()
    )
    alike = found.select(F.col("p").alias("v"), "w").distinct().withColumn("like", F.lit(True))
    # A word that is near to several counts for each in part.
    shares = others.groupBy("v").agg(F.count("*").alias("near"))
    odd = others.join(shares, "v").join(alike, ["v", "w"], "left").where("like is null").groupBy("w").agg(F.sum(F.col("m") / F.col("near")).alias("odd"))
    own = found.groupBy("w").agg(F.sum("m").alias("alike"), F.collect_list("p").alias("ps"))
    weighed = own.join(odd, "w", "left").select("w", "ps", (F.col("alike") > F.coalesce("odd", F.lit(0))).alias("taken")).collect()
    learnt = {_confusion(v, r.w) for r in weighed if r.taken and len(r.w) > SHORT for v in r.ps}
    out: dict[str, str] = {}
    for r in sorted(weighed, key=lambda r: (-frequent[r.w], r.w)):
        for v in r.ps:
            if r.taken or len(r.w) <= SHORT and _confusion(v, r.w) in learnt:
                out.setdefault(v, r.w)
    return out, tuple(sorted(frequent, key=lambda w: (-frequent[w], w)))


def judged(asked: DataFrame, words: DataFrame) -> DataFrame:
    """Those of the hyphens (lft, rgt, how) that break a word, each once, by how often the joined word, the word
    with its hyphen and the two parts stand in the corpus:

    end: nothing follows, and what stands before is no word. small: the joined word is known, and not rarer than
    that with the hyphen; or neither is, and the parts are not both words. capitals: the joined word is known, or
    the parts are not both words. inner, within a line: the joined word is known and not rarer. A part is a word if it
    stands alone more often than as this part of a known joined word, as the pieces of broken words are found alone
    at times in any large corpus.
    """
    once = asked.groupBy("lft", "rgt", "how").agg(F.count("*").alias("times"))
    roles = {"joined": F.concat("lft", "rgt"), "hyphened": F.concat("lft", F.lit("-"), "rgt"), "one": F.col("lft"), "low": F.lower("lft"), "two": F.col("rgt")}
    each = once.select("*", F.explode(F.array(*(F.struct(F.lit(r).alias("role"), w.alias("w")) for r, w in roles.items()))).alias("s"))
    met = each.select("lft", "rgt", "how", "times", "s.role", "s.w").join(words, "w", "left")
    n = met.groupBy("lft", "rgt", "how", "times").agg(*(F.max(F.when(F.col("role") == r, F.coalesce("n", F.lit(0)))).alias(r) for r in roles))
    sure = (F.col("rgt") != "") & (F.col("joined") > 0) & (F.col("joined") >= F.col("hyphened"))
    pieces = F.when(sure, F.col("times")).otherwise(0)
    n = n.withColumns({"lft_cut": F.sum(pieces).over(Window.partitionBy("lft")), "rgt_cut": F.sum(pieces).over(Window.partitionBy("rgt"))})
    one, low, two = F.col("one") > F.col("lft_cut"), F.col("low") > F.col("lft_cut"), F.col("two") > F.col("rgt_cut")
    breaks = (
        F.when(F.col("how") == END, ~one)
        .when(F.col("how") == INNER, (F.col("joined") > 0) & (F.col("joined") >= F.col("hyphened")))
        .when(F.col("how") == CAPITALS, (F.col("joined") > 0) | ~(one & two))
        .otherwise(F.when((F.col("joined") > 0) | (F.col("hyphened") > 0), F.col("joined") >= F.col("hyphened")).otherwise(~((one | low) & two)))
    )
    return n.where(breaks).select("lft", "rgt", "how")


_ASKED = pa.list_(pa.struct([("lft", pa.string()), ("rgt", pa.string()), ("how", pa.string())]))
_ASKED_SQL = "array<struct<lft:string,rgt:string,how:string>>"


def _told(b: pa.RecordBatch) -> tuple[list, list]:
    """What is known of the rows' publications, where it comes with them."""
    return tuple(b.column(c).to_pylist() if c in b.schema.names else [None] * b.num_rows for c in ("ahead", "own", "turns"))


def _records(breaks: Iterable[Sequence[Break]]) -> pa.Array:
    return pa.array([[dict(zip(("lft", "rgt", "how"), x)) for x in bs] for bs in breaks], _ASKED)


def _with_hyphens(found: DataFrame, words: DataFrame) -> DataFrame:
    """(key_id, kinds) of `found` (key_id, kinds, breaks), with the hyphens judged by the vocabulary. The hyphens
    met with the judgements are few beside the lines; these are sent to all tasks if they are few."""
    found = cut(found)
    asked = found.select("key_id", F.explode("breaks").alias("b")).select("key_id", "b.*")
    hit = attach(asked, judged(asked, words).withColumn("hit", F.lit(True)), ["lft", "rgt", "how"]).where("hit").select("key_id", F.lit(HYPHEN).alias("kinds"))
    return found.select("key_id", "kinds").where("kinds > 0").unionByName(hit).groupBy("key_id").agg(F.bit_or("kinds").alias("kinds"))


def line_noise(lines: DataFrame, model: NoiseModel) -> DataFrame:
    """Rows (key_id, kinds) of the lines with noise; kinds is a sum of HYPHEN, MISREAD, HEADER, PAGE_NUMBER.

    Lines are judged on their texts in one form, so that look-alike characters are no misreadings, page by
    page in reading order: one shuffle by (pub, page), in which repeated lines are passed over, lines that stand at
    the same place with the same text under several keys are read once for all of them, and a few lines are held, whatever the size of a page. Lines without a page are spread by column and hundreds of lines; they have
    no page edges, and a hyphen at the end of such a piece, or of a page, is judged by what stands before it.
    Null and empty texts and lines that could not be read have no noise.
    """
    shared = lines.sparkSession.sparkContext.broadcast((model.shapes, model.forms, model.frequent, model.told))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*shared.value)
        out: list[Line] = []

        def rows() -> Iterator[tuple]:
            for b in batches:
                columns = [b.column(c).to_pylist() for c in ("line_id", "_pub", "page", "piece", "col", "line_no")]
                yield from zip(*columns, *_told(b), normalise_array(b.column("text")).to_pylist())

        source = rows()
        row = next(source, None)

        def page(key: tuple) -> Iterator[Line]:
            nonlocal row
            last, x, place, again = None, None, None, []
            while row is not None and row[1:4] == key:
                if x and row[5] is not None and (row[4], row[5], row[-1]) == place:
                    if row[0] != last:
                        again.append(row[0])
                elif row[0] is None or row[0] != last:
                    if x:
                        yield x
                    again = []
                    x, place = Line(row[0], row[2], row[4], row[-1], again=again), (row[4], row[5], row[-1])
                last = row[0]
                row = next(source, None)
            if x:
                yield x

        while row is not None:
            reader.at(row[1], *row[6:9])
            for x in read_page(_with_edges(page(row[1:4])), reader):
                if x.mask or x.breaks:
                    out.append(x)
                    if len(out) >= 10_000:
                        yield _lines_out(out)
                        out = []
        yield _lines_out(out)

    piece = F.when(F.col("page").isNull(), F.concat_ws(" ", "col", F.floor(F.col("line_no") / 500)))
    told = model.attached(lines.select("line_id", F.coalesce("pub", F.lit("")).alias("_pub"), "page", piece.alias("piece"), "col", "line_no", "text"))
    ordered = told.repartition("_pub", "page", "piece").sortWithinPartitions("_pub", "page", "piece", "col", "line_no", "line_id")
    return _with_hyphens(ordered.mapInArrow(run, f"key_id bigint, kinds int, breaks {_ASKED_SQL}"), model.words)


def _lines_out(found: list[Line]) -> pa.RecordBatch:
    every = [(k, x) for x in found for k in (x.line_id, *x.again)]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in every], pa.int64()), pa.array([x.mask for _, x in every], pa.int32()), _records(x.breaks for _, x in every)], ["key_id", "kinds", "breaks"]
    )


def _latest(entries: DataFrame, model: NoiseModel) -> DataFrame:
    """The latest version of each entry, with what is known of its publication."""
    last = entries.groupBy("row_id").agg(F.max(F.struct("loaded_at", "full_text", "publication", "page_number")).alias("m"))
    plain = last.select("row_id", F.coalesce("m.publication", F.lit("")).alias("_pub"), F.col("m.page_number").alias("page"), F.col("m.full_text").alias("text"))
    return model.attached(plain)


def _entries_read(entries: DataFrame, model: NoiseModel) -> DataFrame:
    """Rows (key_id, kinds, breaks) of the entries' latest versions."""
    shared = entries.sparkSession.sparkContext.broadcast((model.shapes, model.forms, model.frequent, model.told))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*shared.value)
        for b in batches:
            masks, breaks = [], []
            for t, p, g, *told in zip(normalise_array(b.column("text")).to_pylist(), *(b.column(c).to_pylist() for c in ("_pub", "page")), *_told(b)):
                reader.asked = []
                reader.at(p, *told)
                masks.append(reader.entry(t, g))
                breaks.append(tuple(reader.asked))
            yield pa.RecordBatch.from_arrays([b.column("row_id"), pa.array(masks, pa.int32()), _records(breaks)], ["key_id", "kinds", "breaks"])

    read = _latest(entries, model).mapInArrow(run, f"key_id bigint, kinds int, breaks {_ASKED_SQL}")
    return read.where((F.col("kinds") > 0) | (F.size("breaks") > 0))


def entry_noise(entries: DataFrame, model: NoiseModel) -> DataFrame:
    """Rows (key_id, kinds) of the entries with noise (row_id, publication, page_number, full_text,
    loaded_at); of several versions the latest counts."""
    return _with_hyphens(_entries_read(entries, model), model.words)


def mended(entries: DataFrame, model: NoiseModel) -> DataFrame:
    """Rows (row_id, clean): the latest version of every entry as continuous readable text; null where there is
    none. The hyphens of each entry are judged first, and go with it."""
    shared = entries.sparkSession.sparkContext.broadcast((model.shapes, model.forms, model.frequent, model.told))
    asked = cut(_entries_read(entries, model).select("key_id", F.explode("breaks").alias("b")).select("key_id", "b.*"))
    breaks = attach(asked, judged(asked, model.words).withColumn("hit", F.lit(True)), ["lft", "rgt", "how"]).where("hit")
    per_entry = breaks.groupBy(F.col("key_id").alias("row_id")).agg(F.collect_set(F.struct("lft", "rgt", "how")).alias("breaks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*shared.value)
        for b in batches:
            clean = []
            for t, p, g, bs, *told in zip(normalise_array(b.column("text")).to_pylist(), *(b.column(c).to_pylist() for c in ("_pub", "page", "breaks")), *_told(b)):
                reader.asked = []
                reader.judged = {(x["lft"], x["rgt"], x["how"]): True for x in bs or ()}
                reader.at(p, *told)
                clean.append(reader.mend(t, g))
            yield pa.RecordBatch.from_arrays([b.column("row_id"), pa.array(clean, pa.string())], ["row_id", "clean"])

    return _latest(entries, model).join(per_entry, "row_id", "left").mapInArrow(run, "row_id bigint, clean string")


def noise_kinds(found: DataFrame) -> DataFrame:
    """(key_id, kind), one row for each kind of noise."""
    each = F.array(*(F.when(F.col("kinds").bitwiseAND(bit) > 0, F.lit(name)) for bit, name in KINDS.items()))
    return found.select("key_id", F.explode(F.array_compact(each)).alias("kind")).distinct()
