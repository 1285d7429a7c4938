"""Text cut off by field limits: a backward character n-gram model of how texts end, and length spikes."""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.arrow_text import code_points
from quirework.runtime import attach, cut

#: Characters of the contexts looked at backwards from a place in the text.
ORDERS = (2, 5, 10, 16, 24)
DEEP = max(ORDERS)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
#: Pseudo-count by which the rate at one order leans on that at the next shorter one.
LEAN = 25.0
#: Every text is also cut at random to learn how the endings of cut texts are rated, on which the thresholds are
#: fitted. Each language has so many texts of all languages added.
POOLED = 200.0
#: A capitalised word is kept as it is if it makes up this share of such words of its language, else it is coded N;
#: so at most 1 / KEEP words of a language are kept.
KEEP = 5e-5
#: A word that is followed by another capitalised word or an initial in more than this share of its places is
#: taken for part of a name, and is not kept.
NAME_SHARE = 0.7
#: Languages with a smaller share of the texts are taken together, so that there are at most 1 / OWN_LANG others.
OWN_LANG = 1e-3
#: Bits of the filter of contexts that end a text, for each of them, and at most; if there are more contexts, the
#: texts are read several times, each time for a range of them.
BITS_EACH, MOST_BITS = 16, 1 << 28
#: Contexts that are sent to all tasks, at most; more are joined to the texts' final contexts.
SENT = 4_000_000
#: Characters that are coded and hashed at once, so that the arrays stay in the processor's cache.
AT_ONCE = 60_000
#: Lengths above and below a length that it is compared with, beginning so far from it, as texts cut at a limit
#: may end somewhat below.
AROUND, SLACK = 40, 30
#: An ending so much likelier at the end of a whole text shows that a text at a limit is whole all the same.
WHOLE = 5.0
#: Bins of the log of the ratio, for each unit.
BINS = 20

BLANK = " \t\r\n\f\v\xa0…"
#: A line that ends in one of these ends a paragraph; others are wrapped.
STOPS = '.?!"”)…:'
PAD, CAPITALS = 2, 3
_UP, _LETTER, _DIGIT, _WORD, _BLANK, _STOP = 1, 2, 4, 8, 16, 32


@functools.cache
def _classes() -> np.ndarray:
    """Class bits of each code point."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for cp in range(0x30000):
        c = chr(cp)
        if c.isalpha():
            out[cp] = _LETTER | _WORD | (_UP if not ("a" <= c <= "z" or "à" <= c <= "ÿ" and c != "÷") else 0)
        elif c.isdecimal():
            out[cp] = _DIGIT | _WORD
        elif c.isalnum() or c == "_":
            out[cp] = _WORD
    for c in BLANK:
        out[ord(c)] |= _BLANK
    for c in STOPS:
        out[ord(c)] |= _STOP
    return out


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(18, (size - 1).bit_length()))


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h += np.uint64(salt)
    h ^= h >> np.uint64(32)
    return h


def word_hash(word: str) -> int:
    """The number by which a kept word is known."""
    h = sum((ord(c) + 1) * pow(BASE, k, 2**64) for k, c in enumerate(word)) % 2**64
    return int(_mixed(np.array([h], np.uint64), 0)[0])


@dataclass(frozen=True)
class Coded:
    """Coded texts in one array, each behind DEEP signs of padding, the place where each ends, and their sizes."""

    codes: np.ndarray
    ends: np.ndarray
    sizes: np.ndarray


def coded(cps: np.ndarray, offsets: np.ndarray, langs: np.ndarray, keep: Mapping[int, np.ndarray]) -> tuple[Coded, Coded]:
    """Texts, given as code points, as the model sees them, coarse and fine: capitalised words as N (in the coarse
    form those all in capitals as one other sign), in the fine form but for those that their language keeps;
    initials as I, numbers as 9, wrapped lines joined, paragraphs set off by one line end, and without blanks and
    dots of omission at the end, which a cut may have left. `keep` has hashes of words for each of `langs`."""
    n, rows = len(cps), len(offsets) - 1
    kind = _classes()[cps] if n else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(rows, dtype=np.int32), sizes)
    at = np.arange(n, dtype=np.int32)
    is_ = lambda bit: (kind & bit) > 0

    def last_of(mask: np.ndarray) -> np.ndarray:
        """The last place of each row where the mask is set; -1 if there is none."""
        seen = np.maximum.accumulate(np.concatenate([[-1], np.where(mask, at, -1)]))[offsets[1:]]
        return np.where(seen >= offsets[:-1], seen, -1)

    solid = ~is_(_BLANK)
    last = last_of(solid)
    dot = np.concatenate([cps == ord("."), np.zeros(3, bool)])
    omitted = np.flatnonzero((last - offsets[:-1] >= 2) & dot[last] & dot[last - 1] & dot[last - 2])
    if len(omitted):
        end = np.full(rows, n)
        end[omitted] = last[omitted] - 2
        last = last_of(solid & (at < end[row]))
    valid = at <= last[row]
    first = np.zeros(n, bool)
    first[offsets[:-1][sizes > 0]] = True

    def before(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(n, bool)
        out[1:] = mask[:-1]
        return out & ~first

    def behind(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(n, bool)
        out[:-1] = (mask & ~first)[1:]
        return out

    codes = cps.astype(np.uint32)
    line = valid & (cps == 10)
    stays = valid & ~(line & behind(line))
    codes[line & ~behind(line) & ~before(line | is_(_STOP))] = 32
    digit = valid & is_(_DIGIT)
    codes[digit] = ord("9")
    stays &= ~(digit & before(digit))
    letter, word, up = valid & is_(_LETTER), valid & is_(_WORD), valid & is_(_UP)
    starts, stops = np.flatnonzero(letter & ~before(letter)), np.flatnonzero(letter & ~behind(letter)) + 1
    coarse, fine = codes, codes.copy()
    coarse_stays, fine_stays = stays, stays.copy()
    if len(starts):
        # The first capital of each run of letters.
        ups = np.flatnonzero(up)
        k = np.searchsorted(ups, starts)
        lead = np.where(k < len(ups), ups[np.minimum(k, max(0, len(ups) - 1))] if len(ups) else n, n)
        named = lead < stops - 1
        alone = ~before(word)[starts] & ~behind(word)[stops - 1]
        initial = alone & (stops - starts == 1) & (lead == starts)
        # A single capital at the very end may be the beginning of a name that was cut.
        final = stops - 1 == last[row[starts]]
        codes[starts[initial]] = fine[starts[initial]] = np.where(final[initial], ord("N"), ord("I"))
        n_up = np.concatenate([[0], np.cumsum(up)])
        capitals = alone & (stops - starts >= 2) & (n_up[stops] - n_up[starts] == stops - starts)
        lead, ends = lead[named], stops[named]
        p, inverse = _power_tables(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * p[:n], dtype=np.uint64)])
        h = (sums[ends] - sums[lead]) * inverse[lead]
        h = _mixed(h, 0)
        own = langs[row[lead]]
        kept = np.zeros(len(lead), bool)
        for g in np.unique(own):
            if g in keep:
                of = own == g
                kept[of] = np.isin(h[of], keep[g])
        for signs, left, which in ((coarse, coarse_stays, np.ones(len(lead), bool)), (fine, fine_stays, ~kept)):
            signs[lead[which]] = ord("N")
            change = np.zeros(n + 1, np.int32)
            np.add.at(change, lead[which] + 1, 1)
            np.add.at(change, ends[which], -1)
            left &= np.cumsum(change)[:-1] == 0
        coarse[starts[capitals]] = CAPITALS
    return _padded(coarse, coarse_stays, row, rows), _padded(fine, fine_stays, row, rows)


def _padded(codes: np.ndarray, stays: np.ndarray, row: np.ndarray, rows: int) -> Coded:
    where = row[stays]
    sizes = np.bincount(where, minlength=rows)
    out = np.full(int(sizes.sum()) + DEEP * rows, PAD, np.uint32)
    out[np.arange(len(where)) + DEEP * (where + 1)] = codes[stays]
    return Coded(out, np.cumsum(sizes + DEEP) - 1, sizes)


class Hashes:
    """The hashes of the contexts that end at places of coded texts, by sums of powers: the same context has the
    same hash wherever it stands."""

    def __init__(self, texts: Coded, form: int):
        self.form = form
        p, self.inverse = _power_tables(len(texts.codes) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((texts.codes.astype(np.uint64) + np.uint64(1)) * p[: len(texts.codes)], dtype=np.uint64)])

    def at(self, places: np.ndarray, order: int) -> np.ndarray:
        h = (self.sums[places + 1] - self.sums[places + 1 - order]) * self.inverse[places + 1 - order]
        return _mixed(h, 64 * self.form + order)


def _languages(b: pa.RecordBatch, langs: Mapping[str, int]) -> np.ndarray:
    return np.array([langs.get(g or "", 0) for g in b.column("lang").to_pylist()], np.int64)


def _pieces(b: pa.RecordBatch, langs: Mapping[str, int], keep: Mapping[int, np.ndarray]) -> Iterator[tuple[np.ndarray, tuple[Coded, Coded]]]:
    """The rows of a batch, some at a time: their languages, and their coded texts."""
    cps, offsets = code_points(b.column("text"))
    own = _languages(b, langs)
    a = 0
    while a < b.num_rows:
        z = max(a + 1, int(np.searchsorted(offsets, offsets[a] + AT_ONCE, "right")) - 1)
        z = min(z, b.num_rows)
        yield own[a:z], coded(cps[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a], own[a:z], keep)
        a = z


def final_chains(cps: np.ndarray, starts: np.ndarray, stops: np.ndarray, own: np.ndarray, keep: Mapping[int, np.ndarray]) -> np.ndarray:
    """For each text, from its start to its stop among the code points, the hashes of its final contexts, shorter
    ones first, the coarse form before the fine one. Coding is local, so only the ends are coded, and more of those
    that shrink too much."""
    out = np.zeros((len(starts), 2 * len(ORDERS)), np.uint64)
    rows, size = np.arange(len(starts)), 128
    while len(rows):
        begin = np.maximum(starts[rows], stops[rows] - size)
        sizes = stops[rows] - begin
        ends = np.concatenate([[0], np.cumsum(sizes)])
        part = cps[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], sizes)] if ends[-1] else cps[:0]
        forms = coded(part, ends, own[rows], keep)
        out[rows] = np.stack([Hashes(c, form).at(c.ends, order) for order in ORDERS for form, c in enumerate(forms)], 1)
        short = (np.minimum(forms[0].sizes, forms[1].sizes) < DEEP + 24) & (begin > starts[rows])
        rows, size = rows[short], size * 8
    return out


@dataclass(frozen=True)
class Model:
    """What was learnt: the languages told apart and the words each keeps, how many places and whole texts each has, and how often each
    context stands (n) and ends a text (ends), as a table and, if they are few, as arrays; and the endings of the
    texts that it was learnt from."""

    langs: Mapping[str, int]
    keep: Mapping[int, np.ndarray]
    places: np.ndarray
    texts: np.ndarray
    contexts: DataFrame
    arrays: tuple[np.ndarray, np.ndarray, np.ndarray] | None
    endings: DataFrame

    @property
    def mean(self) -> float:
        """Texts for each place."""
        return float(self.texts.sum()) / max(1.0, float(self.places.sum()))

    @property
    def base(self) -> np.ndarray:
        """Places for each text, of each language."""
        return self.places / np.maximum(1, self.texts)



def _endings(plain: DataFrame) -> DataFrame:
    """Rows of `plain` without their texts (key, lang, grp, grp_null, chars, h1, h2; odds of the text's length, null
    if it is no spike; copy, whether an equal text of the language with a smaller key stands for it). One row of
    numbers for each text is written; of texts no more is kept. Texts are told apart by 128 bits."""
    facts = cut(plain.select("key", "lang", "grp", "grp_null", F.length("text").alias("chars"), *(F.xxhash64(F.lit(k), "text").alias(f"h{k}") for k in (1, 2))))
    some = facts.where("chars > 0")
    groups = some.groupBy("h1", "h2", "lang").agg(F.min("key").alias("first"), F.count_distinct("key").alias("n")).where("n > 1")
    copies = some.join(groups, ["h1", "h2", "lang"]).where("key <> first").select("key").distinct().withColumn("copy", F.lit(True))
    return attach(attach(facts, _spikes(some.select("grp", "chars", F.col("h1").alias("h"))), ["grp", "chars"]), copies, ["key"])


def _filter(ended: DataFrame, bits: int) -> np.ndarray:
    """The packed bits of the contexts, by the highest bits of their hashes. Blocks of bits are put together in
    the tasks, so that the driver gets one bit for each, whatever the number of contexts."""
    size = min(bits, 1 << 15)
    shift = 64 - (bits.bit_length() - 1)
    places = ended.select(F.shiftrightunsigned("h", shift).alias("b")).distinct()
    blocks = places.groupBy(F.floor(F.col("b") / size).cast("bigint").alias("block")).agg(F.collect_list((F.col("b") % size).cast("int")).alias("bits"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k in range(b.num_rows):
                mask = np.zeros(size, bool)
                mask[b.column("bits")[k].values.to_numpy()] = True
                out.append(np.packbits(mask).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("block"), pa.array(out, pa.binary())], ["block", "packed"])

    whole = np.zeros(bits // 8, np.uint8)
    for r in blocks.mapInArrow(packed, "block bigint, packed binary").toLocalIterator():
        whole[r.block * size // 8 : (r.block + 1) * size // 8] = np.frombuffer(bytes(r.packed), np.uint8)
    return whole


def _counts(values: list[np.ndarray], weights: list[np.ndarray], per_lang: np.ndarray, names: tuple[str, str]) -> pa.RecordBatch:
    """Rows (h, count, lang): sums for each hash, and for each language under its number."""
    each = np.concatenate([*values, np.zeros(0, np.uint64)])
    unique, at = np.unique(each, return_inverse=True)
    n = np.bincount(at, np.concatenate([*weights, np.zeros(0)]), len(unique)).astype(np.int64)
    langs = np.flatnonzero(per_lang)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([unique.view(np.int64), np.zeros(len(langs), np.int64)])), pa.array(np.concatenate([n, per_lang[langs].astype(np.int64)])),
            pa.array(np.concatenate([np.full(len(unique), -1), langs]).astype(np.int32)),
        ],
        ["h", names[0], names[1]],
    )


def train(
    documents: DataFrame, text: str = "text", lang: str = "lang", group: str = "source", key: str = "doc_id", most_bits: int = MOST_BITS, sent: int = SENT,
) -> Model:
    """The model of the distinct texts of all `documents` (`key` is to be unique; of rows that repeat one
    with its text the ending counts once), over every place of every whole text. The ends counted are those of texts whose length is no
    spike, as there most ends are cuts.

    What reaches the driver is bounded by the parameters above, not by the data: kept words (1 / KEEP of a
    language), one bit for each place of the filter, counts of each language, and the contexts only if they are
    at most `sent`. No context is left out, however rare. Texts are read where they stand, and never shuffled:
    keys, hashes and the hashes of final contexts are.
    """
    spark = documents.sparkSession
    plain = documents.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("grp"), F.col(group).isNull().alias("grp_null")
    )
    facts = cut(_endings(plain))
    per_lang = facts.where("chars > 0").groupBy("lang").agg(F.count("*").alias("n"))
    counted = {r.lang: r.n for r in cut(per_lang.where(F.col("n") >= OWN_LANG * (per_lang.agg(F.sum("n")).first()[0] or 0))).collect()}
    langs = {g: k for k, g in enumerate(sorted(counted), 1)}
    n_langs = len(langs) + 1
    known = F.when(F.col("lang").isin([*langs]), F.col("lang")).otherwise(F.lit(None)) if langs else F.lit(None).cast("string")
    left_out = facts.where("copy").select("key", "copy").distinct()
    once = attach(plain.where(F.length("text") > 0), left_out, ["key"]).where("copy is null").select("text", "lang")
    capitals = once.select(known.alias("g"), F.explode(F.regexp_extract_all("text", F.lit(r"\b\p{Lu}\p{L}+(?= ?\p{Lu}?)[ ]?\p{Lu}?"), F.lit(0))).alias("w"))
    counts = cut(
        capitals.select("g", F.regexp_extract("w", r"^\p{Lu}\p{L}+", 0).alias("word"), F.col("w").rlike(r" \p{Lu}$").alias("led"))
        .groupBy("g", "word").agg(F.count("*").alias("n"), F.count_if("led").alias("led"))
    )
    totals = {r.g: r.n for r in counts.groupBy("g").agg(F.sum("n").alias("n")).collect()}
    share = F.lit(None).cast("double")
    for g, n in totals.items():
        share = F.when(F.col("g").eqNullSafe(F.lit(g)), F.lit(max(2.0, KEEP * n))).otherwise(share)
    words: dict[int, list[int]] = {}
    for r in counts.where((F.col("n") >= share) & (F.col("led") <= NAME_SHARE * F.col("n"))).select("g", "word").collect():
        words.setdefault(langs.get(r.g, 0), []).append(word_hash(r.word))
    keep = {g: np.array(sorted(hs), np.uint64) for g, hs in words.items()}
    coding = spark.sparkContext.broadcast((langs, keep))

    def finals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cps, offsets = code_points(b.column("text"))
            own = _languages(b, coding.value[0])
            place = b.column("place").to_numpy(zero_copy_only=False)
            made = np.flatnonzero(place > 0)
            chains = final_chains(cps, np.concatenate([offsets[:-1], offsets[made]]), np.concatenate([offsets[1:], offsets[made] + place[made]]), np.concatenate([own, own[made]]), coding.value[1])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(chains.view(np.int64).ravel()), chains.shape[1]).cast(pa.list_(pa.int64()))
            which = np.concatenate([np.arange(b.num_rows), made])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(pa.array(which)) for c in ("key", "text_h")), pa.array(np.arange(len(which)) >= b.num_rows), pa.array(np.concatenate([own, own[made]]).astype(np.int32)), lists],
                ["key", "h1", "made", "lang_no", "chain"],
            )

    # Every text is cut at a place that follows from its hash, to see how endings of cut texts are rated.
    place = F.when(F.length("text") > 1, F.pmod(F.xxhash64("text", F.lit(2)), F.length("text") - 1) + 1).otherwise(0).cast("int")
    read = plain.where(F.length("text") > 0).select("key", "text", "lang", F.xxhash64(F.lit(1), "text").alias("text_h"), place.alias("place"))
    kind = plain.schema["key"].dataType.simpleString()
    chains = cut(read.mapInArrow(finals, f"key {kind}, h1 bigint, made boolean, lang_no int, chain array<bigint>"))
    told = facts.select("key", "h1", "lang", "grp", "grp_null", "chars", "odds", "copy").distinct()
    once_each = chains.groupBy(F.col("key").alias("k_"), F.col("h1").alias("h_"), "made").agg(F.first("lang_no").alias("lang_no"), F.first("chain").alias("chain"))
    met = told.join(once_each, told["key"].eqNullSafe(once_each["k_"]) & (told["h1"] == once_each["h_"]), "left").drop("k_", "h_")
    endings = cut(met.where("made is null or not made or odds is null"))
    counts_once = endings.where("made = false and copy is null")
    whole = F.col("odds").isNull().cast("bigint")
    ended = cut(
        counts_once.select("lang_no", whole.alias("whole"), F.explode("chain").alias("h")).groupBy("h").agg(F.sum("whole").alias("ends"))
    )
    texts = np.zeros(n_langs)
    for r in counts_once.groupBy("lang_no").agg(F.sum(whole).alias("n")).collect():
        texts[r.lang_no] = r.n
    told = once
    n_ended = ended.count()
    bits = 1 << max(15, (n_ended * BITS_EACH - 1).bit_length() if n_ended else 0)
    rounds = max(1, bits // most_bits)
    bits = min(bits, most_bits)
    stood, places = None, np.zeros(n_langs)
    for k in range(rounds):
        part = ended.where(F.pmod("h", F.lit(rounds)) == k) if rounds > 1 else ended
        found = cut(_standing(told, part, bits, rounds == 1, n_langs, coding).groupBy("h", "lang").agg(F.sum("n").alias("n")))
        if not k:
            for r in found.where("lang >= 0").collect():
                places[r.lang] = r.n
        met = part.join(found.where("lang < 0").select("h", "n"), "h")
        stood = met if stood is None else stood.unionByName(met)
    contexts = cut(stood.select("h", "n", "ends"))
    arrays = None
    if contexts.count() <= sent:
        table = contexts.toPandas()
        h = table["h"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(h)
        arrays = h[order], table["n"].to_numpy()[order].astype(float), table["ends"].to_numpy()[order].astype(float)
    return Model(langs, keep, places, texts, contexts, arrays, endings)


def _standing(texts: DataFrame, ended: DataFrame, bits: int, nested: bool, n_langs: int, coding) -> DataFrame:
    """How often the contexts that the filter of `ended` passes stand in the texts, and how many places each
    language has. If all contexts are in the filter (`nested`), longer ones are looked for only where the shorter
    ones passed, as a context that ends a text ends in one that does."""
    packed = texts.sparkSession.sparkContext.broadcast(_filter(ended, bits))
    shift = np.uint64(64 - (bits.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = packed.value
        for b in batches:
            hs, ns, places = [], [], np.zeros(n_langs)
            for own, forms in _pieces(b, *coding.value):
                places += np.bincount(own, forms[0].sizes, n_langs)
                for form, c in enumerate(forms):
                    made = Hashes(c, form)
                    where = every = np.flatnonzero(c.codes != PAD)
                    for order in ORDERS:
                        h = made.at(where, order)
                        bit = h >> shift
                        passed = (known[(bit >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1 > 0
                        values, n = np.unique(h[passed], return_counts=True)
                        hs.append(values)
                        ns.append(n)
                        where = where[passed] if nested else every
            yield _counts(hs, ns, places, ("n", "lang"))

    return texts.select("text", "lang").mapInArrow(count, "h bigint, n bigint, lang int")


def length_odds(documents: DataFrame, text: str = "text", group: str = "source") -> DataFrame:
    """Rows (grp, chars, odds): the odds that a text of this length was cut at a limit of its source, from
    the number of distinct texts of the length against the mean number of lengths around it. Only lengths
    that are clear spikes have a row."""
    some = documents.where(F.length(text) > 0)
    return _spikes(some.select(F.coalesce(group, F.lit("")).alias("grp"), F.length(text).alias("chars"), F.xxhash64(text).alias("h")))


def _spikes(texts: DataFrame) -> DataFrame:
    n = texts.distinct().groupBy("grp", "chars").agg(F.count("*").alias("n"))
    by = Window.partitionBy("grp").orderBy("chars")
    above = F.coalesce(F.sum("n").over(by.rangeBetween(SLACK, SLACK + AROUND)), F.lit(0)) / (AROUND + 1)
    below = F.coalesce(F.sum("n").over(by.rangeBetween(-SLACK - AROUND, -SLACK)), F.lit(0)) / (AROUND + 1)
    return (
        n.withColumn("base", F.greatest(above, below))
        .where((F.col("n") >= 4) & (F.col("n") >= 4 * F.col("base")))
        .select("grp", "chars", ((F.col("n") - F.col("base")) / (F.col("base") + 0.5)).alias("odds"))
    )


def _met(arrays: tuple[np.ndarray, np.ndarray, np.ndarray], chains: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each context of the chains how often it ends a text and how often it stands, the text's own left out."""
    hashes, n, ends = arrays
    for want in chains:
        at = np.minimum(np.searchsorted(hashes, want), max(0, len(hashes) - 1))
        known = hashes[at] == want if len(hashes) else np.zeros(len(want), bool)
        m = np.where(known, n[at] - 1, 0) if len(hashes) else np.zeros(len(want))
        e = np.where(known, ends[at] - own, 0) if len(hashes) else np.zeros(len(want))
        yield np.maximum(e, 0), np.maximum(m, 0)


def rate_texts(model: Model) -> DataFrame:
    """Rows (key, lang, grp, grp_null, chars, odds, h1, made, ratio) of all texts that the model was learnt from and,
    with `made`, of the same texts cut at random: how much likelier the final context is at the end of a whole text than at
    a random place where a text of its language might be cut; null for null and empty texts."""
    told = model.endings
    spark = told.sparkSession
    base, mean = model.base, model.mean
    rest = ["key", "lang", "grp", "grp_null", "chars", "odds", "h1", "made"]
    told = told.select(*rest[:-1], F.coalesce("made", F.lit(False)).alias("made"), "lang_no", "chain")
    if model.arrays is not None:
        counts = spark.sparkContext.broadcast(model.arrays)
        schema = told.select(*rest, F.lit(0.0).alias("ratio")).schema
        for f in schema.fields:
            f.nullable = True

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lists = b.column("chain")
                some = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
                flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(some), 2 * len(ORDERS))
                own_end = pa.compute.and_(b.column("odds").is_null(), pa.compute.invert(b.column("made"))).to_numpy(zero_copy_only=False).astype(float)
                rate = np.full(len(some), mean)
                for e, n in _met(counts.value, flat.T, own_end[some]):
                    rate = (e + LEAN * rate) / (n + LEAN)
                ratio = np.full(b.num_rows, np.nan)
                ratio[some] = rate * base[b.column("lang_no").fill_null(0).to_numpy(zero_copy_only=False)[some]]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(ratio, from_pandas=True)], [*rest, "ratio"])

        return cut(told.mapInArrow(run, schema))
    bases = F.element_at(F.array(*map(F.lit, base.tolist())), F.col("lang_no") + 1)
    read = told.withColumn("base", F.when(F.col("chain").isNotNull(), bases))
    # The contexts are too many to be sent: the final ones are joined to them, those of which there are most, at
    # most a thousand of each kind, apart.
    read = cut(read.withColumn("uid", F.monotonically_increasing_id()))
    wanted = cut(read.select("uid", (F.col("odds").isNull() & ~F.col("made")).cast("int").alias("own"), F.posexplode("chain").alias("pos", "h")))
    often = F.broadcast(model.contexts.where(F.col("n") >= 1e-3 * float(model.places.sum())))
    common = wanted.join(often, "h")
    others = wanted.join(often, "h", "left_anti").join(model.contexts, "h", "left")
    step = F.struct("pos", F.greatest(F.coalesce("n", F.lit(1)) - 1, F.lit(0)).cast("double").alias("n"), F.greatest(F.coalesce(F.col("ends") - F.col("own"), F.lit(0)), F.lit(0)).cast("double").alias("e"))
    met = common.select("uid", step.alias("s")).unionByName(others.select("uid", step.alias("s")))
    folded = met.groupBy("uid").agg(F.array_sort(F.collect_list("s")).alias("ss")).select(
        "uid", F.aggregate("ss", F.lit(mean), lambda r, s: (s["e"] + LEAN * r) / (s["n"] + LEAN)).alias("rate")
    )
    return cut(read.join(folded, "uid", "left").select(*rest, F.when(F.col("chain").isNotNull(), F.col("rate") * F.col("base")).alias("ratio")))


def fitted(real: Mapping[int, float], simulated: Mapping[int, float]) -> tuple[float, float]:
    """The share of cut texts and the bin of the log of the ratio below which a text is taken for cut, from the
    number of texts, and of texts cut at random, in each bin. How many are cut follows from those below the
    median of the simulated ones, where there are hardly any others; the threshold is that with the best balance
    of found ones among the cut and of cut ones among the found (F1)."""
    n, made = sum(real.values()), sum(simulated.values())
    if not n or not made:
        return 0.0, float("-inf")
    bins = np.arange(min(min(real), min(simulated)), max(max(real), max(simulated)) + 1)
    found = np.cumsum([real.get(b, 0) for b in bins.tolist()])
    recall = np.cumsum([simulated.get(b, 0) for b in bins.tolist()]) / made
    half = int(np.argmax(recall >= 0.5))
    cut_texts = min(found[half] / recall[half], 0.5 * n)
    best = int(np.argmax(2 * cut_texts * recall / (found + cut_texts))) if cut_texts else 0
    return float(cut_texts / n), float(bins[best] + 1) if cut_texts else float("-inf")


def thresholds(rated: DataFrame, model: Model, column: str) -> DataFrame:
    """Rows (lang, column_name, n_docs, cut_share, log_ratio): for each language told apart (the others under the
    empty name) the share of its texts that are cut at a length that is no spike, and the threshold: a text is
    cut if the log of its ratio is below log_ratio."""
    bins: dict[bool, dict[str, dict[int, float]]] = {False: {}, True: {}}
    where = F.col("odds").isNull() & F.col("ratio").isNotNull()
    for r in rated.where(where).groupBy("made", _told_apart(model).alias("g"), F.floor(F.log("ratio") * BINS).cast("int").alias("b")).agg(F.count("*").alias("n")).collect():
        bins[r.made].setdefault(r.g, {})[r.b] = float(r.n)
    rows = []
    for g in sorted({*model.langs, ""}):
        own: list[dict[int, float]] = []
        for made in (False, True):
            all_n = sum(sum(x.values()) for x in bins[made].values())
            mixed = dict(bins[made].get(g, {}))
            for x in bins[made].values():
                for b, n in x.items():
                    mixed[b] = mixed.get(b, 0.0) + n * POOLED / all_n
            own.append(mixed)
        share, at = fitted(*own)
        rows.append((g, column, int(sum(bins[False].get(g, {}).values())), share, at / BINS))
    return rated.sparkSession.createDataFrame(rows, "lang string, column_name string, n_docs bigint, cut_share double, log_ratio double")


def _told_apart(model: Model) -> Column:
    return F.when(F.col("lang").isin([*model.langs]), F.col("lang")).otherwise(F.lit("")) if model.langs else F.lit("")


def scored(model: Model, key: str = "doc_id", text: str = "text", group: str = "source") -> DataFrame:
    """Rows (key, group, odds, cut, ratio, chars) of all documents that the model was learnt from: the odds that the text was cut, from the
    odds of its length and the ratio of its ending, and whether they exceed one.

    The odds of a length that is a spike are those of texts with and without a whole ending among its
    distinct texts; those of any other length are such that the log-odds exceed zero where the log of the ratio
    is below the threshold of the language and column. Null and empty texts have null odds and are not
    cut. Repeated rows of a key with the same text give one.
    """
    every = rate_texts(model)
    rated = every.where("not made")
    once = rated.where("odds is not null and ratio is not null").select("grp", "chars", "h1", (F.col("ratio") >= WHOLE).alias("whole")).distinct()
    limits = once.groupBy("grp", "chars").agg(((F.count_if(~F.col("whole")) + 0.5) / (F.count_if("whole") + 0.5)).alias("limit_odds"))
    known = thresholds(every, model, text).select(F.col("lang").alias("g"), "log_ratio")
    met = attach(attach(rated.withColumn("g", _told_apart(model)), limits, ["grp", "chars"]), known, ["g"])
    usual = F.exp("log_ratio")
    odds = F.when(F.col("odds").isNotNull(), F.coalesce("limit_odds", usual)).otherwise(usual) / F.col("ratio")
    return met.select(
        F.col("key").alias(key), F.when(~F.col("grp_null"), F.col("grp")).alias(group), odds.alias("odds"), F.coalesce(odds > 1.0, F.lit(False)).alias("cut"), "ratio", "chars"
    )
