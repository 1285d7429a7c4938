import random

import numpy as np
import pyarrow as pa

from quirework.llm.arrow_text import code_points
from quirework.llm.truncation import ORDERS, Hashes, _pieces, coded, final_chains, fitted, rate_texts, scored, train, word_hash

SENTENCES = ["The mayor of {n} thanked {p} for work against {d}.", "No physician has settled in {n} since {p} died in {y}.", "A letter from {n} reports {y} cases of {d} since May.", "{p} read a paper on {d}, and {p} opened the discussion."]


def _text(rng):
    name = lambda: rng.choice(["Bal", "Dun", "Ing", "Tol", "Wick"]) + rng.choice(["er", "o", "ing", ""]) + rng.choice(["ford", "by", "wick", "ham"])
    one = lambda: rng.choice(SENTENCES).format(n=name(), p=f"{rng.choice(['Ida', 'Hugh', 'Oscar'])} {name()}", d=rng.choice(["croup", "ague", "quinsy"]), y=rng.randrange(1850, 1918))
    t = " ".join(one() for _ in range(rng.randrange(4, 16)))
    return t + rng.choice(["", "", "", "\nHenry Bader, Clerk"])


def test_cut_texts_are_found(spark):
    rng = random.Random(11)
    rows, cut = [], set()
    for k in range(1500):
        t = _text(rng)
        source = rng.choice(["free", "limited"])
        if k % 10 == 0:
            t = t[: rng.randrange(len(t) // 3, len(t) - 8)].rstrip() + rng.choice(["", "…"])
            cut.add(k)
        elif source == "limited" and len(t) > 500:
            t = t[:500]
            cut.add(k)
        rows.append((k, t, "en", source, "x"))
    rows += [(2000, None, "en", "free", "x"), (2001, "", "en", "free", "x"), (2002, rows[1][1], None, None, "x"), (2003, "word " * 40_000, "en", "free", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, odds string")
    found = {r.doc_id for r in scored(train(df)).where("cut").collect()}
    hit = len(found & cut)
    assert hit / len(cut) > 0.8 and len(found - cut - {2003}) / len(rows) < 0.01
    empty = df.limit(0)
    assert scored(train(empty)).count() == 0
    assert scored(train(df)).where("doc_id >= 2000 and doc_id < 2002 and cut").count() == 0


def _coded(texts, keep=(), own=None, words=None):
    cps, offsets = code_points(pa.array(texts, pa.string()))
    words = words if words is not None else {1: np.array(sorted(map(word_hash, keep)), np.uint64)}
    forms = coded(cps, offsets, np.ones(len(texts), np.int64) if own is None else own, words)
    return [["".join(map(chr, c.codes[e + 1 - n : e + 1])) for c in forms for e, n in ((c.ends[k], c.sizes[k]),)] for k in range(len(texts))]


def test_coding():
    texts = ["In May 1907 Dr. A. Kay\nspoke. END …", None, "", "a B", "x McKay-Moor,\n\n\nUSA I5 é...", " \n", "B", "12 34", "one.\ntwo\nthree"]
    want = [["N N 9 N. I. N spoke. \x03", "N May 9 N. I. N spoke. N"], ["", ""], ["", ""], ["a N"] * 2, ["x N-N,\n\x03 I9 é", "x N-N,\nN I9 é"], ["", ""], ["N"] * 2, ["9 9"] * 2, ["one.\ntwo three"] * 2]
    assert _coded(texts, {"May"}) == want and [_coded([t], {"May"})[0] for t in texts] == want


def test_the_ends_are_coded_as_in_whole_texts():
    rng = random.Random(3)
    parts = ["May ", "The ", "Ingerford", "of ", "x", "A. ", "\n", "\n\n", ". ", "1890", "CAPS ", "é", "…", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 900))) + ("Abcdefghij" * 500 if k % 50 == 0 else "") for k in range(300)]
    b = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 300)], ["text", "lang"])
    cps, offsets = code_points(b.column("text"))
    langs, keep = {"en": 1}, {1: np.array(sorted(map(word_hash, ("May", "The"))), np.uint64)}
    whole = []
    for _, forms in _pieces(b, langs, keep):
        whole.append(np.stack([Hashes(c, form).at(c.ends, order) for order in ORDERS for form, c in enumerate(forms)], 1))
    assert (np.concatenate(whole) == final_chains(cps, offsets[:-1], offsets[1:], np.ones(300, np.int64), keep)).all()


def test_the_same_however_many_contexts_there_are(spark, rows):
    rng = random.Random(5)
    data = [(k, t if k % 9 else t[: len(t) // 2], rng.choice(["en", "de", None]), "s", "x") for k, t in enumerate(_text(rng) for _ in range(400))]
    df = spark.createDataFrame(data + data[:3] + [(900, "", "en", "s", "x"), (901, None, "en", "s", "x")], "doc_id bigint, text string, lang string, source string, odds string")
    sent, joined = train(df), train(df, most_bits=1 << 15, sent=0)
    assert joined.arrays is None and rows(sent.contexts) == rows(joined.contexts) and (sent.places == joined.places).all()
    get = lambda m: {(r.key, r.made, r.h1): r.ratio and round(r.ratio, 9) for r in rate_texts(m).collect()}
    assert get(sent) == get(joined)
    unique = train(df.dropDuplicates(["doc_id"]))
    assert sorted(r.n for r in unique.contexts.collect()) == brute_contexts(data, unique)


def brute_contexts(data, model):
    """How often the contexts that end a distinct text stand in all of them, counted one by one."""
    once = sorted({(t, g or "") for _, t, g, *_ in data})
    forms = list(zip(*_coded([t for t, _ in once], own=np.array([model.langs.get(g, 0) for _, g in once]), words=model.keep)))
    ended, stood = set(), {}
    for form, texts in enumerate(forms):
        padded = ["\x02" * max(ORDERS) + t for t in texts]
        for t in padded:
            ended |= {(form, t[-o:]) for o in ORDERS}
    for form, texts in enumerate(forms):
        for t in ("\x02" * max(ORDERS) + t for t in texts):
            for e in range(max(ORDERS), len(t)):
                for o in ORDERS:
                    if (form, t[e + 1 - o : e + 1]) in ended:
                        stood[form, t[e + 1 - o : e + 1]] = stood.get((form, t[e + 1 - o : e + 1]), 0) + 1
    return sorted(stood.values())


def test_thresholds(spark):
    real, made = {b: 100.0 for b in range(40, 60)} | {b: 5.0 for b in range(-60, -40)}, {b: 50.0 for b in range(-60, -40)}
    share, at = fitted(real, made)
    assert abs(share - 100 / 2100) < 1e-9 and -41 <= at <= 40 and fitted({}, made)[1] == float("-inf")


def test_every_text_is_cut_for_the_fit(spark):
    rng = random.Random(7)
    texts = spark.createDataFrame([(k, "Kay " * rng.randrange(1, 2000) + "x.") for k in range(30)], "k int, text string")
    df = spark.range(24_000).selectExpr("id as doc_id", "concat('No ', id, repeat(' of Kay', cast(id % 97 as int)), '.') as text", "if(id % 4 = 0, 'de', 'en') as lang", "'s' as source")
    df = df.unionByName(texts.selectExpr("cast(k as bigint) + 50000 as doc_id", "text", "'en' as lang", "'s' as source"))
    endings = train(df).endings
    whole = endings.where("not made and chars > 1 and odds is null")
    assert whole.count() > 10_500 and endings.where("made").select("key").exceptAll(whole.select("key")).count() == 0
    assert endings.where("made").count() == whole.count()
