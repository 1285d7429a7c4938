import random
import re

import numpy as np

from quirework.llm.leaks import EDITED, PASSAGE, align, edited_copies, leaks


def _words(t):
    return re.findall(r"[^\W_]+", t.lower())


def _run(a, b):
    best, last = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] * (len(b) + 1)
        for j, y in enumerate(b, 1):
            if x == y:
                row[j] = last[j - 1] + 1
                best = max(best, row[j])
        last = row
    return best


def _score(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 2, h[i][j - 1] - 2)
    return max(map(max, h))


def test_alignment_against_the_plain_recurrence():
    rng = random.Random(4)
    pairs = [([rng.randrange(4) for _ in range(rng.randrange(1, 25))], [rng.randrange(4) for _ in range(rng.randrange(1, 20))]) for _ in range(60)]
    best, longest = align([(np.array(a, np.int32), np.array(b, np.int32)) for a, b in pairs])
    assert best.tolist() == [_score(a, b) for a, b in pairs] and longest.tolist() == [_run(a, b) for a, b in pairs]


def test_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(40)] + ["Été", "it", "the"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([5, 12, 13, 40])))) for k in range(25)] + [(90, None), (91, ""), (92, "only a few words")]
    items.append((93, items[3][1]))
    docs = []
    for k in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        if k % 2:
            w = (items[rng.randrange(25)][1]).split()
            n = rng.randrange(8, 16)
            s = rng.randrange(max(1, len(w) - n + 1))
            words[3:3] = [x.upper() + rng.choice([",", "", "\n", " -"]) for x in w[s : s + n]]
        docs.append((k, " ".join(words), "x", "clash"))
    docs += [(200, None, "x", "c"), (201, "", "x", "c"), (202, docs[1][1], "x", "c"), (202, docs[1][1], "x", "c"), (203, "z " * 30_000 + items[2][1], "x", "c")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_words string, gram string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    want = {(a, b) for a, t, *_ in docs for b, u in items if t and u and _run(_words(t), _words(u)) >= PASSAGE}
    got = [(r.doc_id, r.item_id) for r in leaks(d, i).where(f"run_words >= {PASSAGE}").collect()]
    assert len(want) > 20 and sorted(got) == sorted(want)
    assert leaks(d.limit(0), i).count() == 0 and leaks(d, i.limit(0)).count() == 0


def test_edited_copies_against_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(30)] + ["of", "the"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([12, 14, 25, 40])))) for k in range(20)] + [(90, None), (91, "of the")]
    docs = []
    for k in range(200):
        w = items[rng.randrange(20)][1].split()
        for _ in range(rng.randrange(0, len(w) // 2)):
            j = rng.randrange(len(w))
            w[j : j + 1] = rng.choice([[], ["new", w[j]], ["other"], ["other"]])
            w = w or ["x"]
        around = [[rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))] for _ in range(2)]
        docs.append((k, " ".join(around[0] + w + around[1])))
    docs += [(300, None), (301, ""), (302, docs[0][1]), (302, docs[0][1])]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    whole = {b: 2 * len(_words(u)) for b, u in items if u}
    want = {(a, b) for a, t in docs for b, u in items if t and u and len(_words(u)) >= PASSAGE and _score(_words(t), _words(u)) >= EDITED * whole[b]}
    got = [(r.doc_id, r.item_id) for r in edited_copies(d, i).collect()]
    runs = {(a, b) for a, b in want if _run(_words(dict(docs)[a]), _words(dict(items)[b])) < PASSAGE}
    assert len(want) > 100 and len(runs) > 20 and sorted(got) == sorted(want)
    assert edited_copies(d.limit(0), i).count() == 0 and edited_copies(d, i.limit(0)).count() == 0
