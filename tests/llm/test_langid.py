"""Rank-order profiles against the plain definition."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from codexlake.llm import langid
from codexlake.llm.common import text_parts


def code(g):
    if len(g) == 1:
        return ord(g)
    x = [0 if c == " " else ord(c) for c in g]
    return x[0] << 21 | x[1] | 1 << 42 if len(g) == 2 else x[0] << 42 | x[1] << 21 | x[2] | 1 << 63


def grams(text):
    """Runs of one to three signs around each letter of padded words."""
    out = []
    for w in "".join(c.lower() if c.isalpha() else " " for c in text or "").split():
        p = f" {w} "
        out += list(w) + [p[i : i + 2] for i in range(len(p) - 1)] + [p[i : i + 3] for i in range(len(p) - 2)]
    return Counter(out)


def ranked(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


def brute(text, profiles, size):
    own = ranked(grams(text), size)
    if not own:
        return "und", 0.0
    dist = {k: sum(min(abs(p.index(g) - i), size) if g in p else size for i, g in enumerate(own)) for k, p in profiles.items()}
    best = min(sorted(dist), key=lambda k: dist[k])
    return best, 1 - dist[best] / (len(own) * size)


def test_distances_by_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(langid, "CELLS", 2000)  # several parts
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
    alphabets = {"aa": "abcdeé ", "bb": "cdefgß", "cc": "яабв"}
    rows = [(i, " ".join(word(alphabets[k]) for _ in range(rng.randint(1, 40))), k) for i, k in enumerate(rng.choices(sorted(alphabets), k=60))]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "12 3!", "cc"), (103, "ABC Déa", None), (104, "ж", "aa")]
    size = 20
    docs = documents(rows)
    learnt = langid.learn(docs.filter("doc_id < 40"), size=size)
    profiles = {}
    for k in alphabets:
        total = Counter()
        for i, t, lang in rows:
            if i < 40 and lang == k:
                total += grams(t)
        profiles[k] = ranked(total, size)
    assert learnt == {k: [code(g) for g in p] for k, p in profiles.items()}
    judge = langid.Judge(learnt, size)
    for _, _, data, offs in text_parts(pa.array([t for _, t, _ in rows])):
        best, score = judge.guess(data, offs)
        for (_, t, _), b, s in zip(rows, best, score, strict=True):
            want, value = brute(t, profiles, size)
            assert (judge.names[b] if b >= 0 else "und") == want and abs(s - value) < 1e-9
    got = docs.select("doc_id", langid.predict(F.col("text"), learnt, size).alias("p")).collect()
    assert {r.doc_id: (r.p.lang, round(r.p.score, 9)) for r in got} == {i: (w, round(v, 9)) for i, t, _ in rows for w, v in [brute(t, profiles, size)]}


def test_codes_that_share_a_slot(monkeypatch):
    monkeypatch.setattr(langid, "SLOTS", 1 << 20)
    codes = np.random.default_rng(1).integers(0, 1 << 62, 200_000).astype(np.uint64)
    known, number = langid.numbered(np.concatenate((codes, codes[:1000])))
    assert (known == np.unique(codes)).all() and (known[number] == np.concatenate((codes, codes[:1000]))).all()


def test_nothing_to_learn(spark, documents):
    assert langid.learn(documents([(1, "a", None)])) == {}
    got = documents([(1, "abc")]).select(langid.predict(F.col("text"), {}).alias("p")).first()
    assert (got.p.lang, got.p.score) == ("und", 0.0)
