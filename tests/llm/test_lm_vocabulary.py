"""The model's words grow with the corpus; the others are scored by group."""

import random

import numpy as np
from pyspark.sql import functions as F

from codexlake.llm import lm


def test_order_of_words_beyond_the_first_thousand_counts(spark, documents, scratch):
    rng = random.Random(3)
    words = [f"w{i:04d}" for i in range(2000)]
    rows = [(i, " ".join(rng.sample(words, len(words)))) for i in range(40)]
    rare = [f"x{i:02d}" for i in range(40)]  # once each, under the threshold
    rows.append((40, " ".join(rare)))
    asked = ["w1500 w1600 w1700", "w1700 w1500 w1600", "x01 x02 x03", "x03 x01 x02"]
    docs = documents([*rows, *((100 + i, t) for i, t in enumerate(asked))])
    got = {r.doc_id: r for r in lm.score_texts(docs, F.col("doc_id") < 100, scratch, [F.col("doc_id")]).collect()}
    for a, b in ((100, 101), (102, 103)):
        assert abs(got[a].base_score - got[b].base_score) < 1e-9
        assert got[a].score != got[b].score
        assert abs(got[a].score - got[b].score) > 1e-6


def test_tree_holds_all_words_and_is_normalised():
    rng = np.random.default_rng(2)
    for n in (1, 2, 4, 5, 77, 1000):
        u = np.sort(rng.random(n))[::-1]
        m = lm.Model(u / u.sum(), dim=4)
        m.r = rng.normal(0, 1, m.r.shape).astype(np.float32)
        m.s1, m.s2 = (rng.normal(0, 1, x.shape).astype(np.float32) for x in (m.s1, m.s2))
        p = 10 ** m.log10(np.full(n, n), np.full(n, n - 1), np.arange(n))
        assert abs(p.sum() - 1) < 1e-5


def test_score_of_a_text_by_brute_force():
    """Products of softmaxes along the tree, one word after the other."""
    rng = np.random.default_rng(4)
    u = np.sort(rng.random(60))[::-1]
    m = lm.Model(u / u.sum(), dim=4)
    for p in ("r", "s1", "s2", "b", "b1", "b2", "c"):
        setattr(m, p, rng.normal(0, 1, getattr(m, p).shape).astype(np.float32))
    w = rng.integers(0, 60, 200)
    c1, c2 = lm.contexts(w, np.array([0, 70]), m.n)

    def softmax(h, x, b, low):
        z = x[low : low + m.branch] @ h + b[low : low + m.branch]
        return np.exp(z - z.max()) / np.exp(z - z.max()).sum()

    want = []
    for a, b, x in zip(c1, c2, w):
        h = m.c[0] @ m.r[a] + m.c[1] @ m.r[b]
        twig = x // m.branch
        branch = twig // m.branch
        p = softmax(h, m.s1, m.b1, 0)[branch] * softmax(h, m.s2, m.b2, branch * m.branch)[twig % m.branch] * softmax(h, m.r[: m.n], m.b[: m.n], twig * m.branch)[x % m.branch]
        want.append(np.log10(p))
    assert np.allclose(m.log10(c1, c2, w), want, atol=1e-4)


def test_empty_table_and_kept_columns_of_any_name(spark, documents, scratch):
    docs = documents([(1, "a b"), (2, None), (3, "")]).withColumnRenamed("source", "s").withColumnRenamed("lang", "row")
    got = lm.score_texts(docs, F.lit(True), scratch, [F.col("doc_id"), F.col("s"), F.col("row")])
    assert got.columns[:3] == ["doc_id", "s", "row"] and sorted((r.doc_id, r.n_tokens) for r in got.collect()) == [(1, 3), (2, 1), (3, 1)]
    assert lm.score_texts(documents([]), F.lit(True), scratch, [F.col("doc_id")]).collect() == []


def test_places_of_own_rare_and_unknown_words():
    words, own = [b"a", b"b", b"c", b"d"], 2
    mass = np.array([9.0, 2.0, 5.0, 1.0, 3.0])  # a, b and three groups
    places = lm.Words(words, own, mass)
    index = lm.Index(words, places)
    got = index.numbers(b"A d x b zz")
    assert index.far == [b"x", b"zz", b""]
    falling = [int(i) for i in np.argsort(-mass)]
    want = [falling.index(0 if w == b"a" else 1 if w == b"b" else own + places.group(w)) for w in (b"a", b"d", b"x", b"b", b"zz", b"")]
    assert places.of(got).tolist() == want


def test_a_minibatch_sums_gradients_as_one_scatter_does():
    """Contexts that are the words before, those at texts' begins, and
    minibatches of one and two words, against a plain sum over all rows."""
    rng = np.random.default_rng(6)
    u = np.sort(rng.random(30))[::-1]
    u /= u.sum()
    for n in (1, 2, 3, 50):
        w = rng.integers(0, 30, n)
        c1, c2 = lm.contexts(w, np.array([0] if n < 4 else [0, 7, 8]), 30)
        models = [lm.Model(u, dim=4) for _ in range(2)]
        memories = [m.start(np.random.default_rng(1)) for m in models]
        for m, memory, cut in zip(models, memories, (lm._apart, lambda c, w, by: np.arange(len(w)))):
            with_cut, lm._apart = lm._apart, cut
            try:
                m.train(c1, c2, w, np.random.default_rng(2), memory)
            finally:
                lm._apart = with_cut
        for p in ("r", "b", "s1", "b1", "s2", "b2", "c"):
            assert np.allclose(getattr(models[0], p), getattr(models[1], p), atol=1e-6)
        assert memories[0]["hits"].tolist() == memories[1]["hits"].tolist()
        assert memories[0]["hits"].sum() == 5 * n
