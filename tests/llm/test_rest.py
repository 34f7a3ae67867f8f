import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from codexlake.llm import cotrain, langid, lm, quality_rules, warc, warc_files

W = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules ---------------------------------------------------------------


def counts(t):
    t = t or ""
    w, seen = W.findall(t), {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    hit = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if W.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


def test_measures():
    rng = random.Random(2)
    texts = [None, "", " ", "a", "\n\n", "a b\na b\n"] + ["".join(rng.choice("ab é\n\t#* ") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    assert quality_rules.measure(pa.array(texts)).to_pylist() == [counts(t) for t in texts]
    assert quality_rules.measure(pa.array([], pa.string())).to_pylist() == []


def test_bad_host_is_rejected(spark, documents, scratch):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good + f" {i}", "en", "clean") for i in range(200)]
    rows += [(1000 + i, "one two three four five " * 9, "en", "spam") for i in range(80)] + [(2000, good, "en", "spam"), (2001, good, "en", None), (2002, None, "en", None)]
    docs = documents(rows).withColumnRenamed("n_chars", "host")
    out = quality_rules.apply_rules(docs, scratch, into="q")
    assert out.columns == [*docs.columns, "q"]
    kept = {r.doc_id for r in out.filter("q.kept").collect()}
    assert kept == set(range(200)) | {2001}
    assert quality_rules.apply_rules(documents([]), scratch).collect() == []


# --- archive ------------------------------------------------------------------------


def test_archive_round_trip(spark, scratch):
    big = "é" * 600
    rows = [(1, "u", "small"), (2, "u2", "small"), (3, "a\r\nb", big), (7, None, big), (5, "x", big), (8, "n", None), (None, "q", big), (9, "z", "y" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    payloads, headers = warc.write_archive(pages, scratch)
    assert payloads.count() == 4
    archive = warc.read_archive(payloads, headers)
    got = {r.page_id: r for r in warc.parsed(archive).collect()}
    for i, _, h in rows:
        b = (h or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(b), hashlib.sha1(b).hexdigest())
        again = len(b) >= 1000 and i not in (7, 9)
        assert (r.record_type, r.refers_to) == (("revisit", 7) if again else ("response", None))
    whole = b"".join(bytes(r.record) for r in archive.collect())
    cut = warc_files.cut(whole)
    assert len(cut) == len(rows) and sum(len(c["body"]) for c in cut) == 5 + 5 + 1200 + 0 + 1000
    import gzip

    assert len(warc_files.cut(b"".join(gzip.compress(c["header"] + c["body"] + b"\r\n\r\n") for c in cut))) == len(rows)


def test_damage_is_found(spark, scratch):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    payloads, headers = warc.write_archive(pages, scratch)
    bad = payloads.withColumn("payload", F.lit("abd").cast("binary"))
    try:
        warc.read_archive(bad, headers).collect()
    except Exception as e:
        assert "damaged" in str(e)
    else:
        raise AssertionError


def test_empty_archive(spark, scratch):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.parsed(warc.read_archive(*warc.write_archive(pages, scratch))).collect() == []


# --- languages ------------------------------------------------------------------------


def test_languages(spark, documents):
    rng = random.Random(1)
    stock = {"aa": "the and that ing tion er".split(), "bb": "le la ére çon eaux ñ".split(), "cc": "дом река мир лес".split()}
    make = lambda k: " ".join("".join(rng.choice(stock[k]) for _ in range(2)) for _ in range(rng.randint(1, 40)))
    rows = [(i, make(k), k) for i, k in enumerate(rng.choices(list(stock), k=300))]
    profiles = langid.learn(documents(rows[:250] + [(999, None, "aa"), (998, "x", None)]))
    assert list(profiles) == ["aa", "bb", "cc"]
    asked = rows[250:] + [(1, None), (2, "12 .. 3"), (3, "")]
    got = documents(asked).select("lang", "text", langid.predict(F.col("text"), profiles).alias("p")).collect()
    right = [r.p.lang == r.lang for r in got if r.lang]
    assert sum(right) / len(right) > 0.95
    assert [(r.p.lang, r.p.score) for r in got if not r.lang] == [("und", 0.0)] * 3
    assert all(0 <= r.p.score <= 1 for r in got)


def test_nothing_to_learn(spark, documents):
    assert langid.learn(documents([])) == {}
    assert documents([(1, "abc")]).select(langid.predict(F.col("text"), {}).alias("p")).first().p.lang == "und"


def test_grams_of_a_word():
    data = np.frombuffer(b"Ab c", np.uint8)
    row, g, has = langid.grams(data, np.array([0, 4]))
    assert len(g) == 3 + 3 + 2 + 3 and has.tolist() == [True]  # letters, pairs with a blank before or within, word ends, triples


# --- language model ------------------------------------------------------------------------


def test_scores(spark, documents, scratch):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        a, b = ("red", "blue") if i % 2 else ("dog", "cat")
        rows.append((i, " ".join(rng.choice((a, b, a + str(rng.randint(0, 30)))) for _ in range(rng.randint(0, 60)))))
    rows += [(300, None), (301, "NEW words Only"), (None, "red")]
    docs = documents(rows)
    learn = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 0
    got = lm.score_texts(docs, learn, scratch, [F.col("doc_id"), F.col("text")], vocabulary=8, head=20).collect()
    c = Counter()
    for i, t in rows:
        if (i or 0) % 3:
            c.update([*(t or "").lower().split(), ""])
    n, v = sum(c.values()), len(c)
    gain = []
    for r in got:
        t = [*(r.text or "").lower().split(), ""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) < 1e-9
        if r.doc_id and r.doc_id % 3 == 0 and r.doc_id < 300:
            gain.append(r.score - r.base_score)
    assert np.mean(gain) > 0


def test_model_is_normalised():
    rng = np.random.default_rng(1)
    m = lm.Model(np.array([0.5, 0.3, 0.2]), dim=4)
    m.r = rng.normal(0, 1, m.r.shape).astype(np.float32)
    for c1 in range(4):
        for c2 in range(4):
            p = 10 ** m.log10(np.full(3, c1), np.full(3, c2), np.arange(3))
            assert abs(p.sum() - 1) < 1e-5


def test_nothing_to_learn_from(spark, documents, scratch):
    got = lm.score_texts(documents([(1, "a b")]), F.lit(False), scratch, [F.col("doc_id")]).first()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.base_score) == (3, 0, 0, 0.0)


# --- classifier --------------------------------------------------------------------------------


def test_cotraining(spark, documents, scratch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, labels = [], []
    for i in range(900):
        bad, rude = rng.random() < 0.3, rng.random() < 0.2
        t = [word() + ("***" if bad else "") for _ in range(40)] + (["idiot", "moron"] if rude else [])
        rng.shuffle(t)
        rows.append((i, " ".join(t), "en", rng.choice("xyz")))
        if i < 600:
            labels.append((i, 0 if bad else 1, 1 if rude else 0))
        else:
            rows[-1] = (*rows[-1][:2], "en", "x")
    truth = {r[0]: ("***" in r[1], "idiot" in r[1]) for r in rows}
    docs = documents([*rows, (None, None), (5000, "")])
    lab = spark.createDataFrame([*labels, (3, None, None)], "doc_id long, quality int, toxic int")
    got = cotrain.classify(docs, lab, scratch, per_round=64).collect()
    assert len(got) == 902
    own = [r for r in got if r.doc_id is not None and 600 <= r.doc_id < 900]
    assert np.mean([(r.quality_all < 0.5) == truth[r.doc_id][0] for r in own]) > 0.97
    assert np.mean([(r.toxic_all >= 0.5) == truth[r.doc_id][1] for r in own]) > 0.95


def test_one_class_only(spark, documents, scratch):
    lab = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = cotrain.classify(documents([(1, "a"), (2, None)]), lab, scratch).collect()
    assert {(r.quality_all, r.toxic_all) for r in got} == {(1.0, 0.0)}
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.quality_all for r in cotrain.classify(documents([(1, "a")]), empty, scratch).collect()} == {0.5}
    assert cotrain.classify(documents([]), empty, scratch).collect() == []
