import hashlib
import random
import re

from codexlake.llm import decontam
from codexlake.llm.queries import op2_decontamination  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, items):
    wins = []
    for i, t in items:
        w = WORD.findall(lower(t))
        wins += [(i, w[j : j + 10]) for j in range(max(1, len(w) - 9))] if w else []
    out = []
    for d, t in docs:
        w, hit, ids = WORD.findall(lower(t)), set(), set()
        for i, win in wins:
            for j in range(len(w) - len(win) + 1):
                if w[j : j + len(win)] == win:
                    hit |= set(range(j, j + len(win)))
                    ids |= {str(i)} - {"None"}
        out.append((d is None, d or 0, len(w), len(hit), ",".join(sorted(ids))))
    return sorted(out)


def run(spark, documents, scratch, docs, items, **options):
    from pyspark.sql import functions as F

    c = decontam.find_contamination(documents(docs), spark.createDataFrame(items, "item_id long, text string"), scratch, **options)
    rows = c.select("doc_id", "contamination.*", decontam.n_hit(F.col("contamination.spans")).alias("hit")).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.hit, ",".join(r["items"])) for r in rows)


def case(seed=5):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "a", "x1", "É", "Bé", "c", "D"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 9, 10, 11, 25])))) for i in range(12)] + [(3, "of the of the"), (None, "x1 x1 x1"), (12, None)]
    docs = [(None, "a, b"), (1, None), (2, "")] + [(i, "--".join([*(word() for _ in range(rng.randint(0, 30))), *re.split(" ", rng.choice(items)[1] or ""), *(word() for _ in range(4))])) for i in range(3, 60)]
    return docs + docs[5:7], items


def test_against_every_window(spark, documents, scratch):
    docs, items = case()
    assert run(spark, documents, scratch, docs, items) == brute(docs, items)


def test_blocks_of_windows(spark, documents, scratch):
    docs, items = case(6)
    assert run(spark, documents, scratch, docs, items, block_windows=7) == brute(docs, items)


def test_no_items_or_documents(spark, documents, scratch):
    assert run(spark, documents, scratch, [(1, "a b")], []) == [(False, 1, 2, 0, "")]
    assert run(spark, documents, scratch, [], [(1, "a b")]) == []


def test_spans_merge():
    assert decontam.merged([(5, 9), (0, 3), (3, 4), (8, 12)]) == [0, 4, 5, 12]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
