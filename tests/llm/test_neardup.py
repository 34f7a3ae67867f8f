import random

import numpy as np
import pyarrow as pa
import pytest

from codexlake.llm import kernels as K
from codexlake.llm import neardup
from codexlake.llm.components import connected


def brute(rows, size, percent):
    def shingles(t):
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())

    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def corpus(seed, groups=25):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))
    rows = [(0, None), (1, ""), (2, "One"), (3, "one"), (4, "a b c"), (5, "A B C")]
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(5, 120))]
        for _ in range(rng.randint(1, 6)):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t)))
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_components_match_all_pairs(spark, documents, scratch, size):
    rows = corpus(size)
    got = neardup.near_duplicates(documents(rows), scratch, size=size, bucket_rows=3).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, size, 80)


def test_chain_across_leaders(spark, documents, scratch):
    """b links to a and c, but a and c are no near duplicates."""
    w = [f"w{i}" for i in range(100)]
    a, b, c = w[0:90], w[5:95], w[10:100]
    got = neardup.near_duplicates(documents([(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]), scratch).collect()
    assert {r.component_id for r in got} == {1}


def test_sketch_margin():
    for at in (0.8, 0.9):
        assert neardup.bit_limit(at) < neardup.BITS / 2


def test_deduplicated_keeps_one_of_a_group(spark, documents, scratch):
    rows = [(1, "x y z q r s"), (1, "x y z q r s"), (2, "x y z q r s"), (None, "x y z q r s"), (5, ""), (6, None), (None, "other words here")]
    docs = scratch.put(documents(rows).withColumnRenamed("n_chars", "__place"))
    got = neardup.deduplicated(docs, scratch)
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got.collect()) == sorted([(False, 1, "x y z q r s"), (False, 5, ""), (False, 6, ""), (True, 0, "other words here")])


def test_empty(spark, documents, scratch):
    assert neardup.near_duplicates(documents([]), scratch).collect() == []


def test_connected(spark, scratch):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (3, 4), (10, 10), (1, 2)], "a long, b long")
    assert sorted(map(tuple, connected(links, scratch).collect())) == [(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7), (9, 7), (10, 10)]


def test_signature_is_the_same_in_any_batch():
    t = pa.array(["a b c d e f", None, "x y z", ""])
    one = neardup.signature_of(neardup.shingle_sets(t, 4), 4).to_pylist()
    assert one[0] == neardup.signature_of(neardup.shingle_sets(t.slice(0, 1), 4), 1).to_pylist()[0]
    assert one[1] is None and one[3] is None


def test_large_bucket_meets_all(spark, documents, scratch):
    """60 near copies in one bucket, dealt into cells of 7 rows."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randint(1, 3)):
            t[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    got = neardup.near_duplicates(documents(rows), scratch, size=4, bucket_rows=7).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 4, 80)


def test_text_ids_nulls_and_clashing_columns(spark, scratch):
    rows = [("b", "x y z q r", "1"), ("a", "x y z q r", "2"), (None, "x y z q r", "3"), ("c", None, "4"), ("c", "", "5")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, component_id string")
    got = neardup.near_duplicates(docs, scratch, size=4).collect()
    assert sorted((r.doc_id or "", r.component_id or "") for r in got) == [("", "a"), ("a", "a"), ("b", "a"), ("c", "c"), ("c", "c")]


def test_words_in_pieces():
    text = ("ab cde  f " * 40 + "x" * 50 + " y").encode()
    data, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole, _ = K.word_hashes(data, offs)
    for piece in (1, 7, 16, 64):
        parts, first = K.word_hashes(data, offs, piece=piece)
        assert parts.tolist() == whole.tolist() and first.tolist() == [0, len(whole)]
