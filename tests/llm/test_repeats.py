import hashlib
import random

import pytest

from codexlake.llm import repeats


def brute(texts, length):
    seen = {}
    blobs = [(t or "").encode() for t in texts]
    for b in blobs:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in blobs:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(n))


@pytest.mark.parametrize("hot", [repeats.HOT, 2, 0])
def test_against_every_window(spark, documents, scratch, hot):
    rng = random.Random(3)
    passages = [words(rng, 60) for _ in range(5)]
    texts = [None, "", "short", "a" * 500, "ab" * 300, words(rng, 100)]
    for _ in range(60):
        parts = [words(rng, rng.randint(1, 80)) for _ in range(3)]
        p = rng.choice(passages)
        cut = rng.randint(0, 150)
        texts.append(parts[0] + p[cut:] + parts[1] + rng.choice(passages)[: rng.randint(190, 400)] + parts[2])
    texts += [texts[10], texts[10], texts[11] + "x"]
    docs = documents([(i % 60, t) for i, t in enumerate(texts)])
    got = repeats.remove_repeats(docs, scratch, hot=hot).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(texts, 200)


def test_long_text_in_pieces(spark, documents, scratch, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(repeats, "PIECE", 3000)
    p = words(rng, 80)
    t = words(rng, 600) + p + words(rng, 900) + p
    rows = []
    import pyarrow as pa

    for a, data, offs, at in repeats.pieces(pa.array([t]), 200):
        row, first, last, *_ = repeats.parse(data, offs, 200)
        rows += [x + at for f, e in zip(first, last) for x in range(f, e + 1)]
    assert rows == list(range(len(t.encode()) - 199))


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "x")]])
def test_small_tables(spark, documents, scratch, rows):
    got = repeats.remove_repeats(documents(rows), scratch).collect()
    assert len(got) == len(rows) and all(r.n_removed == 0 for r in got)


def test_text_ids_and_clashing_columns(spark, scratch):
    rows = [("a", "y" * 300, 1), (None, "y" * 300, 2), (None, None, 3), ("b", "z" * 150, 4)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, key int").withColumnRenamed("key", "spans")
    got = repeats.remove_repeats(docs, scratch).collect()
    assert sorted((r.doc_id or "", r.n_bytes, r.n_removed) for r in got) == [("", 0, 0), ("", 300, 300), ("a", 300, 300), ("b", 150, 0)]
