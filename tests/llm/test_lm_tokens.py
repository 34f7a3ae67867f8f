"""Tokens of many texts at a time are those of one text after the other."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from codexlake.llm import lm

TEXTS = [None, "", " a\tB\x0bc\x1c d\x85é \xa0x", "Ä\n", "  ", "x y x", None, "z" * 5000 + " q", ""]


@pytest.mark.parametrize("limit", [1, 8, 1 << 22])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_numbered(limit, kind):
    arr = pa.array(["left out", *TEXTS], kind).slice(1)
    got = []
    for begin, words, at in lm.numbered(arr, limit):
        assert len(set(words)) == len(words)
        for a, b in zip(begin, [*begin[1:], len(at)], strict=True):
            got.append([words[i] for i in at[a:b]])
    assert got == [lm.tokens(t.encode() if t is not None else None) for t in TEXTS]
    assert list(lm.numbered(arr.slice(0, 0), limit)) == []


def test_counts_and_rare_words(spark, documents, scratch):
    docs = documents(list(enumerate(TEXTS)))
    want = Counter(w for t in TEXTS for w in lm.tokens(t.encode() if t is not None else None))
    assert {bytes(r.word): r.c for r in lm.word_counts(docs, "text", flush=2).collect()} == want
    # with a head of three words the others' counts are joined
    n, v = sum(want.values()), len(want)
    got = {r.doc_id: r for r in lm.score_texts(docs, F.lit(True), scratch, [F.col("doc_id")], head=3).collect()}
    for i, t in enumerate(TEXTS):
        words = lm.tokens(t.encode() if t is not None else None)
        assert (got[i].n_tokens, got[i].n_known) == (len(words), len(words))
        assert abs(got[i].base_score - sum(np.log10((want[w] + 1) / (n + v + 1)) for w in words)) < 1e-9
