"""The dedup stage links rows, also those without an id or with a shared one."""

import random

from codexlake.llm import neardup


def test_null_and_shared_ids(spark, documents, scratch):
    rng = random.Random(8)
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(60)]
    a, b, c, d, e = (text() for _ in range(5))
    near = lambda t: " ".join([*t[:-1], "end"])
    j = " ".join
    rows = [(None, j(a)), (None, near(a)), (None, j(b)), (None, j(b)), (7, j(c)), (7, j(d)), (7, j(d)), (9, near(e)), (None, j(e)), (None, ""), (None, "")]
    left = neardup.deduplicated(documents(rows), scratch, size=5, percent=80).collect()
    got = sorted(((r.doc_id, r.text) for r in left), key=repr)
    assert got == sorted([(None, j(a)), (None, j(b)), (7, j(c)), (7, j(d)), (9, near(e)), (None, ""), (None, "")], key=repr)
