"""The pipeline's stages against brute force, on a table with odd rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from codexlake.llm import mixing, warc

from test_neardup import brute

DOC = "doc_id long, text string, lang string, source string, n_chars long, shard string, quality string, __place int"


def rows():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(14))
    out = [None, "", " \n", "too short", "Z" * 30]
    for i in range(40):
        base = [word() for _ in range(rng.randint(12, 60))]
        out.append(" ".join(base))
        if i % 3 == 0:
            out += [" ".join(base), " ".join([*base[:-1], "other"])]
        if i % 8 == 0:
            out.append(" ".join(base[:9]) + " " + passage[rng.randint(0, 5) :])
    full = [(i, t, "en", rng.choice(["a.org", "b.org", None]), len(t or ""), "s", "q", 1) for i, t in enumerate(out)]
    return full + [full[6], full[7], (None, *full[9][1:])], passage


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    full, passage = rows()
    where = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(full, DOC).coalesce(2).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([("x", passage), ("y", None)], "item_id string, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, passage


def test_stages_against_brute_force(spark, tables, tmp_path):
    where, passage = tables
    docs = spark.read.parquet(f"{where}/documents.parquet")
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, where)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = seen[name] = spark.read.parquet(f"{tmp_path}/{name}")
    cols = seen["documents"].columns
    assert all(seen[n].columns == cols for n, _ in corpus_pipeline.STAGES[:-1])
    assert seen["kd_sharding"].columns == [*cols, "shard_", "slot"]
    get = lambda n: [tuple(r) for r in seen[n].collect()]
    key = lambda x: sorted(map(repr, x))
    kept = get("quality_rules")
    assert key(kept) == key(r for r in get("documents") if len((r[1] or "").split()) >= 10)
    place = [(i, r[1]) for i, r in enumerate(sorted(kept, key=lambda r: (r[0] is None, r[0] or 0)))]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))
    left = [order[i] for i, _, _, first in brute(place, 5, 80) if first]
    assert key(get("minhash_near_dedup")) == key(left)
    words = passage.split()
    hit = lambda t: any(" " + " ".join(words[i : i + 10]) + " " in f" {t} " for i in range(len(words) - 9))
    clean = [r for r in left if not hit(r[1])]
    assert 0 < len(clean) < len(left) and key(get("decontamination")) == key(clean)
    copies = mixing.mix(seen["decontamination"], corpus_pipeline.Scratch(spark, "t")).collect()
    assert sorted((r.doc_id or -1) for r in copies for _ in range(r.copies)) == sorted(r[0] if r[0] is not None else -1 for r in get("source_mixing"))
    slots = defaultdict(list)
    for r in get("kd_sharding"):
        slots[r[-2]].append(r[-1])
    assert key(r[:-2] for r in get("kd_sharding")) == key(get("source_mixing"))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_archive_that_stays(spark, scratch, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 1200), (2, "v", "x" * 1200), (3, "w", None)], "page_id long, url string, html string")
    warc.write_archive(pages, scratch, path=str(tmp_path / "a"))
    got = warc.parsed(warc.read_archive(*warc.open_archive(spark, str(tmp_path / "a")))).orderBy("page_id").collect()
    assert [(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got] == [(1, "revisit", 2, 1200), (2, "response", None, 1200), (3, "response", None, 0)]
