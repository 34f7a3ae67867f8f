import random
from collections import defaultdict

from pyspark.sql import functions as F

from codexlake.llm import mixing, sharding


def shares(sizes):
    """Targets by sharing the excess again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s, extra in [(s, left * weight[s] / total) for s in open_]:
            target[s] += extra
        left = 0.0
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def rows(seed, n=400):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 40, 200])) or None, "en", rng.choice([None, "", "a", "b", "c", "c", "c", "c", "é"])) for i in range(n)]


def test_targets_and_takes(spark, documents, scratch):
    data = rows(1) + [(7, "hot " * 5000, "en", "zz")]
    got = mixing.mix(documents(data), scratch).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
    want, taken = shares(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for s, t in want.items():
        assert taken[s] <= t + 1e-6 and t - taken[s] <= max(r.size for r in got if r.source == s)
    again = mixing.mix(documents(data[::-1]), scratch).collect()
    assert sorted((r.doc_id, r.size, r.taken) for r in got) == sorted((r.doc_id, r.size, r.taken) for r in again)


def test_importance_changes_odds(spark, documents, scratch):
    data = [(i, "w " * 10, "en", "a" if i % 2 else "b") for i in range(2000)]
    docs = documents(data).withColumn("imp", F.when(F.col("doc_id") < 1000, 3.0).otherwise(1.0))
    got = mixing.mix(docs, scratch, importance="imp").groupBy((F.col("doc_id") < 1000).alias("x")).agg(F.sum("copies").alias("n")).collect()
    n = {r.x: r.n for r in got}
    assert n[True] > 2 * n[False]


def test_mixed_documents_repeat_rows(spark, documents, scratch):
    docs = scratch.put(documents(rows(2)).withColumnRenamed("n_chars", "__place"))
    out = mixing.mixed_documents(docs, scratch)
    assert out.columns == docs.columns
    want = sum(r.copies for r in mixing.mix(docs, scratch).collect())
    assert out.count() == want


def test_empty_and_null_sources(spark, documents, scratch):
    assert mixing.mix(documents([]), scratch).collect() == []
    got = mixing.mix(documents([(1, None, None, None), (1, None, None, None)]), scratch).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_shards_are_even(spark, documents, scratch):
    rng = random.Random(4)
    data = [(i, "é" * rng.randint(0, 40), rng.choice(["en", "fr", None]), rng.choice(["hot"] * 5 + ["a", "b"])) for i in range(4000)] + [(None, None)]
    got = sharding.kd_shards(documents(data), scratch, shards=24).collect()
    assert len(got) == len(data)
    size, slots = defaultdict(int), defaultdict(list)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(size) == set(range(24))
    assert max(size.values()) - min(size.values()) <= 3 * 88
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_value_everywhere(spark, documents, scratch):
    got = sharding.kd_shards(documents([(i, "same", "en", "a") for i in range(480)]), scratch, shards=6, block_rows=20).collect()
    n = defaultdict(int)
    for r in got:
        n[r.shard] += 1
    assert sorted(n.values()) == [80] * 6


def test_few_rows_and_clashes(spark, documents, scratch):
    assert sharding.kd_shards(documents([]), scratch).collect() == []
    docs = scratch.put(documents([(1, "x"), (2, None)]).withColumn("shard", F.lit("s")).withColumn("slot", F.lit(1)))
    out = sharding.sharded_documents(docs, scratch)
    assert out.columns == [*docs.columns, "shard_", "slot_"] and out.count() == 2


def test_tree_against_sorting(spark, documents, scratch):
    """With one dimension and distinct values, shards are runs of the order."""
    data = [(i, "x" * (i % 7), "en", "a") for i in range(700)]
    dims = {"d": F.col("doc_id")}
    got = sharding.kd_shards(documents(data), scratch, shards=8, tolerance=0.0, dims=dims).orderBy("doc_id").collect()
    assert [r.shard for r in got] == sorted(r.shard for r in got)


def test_repeated_rows_are_parted_one_by_one(spark, documents, scratch):
    """Half of the table is one row."""
    data = [(7, "the same text.", "en", "a")] * 240 + [(i, None, "fr", "b") for i in range(240)]
    got = sharding.kd_shards(documents(data), scratch, shards=6, block_rows=20).collect()
    size, slots = defaultdict(int), defaultdict(list)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == 480 and set(size) == set(range(6))
    assert max(size.values()) - min(size.values()) <= 22
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def brute_tree(rows, dims, shards):
    """rows: dicts with size, tie and the dims; the shard of each doc_id."""
    whole = {d: max(1, max(r[d] for r in rows) - min(r[d] for r in rows)) for d in dims}
    out = {}

    def part(node, first, k):
        if k == 1 or not node:
            out.update((r["doc_id"], first) for r in node)
            return
        dim = max(dims, key=lambda d: (max(r[d] for r in node) - min(r[d] for r in node)) / whole[d])
        node = sorted(node, key=lambda r: (r[dim], r["tie"]))
        goal, before, cut = sum(r["size"] for r in node) * (k // 2) / k, 0, len(node)
        for i, r in enumerate(node):
            if before + r["size"] > goal:
                cut = i + (before + r["size"] - goal < goal - before)
                break
            before += r["size"]
        part(node[:cut], first, k // 2)
        part(node[cut:], first + k // 2, k - k // 2)

    part(rows, 0, shards)
    return out


def test_splits_against_brute_force(spark, documents, scratch):
    rng = random.Random(9)
    hosts = ["https://a.org", "https://b.org", "www.c.net", None]
    langs = ["en", "fr", None]
    data = [(i, "x" * rng.randint(0, 60), rng.choice(langs), rng.choice(hosts)) for i in range(600)]
    docs = documents(data)
    got = {r.doc_id: r.shard for r in sharding.kd_shards(docs, scratch, shards=7, tolerance=0.0).collect()}
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    tie = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), crc), F.lit(sharding.UNIT))
    rows = [r.asDict() for r in docs.select("doc_id", tie.alias("tie"), sharding.log_size(F.length("text")).alias("length"), "lang", "source", (F.length("text") + 8).alias("size")).collect()]
    order = lambda x: {v: i + 1 for i, v in enumerate(sorted(v for v in x if v))} | {None: 0}
    for r in rows:
        r |= {"lang": order(langs)[r["lang"]], "source": order(hosts)[r["source"]]}
    assert got == brute_tree(rows, ["length", "source", "lang"], 7)
