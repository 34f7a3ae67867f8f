"""K-d tree partitioning into shards of near equal bytes (DataFrame only).

A node that holds k shards splits into floor(k / 2) and the rest, where its
bytes divide in that proportion, along the metadata dimension in which it is
widest (its range over the range of the whole table). The weighted medians of
all nodes of a level are found together from histograms: each round sums the
bytes of 1024 bins a node, and goes on in the bins that hold the cut, until the
bin's bytes are below the tolerance or a single value is left; equal values are
parted by a hash of id and text, equal hashes by the row's place in the written
table of points. Only bin sums reach the driver (1024 a node at most).

Source and language are dimensions by the order of their whole values: the
distinct values are sorted by ranges, and a value's number is its place there.

Groups: equal texts may lie in several shards. They have the same length, but
the hash that parts equal values holds the id too, so it deals copies evenly.

Defined cases: a null text has 0 bytes; a null in a dimension sorts first; of
equal rows any may go to either side, one by one, so that shards of nothing but
repeated rows are even too; null and repeated ids are rows like others, of any
type; an empty table gives an empty result; a shard may stay empty if there are
fewer rows than shards or one row is larger than a shard; long texts are read for
their size and CRC alone; extra columns aren't read, or pass
(``sharded_documents``, whose new columns get underscores if names are taken).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, few, free_name, id_text

BINS = 1024
UNIT = 1 << 40  # dimensions and the tie hash are whole numbers below this


def ordinals(values: DataFrame, scratch: Scratch, parts: int = 64) -> DataFrame:
    """(value, number) of the distinct values but null, by their bytes, from 1
    on. Each range of values is numbered by itself; a count for each range
    reaches the driver."""
    one = values.select(values.columns[0]).toDF("value").filter("value is not null").distinct()
    key = F.hex(F.encode("value", "UTF-8"))
    ranges = one.withColumn("key", key).repartitionByRange(parts, "key").sortWithinPartitions("key")
    rows = scratch.put(ranges.select("value", F.monotonically_increasing_id().alias("at")), "values")
    part, counts = F.shiftright("at", 33), {}
    for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["p"]] = r["n"]
    before, total = [F.lit(0), F.lit(0)], 0
    for p in sorted(counts):
        before += [F.lit(p), F.lit(total)]
        total += counts[p]
    first = F.create_map(*(x.cast("long") for x in before[2:] or before))
    return rows.select("value", (F.element_at(first, part) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("number"))


def log_size(c: Column) -> Column:
    return F.floor(F.log1p(F.coalesce(c, F.lit(0)).cast("double")) / math.log(2) * (UNIT >> 6)).cast("long")


def _pick(values: list, node: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (node + 1).cast("int"))


def plan_tree(points: DataFrame, scratch: Scratch, dims: list[str], shards: int, tolerance: float) -> tuple[DataFrame, list[dict]]:
    """points with the column ``node`` (the shard), and the splits made. Each
    level is written, as only ids, sizes and dimensions are kept."""
    nodes = [{"first": 0, "k": shards}]
    node, tree = F.lit(0), []
    whole = None
    while any(n["k"] > 1 for n in nodes):
        at = points.withColumn("node", node)
        stats = {r["node"]: r for r in at.groupBy("node").agg(F.sum("size").alias("mass"), F.max("place").alias("places"), *(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max)))).collect()}
        if whole is None:
            whole = {d: max(1, stats[0][f"hi_{d}"] - stats[0][f"lo_{d}"]) if stats else 1 for d in dims}
        cuts = []
        for i, n in enumerate(nodes):
            r = stats.get(i)
            width = {d: (r[f"hi_{d}"] - r[f"lo_{d}"]) / whole[d] for d in dims} if r else {}
            dim = max(dims, key=lambda d: width.get(d, 0)) if r else dims[0]
            n |= {"dim": dim, "mass": int(r["mass"]) if r else 0, "lo": [int(r[f"lo_{dim}"]) if r else 0, 0, 0], "hi": [int(r[f"hi_{dim}"]) + 1 if r else 1, UNIT, int(r["places"]) + 1 if r else 1], "before": 0, "part": 0, "done": n["k"] == 1 or not r}
            n["goal"] = n["mass"] * (n["k"] // 2) / n["k"]
            cuts.append(n)
        # an open node searches [lo, hi) of its dimension (part 0), then of the tie hash among equal values (part 1), then of the places of equal rows (part 2)
        while any(not n["done"] for n in cuts):
            dim = F.coalesce(*(F.when(F.col("node") == i, F.col(n["dim"])) for i, n in enumerate(cuts)))
            part = _pick([n["part"] for n in cuts], F.col("node"))
            value = F.when(part == 0, dim).when(part == 1, F.col("tie")).otherwise(F.col("place"))
            lo, hi = (_pick([int(n[x][n["part"]]) for n in cuts], F.col("node")) for x in ("lo", "hi"))
            step = _pick([max(1, -(-(n["hi"][n["part"]] - n["lo"][n["part"]]) // BINS)) for n in cuts], F.col("node"))
            live = F.lit(False)
            for i, n in enumerate(cuts):
                if not n["done"]:
                    fixed = [F.col(c) == F.lit(v) for c, v in zip((n["dim"], "tie"), n["lo"][: n["part"]], strict=False)]
                    live = live | reduce(Column.__and__, fixed, F.col("node") == i)
            hist = at.filter(live).filter((value >= lo) & (value < hi)).groupBy("node", ((value - lo) - (value - lo) % step).alias("bin")).agg(F.sum("size").alias("mass"), F.count(F.lit(1)).alias("rows")).collect()
            for i, n in enumerate(cuts):
                if n["done"]:
                    continue
                p = n["part"]
                size = max(1, -(-(n["hi"][p] - n["lo"][p]) // BINS))
                for r in sorted((r for r in hist if r["node"] == i), key=lambda r: r["bin"]):
                    if n["before"] + r["mass"] > n["goal"]:
                        break
                    n["before"] += int(r["mass"])
                start = n["lo"][p] + int(r["bin"])
                near = r["mass"] <= tolerance * n["mass"] / n["k"]
                n["lo"][p], n["hi"][p] = start, start + size
                if near or r["rows"] == 1 or (p == 2 and size == 1):
                    # the bin goes where it leaves less of a difference
                    over = n["before"] + r["mass"] - n["goal"] < n["goal"] - n["before"]
                    n["lo"][p] = start + size if over else start
                    n["done"] = True
                elif size == 1:
                    n["part"] += 1
        move, fresh = node, []
        for i, n in enumerate(cuts):
            if n["k"] == 1:
                fresh.append({"first": n["first"], "k": 1})
                move = F.when(node == i, len(fresh) - 1) if i == 0 else move.when(node == i, len(fresh) - 1)
                continue
            x = F.col(n["dim"])
            left = F.lit(False)
            for c, v in reversed(list(zip((x, F.col("tie"), F.col("place")), n["lo"][: n["part"] + 1], strict=False))):
                left = (c < F.lit(v)) | ((c == F.lit(v)) & left)
            k = n["k"] // 2
            fresh += [{"first": n["first"], "k": k}, {"first": n["first"] + k, "k": n["k"] - k}]
            which = F.when(left, len(fresh) - 2).otherwise(len(fresh) - 1)
            move = F.when(node == i, which) if i == 0 else move.when(node == i, which)
            tree.append({"shards": (n["first"], n["k"]), "dim": n["dim"], "cut": n["lo"][0], "tie": n["lo"][1 : n["part"] + 1]})
        last, points = points, scratch.put(points.withColumn("node", move.cast("int")), "level")
        scratch.drop(last)
        node, nodes = F.col("node"), fresh
    return points, tree


def kd_shards(docs: DataFrame, scratch: Scratch, shards: int = 24, tolerance: float = 0.001, text: str = "text", doc_id: str = "doc_id", dims: dict[str, Column] | None = None, key: Column | None = None, block_rows: int = 50_000) -> DataFrame:
    """key (if given), doc_id, size, text_crc32, shard, slot for each row.

    size is the text's UTF-8 bytes plus 8; slots of a shard run from 0 without
    gaps, numbered in blocks of about ``block_rows`` rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    crc = F.crc32(body.cast("binary"))
    own = {"doc_id": F.col(doc_id), "size": (F.octet_length(body) + F.lit(8)).cast("long"), "text_crc32": crc, "tie": F.pmod(F.xxhash64(id_text(F.col(doc_id)), crc), F.lit(UNIT)), "place": F.monotonically_increasing_id()}
    if key is not None:
        own["key"] = key
    if dims is None:
        own |= {"d_length": log_size(F.length(text)), "source": F.col("source"), "lang": F.col("lang")}
    points = scratch.put(docs.select(*(c.alias(n) for n, c in (own | (dims or {})).items())), "points")
    if dims is None:
        dims, unnumbered = {"d_length": None}, points
        for c in ("source", "lang"):
            numbers = few(ordinals(points.select(c), scratch).withColumnsRenamed({"value": c, "number": f"d_{c}"}))
            points = points.join(numbers, c, "left").withColumn(f"d_{c}", F.coalesce(f"d_{c}", F.lit(0).cast("long"))).drop(c)
            dims[f"d_{c}"] = None
        points = scratch.put(points, "points")
        scratch.drop(unnumbered)
    total = points.count()
    placed, _ = plan_tree(points, scratch, list(dims), shards, tolerance)
    blocks = max(8, -(-total // (shards * block_rows)))
    placed = placed.select(*(["key"] if key is not None else []), "doc_id", "size", "text_crc32", "tie", F.col("node").cast("int").alias("shard"), F.floor(F.col("tie") / F.lit(-(-UNIT // blocks))).cast("int").alias("block"))
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("shard", "block", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "block").orderBy("tie", "doc_id", "size")) - 1
    out = placed.withColumn("own", own).join(counts, ["shard", "block"])
    return out.select(*(["key"] if key is not None else []), "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("own")).cast("long").alias("slot"))


def sharded_documents(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """docs with the columns shard and slot. Rows are told apart by their place
    in the scan, so docs must be a table that was read."""
    key, shard, slot = (free_name(docs, n) for n in ("__place", "shard", "slot"))
    placed = docs.withColumn(key, F.monotonically_increasing_id())
    got = kd_shards(placed, scratch, key=F.col(key), **options)
    got = scratch.put(got.select(F.col("key").alias(key), F.col("shard").alias(shard), F.col("slot").alias(slot)), "placed")
    # texts are shuffled only where there are too many rows to send
    return placed.join(few(got), key).drop(key)
