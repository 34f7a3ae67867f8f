"""Mixing sources to target weights by Pareto order sampling (DataFrame only).

Every document of a source has the same expected number of copies, unless an
importance column says otherwise. The whole part of it is taken for certain;
the fraction is the inclusion probability p of a Pareto sample: documents are
ranked by (u / (1 - u)) / (p / (1 - p)), u a hash of the id and the seed, and
the first ones are taken until the source's words are used up. The sample's
fixed size is counted in words: a first pass takes the longest prefix of the
ranking that fits, later passes fill what is left from the documents behind it
that still fit.

Prefix sums run over 4096 bins of the rank in each source (bin sums are added
up before they are shuffled) and over the rows of a bin, so no source is ever
sorted in one task. Only ids, sizes and ranks are shuffled, never texts.

Defined cases: a null text has size 0 and is never taken (0 words); a null
source is a source, last in order; repeated rows are ranked alike and counted
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, Scratch, few, free_name, id_text

BINS = 4096
PASSES = 5


def unit_hash(c: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 13 hex digits of the md5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), id_text(c)).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """One row per source: source, source_size, target.

    The total is shared by weight; a source's target stops at ``cap`` times its
    size and the excess is shared again by weight: target = min(cap * size,
    level * weight). Sources are ordered by code point, null last. The window
    over all sources holds one row per source, not per document.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*(F.lit(x) for x in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = s.withColumn("w", w).withColumn("cap", F.lit(cap) * F.col("source_size"))
    # capped sources come first in the order of cap / w; the level is that of the first source which is not capped, the largest that fits
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest))
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))).over(every)
    return s.withColumn("level", level).select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def _take(rows: DataFrame) -> DataFrame:
    """Marks as picked the longest prefix, by rank, of the open rows that fit
    ``room`` (each row carries its source's), and takes their words off it."""
    fits = F.col("open") & (F.col("size") <= F.col("room"))
    rows = rows.withColumn("mass", F.when(fits, F.col("size")).otherwise(0))
    # dealt by source alone, as a join may have left them, a hot source is one task
    rows = rows.repartition("skey", "bin")
    hist = rows.groupBy("skey", "bin").agg(F.sum("mass").alias("bin_mass"))
    run = F.sum("bin_mass").over(Window.partitionBy("skey").orderBy("bin"))
    hist = hist.select("skey", "bin", (run - F.col("bin_mass")).alias("before"))
    own = F.sum("mass").over(Window.partitionBy("skey", "bin").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("own", own).join(hist, ["skey", "bin"])
    now = fits & (F.col("before") + F.col("own") <= F.col("room"))
    rows = rows.select(*[c for c in rows.columns if c not in ("own", "before", "mass", "open", "picked")], now.alias("now"), (F.col("picked") | now).alias("picked"), F.col("open").alias("was"))
    return rows


def _next(rows: DataFrame) -> DataFrame:
    used = rows.groupBy("skey").agg(F.sum(F.when(F.col("now"), F.col("size")).otherwise(0)).alias("used"))
    return rows.join(used, "skey").withColumn("room", F.col("room") - F.col("used")).withColumn("open", F.col("was") & ~F.col("now")).drop("used", "now", "was")


def mix(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: str = "mix", text: str = "text", source: str = "source", doc_id: str = "doc_id", importance: str | None = None, key: Column | None = None) -> DataFrame:
    """One row per row of docs: key (if given), doc_id, source, size,
    source_size, target, copies, taken.

    importance: a positive column; expected copies in a source are then in
    proportion to it, at most ``cap``. What that limit takes away goes to the
    documents next in rank.
    """
    cols = [F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), (F.col(importance).cast("double") if importance else F.lit(1.0)).alias("imp")]
    sizes = scratch.put(docs.select(*cols, *([key.alias("key")] if key is not None else [])), "sizes")
    sizes = sizes.withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    targets = source_targets(sizes, weights, cap).withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    if importance:
        targets = targets.join(sizes.groupBy("skey").agg(F.sum(F.col("imp") * F.col("size")).alias("imp_size")), "skey")
    else:
        targets = targets.withColumn("imp_size", F.col("source_size").cast("double"))
    targets = scratch.put(targets, "targets")
    mean = F.when(F.col("imp_size") > 0, F.least(F.col("target") / F.col("imp_size") * F.col("imp"), F.lit(float(cap)))).otherwise(0.0)
    rows = sizes.join(targets, "skey").withColumn("mean", mean).withColumn("whole", F.floor("mean"))
    p = F.col("mean") - F.col("whole")
    u = unit_hash(F.col("doc_id"), seed)
    odds = F.when(p > 0, u / (1 - u) * ((1 - p) / p))
    # rows that aren't sampled take part in no sum; their bins only spread them
    place = F.coalesce(F.floor(odds / (1 + odds) * BINS), BINS + F.floor(u * BINS))
    rows = rows.withColumn("rank", odds).withColumn("open", F.col("rank").isNotNull()).withColumn("bin", place.cast("int"))
    certain = rows.groupBy("skey").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    rows = rows.join(certain, "skey").withColumn("room", F.col("target") - F.col("certain")).withColumn("picked", F.lit(False)).drop("certain", "mean", "imp", "imp_size")
    for n in range(PASSES):
        rows = scratch.put(_take(rows), f"pass{n}")
        if n < PASSES - 1:
            rows = _next(rows)
    copies = (F.col("whole") + F.col("picked").cast("int")).cast("long")
    return rows.select(*(["key"] if key is not None else []), "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken.

    Rows are told apart by their place in the scan, so docs must be a table
    that was read, not one that changes its order when computed again."""
    key = free_name(docs, "__place")
    while {key + "n", key + "i"} & set(docs.columns):
        key += "_"
    placed = docs.withColumn(key, F.monotonically_increasing_id())
    got = mix(placed, scratch, key=F.col(key), **options).filter("copies > 0").select(F.col("key").alias(key), F.col("copies").alias(key + "n"))
    # texts are shuffled only where there are too many rows to send
    return placed.join(few(scratch.put(got, "taken")), key).withColumn(key + "i", F.explode(F.sequence(F.lit(1).cast("long"), F.col(key + "n")))).drop(key, key + "n", key + "i")
