"""Near-duplicates: MinHash bands, odd sketches, exact confirmation.

1. Every text gets 128 MinHash values of its set of word shingles, folded into
   32 band keys and one odd sketch: a parity bitmap of 512 bits, in which the
   bits that differ between two sketches count the samples that differ. A second
   odd sketch, of 2048 bits, takes the whole set: two of them never differ in
   more bits than the sets do in shingles, so that it leaves no link out.
2. Texts with equal sets form a class. Classes that share a band key are
   candidates: a pair of similarity 0.8 is missed by all bands with a
   probability of about 5e-8.
3. Each class is first held against the leaders of its buckets (the member
   that shares most buckets with most others, as the least edited copy does);
   confirmed links give components.
4. In buckets that still hold several components, each class outside the
   bucket's largest component is held against all classes of other components
   by both sketches, and only pairs that pass leave and are confirmed on full
   sets. A bucket of more than ``bucket_rows`` classes is dealt into cells of that
   many, each of which meets every other that it must: no partner is capped.

Only ids, keys and sketches are shuffled; full sets are made for the classes of
pairs that both sketches let pass.

Defined cases: a text without words (or null) has an empty set and links with
nothing; one with fewer words than a shingle is one shingle; ids may be of any
type that sorts; a null id is never a component's id, and its row is kept only
if its component has no id; rows that share an id are one document
(``deduplicated`` goes by row instead); repeated rows are one class; of leaders
that tie the smallest id leads; an empty table gives an empty result; other
columns aren't read. A text's words are hashed in pieces of 1 MB, its set takes
about 40 bytes a word.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import PIECE, Scratch, few, free_name, row_type, text_parts
from .components import connected

SAMPLES, BANDS, BITS, FINE = 128, 32, 512, 2048
SIGNATURE = row_type(n="long", set1="long", set2="long", bands="long[]", sketch="long[]", fine="long[]")
_rng = np.random.default_rng(77)
_XOR = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)[:, None]
_MUL = (_rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_SEAT = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)
_ROWS = SAMPLES // BANDS
_BAND = K.mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))


def shingle_sets(arr: pa.Array, size: int):
    """Row number and sorted distinct shingle hashes of each text with words."""
    for a, b, data, offs in text_parts(arr, PIECE):
        h, first = K.word_hashes(K.LOWER[data], offs)
        windows = K.word_windows(h, size)
        for i in range(b - a):
            n = first[i + 1] - first[i]
            if n >= size:
                s = np.sort(windows[first[i] : first[i + 1] - size + 1])
                yield a + i, s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif n:
                yield a + i, K.word_windows(h[first[i] : first[i + 1]], int(n))


def parity(hashes: np.ndarray) -> np.ndarray:
    """Odd sketch of a whole set."""
    odd = np.bincount((hashes & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def minhash(hashes: np.ndarray) -> np.ndarray:
    low = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    x = (hashes >> np.uint64(16)).astype(np.uint32)
    for i in range(0, len(x), 4096):
        np.minimum(low, ((x[i : i + 4096] ^ _XOR) * _MUL).min(axis=1), out=low)
    return low


def signature_of(sets, rows: int) -> pa.Array:
    n = np.zeros(rows, np.int64)
    set1, set2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    low = np.zeros((rows, SAMPLES), np.uint32)
    fine = np.zeros((rows, FINE // 64), np.int64)
    for i, s in sets:
        n[i], set1[i], set2[i], fine[i] = len(s), s.sum(), K.mix(s ^ K.BYTE[1][7]).sum(), parity(s)
        low[i] = minhash(s)
    has = n > 0
    part = low.reshape(rows, BANDS, _ROWS).astype(np.uint64)
    keys = np.broadcast_to(_BAND, (rows, BANDS))
    for j in range(_ROWS):
        keys = K.mix(keys + part[:, :, j])
    bit = K.mix(low.astype(np.uint64) | _SEAT) % np.uint64(BITS)
    odd = np.zeros((rows, BITS), np.uint8)
    np.add.at(odd, (np.arange(rows)[:, None], bit.astype(np.int64)), 1)
    sketch = np.packbits(odd & 1, axis=1).view(np.int64)
    fixed = lambda m, k: pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(m).view(np.int64).ravel()), k).cast(pa.list_(pa.int64()))
    cols = [pa.array(n), pa.array(set1.view(np.int64)), pa.array(set2.view(np.int64)), fixed(keys, BANDS), fixed(sketch, BITS // 64), fixed(fine, FINE // 64)]
    return pa.StructArray.from_arrays(cols, SIGNATURE.names, mask=pa.array(~has))


def signature_udf(size: int):
    @F.arrow_udf(SIGNATURE)
    def signature(text: pa.Array) -> pa.Array:
        parts = [signature_of(((i, s) for i, s in shingle_sets(text.slice(a, 2000), size)), min(2000, len(text) - a)) for a in range(0, len(text), 2000)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([]))

    return signature


def set_udf(size: int):
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def full_set(text: pa.Array) -> pa.Array:
        sizes, sets = np.zeros(len(text) + 1, np.int32), []
        for i, s in shingle_sets(text, size):
            sizes[i + 1] = len(s)
            sets.append(s)
        values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(values))

    return full_set


def differing_bits(a: str, b: str) -> Column:
    """Bits that differ in two sketches of the samples."""
    out = F.lit(0)
    for i in range(BITS // 64):
        out = out + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return out


def bit_limit(similarity: float, errors: float = 5.0) -> int:
    """Sketches of pairs at the similarity differ in fewer bits than this:
    ``errors`` standard deviations above the mean. The variance is that of the
    samples that differ, each of which puts in two signs, and of folding."""
    differ = 2 * SAMPLES * (1 - similarity)
    keep = math.exp(-2 * differ / BITS)
    mean = BITS / 2 * (1 - keep)
    sampling = (keep * 2) ** 2 * SAMPLES * similarity * (1 - similarity)
    folding = BITS / 4 * (1 - keep * keep) - keep * keep * differ
    return math.ceil(mean + errors * math.sqrt(sampling + max(0.0, folding)))


def judge(t: pa.Table, percent: int, limit: int) -> pa.Table:
    """The pairs (a, b) of each cell that sizes and both sketches allow. Rows of
    a cell stand together; ``asks`` and ``told`` are a row's parts in it."""
    get = lambda c: t[c].to_numpy(zero_copy_only=False)
    longs = lambda c, k: np.ascontiguousarray(t[c].combine_chunks().flatten().to_numpy()).view(np.uint64).reshape(-1, k)
    cell = np.stack([get("key"), get("i"), get("j")])
    cut = np.append(np.flatnonzero(np.append(True, (cell[:, 1:] != cell[:, :-1]).any(axis=0))), t.num_rows)
    asks, told, looks, n, name = get("asks"), get("told"), get("looks"), get("n"), get("name")
    label = t["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    sketch, fine = longs("sketch", BITS // 64), longs("fine", FINE // 64)
    found = [np.zeros((2, 0), np.int64)]
    for begin, end in zip(cut[:-1], cut[1:], strict=True):
        mine, theirs = begin + np.flatnonzero(asks[begin:end]), begin + np.flatnonzero(told[begin:end])
        step = max(1, 400_000 // max(1, len(theirs)))
        for at in range(0, len(mine), step):
            x, y = mine[at : at + step, None], theirs[None]
            # of two that both look, one asks
            fits = (label[x] != label[y]) & (~looks[y] | (name[x] <= name[y]))
            fits &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
            p, q = np.nonzero(fits)
            p, q = mine[at + p], theirs[q]
            near = np.bitwise_count(sketch[p] ^ sketch[q]).sum(axis=1) <= limit
            p, q = p[near], q[near]
            whole = np.bitwise_count(fine[p] ^ fine[q]).sum(axis=1, dtype=np.int64)
            near = (100 + percent) * whole <= (100 - percent) * (n[p] + n[q])
            found.append(np.stack([p[near], q[near]]))
    pairs = np.concatenate(found, axis=1)
    return pa.table({"a": t["node"].take(pa.array(pairs[0])), "b": t["node"].take(pa.array(pairs[1]))})


def judge_cells(percent: int, limit: int):
    """mapInArrow over sorted cells; one that a batch leaves open goes on in the
    next (a cell holds ``bucket_rows`` of either part at most)."""
    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            if not t.num_rows:
                continue
            cell = np.stack([t[c].to_numpy() for c in ("key", "i", "j")])
            last = int(np.flatnonzero((cell != cell[:, -1:]).any(axis=0))[-1]) + 1 if (cell != cell[:, -1:]).any() else 0
            if last:
                yield from judge(t.slice(0, last), percent, limit).to_batches()
            held = t.slice(last)
        if held is not None:
            yield from judge(held, percent, limit).to_batches()

    return run


class Linker:
    """Candidate classes, their sets and the links confirmed so far."""

    def __init__(self, docs: DataFrame, scratch: Scratch, doc_id: str, text: str, size: int, percent: int, bucket_rows: int):
        self.docs, self.scratch, self.size, self.percent, self.bucket_rows = docs, scratch, size, percent, bucket_rows
        self.doc_id, self.text = doc_id, text
        self.limit = bit_limit(percent / 100)

    def run(self, classes: DataFrame) -> DataFrame:
        """Labels (node, label) of linked classes (node, n, bands, sketch, fine)."""
        put = self.scratch.put
        rows = classes.select("node", F.explode("bands").alias("key"))
        buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
        members = put(rows.join(buckets, "key"), "members")
        # a class amid its group shares the most buckets with the most others; it leads those it is in
        weight = members.groupBy("node").agg(F.sum("rows").alias("weight"))
        weighed = members.join(weight, "node")
        leaders = weighed.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("minus"), "node")).alias("top")).select("key", F.col("top.node").alias("leader"))
        buckets = put(members.select("key", "node").join(leaders, "key"), "buckets")
        # only what shares a bucket goes on
        held = put(classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "n", "sketch", "fine"), "held")
        self.scratch.drop(members)
        first = self._prune(buckets.filter("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), held)
        links = self._confirm(first)
        labels = connected(links, self.scratch)
        more = self._confirm(self._between(buckets.select("key", "node"), labels, held))
        if more.take(1):
            labels = connected(links.unionByName(more), self.scratch)
        self.scratch.drop(buckets, held)
        return labels

    def _prune(self, pairs: DataFrame, held: DataFrame) -> DataFrame:
        """Pairs whose sizes and first sketches allow the similarity."""
        side = lambda x: held.select(F.col("node").alias(x), F.col("n").alias("n" + x), F.col("sketch").alias("s" + x))
        sizes = 100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb")
        near = differing_bits("sa", "sb") <= self.limit
        return pairs.join(side("a"), "a").join(side("b"), "b").filter(sizes & near).select("a", "b")

    def _confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets have the similarity."""
        pairs = self.scratch.put(pairs.distinct(), "pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        nodes = self.scratch.put(nodes, "nodes")
        one = self.docs.select(F.col(self.doc_id).alias("node"), F.col(self.text).alias("body"))
        # the text is shuffled only where there are too many ids to send
        sets = one.join(few(nodes), "node", "left_semi").select("node", set_udf(self.size)("body").alias("set")).filter(F.size("set") > 0)
        sets = self.scratch.put(sets, "sets")
        side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias("s" + x))
        p = pairs.join(side("a"), "a").join(side("b"), "b")
        both = F.size(F.array_intersect("sa", "sb"))
        links = self.scratch.put(p.filter(100 * both >= self.percent * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct(), "links")
        self.scratch.drop(pairs, nodes, sets)
        return links

    def _between(self, rows: DataFrame, labels: DataFrame, held: DataFrame) -> DataFrame:
        """Pairs of classes in one bucket but in different components which the
        sketches allow. Only those outside the bucket's largest component look
        for others. Lookers fall into g parts, the largest component into h (or
        among the former, in a small bucket); cell (i, j) is where the lookers
        of part i meet part j."""
        named = rows.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
        sizes = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("rows"))
        stat = sizes.groupBy("key").agg(F.sum("rows").alias("rows"), F.max(F.struct("rows", "label")).alias("top")).filter("rows > top.rows")
        parts = lambda n: F.ceil(n / F.lit(self.bucket_rows)).cast("int")
        inner = F.when(F.col("rows") > self.bucket_rows, parts(F.col("top.rows"))).otherwise(0)
        stat = stat.select("key", F.col("top.label").alias("largest"), parts(F.col("rows") - F.col("top.rows")).alias("g"), inner.alias("h"))
        here = named.join(stat, "key").join(held, "node").withColumn("looks", F.col("label") != F.col("largest"))
        name = F.xxhash64("node")
        within = F.pmod(name, F.when(F.col("looks") | (F.col("h") == 0), F.col("g")).otherwise(F.col("h"))).cast("int")
        here = here.withColumn("name", name).withColumn("own", F.when(F.col("looks") | (F.col("h") == 0), within).otherwise(F.col("g") + within))
        cell = lambda i, j, asks, told: F.struct(i.alias("i"), j.alias("j"), asks.alias("asks"), told.alias("told"))
        own, looks = F.col("own"), F.col("looks")
        asking = F.transform(F.sequence(F.lit(0), F.col("g") + F.col("h") - 1), lambda j: cell(own, j, F.lit(True), j == own))
        told = F.transform(F.filter(F.sequence(F.lit(0), F.col("g") - 1), lambda i: ~looks | (i != own)), lambda i: cell(i, own, F.lit(False), F.lit(True)))
        cells = F.when(looks, F.concat(asking, told)).otherwise(told)
        here = here.select("key", F.inline(cells), "node", "name", "label", "looks", "n", "sketch", "fine")
        here = here.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        kind = T.StructType([T.StructField(c, here.schema["node"].dataType) for c in "ab"])
        pairs = here.mapInArrow(judge_cells(self.percent, self.limit), kind)
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, scratch: Scratch, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id", key: Column | None = None, bucket_rows: int = 4000) -> DataFrame:
    """key (if given), doc_id, n_shingles, component_id, kept for each row."""
    own = ["key"] if key is not None else []
    cols = [F.col(doc_id).alias("doc_id"), *([key.alias("key")] if own else [])]
    sig = docs.select(*cols, signature_udf(size)(F.col(text)).alias("s"))
    sig = scratch.put(sig.select(*own, "doc_id", F.coalesce("s.n", F.lit(0)).alias("n"), "s.set1", "s.set2", "s.bands", "s.sketch", "s.fine"), "signatures")
    like = F.any_value(F.struct("bands", "sketch", "fine")).alias("like")
    classes = sig.filter("n > 0 and doc_id is not null").groupBy("set1", "set2", "n").agg(F.min("doc_id").alias("node"), like)
    classes = scratch.put(classes.select("set1", "set2", "n", "node", "like.*"), "classes")
    # from here on the rows' sketches aren't needed
    rows = scratch.put(sig.drop("bands", "sketch", "fine"), "rows")
    scratch.drop(sig)
    labels = Linker(docs, scratch, doc_id, text, size, percent, bucket_rows).run(classes.select("node", "n", "bands", "sketch", "fine"))
    named = classes.select("set1", "set2", "n", "node").join(labels, "node", "left").select("set1", "set2", "n", F.coalesce("label", "node").alias("component"))
    out = rows.join(named, ["set1", "set2", "n"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select(*own, "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def deduplicated(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", **options) -> DataFrame:
    """docs with one row of each component of near-duplicate rows, whatever
    their ids: that of the smallest id, the first in the table among rows that
    share it; null ids come last. Rows without words all stay."""
    place = free_name(docs, "__place")
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    # rows are linked by place, and their ids pass by
    found = near_duplicates(placed, scratch, doc_id=place, key=F.col(doc_id), **options).withColumnsRenamed({"doc_id": "place", "key": "id"})
    found = scratch.put(found.select("id", "place", "component_id"), "found")
    best = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct(F.col("id").isNull().alias("x"), "id", "place")).alias("best"))
    groups = best.filter("rows > 1").select("component_id", F.col("best.place").alias("stays"))
    gone = scratch.put(found.join(groups, "component_id").filter("place != stays").select(F.col("place").alias(place)), "gone")
    return placed.join(few(gone), place, "left_anti").drop(place)
