"""Exact repeated substrings by prefix-free parsing.

Texts are parsed where a rolling hash triggers: at every position whose 50-byte
hash is the least of some 151 in a row, so that each string of ``length`` (200)
bytes holds a trigger, and equal strings hold it at the same place. The strings
(windows) that share a trigger are a phrase, which overlaps its neighbours by a
window less one byte; so a string of ``length`` never goes beyond its phrase, and
of the parse's suffix array only the order of its first symbols is needed: the
count of each phrase. Phrases are told apart by the hash of the bytes at the
trigger (core) and 128 bits of hash of all their bytes.

* A core that occurs once makes all its phrase's windows unique.
* A phrase that occurs twice makes all of them repeated.
* What is left is the dictionary: distinct phrases whose core others have too.
  Two suffix arrays of it are sorted, on bytes: of the suffixes from the trigger
  on, and of the reversed prefixes before it. A window that starts o bytes before
  its trigger lies in one run of the first to depth ``length`` - o and in one run
  of the second to depth o; windows that share both runs are equal, and no other.

Dictionary entries are dealt by core, as equal windows share it, and many cores
are sorted together. Cores with more than ``hot`` entries aren't brought into one
task: their windows are grouped by 64-bit hashes, dealt by Spark, in blocks of
16 by the same two rules and then one by one.

Defined cases: a null or empty text has no bytes; texts shorter than the length
have no window; repeated rows repeat each other whole; ids may be null, repeat or
be of any type; bytes are judged on the input; an empty table gives an empty
result; a long text is parsed in pieces of 2 MB that share a window's bytes;
columns other than id and text aren't read. In a run of one byte each window is
a phrase of its own, as each has its own least place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import Scratch, id_text, row_type, text_parts

CORE = 50
BLOCK = 16
PIECE = 1 << 21
HOT = 20_000
PHRASES = T.ArrayType(row_type(s0="int", m="int", core="long", ctx="long", ctx2="long"))
ENTRIES = T.ArrayType(row_type(s0="int", m="int", dt="int", body="binary"))
CLEANED = row_type(n_bytes="long", n_removed="long", n_spans="long", kept_sha256="string")
_LOW = np.uint64((1 << 22) - 1)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        v, have = np.minimum(v[:-have], v[have:]), 2 * have
    return np.minimum(v[: len(v) - (width - have)], v[width - have :]) if have < width else v


def parse(data: np.ndarray, offs: np.ndarray, length: int):
    """Phrases: row, first window, last window, trigger (all in data), prefix
    sums and the cores' hashes. data has less than 2**22 bytes."""
    width = length - CORE + 1
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, None, np.zeros(0, np.uint64)
    sums = K.prefix(data)
    at = np.arange(len(data) - CORE + 1)
    core = K.ranges(sums, at, at + CORE)
    least = sliding_min((core & ~_LOW) | (_LOW - at.astype(np.uint64)), width)
    trigger = (_LOW - (least & _LOW)).astype(np.int64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(least)]
    start = np.flatnonzero(at[: len(least)] + length <= offs[row + 1])
    if not len(start):
        return empty, empty, empty, empty, None, np.zeros(0, np.uint64)
    t = trigger[start]
    new = np.ones(len(start), bool)
    new[1:] = (t[1:] != t[:-1]) | (start[1:] != start[:-1] + 1)
    a = np.flatnonzero(new)
    first, last = start[a], start[np.append(a[1:], len(start)) - 1]
    return row[first], first, last, t[a], sums, core[t[a]]


def pieces(arr: pa.Array, length: int):
    """First row, and data with row offsets, in parts that parse() takes. A
    longer text comes in pieces which share the bytes of a window."""
    for a, _, data, offs in text_parts(arr, PIECE):
        if len(data) <= PIECE:
            yield a, data, offs, 0
            continue
        for at in range(0, len(data), PIECE):
            cut = data[at : at + PIECE + length - 1]
            yield a, cut, np.array([0, len(cut)]), at


def phrases_udf(length: int):
    @F.arrow_udf(PHRASES)
    def phrases(text: pa.Array) -> pa.Array:
        rows, cols = [], []
        for a, data, offs, at in pieces(text, length):
            row, first, last, _, sums, core = parse(data, offs, length)
            if len(row):
                rows.append(row + a)
                other = K.ranges(K.prefix(data, 1), first, last + length, 1)
                cols.append((first - offs[row] + at, last - first + 1, core, K.ranges(sums, first, last + length), other))
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        s0, m, *hashes = (np.concatenate(x) for x in zip(*cols, strict=True)) if cols else [np.zeros(0, np.uint64)] * 5
        fields = [pa.array(s0.astype(np.int32)), pa.array(m.astype(np.int32)), *(pa.array(h.view(np.int64)) for h in hashes)]
        body = pa.StructArray.from_arrays(fields, ["s0", "m", "core", "ctx", "ctx2"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(text) + 1)).astype(np.int32)), body)

    return phrases


def entries_udf(length: int):
    @F.arrow_udf(ENTRIES)
    def entries(text: pa.Array, wanted: pa.Array) -> pa.Array:
        out: list[list[dict]] = [[] for _ in range(len(text))]
        asked = [set(x or ()) for x in wanted.to_pylist()]
        for a, data, offs, at in pieces(text, length):
            row, first, last, t, _, _ = parse(data, offs, length)
            for r, f, e, x in zip(row.tolist(), first.tolist(), last.tolist(), t.tolist(), strict=True):
                s0 = f - int(offs[r]) + at
                if s0 in asked[r + a]:
                    out[r + a].append({"s0": s0, "m": e - f + 1, "dt": x - f, "body": data[f : e + length].tobytes()})
        return pa.array(out, pa.list_(pa.struct([("s0", pa.int32()), ("m", pa.int32()), ("dt", pa.int32()), ("body", pa.binary())])))

    return entries


def _runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes, whose first four name their group, and how
    many bytes after these each has in common with the row before it."""
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")
    unlike = rows[order[1:]] != rows[order[:-1]]
    common = np.where(unlike.any(axis=1), unlike.argmax(axis=1), rows.shape[1]) - 4
    return order, np.append(-1, common)


def repeated_windows(group: np.ndarray, m: np.ndarray, dt: np.ndarray, data: np.ndarray, offs: np.ndarray, length: int) -> np.ndarray:
    """Entry by o: whether the window that starts o bytes before the entry's
    trigger is in another entry of its group too. Entries are bytes of data
    between offs, with m windows and the trigger at byte dt."""
    rows, most = len(m), length - CORE
    trigger = (offs[:-1] + dt)[:, None]
    name = group.astype(">u4").view(np.uint8).reshape(rows, 4)

    def side(at: np.ndarray) -> np.ndarray:
        inside = (at >= offs[:-1, None]) & (at < offs[1:, None])
        return np.hstack([name, np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0).astype(np.uint8)])

    right, right_common = _runs(side(trigger + np.arange(length)))
    left, left_common = _runs(side(trigger - 1 - np.arange(most)))
    found = np.zeros((rows, most + 1), bool)
    a, b = np.empty(rows, np.int64), np.empty(rows, np.int64)
    for o in range(most + 1):
        there = np.flatnonzero((dt >= o) & (dt - o < m))
        if len(there) < 2:
            continue
        a[right] = np.cumsum(right_common < length - o)
        b[left] = np.cumsum(left_common < o)
        _, back, count = np.unique(a[there] * (rows + 1) + b[there], return_inverse=True, return_counts=True)
        found[there, o] = count[back] > 1
    return found


def _suffixes(length: int, entries: int = 4000):
    """mapInArrow over entries sorted by core: spans of repeated windows. Whole
    cores are taken together, some ``entries`` at a time."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < entries:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            core = t["core"].to_numpy()
            apart = np.flatnonzero(core != core[-1])
            cut = int(apart[-1]) + 1 if len(apart) else 0
            at = 0
            while at < cut:  # batches may be larger than asked for
                end = _core_end(core, at + entries, cut) if cut - at > entries else cut
                yield spans(t.slice(at, end - at))
                at = end
            held = t.slice(cut).to_batches()
            size = t.num_rows - cut
        if size:
            yield spans(pa.Table.from_batches(held).combine_chunks())

    def spans(t: pa.Table) -> pa.RecordBatch:
        get = lambda c: t[c].to_numpy().astype(np.int64)
        s0, n, m, dt, core = (get(c) for c in ("s0", "n", "m", "dt", "core"))
        body = t["body"].combine_chunks().cast(pa.large_binary())
        offs = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(body) + 1]
        data = np.frombuffer(body.buffers()[2], np.uint8)[offs[0] : offs[-1]]
        group = np.cumsum(np.append(0, core[1:] != core[:-1]))
        found = repeated_windows(group, m, dt, data, offs - offs[0], length)
        found[n > 1] = False  # these are known to be repeated whole
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, near = np.nonzero(edge == 1)
        far = np.nonzero(edge == -1)[1] - 1  # the run of o from near to far
        lo, hi = s0[row] + dt[row] - far, s0[row] + dt[row] - near + length
        return pa.RecordBatch.from_arrays([t["key"].combine_chunks().take(pa.array(row)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["key", "lo", "hi"])

    return run


def _core_end(core: np.ndarray, at: int, end: int) -> int:
    """The first place from ``at`` on where another core begins."""
    other = np.flatnonzero(core[at:end] != core[at - 1])
    return at + int(other[0]) if len(other) else end


def _expand(length: int, step: int, chosen: bool):
    """mapInArrow: rows (key, s0, n, m, dt, body[, block]) to the blocks of
    ``step`` windows they hold, counted back from the trigger."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                yield one(batch.slice(at, 4000))

    def one(batch):
        get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        s0, n, m, dt = (get(c).astype(np.int64) for c in ("s0", "n", "m", "dt"))
        body = batch.column("body").cast(pa.large_binary())
        offs = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(body) + 1] if len(body) else np.zeros(1, np.int64)
        data = np.frombuffer(body.buffers()[2], np.uint8)[offs[0] : offs[-1]] if len(body) else np.zeros(0, np.uint8)
        offs = offs - offs[0]
        if chosen:  # windows of one block each
            j = get("block").astype(np.int64)
            lo, hi = np.maximum(0, dt - BLOCK * j - BLOCK + 1), np.minimum(m - 1, dt - BLOCK * j)
        else:
            lo, hi = np.zeros(len(m), np.int64), m - 1
        near, far = (dt - hi) // step, (dt - lo) // step
        count = np.maximum(0, far - near + 1)
        row = np.repeat(np.arange(len(m)), count)
        j = near[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        first = np.maximum(lo[row], dt[row] - step * j - step + 1)
        last = np.minimum(hi[row], dt[row] - step * j)
        sums = K.prefix(data)
        inner = offs[row] + dt[row] - step * j
        core = K.mix(K.ranges(sums, inner, inner + length - step + 1) + j.astype(np.uint64))
        ctx = K.ranges(sums, offs[row] + first, offs[row] + last + length) + (dt[row] - first).astype(np.uint64)
        key = batch.column("key").take(pa.array(row))
        return pa.RecordBatch.from_arrays([key, *(pa.array(x) for x in (s0[row], n[row], j, s0[row] + first, s0[row] + last, core.view(np.int64), ctx.view(np.int64)))], ["key", "s0", "n", "block", "lo", "hi", "core", "ctx"])

    return run


_SPANS = row_type(key="binary", lo="int", hi="int")
_BLOCKS = row_type(key="binary", s0="long", n="long", block="long", lo="long", hi="long", core="long", ctx="long")


def _cleaner():
    @F.arrow_udf(CLEANED)
    def clean(text: pa.Array, spans: pa.Array) -> pa.Array:
        n, removed, runs, digest = [], [], [], []
        asked = spans.to_pylist()
        for a, b, data, offs in text_parts(text):
            for i in range(b - a):
                body = data[offs[i] : offs[i + 1]]
                merged = union([(s["lo"], s["hi"]) for s in asked[a + i] or ()])
                sha, at = hashlib.sha256(), 0
                for lo, hi in merged:
                    sha.update(body[at:lo].tobytes())
                    at = hi
                sha.update(body[at:].tobytes())
                n.append(len(body))
                removed.append(sum(hi - lo for lo, hi in merged))
                runs.append(len(merged))
                digest.append(sha.hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())], CLEANED.names)

    return clean


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by 128 bits of its id and text; equal rows share it, and
    their fate."""
    body = F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(id_text(doc_id), F.lit("\0"), doc_id.isNull().cast("string"), text.isNull().cast("string"), body).cast("binary")))


def repeated_spans(keyed: DataFrame, scratch: Scratch, length: int = 200, hot: int = HOT) -> DataFrame:
    """(key, spans): the byte ranges [lo, hi) of (key, text) rows that repeated
    strings cover; they may overlap. Texts without any have no row. Keys that
    are joined to are written first, so that Spark can split the hot ones."""
    put = scratch.put
    phrase = ["core", "ctx", "ctx2"]
    phrases = put(keyed.select("key", F.explode(phrases_udf(length)("text")).alias("p")).select("key", "p.*"), "phrases")
    again = put(phrases.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core"), "again")
    shared = put(phrases.join(again, "core", "left_semi"), "shared")
    scratch.drop(phrases, again)
    contexts = put(shared.groupBy(*phrase).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "s0")).alias("rep")), "contexts")
    twice = put(contexts.filter("n > 1").select(*phrase), "twice")
    whole = shared.join(twice, phrase, "left_semi")
    spans = [put(whole.select("key", F.col("s0").alias("lo"), (F.col("s0") + F.col("m") - 1 + length).alias("hi")), "whole")]
    scratch.drop(shared, twice)
    # the dictionary: one place of each phrase whose core has several
    several = put(contexts.groupBy("core").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "several")
    places = put(contexts.join(several, "core").select("rep.key", "rep.s0", "n", "core", "k"), "places")
    scratch.drop(contexts, several)
    wanted = places.groupBy("key").agg(F.collect_list("s0").alias("wanted"))
    texts = keyed.join(wanted, "key").dropDuplicates(["key"])
    found = texts.select("key", F.explode(entries_udf(length)("text", "wanted")).alias("e")).select("key", "e.*")
    words = put(found.join(places, ["key", "s0"]).select("key", "s0", "n", "m", "dt", "body", "core", "k"), "dictionary")
    scratch.drop(places)
    cold = words.filter(F.col("k") <= hot).drop("k").repartition("core").sortWithinPartitions("core")
    spans.append(put(cold.mapInArrow(_suffixes(length), _SPANS), "suffixes"))
    large = words.filter(F.col("k") > hot).drop("core", "k")
    if large.take(1):
        spans += _by_hash(large, scratch, length)
    every = spans[0]
    for x in spans[1:]:
        every = every.unionByName(x)
    out = put(every.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")
    scratch.drop(words, *(x for x in spans[:2]))
    return out


def _by_hash(words: DataFrame, scratch: Scratch, length: int) -> list[DataFrame]:
    """Spans of repeated windows of entries whose cores are hot."""
    put = scratch.put
    blocks = put(words.mapInArrow(_expand(length, BLOCK, False), _BLOCKS), "blocks")
    kinds = put(blocks.groupBy("core", "ctx").agg(F.sum("n").alias("total"), F.min(F.struct("key", "s0", "block")).alias("rep")), "kinds")
    found = [_matched(blocks, kinds, length)]
    mixed = put(kinds.groupBy("core").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("core"), "mixed")
    left = kinds.join(mixed, "core", "left_semi").select("rep.key", "rep.s0", "rep.block", "total")
    windows = words.drop("n").join(left, ["key", "s0"]).select("key", "s0", F.col("total").alias("n"), "m", "dt", "body", "block")
    windows = put(windows.mapInArrow(_expand(length, 1, True), _BLOCKS), "windows")
    return [*found, _matched(windows, windows.groupBy("core", "ctx").agg(F.sum("n").alias("total")), length)]


def _matched(blocks: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """Ranges of blocks that occur more than once. Blocks of contexts that do
    are known already."""
    twice = kinds.filter("total > 1").select("core", "ctx")
    own = blocks.filter("n = 1").join(twice, ["core", "ctx"], "left_semi")
    return own.select("key", F.col("lo").cast("int").alias("lo"), (F.col("hi") + length).cast("int").alias("hi"))


def remove_repeats(docs: DataFrame, scratch: Scratch, length: int = 200, text: str = "text", doc_id: str = "doc_id", hot: int = HOT) -> DataFrame:
    """doc_id, spans, and the counts and digest of what is left, for each row."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), row_key(F.col(doc_id), F.col(text)).alias("key"))
    spans = repeated_spans(keyed.select("key", "text"), scratch, length, hot)
    out = keyed.join(spans, "key", "left")
    return out.select("doc_id", "spans", _cleaner()("text", "spans").alias("c")).select("doc_id", "spans", "c.*")
