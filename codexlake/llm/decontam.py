"""Benchmark decontamination by a prefix-filtered set join.

An item gives windows of ``window`` consecutive words (a shorter item is one
window). The tokens of a window are its words, ordered by rarity: the number of
documents that hold them, counted over the whole corpus. A window that must be
contained whole has to match in every token, so its necessary prefix is its
rarest token alone. A document word that is such a token is joined to the
windows that have it, with its offset in them: the positional bound puts the
window's start at that offset before the word, the length bound keeps it inside
the document. What is left is verified word by word over the window's extent.

The windows travel to the executors in blocks of at most ``block_windows``, so
what is sent is bounded; a larger benchmark takes one more pass per block.

Defined cases: a null text has no words and no hits; an item without words has
no window; an item without id marks words but isn't counted; items that share
an id count once; repeated documents are each reported; no items or an empty
table leave everything clean; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, row_type

#: Lower-cases A-Z and turns every other ASCII byte that is no digit or letter into a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
HITS = row_type(n_words="long", spans="long[]", items="string[]")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def _bytes(arr: pa.Array) -> pa.Array:
    return arr.cast(pa.binary() if pa.types.is_string(arr.type) else pa.large_binary())


def document_frequency(docs: DataFrame, text: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How many documents hold each word of the vocabulary (bounded by the
    block); whole texts of all documents are counted."""
    def count(batches):
        held: dict[bytes, int] = {}
        for batch in batches:
            for x in _bytes(batch.column(0)).to_pylist():
                for w in vocabulary.intersection(words_of(x)):
                    held[w] = held.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    found = docs.select(text).mapInArrow(count, row_type(word="binary", n="long")).groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in found.toLocalIterator()}


class Block:
    """The windows of some items, under their rarest word."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], size: int, frequency: Callable[[bytes], int]):
        self.windows: dict[tuple[bytes, ...], list[str]] = {}
        for name, words in items:
            for w in windows_of(words, size):
                ids = self.windows.setdefault(w, [])
                if name is not None and name not in ids:
                    ids.append(name)
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for w in self.windows:
            rarest = min(range(len(w)), key=lambda i: (frequency(w[i]), w[i], i))
            places = self.prefix.setdefault(w[rarest], [])
            if (rarest, len(w)) not in places:
                places.append((rarest, len(w)))

    def find(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Start and end of the merged hit spans, and the items found."""
        prefix, windows, n = self.prefix, self.windows, len(words)
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for i in [i for i, w in enumerate(words) if w in prefix]:
            for offset, length in prefix[words[i]]:
                a = i - offset
                if a >= 0 and a + length <= n and (ids := windows.get(tuple(words[a : a + length]))) is not None:
                    spans.append((a, a + length))
                    items.update(ids)
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _scanner(block):
    @F.arrow_udf(HITS)
    def scan(text: pa.Array, had: pa.Array) -> pa.Array:
        n, spans, items = [], [], []
        for x, old in zip(_bytes(text).to_pylist(), had.to_pylist(), strict=True):
            words = words_of(x)
            s, found = block.value.find(words)
            if old and old["spans"]:
                s = merged(list(zip(old["spans"][::2], old["spans"][1::2], strict=True)) + list(zip(s[::2], s[1::2], strict=True)))
            n.append(len(words))
            spans.append(s)
            items.append(sorted(found | set((old or {}).get("items") or ())))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], ["n_words", "spans", "items"])

    return scan


def find_contamination(docs: DataFrame, items: DataFrame, scratch: Scratch, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_windows: int = 200_000, into: str = "contamination") -> DataFrame:
    """docs with a struct column ``into`` (underscores are added to the name while
    docs has it): n_words, spans (start and end word of each merged hit, in turn)
    and items (sorted ids as text)."""
    into = free_name(docs, into)
    spark = docs.sparkSession
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("t")).orderBy("id", "t").toLocalIterator()
    out = docs.withColumn(into, F.lit(None).cast(HITS))
    first = True

    def blocks():
        have, n = [], 0
        for r in rows:
            w = words_of((r["t"] or "").encode())
            # an item longer than a block is dealt over several, overlapping by a window less one
            for part in batched(range(max(1, len(w) - window + 1)), block_windows):
                if w:
                    have.append((r["id"], w[part[0] : part[-1] + window]))
                    n += len(part)
                if n >= block_windows:
                    yield have
                    have, n = [], 0
        if have or first:
            yield have

    for have in blocks():
        if not first:
            out = scratch.put(out, "hits")
        first = False
        frequency = document_frequency(docs, text, frozenset(w for _, ws in have for w in ws)) if have else {}
        block = spark.sparkContext.broadcast(Block(have, window, lambda w, f=frequency: f.get(w, 0)))
        out = out.withColumn(into, _scanner(block)(F.col(text), F.col(into)))
    return out


def n_hit(spans):
    """Hit words of a column of spans."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda total, x: total + x)
