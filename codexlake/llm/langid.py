"""Language identification by rank-order profiles.

A text's letters are lower-cased and its words padded with a blank; runs of one
to three signs are its n-grams. A language's profile is its ``size`` most
frequent n-grams in all learning texts, in order. A text is given the language
whose profile is nearest by out-of-place distance: the sum, over the text's
``size`` most frequent n-grams, of the places between the two ranks, or
``size`` if the profile lacks the n-gram. N-grams are told apart by their code
points, exactly.

Texts are counted in tables of at most some four million cells (texts by n-grams
that occur in them), so memory is bounded but for one text's own n-grams.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
ranks tie by the n-gram's code, distances by the language's name; a text with
none of the known n-grams gets the first language with score 0; texts without a
language aren't learnt from; with nothing to learn from every text is ``und``; an
empty table gives an empty result; repeated rows are predicted alike; other
columns, whatever their names, pass by.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import row_type, text_parts

SLOTS = 1 << 20
CELLS = 1 << 22
GUESS = row_type(lang="string", score="double")
_SALTS = 32


@cache
def _letters() -> np.ndarray:
    """Each code point's lower-case letter, 0 for all that are no letters."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and code of each n-gram, and whether a row has a letter. A code holds
    the signs' code points, 21 bits each (0 is the blank), and the length."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offs]
    x = _letters()[np.minimum(points, 0x10FFFF)]
    letter = x > 0
    lettered = np.diff(np.concatenate(([0], np.cumsum(letter)))[heads]) > 0
    # keep letters, and one blank after each word; a text's end also ends a word
    last = np.zeros(len(x), bool)
    last[:-1] = letter[:-1] & ~letter[1:]
    ends = heads[1:][(heads[1:] > heads[:-1])] - 1
    last[ends] |= letter[ends]
    row = np.repeat(np.arange(len(offs) - 1), np.diff(heads))
    at = np.flatnonzero(letter)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), lettered
    place = np.arange(len(at)) + np.concatenate(([0], np.cumsum(last[at])))[:-1]
    n = int(place[-1]) + 2
    s, of = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.int64)
    s[1 + place], of[1 + place] = x[at], row[at]  # s[0] and every word's end are blanks
    a, b, c = s[:-2], s[1:-1], s[2:]
    mid = b > 0
    tail = mid & (c == 0)
    one, wide = np.uint64(21), np.uint64(42)
    two = (a << one | b | np.uint64(1) << wide)[mid]
    back = (b << one | np.uint64(1) << wide)[tail]
    three = (a << wide | b << one | c | np.uint64(1 << 63))[mid]
    rows = of[1:-1][mid]
    return np.concatenate((rows, rows, of[1:-1][tail], rows)), np.concatenate((b[mid], two, back, three)), lettered


def numbered(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, sorted, and each code's number among them. Codes that
    share a slot of a table with others are looked up by search."""
    h = ((codes ^ (codes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
    slot = np.zeros(SLOTS, np.uint64)
    slot[h] = codes
    rest = np.flatnonzero(slot[h] != codes)
    held = np.zeros(SLOTS, bool)
    held[h] = True
    known = np.unique(np.concatenate((slot[held], codes[rest])))
    number = np.zeros(SLOTS, np.int32)
    number[held] = np.searchsorted(known, slot[held])
    out = number[h]
    out[rest] = np.searchsorted(known, codes[rest])
    return known, out


def gram_counts(docs: DataFrame, lang: str, text: str, most: int = 500_000) -> DataFrame:
    """(lang, gram, n) over all rows, summed in each partition first."""
    def count(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts):
            known, number = numbered(np.concatenate([k for k, _ in parts]))
            return known, np.bincount(number, np.concatenate([n for _, n in parts]), len(known)).astype(np.int64)

        def rows():
            for name, parts in held.items():
                known, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(known), pa.string()), pa.array(known.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            names = batch.column(0).cast(pa.string())
            for name in names.unique().to_pylist():
                own = batch.column(1).filter(pa.compute.equal(names, name))
                for _, _, data, offs in text_parts(own, 1 << 21):
                    known, number = numbered(grams(data, offs)[1])
                    held.setdefault(name, []).append((known, np.bincount(number, minlength=len(known))))
                    size += len(known)
            if size > most:
                yield from rows()
                size = 0
        yield from rows()

    found = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(count, row_type(lang="string", gram="long", n="long"))
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = 300) -> dict[str, list[int]]:
    """The profile of each language: its most frequent n-grams, in order; ties
    by code. Tops are first found in 32 parts of each language, so no task sees
    all its n-grams, and the driver gets ``size`` rows a language."""
    n = gram_counts(docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()), lang, text)
    order = (F.desc("n"), F.col("gram") < 0, "gram")  # codes have no sign
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(_SALTS))).orderBy(*order)
    top = n.withColumn("r", F.row_number().over(part)).filter(F.col("r") <= size)
    top = top.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("r") <= size)
    found: dict[str, list] = {}
    for r in top.select("lang", "gram", "r").toLocalIterator():
        found.setdefault(r["lang"], []).append((r["r"], r["gram"] % (1 << 64)))
    return {k: [g for _, g in sorted(found[k])] for k in sorted(found)}


class Judge:
    """Profiles as sorted codes with their ranks."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = list(profiles), size
        self.known = np.unique(np.array([g for p in profiles.values() for g in p], np.uint64))
        # the last column stands for what no profile has
        self.rank = np.full((len(profiles), len(self.known) + 1), -1, np.int32)
        for i, p in enumerate(profiles.values()):
            self.rank[i, np.searchsorted(self.known, np.array(p, np.uint64))] = np.arange(len(p))

    def guess(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language (-1: none) and score of each row."""
        rows = len(offs) - 1
        of, codes, lettered = grams(data, offs)
        best, score = np.full(rows, -1), np.zeros(rows)
        if not self.names or not len(codes):
            return best, score
        codes, g = numbered(codes)
        at = np.searchsorted(self.known, codes)
        at[at == len(self.known)] = 0
        at = np.where(self.known[at] == codes, at, len(self.known)) if len(self.known) else np.zeros(len(codes), np.int64)
        step = max(1, CELLS // len(codes))
        order = np.argsort(of, kind="stable") if rows > step else slice(None)
        of, g = of[order], g[order]
        cut = np.searchsorted(of, np.arange(0, rows + step, step)) if rows > step else np.array([0, len(of)])
        for i, a in enumerate(range(0, rows, step)):
            b = min(a + step, rows)
            best[a:b], score[a:b] = self._nearest(of[cut[i] : cut[i + 1]] - a, g[cut[i] : cut[i + 1]], at, b - a)
        return np.where(lettered, best, -1), np.where(lettered, score, 0.0)

    def _nearest(self, of: np.ndarray, g: np.ndarray, at: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        width = len(at)
        counts = np.bincount(of * width + g, minlength=rows * width).reshape(rows, width)
        # by falling count, then by code: one whole number each
        key = counts * width + np.arange(width - 1, -1, -1)
        k = min(self.size, width)
        top = np.argpartition(key, width - k, axis=1)[:, width - k :] if k < width else np.broadcast_to(np.arange(width), key.shape)
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(key, top, 1), axis=1), 1)
        there = np.take_along_axis(counts, top, 1) > 0
        place, column = np.arange(k), at[top]
        dist = np.empty((len(self.names), rows))
        for i, rank in enumerate(self.rank):
            r = rank[column]
            dist[i] = (np.where(r >= 0, np.minimum(np.abs(r - place), self.size), self.size) * there).sum(axis=1)
        best, n = dist.argmin(axis=0), there.sum(axis=1)
        return best, np.where(n > 0, 1 - dist[best, np.arange(rows)] / np.maximum(1, n * self.size), 0.0)


def predict(text: Column, profiles: dict[str, list[int]], size: int = 300) -> Column:
    """A struct column: lang and score."""
    @F.arrow_udf(GUESS)
    def guess(texts: pa.Array) -> pa.Array:
        judge = _judge(tuple((k, tuple(v)) for k, v in profiles.items()), size)
        names, scores = [], []
        for _, _, data, offs in text_parts(texts, 1 << 20):
            best, score = judge.guess(data, offs)
            names += [judge.names[i] if i >= 0 else "und" for i in best]
            scores.append(score)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang", "score"])

    return guess(text)


@cache
def _judge(profiles: tuple, size: int) -> Judge:
    return Judge({k: list(v) for k, v in profiles}, size)
