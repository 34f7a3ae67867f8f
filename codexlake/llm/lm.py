"""Log-bilinear language model, trained by noise-contrastive estimation.

Counts of all words come from every learning text (the end of a text counts as
a word). A word that occurs ``least`` times or more there is the model's own, so
that the vocabulary grows with the corpus; all others are dealt by CRC-32 to
groups, one for 16 own words, and a group is to the model as a word is: it is
predicted and it is a context. Within a group a word's share is its add-one
count.

With h = C1 r1 + C2 r2 of the two words before, words by frequency are the leaves
of a tree of three levels, each node with about the cube root of their number of
children; a word's probability is the product of three softmaxes of h . x + b, each
over the children of one node, so that it is exactly normalised and some 200
products score a word among 2^18. A leaf's vector is the word's own r.

Training: in each round the texts of one fold (by hash) are learnt from, in
shards of about ``shard_tokens`` tokens, so that a round moves one model for each
shard. A shard runs minibatches in numpy from the last round's parameters: noise
branches are shared by a minibatch, noise on the levels below comes from the
word's siblings. Then parameters are averaged: a word's vector by how often a shard
used it, the others by words. Vectors (never counts) depend on how Spark dealt the
texts, as the order of minibatches does.

The ``head`` most frequent words travel to the executors with their counts (a
fixed bound, of the model's own words too); counts of rarer ones are joined,
grouped by text.

Defined cases: a null text is empty (its end alone is scored); with no learning
text every count is 0; an empty table gives an empty result; words that tie in
count go by their bytes; repeated rows are scored each; kept columns may have any
name; texts are read some 4 MB at a time, a longer one alone, and scored in parts of
2^18 tokens; a text's rare words are one list.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import Scratch, row_type, text_parts

END = b""  # no word is empty
BLOCK = 512  # words whose parameters travel in one row
SCORED = T.StructType([*row_type(n_tokens="long", known="long", head_sum="double", model_sum="double", group_sum="double", rare_sum="double"), T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.LongType()))])


def tokens(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, then the end."""
    out = (text or b"").lower().split()
    out.append(END)
    return out


def numbered(arr: pa.Array, limit: int = 1 << 22) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """The tokens of some 4 MB of texts at a time: where each text begins, the
    distinct tokens, and the number of each token among these. A token is held
    with a line feed behind it, which no word has."""
    for a, b, data, offs in text_parts(arr, limit):
        lines, n = [], np.zeros(b - a + 1, np.int64)
        for i, (x, y) in enumerate(pairwise(offs.tolist())):
            found = tokens(data[x:y].tobytes())
            n[i + 1] = len(found)
            lines.append(b"\n".join(found))
        lines.append(b"")
        held = np.frombuffer(b"\n".join(lines), np.uint8)
        ends = np.concatenate(([0], np.flatnonzero(held == 10) + 1))
        coded = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(held)]).dictionary_encode()
        _, ends, words = coded.dictionary.buffers()
        end = np.frombuffer(ends, np.int64)[len(coded.dictionary)]
        yield np.cumsum(n)[:-1], words[:end].to_pybytes().split(b"\n")[:-1], coded.indices.to_numpy()


def word_counts(docs: DataFrame, text: str, flush: int = 300_000) -> DataFrame:
    """(word, c): how often each token occurs in all texts."""
    def count(batches):
        held: Counter[bytes] = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for _, found, at in numbered(batch.column(0)):
                for word, n in zip(found, np.bincount(at, minlength=len(found)).tolist(), strict=True):
                    held[word] += n
                if len(held) > flush:
                    yield rows()
        yield rows()

    return docs.select(text).mapInArrow(count, row_type(word="binary", n="long")).groupBy("word").agg(F.sum("n").alias("c"))


def frequent(counts: DataFrame, head: int) -> list[tuple[bytes, int]]:
    """At most ``head`` of the most frequent words, by count: all those above
    the smallest count class (64 to the power of two) that fits."""
    band = F.floor(F.log2("c") * 64)
    kept, least = 0, None
    for r in sorted(counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["band"]):
        if kept + r["n"] > head:
            break
        kept, least = kept + r["n"], r["band"]
    rows = counts.filter(band >= least).collect() if least is not None else []
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))


class Level:
    """Nodes of one level: their noise by the mass of siblings, of ``branch``
    children each."""

    def __init__(self, mass: np.ndarray, branch: int, rng, draws: int):
        self.low = np.arange(0, len(mass), branch)
        total = np.add.reduceat(mass, self.low)
        self.log = (np.log(mass) - np.log(total)[np.arange(len(mass)) // branch]).astype(np.float32)
        ends = np.cumsum(mass)
        base, high = ends[self.low] - mass[self.low], ends[np.minimum(self.low + branch, len(mass)) - 1]
        drawn = np.searchsorted(ends, base[:, None] + rng.random((len(self.low), draws)) * (high - base)[:, None])
        self.drawn = np.clip(drawn, self.low[:, None], np.minimum(self.low + branch, len(mass))[:, None] - 1)


def _near(x: np.ndarray) -> np.ndarray:
    x = np.clip(x, -30, 30)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


class Model:
    """Parameters of words 0..n-1 by falling frequency, and n (before the text):
    words r, b; the tree's branches s1, b1 and twigs s2, b2; contexts c."""

    DENSE = ("s1", "b1", "s2", "b2", "c")

    def __init__(self, unigram: np.ndarray, dim: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        n = self.n = len(unigram)
        self.dim, self.branch, self.unigram = dim, 2, unigram
        while self.branch**3 < n:
            self.branch += 1
        twigs = np.add.reduceat(unigram, np.arange(0, n, self.branch))
        branches = np.add.reduceat(twigs, np.arange(0, len(twigs), self.branch))
        self.cdf = np.cumsum(branches)
        self.log1 = (np.log(branches) - np.log(branches.sum())).astype(np.float32)
        vectors = lambda k: rng.normal(0, 0.1, (k, dim)).astype(np.float32)
        self.r, self.s2, self.s1 = vectors(n + 1), vectors(len(twigs)), vectors(len(branches))
        self.c = np.stack([np.eye(dim, dtype=np.float32) * 0.5] * 2)
        share = lambda x, low: (np.log(x) - np.log(np.add.reduceat(x, low))[np.arange(len(x)) // self.branch]).astype(np.float32)
        self.b1 = self.log1.copy()
        self.b2 = share(twigs, np.arange(0, len(twigs), self.branch))
        self.b = np.append(share(unigram, np.arange(0, n, self.branch)), np.float32(0))
        self.twigs = twigs

    def dense(self) -> np.ndarray:
        return np.concatenate([getattr(self, p).ravel() for p in self.DENSE])

    def rows(self) -> np.ndarray:
        return np.hstack([self.r, self.b[:, None]])

    def load(self, dense: np.ndarray, rows: np.ndarray) -> Model:
        at = 0
        for p in self.DENSE:
            x = getattr(self, p)
            setattr(self, p, dense[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        self.r, self.b = rows[:, :-1].astype(np.float32), rows[:, -1].astype(np.float32)
        return self

    def start(self, rng, draws: int = 64) -> dict:
        """What training keeps: squared gradients, noise, how often words were used."""
        memory = {p: np.ones_like(getattr(self, p)) for p in (*self.DENSE, "r", "b")}
        return memory | {"leaf": Level(self.unigram, self.branch, rng, draws), "twig": Level(self.twigs, self.branch, rng, 4 * draws), "hits": np.zeros(self.n + 1, np.float32), "steps": 0}

    def train(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray, rng, memory: dict, noise: int = 16, own: int = 2, rate: float = 0.03, half: int = 100) -> None:
        """One minibatch by noise-contrastive estimation and AdaGrad, whose sums
        start at 1, so that what is seen once moves little; the rate has halved
        after ``half`` minibatches, as late noise would undo what was learnt."""
        rate = np.float32(rate / (1 + memory["steps"] / half))
        memory["steps"] += 1
        t2 = w // self.branch
        t1 = t2 // self.branch
        # a context is the word before it, but at a text's or the minibatch's begin
        xw, at1, at2 = self.r.take(w, 0), _apart(c1, w, 1), _apart(c2, w, 2)
        r1, r2 = _behind(xw, 1), _behind(xw, 2)
        r1[at1], r2[at2] = self.r.take(c1[at1], 0), self.r.take(c2[at2], 0)
        h = r1 @ self.c[0].T + r2 @ self.c[1].T
        # branches: noise is shared
        k = np.minimum(np.searchsorted(self.cdf, rng.random(noise) * self.cdf[-1]), len(self.cdf) - 1)
        sk, st, shift = self.s1[k], self.s1.take(t1, 0), np.float32(np.log(noise))
        gt = _near(np.einsum("td,td->t", h, st) + (self.b1 - self.log1).take(t1) - shift)
        gf = -_near(-(h @ sk.T + (self.b1[k] - self.log1[k] - shift)))
        gh = gt[:, None] * st + gf @ sk
        by_dim = h.T.astype(np.float64, order="C")  # summed a dimension at a time
        grad = {"s1": _scatter(t1, gt * by_dim, len(self.s1)), "b1": np.bincount(t1, gt, len(self.s1)).astype(np.float32)}
        np.add.at(grad["s1"], k, gf.T @ h)
        np.add.at(grad["b1"], k, gf.sum(0))
        # twigs, then leaves: noise from the target's siblings
        shift, found = np.float32(np.log(own)), {}
        for level, x, bias, to, parent in (("twig", self.s2, self.b2, t2, t1), ("leaf", self.r, self.b, w, t2)):
            lv = memory[level]
            draws = lv.drawn.shape[1]
            v = lv.drawn.reshape(-1).take(parent[:, None] * draws + rng.integers(0, draws, (len(w), own)))
            xt, xv = x.take(to, 0) if level == "twig" else xw, x.take(v, 0)
            gt = _near(np.einsum("td,td->t", h, xt) + (bias.take(to) - lv.log.take(to) - shift))
            gf = -_near(-(np.einsum("tod,td->to", xv, h) + (bias.take(v) - lv.log.take(v) - shift)))
            gh += gt[:, None] * xt + np.einsum("to,tod->td", gf, xv)
            both = np.concatenate([gt, *gf.T]).astype(np.float64)
            found[level] = np.concatenate([to, *v.T]), both, (both.reshape(-1, len(w)) * by_dim[:, None]).reshape(self.dim, -1)
        ids, g, gx = found["twig"]
        grad |= {"s2": _scatter(ids, gx, len(self.s2)), "b2": np.bincount(ids, g, len(self.s2)).astype(np.float32), "c": np.stack([gh.T @ r1, gh.T @ r2])}
        for p, x in grad.items():
            memory[p] += x * x
            setattr(self, p, getattr(self, p) + rate * x / np.sqrt(memory[p]))
        # only the words in use; contexts' gradients are added to those of the words before
        ids, g, gx = found["leaf"]
        used = np.bincount(np.concatenate([ids, c1, c2]), minlength=self.n + 1)
        rows = np.flatnonzero(used)
        memory["hits"][rows] += used[rows]
        g1, g2 = self.c[0].T @ gh.T, self.c[1].T @ gh.T
        apart = g1[:, at1], g2[:, at2]
        g1[:, at1], g2[:, at2] = 0, 0
        for by, x in ((1, g1), (2, g2)):
            gx[:, : max(0, len(w) - by)] += x[:, by:]
        number = np.empty(len(used), np.int64)
        number[rows] = np.arange(len(rows))
        to = number.take(np.concatenate([ids, c1[at1], c2[at2]]))
        gr = _scatter(to, np.concatenate([gx, *apart], 1), len(rows))
        gb = np.bincount(to[: len(ids)], g, len(rows)).astype(np.float32)
        for p, x in (("r", gr), ("b", gb)):
            m = memory[p].take(rows, 0)
            m += x * x
            memory[p][rows] = m
            np.sqrt(m, out=m)
            x *= rate
            x /= m
            x += getattr(self, p).take(rows, 0)
            getattr(self, p)[rows] = x

    def log10(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray, part: int = 1 << 18) -> np.ndarray:
        return np.concatenate([self._log10(c1[a : a + part], c2[a : a + part], w[a : a + part]) for a in range(0, len(w), part)] or [np.zeros(0)])

    def _log10(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> np.ndarray:
        order = np.argsort(w)
        w = w[order]
        h = np.ones((len(w), self.dim + 1), np.float32)  # the last column takes the bias
        h[:, :-1] = self.r.take(c1[order], 0) @ self.c[0].T + self.r.take(c2[order], 0) @ self.c[1].T
        got = np.zeros(len(w))
        one = np.zeros(len(w), np.int64)
        t2 = w // self.branch
        for x, bias, pick, parent in ((self.s1, self.b1, t2 // self.branch, one), (self.s2, self.b2, t2, t2 // self.branch), (self.r[: self.n], self.b[: self.n], w, t2)):
            x = np.column_stack([x, bias])
            ends = np.append(np.flatnonzero(np.diff(parent)) + 1, len(w))
            begin = 0
            for end in ends.tolist():
                lo = int(parent[begin]) * self.branch
                xs = x[lo : lo + self.branch]
                if len(xs) > 1:
                    for a in range(begin, end, 4096):
                        b = min(a + 4096, end)
                        got[a:b] += _log_share(h[a:b], xs, pick[a:b] - lo)
                begin = end
        out = np.empty(len(w))
        out[order] = got / np.log(10)
        return out


def _apart(c: np.ndarray, w: np.ndarray, by: int) -> np.ndarray:
    """Where a context isn't the word ``by`` places before."""
    return np.concatenate([np.arange(min(by, len(w))), np.flatnonzero(c[by:] != w[:-by]) + by])


def _behind(x: np.ndarray, by: int) -> np.ndarray:
    """Rows moved by ``by`` places; the first ones are unset."""
    out = np.empty_like(x)
    out[by:] = x[:-by]
    return out


def _scatter(rows: np.ndarray, by_dim: np.ndarray, n: int) -> np.ndarray:
    """Sums by row; by_dim has a line for each dimension."""
    out = np.empty((len(by_dim), n), np.float32)
    for line, v in zip(out, by_dim, strict=True):
        line[:] = np.bincount(rows, v, n)
    return np.ascontiguousarray(out.T)


def _log_share(h: np.ndarray, vectors: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax at pick."""
    x = h @ vectors.T
    np.minimum(x, 80, out=x)  # so that the sum stays finite
    at = x.reshape(-1).take(np.arange(0, x.size, x.shape[1]) + pick)
    np.exp(x, out=x)
    return at.astype(np.float64) - np.log(x @ np.ones(x.shape[1], np.float32))


def contexts(ids: np.ndarray, first: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The last word and the one before it, for texts one after the other."""
    c1 = np.concatenate(([before], ids[:-1]))
    c1[first] = before
    c2 = np.concatenate(([before], c1[:-1]))
    c2[first] = before
    return c1, c2


class Words:
    """Places of words in the model: own ones and groups, by falling frequency."""

    def __init__(self, words: list[bytes], own: int, mass: np.ndarray):
        self.own, self.groups = own, len(mass) - own
        self.order = np.argsort(-mass, kind="stable")
        self.place = np.empty(len(mass), np.int64)
        self.place[self.order] = np.arange(len(mass))
        tail = np.array([self.group(w) for w in words[own:]], np.int64)
        # by number among the head from the front, by group from the end
        self.slot = np.concatenate([self.place[:own], self.place[own + tail], self.place[own:][::-1]])

    def group(self, word: bytes) -> int:
        return crc32(word) % self.groups

    def of(self, at: np.ndarray) -> np.ndarray:
        """Places by number among the head, or -1 - group."""
        return self.slot.take(at, mode="wrap")


class Index(dict):
    """Numbers of the head's words, and -1 - group of others, which are added to
    ``far``."""

    def __init__(self, words: list[bytes], places: Words):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.group, self.far = places.group, []

    def __missing__(self, word: bytes) -> int:
        self.far.append(word)
        return -1 - self.group(word)

    def all(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def numbers(self, text: bytes | None) -> np.ndarray:
        return self.all(tokens(text))


def fit(docs: DataFrame, text: str, words: list[bytes], places: Words, unigram: np.ndarray, dim: int, total: int, rounds: int, shard_tokens: int, batch_words: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Parameters after ``rounds`` rounds over disjoint parts of the texts, each
    averaged over its shards."""
    model = Model(unigram, dim)
    dense, rows = model.dense(), model.rows()
    shards = max(8, -(-total // (rounds * shard_tokens)))
    spark = docs.sparkSession
    for n in range(rounds):
        part = docs.filter(F.pmod(F.xxhash64(text), F.lit(rounds)) == n).select(text)
        shared = spark.sparkContext.broadcast((words, places, unigram, dim, dense, rows))
        for r in part.coalesce(shards).mapInArrow(_round(shared, n, batch_words), AVERAGED).groupBy("at").applyInArrow(_average, AVERAGED).toLocalIterator():
            hits = np.frombuffer(r["n"], np.float32)
            v = np.frombuffer(r["v"], np.float32).reshape(len(hits), -1)
            if r["at"] < 0:
                dense = v[0].copy()
            else:
                a = r["at"] * BLOCK
                rows[a : a + BLOCK] = np.where((hits > 0)[:, None], v, rows[a : a + BLOCK])
        shared.destroy()
    return dense, rows


AVERAGED = row_type(at="long", v="binary", n="binary")


def _round(shared, number: int, batch_words: int):
    def run(batches):
        words, places, unigram, dim, dense, rows = shared.value
        own, rng = Model(unigram, dim).load(dense, rows), np.random.default_rng((9, number))
        before, memory, ids = own.n, own.start(rng), Index(words, places)
        seen, size, queue, begins = 0, 0, [], []

        def flush():
            nonlocal seen, size, queue, begins
            if queue:
                w = places.of(np.concatenate(queue))
                c1, c2 = contexts(w, np.concatenate(begins), before)
                for a in range(0, len(w), batch_words):
                    own.train(c1[a : a + batch_words], c2[a : a + batch_words], w[a : a + batch_words], rng, memory)
                seen += len(w)
            size, queue, begins = 0, [], []

        for batch in batches:
            for begin, found, at in numbered(batch.column(0)):
                queue.append(ids.all(found)[at])
                begins.append(size + begin)
                ids.far.clear()
                size += len(at)
                if size >= 16 * batch_words:
                    flush()
        flush()
        if seen:
            found, hits = own.rows(), memory["hits"]
            yield _packed([-1], [own.dense()], [np.full(1, seen, np.float32)])
            at = [a for a in range(0, len(found), BLOCK) if hits[a : a + BLOCK].any()]
            yield _packed([a // BLOCK for a in at], [found[a : a + BLOCK] for a in at], [hits[a : a + BLOCK] for a in at])

    return run


def _packed(at: list[int], v: list[np.ndarray], n: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([x.astype(np.float32).tobytes() for x in v], pa.binary()), pa.array([x.tobytes() for x in n], pa.binary())], AVERAGED.names)


def _average(block: pa.Table) -> pa.Table:
    """One block of rows from all shards, by how often they used them."""
    v, n = 0.0, 0.0
    for x, m in zip(block["v"], block["n"], strict=True):
        m = np.frombuffer(m.as_py(), np.float32).astype(np.float64)
        v = v + np.frombuffer(x.as_py(), np.float32).reshape(len(m), -1) * m[:, None]
        n = n + m
    mean = v / np.maximum(n, 1)[:, None]
    return pa.Table.from_batches([_packed([block["at"][0].as_py()], [mean], [n.astype(np.float32)])])


_loaded: dict[str, tuple[Index, Words, Model, np.ndarray, np.ndarray]] = {}


def _open(name: str, b) -> tuple[Index, Words, Model, np.ndarray, np.ndarray]:
    """Built once in each Python worker."""
    if name not in _loaded:
        _loaded.clear()
        words, counts, places, unigram, vectors, shares, dim = b.value
        _loaded[name] = Index(words, places), places, Model(unigram, dim).load(*vectors), np.log10(counts + 1.0), shares
    return _loaded[name]


def scorer(shared):
    name = uuid.uuid4().hex

    def part(begin, found, code, index, places, model, logs, shares) -> pa.Array:
        number = index.all(found)
        index.far.clear()
        at = number[code]
        ids = places.of(at)
        grouped = ~((at >= 0) & (at < places.own))
        logp = model.log10(*contexts(ids, begin, model.n), ids)
        log_c = np.where(at >= 0, logs.take(at, mode="clip"), 0.0) if len(logs) else np.zeros(len(at))
        sums = lambda v: np.add.reduceat(v, begin)
        cols = [np.diff(np.append(begin, len(at))), sums((at >= 0).astype(np.int64)), sums(log_c), sums(logp), sums(shares[ids]), sums(np.where(grouped, log_c, 0.0))]
        # words beyond the head, counted by text
        far = np.flatnonzero(at < 0)
        text = np.searchsorted(begin, far, "right") - 1
        pairs, n = np.unique(text * len(found) + code[far], return_counts=True)
        cut = pa.array(np.searchsorted(pairs, np.arange(len(begin) + 1) * len(found)).astype(np.int32))
        rare = pa.array([found[i] for i in (pairs % len(found)).tolist()], pa.binary())
        lists = [pa.ListArray.from_arrays(cut, rare), pa.ListArray.from_arrays(cut, pa.array(n.astype(np.int64)))]
        return pa.StructArray.from_arrays([*(pa.array(c) for c in cols), *lists], SCORED.names)

    @F.arrow_udf(SCORED)
    def score(text: pa.Array) -> pa.Array:
        held = _open(name, shared)
        out = [part(*x, *held) for x in numbered(text)]
        return pa.concat_arrays(out) if out else pa.array([], pa.struct([]))

    return score


def score_texts(docs: DataFrame, learning: Column, scratch: Scratch, keep: list[Column], text: str = "text", vocabulary: int | None = None, head: int = 1 << 18, dim: int = 16, least: int = 32, rounds: int = 2, shard_tokens: int = 20_000_000) -> DataFrame:
    """The columns ``keep`` with n_tokens, n_known, train_tokens, base_score
    and score for each row of docs; the model learns from rows of ``learning``.
    ``vocabulary`` sets the number of the model's own words, if not by ``least``."""
    spark = docs.sparkSession
    train = docs.filter(learning)
    counts = scratch.put(word_counts(train, text), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = total["n"], total["v"]
    top = frequent(counts, head)
    words, c = [w for w, _ in top], np.array([x for _, x in top], np.float64)
    own = int((c >= least).sum()) if vocabulary is None else min(vocabulary, len(words))
    groups = own // 16 + 1
    # words and tokens of each group: all in it, without the model's own
    n_group, v_group = np.zeros(groups), np.zeros(groups)
    for r in counts.groupBy((F.crc32("word") % groups).alias("g")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        n_group[r["g"]], v_group[r["g"]] = r["n"], r["v"]
    at = np.array([crc32(w) % groups for w in words[:own]], np.int64)
    n_group -= np.bincount(at, c[:own], groups)
    v_group -= np.bincount(at, minlength=groups)
    mass = np.append(c[:own], n_group + 1.0)
    places = Words(words, own, mass)
    unigram = mass[places.order] / (n + groups)
    shares = np.append(np.zeros(own), np.log10(n_group + v_group + 1.0))[places.order]
    vectors = fit(train, text, words, places, unigram, dim, n, rounds, shard_tokens)
    shared = spark.sparkContext.broadcast((words, c, places, unigram, vectors, shares, dim))
    held = docs.select(F.struct(*keep).alias("keep"), scorer(shared)(F.col(text)).alias("s"), F.monotonically_increasing_id().alias("row"))
    scored = scratch.put(held, "scored")
    pairs = scored.select("row", F.explode(F.arrays_zip(F.col("s.words").alias("w"), F.col("s.counts").alias("k"))).alias("x")).select("row", F.col("x.w").alias("word"), F.col("x.k").alias("k"))
    rare = pairs.join(counts, "word").groupBy("row").agg(F.sum("k").alias("rare_known"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("rare_log"))
    out = scored.join(rare, "row", "left")
    extra = F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        "keep.*",
        F.col("s.n_tokens").alias("n_tokens"),
        (F.col("s.known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("s.head_sum") + extra - F.col("s.n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        (F.col("s.model_sum") + F.col("s.rare_sum") + extra - F.col("s.group_sum")).alias("score"),
    )
