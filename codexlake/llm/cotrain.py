"""Quality classifier by co-training.

Two views of a document are kept apart: its words and word stems (text
content), and what a
crawl knows of the page: host, language, length and the layout's statistics
(lines, character classes). Each view has a sparse logistic model for each
target (good quality; toxic), fitted on a bounded sample of labelled rows and
calibrated on a part of it that is held back. In each round all documents are
scored by both views; those of which a view is confident are pseudo-labels for
the other view, at most ``per_round`` of either class and round (picked by a
hash among all confident ones); they add up over the rounds, and a view that is
never confident gives none. Last, the calibrated views are combined by a
logistic model of their two log-odds, on rows that neither fitted nor calibrated
them, and every document is scored. Features and scores are made in slices of
1 MB of text or 1,000 rows.

Defined cases: a null text has no words, null host and language are values of
their own; labels that are null are not used, a document labelled twice counts
twice, labelled rows beyond the bound are left out by the hash of their id, then
by id; without labels of both classes a target's share (or one half) is
everyone's score, without such rows to blend on the views count alike; ids may
be of any type, null ids are scored but never give pseudo-labels; repeated rows
score alike; an empty table gives an empty result; other columns aren't read; a
very long text is held once, its tables take some 60 bytes for each of its own.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import Scratch, row_type, text_parts

WORDS, META = 1 << 16, 1 << 12
STEMS = (6, 8)  # bytes
VIEWS = {"text": WORDS, "meta": META}
FEATURES = row_type(text="binary", meta="binary")
_CLASS = np.full(256, 1, np.uint8)  # letters beyond ASCII count as small ones
for _n, _set in enumerate((range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b".,;:'\"()-", b"!?", b"|", b"#*$%&<>@/\\=+_~^[]{}`")):
    _CLASS[list(_set)] = _n + 1
_CLASS[list(range(33)) + [127]] = 0
_APART = np.isin(_CLASS, (0, 4, 5, 6, 7))  # what parts words in the text view


def _bucket(x: np.ndarray, n: int = 12) -> np.ndarray:
    """Halving steps of a share; 0 for none."""
    return np.where(x > 0, np.minimum(n, 1 - np.floor(np.log2(np.maximum(x, 1e-9)))), 0).astype(np.int64)


def _hash(*parts) -> np.ndarray:
    h = np.full(1, 0x9E3779B97F4A7C15, np.uint64)
    for p in parts:
        h = K.mix(np.asarray(p).astype(np.uint64) + h)
    return h


def _by_row(row: np.ndarray, ids: np.ndarray, rows: int) -> list[bytes]:
    """Sorted distinct ids of each row, as two-byte numbers."""
    key = np.unique(row.astype(np.int64) * WORDS + ids.astype(np.int64))
    cut = np.searchsorted(key, np.arange(rows + 1) * WORDS)
    low = (key % WORDS).astype("<u2")
    return [low[cut[i] : cut[i + 1]].tobytes() for i in range(rows)]


def features(text: pa.Array, host: pa.Array, lang: pa.Array) -> pa.Array:
    words, meta = [], []
    for a, b, data, offs in text_parts(text, 1 << 20):
        rows = b - a
        start, end, first = K.words(data, offs)
        n = np.maximum(1, np.diff(first))
        row = np.repeat(np.arange(rows), np.diff(first))
        w_start, w_end, w_first = K.words(data, offs, _APART)
        sums = K.prefix(K.LOWER[data])
        low = K.ranges(sums, w_start, w_end)
        stems = [K.ranges(sums, w_start, np.minimum(w_end, w_start + k)) + np.uint64(k) for k in STEMS]
        w_row = np.repeat(np.arange(rows), np.diff(w_first))
        shape = _CLASS[data[start]].astype(np.int64) * 8 + _CLASS[data[end - 1]]
        shares = np.bincount(row * 64 + shape, minlength=rows * 64).reshape(rows, 64) / n[:, None]
        r, s = np.nonzero(shares)
        distinct = np.bincount(np.unique(w_row * (1 << 40) + (low >> np.uint64(24)).astype(np.int64)) >> 40, minlength=rows)
        ids = np.concatenate((low >> np.uint64(48), *(K.mix(x) >> np.uint64(48) for x in stems), _hash(1, s, _bucket(shares[r, s])) >> np.uint64(48), _hash(2, np.floor(distinct / n * 10)) >> np.uint64(48)))
        words += _by_row(np.concatenate((w_row, *[w_row] * len(stems), r, np.arange(rows))), ids, rows)
        size = np.maximum(1, np.diff(offs))
        of = np.repeat(np.arange(rows), np.diff(offs))
        kinds = np.bincount(of * 8 + _CLASS[data], minlength=rows * 8).reshape(rows, 8) / size[:, None]
        lines = np.bincount(of[data == 10], minlength=rows)
        cols = [_hash(10 + k, _bucket(kinds[:, k])) for k in range(8)]
        cols += [_hash(20, np.floor(2 * np.log2(size))), _hash(21, np.floor(np.log2(1 + lines))), _hash(22, np.floor(np.log2(size / (1 + lines)) * 2))]
        for tag, col in ((30, host), (31, lang)):
            cols.append(_hash(tag, [hash_text(x) for x in col.slice(a, rows).to_pylist()]))
        meta += _by_row(np.tile(np.arange(rows), len(cols)), np.concatenate(cols) >> np.uint64(52), rows)
    return pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(meta, pa.binary())], ["text", "meta"])


def hash_text(x: str | None) -> int:
    h = 1469598103934665603
    for c in b"\0" if x is None else x.encode():
        h = ((h ^ c) * 1099511628211) & ((1 << 64) - 1)
    return h


@F.arrow_udf(FEATURES)
def features_udf(text: pa.Array, host: pa.Array, lang: pa.Array) -> pa.Array:
    return features(text, host, lang)


class Sparse:
    """Rows of binary features, two bytes each."""

    def __init__(self, rows: list[bytes]):
        self.ids = np.frombuffer(b"".join(rows), "<u2")
        self.cut = np.concatenate(([0], np.cumsum([len(r) // 2 for r in rows], dtype=np.int64)))
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(self.cut))

    def part(self, keep: np.ndarray) -> Sparse:
        out = Sparse([])
        out.ids, out.row, out.cut = self.ids[keep], self.row[keep], self.cut
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.ids], len(self.cut) - 1)


def sums(column: pa.Array, w: np.ndarray) -> np.ndarray:
    """The rows' sums of weights, read from a binary column's own buffers."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offs, data = column.buffers()
    cut = (np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]) // 2
    ids = np.frombuffer(data, "<u2") if data is not None and data.size else np.zeros(0, "<u2")
    running = np.concatenate(([0.0], np.cumsum(w[ids[cut[0] : cut[-1]]], dtype=np.float64)))
    return np.diff(running[cut - cut[0]])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def telling(x: Sparse, y: np.ndarray, size: int, least: float = 3.0) -> np.ndarray:
    """Features whose shares in the two classes differ by ``least`` standard
    errors and that three rows have."""
    ones, zeros = max(1.0, y.sum()), max(1.0, len(y) - y.sum())
    held, with_one = np.bincount(x.ids, minlength=size), np.bincount(x.ids, y[x.row], size)
    share = held / max(1, len(y))
    error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / ones + 1 / zeros))
    return (np.abs(with_one / ones - (held - with_one) / zeros) >= least * error) & (held >= 3)


def logistic(x: Sparse, y: np.ndarray, size: int, steps: int = 150, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the telling features, by Adam over all rows."""
    keep = telling(x, y, size)[x.ids]
    x = x.part(keep)
    w, bias = np.zeros(size), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        e = (sigmoid(x.dot(w) + bias) - y) / len(y)
        g = np.append(np.bincount(x.ids, e[x.row], size) + ridge * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, bias


def calibrated(z: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression of y on the columns of z: coefficients, intercept
    last. Newton steps, halved until the loss falls; columns are scaled for it,
    so that one which hardly varies gets no weight."""
    scale = np.append(np.maximum(z.std(axis=0), 0.5), 1.0)
    x = np.column_stack([z, np.ones(len(z))]) / scale
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    damp = np.append(np.full(z.shape[1], ridge), 1e-6)

    def loss(c: np.ndarray) -> float:
        s = x @ c
        return float(np.sum(np.logaddexp(0, s) - target * s) + 0.5 * np.sum(damp * c * c))

    c = np.zeros(x.shape[1])
    now = loss(c)
    for _ in range(60):
        p = sigmoid(x @ c)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + np.diag(damp), x.T @ (p - target) + damp * c)
        size = 1.0
        while size > 1e-6 and not (new := loss(c - size * step)) < now:
            size /= 2
        if size <= 1e-6 or now - new < 1e-10:
            break
        c, now = c - size * step, new
    return c / scale


class CoTrainer:
    """Models of one target. ``use`` tells what a labelled row is for: 0 to fit
    the views, 1 to calibrate them, 2 to blend them."""

    def __init__(self, labelled: dict[str, list[bytes]], y: np.ndarray, use: np.ndarray):
        self.y, self.use, self.own = y, use, labelled
        self.more: dict[str, tuple[list[bytes], list[float]]] = {v: ([], []) for v in VIEWS}
        mixed = [0 < y[use == u].sum() < (use == u).sum() for u in range(3)]
        self.usable, self.blends = mixed[0] and mixed[1], mixed[2]
        self.model: dict[str, tuple] = {}
        self.blend = np.array([0.5, 0.5, 0.0])

    def _rows(self, view: str, use: int) -> list[bytes]:
        return [r for r, u in zip(self.own[view], self.use, strict=True) if u == use]

    def fit(self) -> None:
        if not self.usable:
            return
        logits = []
        for view, size in VIEWS.items():
            rows = self._rows(view, 0) + self.more[view][0]
            w, b = logistic(Sparse(rows), np.append(self.y[self.use == 0], self.more[view][1]), size)
            w = w.astype(np.float32)
            c = calibrated((Sparse(self._rows(view, 1)).dot(w) + b)[:, None], self.y[self.use == 1])
            self.model[view] = w, b, c
            logits.append((Sparse(self._rows(view, 2)).dot(w) + b) * c[0] + c[1])
        if self.blends:
            self.blend = calibrated(np.column_stack(logits), self.y[self.use == 2])

    def bounds(self, confident: float, odds: float = 10.0) -> tuple[float, float]:
        """Probabilities from which a view counts as confident: beyond
        ``confident``, and ten times the odds that the target's share gives, so
        that a view which knows nothing of a rare class can't vouch for it."""
        prior = np.log((self.y.sum() + 1) / (len(self.y) - self.y.sum() + 1))
        return min(1 - confident, float(sigmoid(prior - np.log(odds)))), max(confident, float(sigmoid(prior + np.log(odds))))

    def packed(self) -> tuple:
        share = float(self.y.mean()) if len(self.y) else 0.5
        return self.usable, share, self.model, self.blend


SLICE = 1000  # rows that are scored at a time


def probabilities(columns: dict[str, pa.Array], models: list[tuple]) -> list[np.ndarray]:
    """For each target the views' calibrated probabilities and the blend's."""
    n, out = len(columns["text"]), []
    for usable, share, model, blend in models:
        if not usable:
            out += [np.full(n, share)] * 3
            continue
        logits = []
        for v in VIEWS:
            w, b, c = model[v]
            logits.append((sums(columns[v], w) + b) * c[0] + c[1])
        out += [sigmoid(x) for x in logits] + [sigmoid(np.column_stack(logits) @ blend[:2] + blend[2])]
    return out


def _scorer(shared, targets: list[str]):
    names = [f"{t}_{v}" for t in targets for v in (*VIEWS, "all")]

    @F.arrow_udf(row_type(**dict.fromkeys(names, "double")))
    def score(text: pa.Array, meta: pa.Array) -> pa.Array:
        parts = [probabilities({"text": text.slice(a, SLICE), "meta": meta.slice(a, SLICE)}, shared.value) for a in range(0, len(text), SLICE)]
        cols = [np.concatenate(x) for x in zip(*parts, strict=True)] or [np.zeros(0)] * len(names)
        return pa.StructArray.from_arrays([pa.array(x) for x in cols], names)

    return score


#: What a labelled row is for, by a hash of its id in eight parts.
USES = (1, 0, 0, 0, 2, 0, 0, 0)


def classify(docs: DataFrame, labels: DataFrame, scratch: Scratch, targets: tuple[str, ...] = ("quality", "toxic"), rounds: int = 2, confident: float = 0.95, per_round: int = 512, max_labelled: int = 8192, text: str = "text", host: str = "source", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and, for each target, the calibrated probabilities
    <target>_text, <target>_meta and <target>_all.

    Models are fitted on at most ``max_labelled`` labelled rows (first by hash);
    confident documents are sought among all."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), features_udf(F.col(text), F.col(host), F.col(lang)).alias("f"))
    rows = scratch.put(rows.select("doc_id", "f.text", "f.meta"), "features")
    rank = F.xxhash64("doc_id")
    known = labels.select(F.col("doc_id"), *(F.col(t).cast("int").alias(t) for t in targets)).dropna().orderBy(rank, "doc_id", *targets).limit(max_labelled)
    sample = rows.join(F.broadcast(known), "doc_id").orderBy(rank, "doc_id").limit(max_labelled).collect()  # at most max_labelled rows
    use = np.array([USES[crc32(str(r["doc_id"]).encode()) % 8] for r in sample], np.int64)
    own = {v: [bytes(r[v]) for r in sample] for v in VIEWS}
    trainers = {t: CoTrainer(own, np.array([float(r[t] > 0) for r in sample]), use) for t in targets}
    one_id = T.StructType([rows.schema["doc_id"]])
    ids = lambda found: spark.createDataFrame([(i,) for i in found], one_id)
    used = {r["doc_id"] for r in sample}

    def scored(frame: DataFrame) -> DataFrame:
        for t in trainers.values():
            t.fit()
        shared = spark.sparkContext.broadcast([t.packed() for t in trainers.values()])
        return frame.select("doc_id", _scorer(shared, list(targets))("text", "meta").alias("p")).select("doc_id", "p.*")

    for n in range(rounds if any(t.usable for t in trainers.values()) else 0):
        pool = scratch.put(scored(rows).filter("doc_id is not null").join(F.broadcast(ids(used)), "doc_id", "left_anti"), f"round{n}")
        picks = []
        for t in targets:
            for view, other in (("text", "meta"), ("meta", "text")):
                low, high = trainers[t].bounds(confident)
                for sure, value in ((F.col(f"{t}_{view}") >= high, 1.0), (F.col(f"{t}_{view}") <= low, 0.0)):
                    first = pool.filter(sure).orderBy(F.xxhash64("doc_id", F.lit(n)), "doc_id").select("doc_id").limit(per_round)
                    picks += [(r["doc_id"], t, other, value) for r in first.collect()]
        scratch.drop(pool)
        if not picks:
            break
        chosen = {p[0] for p in picks}
        found = {r["doc_id"]: r for r in rows.join(F.broadcast(ids(chosen)), "doc_id").dropDuplicates(["doc_id"]).collect()}
        used |= chosen
        for i, t, view, value in picks:
            trainers[t].more[view][0].append(bytes(found[i][view]))
            trainers[t].more[view][1].append(value)
    return scored(rows)
