"""Host-level quality rules.

Each document is measured once; rule failures are summed by host (source), the
hosts' failure rates are shrunk towards the corpus by an empirical beta prior,
and the verdict on the host is joined back to its documents.

Defined cases: a null text has no words (all counts 0, so it fails the length
rule); a null source is a host of its own; repeated rows count once each; an
empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import PIECE, Scratch, free_name, row_type, text_parts

METRICS = row_type(n_words="long", word_chars="long", n_symbols="long", n_dup_lines="long", n_repeat_words="long")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: Rules on a document's counts that are summed by host.
RULES = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "dup_lines": "2 * n_dup_lines > 1 + n_words / 10",
}


def measure(arr: pa.Array, size: int = 5) -> pa.Array:
    """The counts of each text, as a struct array."""
    cols = [np.zeros(len(arr), np.int64) for _ in range(5)]
    n_words, chars, symbols, dup_lines, repeats = cols
    for a, b, data, offs in text_parts(arr, PIECE):
        start, end, first = K.words(data, offs)
        n_words[a:b] = np.diff(first)
        solid = ~K.SPACE[data] & ((data & 0xC0) != 0x80)
        for out, mask in ((chars, solid), (symbols, _SYMBOL[data])):
            out[a:b] = np.diff(np.concatenate(([0], np.cumsum(mask)))[offs])
        newline = np.diff(np.concatenate(([0], np.cumsum(data == 10)))[offs])
        for i in np.flatnonzero(newline):
            lines = [x for x in data[offs[i] : offs[i + 1]].tobytes().split(b"\n") if x.strip()]
            dup_lines[a + i] = len(lines) - len(set(lines))
        h = K.word_windows(K.ranges(K.prefix(data), start, end), size)
        if not len(h):
            continue
        doc = np.repeat(np.arange(b - a), np.diff(first))
        own = doc[: len(h)] == doc[size - 1 :]
        h = (h + K.mix(doc[: len(h)].astype(np.uint64)))[own]
        at = np.flatnonzero(own)
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]  # 64-bit hashes, compared within a text only
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        edge = np.zeros(len(start) + size + 1, np.int64)
        np.add.at(edge, at[twice], 1)
        np.add.at(edge, at[twice] + size, -1)
        inside = np.cumsum(edge)[: len(start)] > 0
        repeats[a:b] = np.diff(np.concatenate(([0], np.cumsum(inside)))[first])
    return pa.StructArray.from_arrays([pa.array(c) for c in cols], ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


@F.arrow_udf(METRICS)
def metrics(text: pa.Array) -> pa.Array:
    return measure(text)


def host_verdicts(measured: DataFrame, host: str, rules: dict[str, str], prior_floor: float = 1.0, reject_rate: float = 0.6) -> DataFrame:
    """One row per host: documents, failures and shrunken rate of each rule,
    and whether any rate is above ``reject_rate``.

    The prior of a rule is the beta distribution with the mean and variance of
    the hosts' rates (method of moments, hosts weighing alike); its strength is
    at least ``prior_floor`` documents, also where hosts don't differ.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n_docs"), *(F.sum(F.when(F.expr(sql), 1).otherwise(0)).alias(f"fail_{name}") for name, sql in rules.items()))
    moments = hosts.agg(*(x for name in rules for x in (F.avg(F.col(f"fail_{name}") / F.col("n_docs")).alias(f"m_{name}"), F.var_pop(F.col(f"fail_{name}") / F.col("n_docs")).alias(f"v_{name}"))))
    out = hosts.crossJoin(F.broadcast(moments))  # one row
    for name in rules:
        m, v = F.col(f"m_{name}"), F.col(f"v_{name}")
        strength = F.greatest(F.lit(float(prior_floor)), F.when(v > 0, m * (1 - m) / v - 1).otherwise(F.lit(1e6)))
        out = out.withColumn(f"rate_{name}", (F.col(f"fail_{name}") + m * strength) / (F.col("n_docs") + strength))
    bad = F.greatest(*(F.col(f"rate_{name}") for name in rules), F.lit(0.0)) > reject_rate
    return out.select("host", "n_docs", *(f"fail_{name}" for name in rules), *(f"rate_{name}" for name in rules), bad.alias("host_rejected"))


#: Rejected hosts up to this number are broadcast; more are joined by shuffle.
BROADCAST_HOSTS = 100_000


def judge(measured: DataFrame, scratch: Scratch, host: str, counts: str, rules: dict[str, str] | None = None, reject_rate: float = 0.6) -> DataFrame:
    """measured with its struct of counts turned into a struct ``quality``: the
    counts, ``base_failed``, ``host_rejected`` and ``kept``. Rejected hosts are
    written and counted, so that rows with texts aren't shuffled for a few."""
    rules = rules or RULES
    verdicts = host_verdicts(measured.select(F.col(host).alias("host"), f"{counts}.*"), "host", rules, reject_rate=reject_rate)
    bad = verdicts.filter("host_rejected").select(F.col("host").alias("__bad_host"), F.lit(True).alias("__rejected"))
    bad = scratch.put(bad, "rejected")
    if bad.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        bad = F.broadcast(bad)
    out = measured.join(bad, F.col(host).eqNullSafe(F.col("__bad_host")), "left")
    failed = F.expr(f"{counts}.n_words < 10 or 100 * {counts}.n_repeat_words > 20 * {counts}.n_words")
    rejected = F.coalesce(F.col("__rejected"), F.lit(False))
    quality = F.struct(f"{counts}.*", failed.alias("base_failed"), rejected.alias("host_rejected"), (~failed & ~rejected).alias("kept"))
    return out.select(*(c for c in measured.columns if c != counts), quality.alias("quality"))


def apply_rules(docs: DataFrame, scratch: Scratch, text: str = "text", host: str = "source", rules: dict[str, str] | None = None, reject_rate: float = 0.6, into: str = "quality") -> DataFrame:
    """docs with the struct column ``into`` (see judge; underscores are added to the
    name while docs has it). The measured rows are written once, so that no text
    is measured twice."""
    into = free_name(docs, into)
    m = docs.select(F.struct(*docs.columns).alias("row"), F.col(host).alias("host"), metrics(F.col(text)).alias("q"))
    return judge(scratch.put(m, "measured"), scratch, "host", "q", rules, reject_rate).select("row.*", F.col("quality").alias(into))
