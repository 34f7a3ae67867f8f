"""Steps that ask a language model. The model is any function from prompts to
answers; without one, the heuristic or the fallback stands."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[list[str]], list[str]]


def ask(prompt: Column, model: Model, batch: int = 32) -> Column:
    @F.arrow_udf(T.StringType())
    def run(prompts: pa.Array) -> pa.Array:
        texts = prompts.to_pylist()
        out: list[str | None] = []
        for a in range(0, len(texts), batch):
            out += model([t or "" for t in texts[a : a + batch]])
        return pa.array(out, pa.string())

    return run(prompt)


def decision(answer: Column) -> Column:
    """(label, confidence) of an answer by its first line."""
    first = F.upper(F.trim(F.split(answer, "\n")[0]))
    label = F.when(first.contains("ARTICLE_START"), "ARTICLE_START").when(first.contains("MENTION"), "MENTION").otherwise("UNCERTAIN")
    return F.struct(label.alias("label"), F.when(label == "UNCERTAIN", 0.5).otherwise(0.9).alias("confidence"))


def cascade(candidates: DataFrame, model: Model | None = None, threshold: float = 0.8, budget: int = 1000) -> DataFrame:
    """candidates (headword, context, label, confidence) with uncertain ones
    asked about: equal questions (headword and the context's first 200 signs)
    once, the least certain first, up to ``budget``."""
    if model is None:
        return candidates
    key = F.xxhash64("headword", F.left("context", F.lit(200)))
    c = candidates.withColumn("key", key)
    open_ = c.filter(F.col("confidence") < threshold).groupBy("key").agg(F.min("confidence").alias("least"), F.min("headword").alias("h"), F.min("context").alias("t"))
    asked = open_.orderBy("least", "key").limit(budget)
    prompt = F.concat(F.lit("Does this start the article "), F.col("h"), F.lit("? ARTICLE_START or MENTION.\n"), F.col("t"))
    answers = asked.select("key", decision(ask(prompt, model)).alias("said"))
    j = c.join(answers, "key", "left")
    new = (F.col("confidence") < threshold) & F.col("said").isNotNull()
    return j.select(*[x for x in candidates.columns if x not in ("label", "confidence")], F.when(new, F.col("said.label")).otherwise(F.col("label")).alias("label"), F.when(new, F.col("said.confidence")).otherwise(F.col("confidence")).alias("confidence"))


def samples(text: Column, size: int = 3000, step: int = 15000, tail: int = 5000) -> Column:
    """Samples of a long text at regular steps, and its end if more than
    ``tail`` signs would stay unseen."""
    n = F.length(text)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step))
    last = F.element_at(starts, -1)
    starts = F.when(n - last - size > tail, F.array_append(starts, n - size)).otherwise(starts)
    return F.transform(starts, lambda a: F.struct(a.alias("start"), F.substring(text, a + 1, F.lit(size)).alias("text")))


ANSWER = "array<struct<title:string,starts_with:string,marker:string,level:int>>"


def answered_sections(answer: Column) -> Column:
    """The JSON list in an answer, whatever stands around it."""
    return F.from_json(F.regexp_extract(answer, r"(?s)\[.*\]", 0), ANSWER)


def locate(text: Column, section: Column) -> Column:
    """0-based place of a section: its first 50 signs, else shorter and
    shorter beginnings of its marker; null if none is found."""
    def at(what: Column, n: int) -> Column:
        w = F.left(what, F.lit(n))
        return F.when((F.length(w) >= 5) & (F.position(w, text) > 0), F.position(w, text) - 1)

    return F.coalesce(at(section["starts_with"], 50), *(at(section["marker"], n) for n in (60, 40, 25, 15)))


def spaced(positions: Column, apart: int = 500) -> Column:
    """Sorted positions without those that are near one kept before."""
    keep = lambda kept, p: F.when(F.exists(kept, lambda k: F.abs(k - p) < apart), kept).otherwise(F.array_append(kept, p))
    return F.aggregate(F.array_sort(positions), F.array().cast("array<int>"), keep)
