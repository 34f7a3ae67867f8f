"""Candidates for headwords that are expected but were not found."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import patterns as P
from .classify import boundary
from .segment import article_end


def candidates(volumes: DataFrame, kind: str = "any") -> DataFrame:
    """(volume_id, pos, candidate): what looks like a headword (a comma and a
    small letter follow), in capitals, title case or any case."""
    pattern = re.compile(P.CANDIDATES[kind], re.M)

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("candidate", T.StringType())])))
    def find(text: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("pos", pa.int32()), ("candidate", pa.string())]))
        return pa.array([[{"pos": m.start(1), "candidate": m[1].strip()} for m in pattern.finditer(t)] if t else [] for t in text.to_pylist()], kind)

    return volumes.select("volume_id", F.explode(find("text")).alias("c")).select("volume_id", "c.*")


def sweep(volumes: DataFrame, expected: DataFrame, accept: float = 0.7, most: int = 500) -> DataFrame:
    """Places in each volume where an expected headword (``canonical``) may
    start an article, by the boundary heuristic: (volume_id, pos, canonical,
    confidence). The first ``most`` candidates of a volume are asked
    about, in text order; this budget is the operator's feature."""
    lines = F.split("text", "\n")
    v = volumes.select("volume_id", F.posexplode(lines).alias("n", "line"))
    order = Window.partitionBy("volume_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    v = v.withColumn("pos", F.coalesce(F.sum(F.length("line") + 1).over(order), F.lit(0)))
    # what stands before the line's first comma, or its first word
    before = F.array_distinct(F.transform(F.array(F.regexp_extract("line", r"^([^,]+),", 1), F.regexp_extract("line", r"^(\S+?),?(?:\s|$)", 1)), F.upper))
    named = v.withColumn("canonical", F.explode(F.filter(before, lambda x: x != "")))
    asked = named.join(expected.select(F.upper("canonical").alias("canonical")).distinct(), "canonical")
    rank = F.row_number().over(Window.partitionBy("volume_id").orderBy("pos", "canonical"))
    asked = asked.withColumn("r", rank).filter(F.col("r") <= most)
    b = boundary(F.lit("\n"), F.expr("substring(line, length(canonical) + 1)"))
    return asked.select("volume_id", "pos", "canonical", b.alias("b")).filter((F.col("b.label") == "ARTICLE_START") & (F.col("b.confidence") >= accept)).select("volume_id", "pos", "canonical", "b.confidence")


def recovered_bodies(volumes: DataFrame, found: DataFrame) -> DataFrame:
    """Texts of recovered articles: from each place (volume_id, pos) to the next
    candidate boundary, at most 100,000 characters."""
    ends = candidates(volumes, "capitals").groupBy("volume_id").agg(F.array_sort(F.collect_list("pos")).alias("boundaries"))
    j = found.join(volumes.select("volume_id", "text"), "volume_id").join(ends, "volume_id", "left")
    end = article_end(F.col("text"), F.col("pos"), F.coalesce("boundaries", F.array().cast("array<int>")))
    return j.withColumn("char_end", end).select(*found.columns, "char_end", F.expr("substring(text, pos + 1, char_end - pos)").alias("text"))
