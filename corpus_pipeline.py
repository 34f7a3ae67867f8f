"""From raw documents to shards of a training mix.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again as the next one's docs.

Defined cases, for all stages: docs have doc_id, text, source and lang, any other
columns pass by, whatever their names; null and repeated ids are rows like others;
an empty table gives an empty one; long texts are read whole. What a stage does
with nulls, empty texts, ties and repeated rows is told with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.llm import decontam, mixing, neardup, quality_rules, sharding
from codexlake.llm.common import Scratch, free_name, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the rules or whose host is rejected. Null and
    empty texts have no words and fail; a null source is a host like others;
    repeated rows are judged alike."""
    name = free_name(docs, "quality")
    judged = quality_rules.apply_rules(docs, Scratch(spark, "stage-quality"), into=name)
    return judged.filter(F.col(f"{name}.kept")).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: five-word shingles,
    similarity of 0.8 or more. That of the smallest id stays, null last, of
    repeated ids or rows the first in the table; rows without words all stay."""
    return neardup.deduplicated(docs, Scratch(spark, "stage-neardup"), size=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a ten-word window of a benchmark item (of a
    shorter item all of it). Null and empty texts stay; repeated rows fare alike."""
    name = free_name(docs, "contamination")
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "stage-decontam"), window=10, into=name)
    return found.filter(F.size(F.col(f"{name}.spans")) == 0).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each copy that is taken. Texts without words
    are never taken; a null source is one; repeated ids rank alike, and their rows
    are taken one by one."""
    return mixing.mixed_documents(docs, Scratch(spark, "stage-mixing")).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes; adds shard and slot (with underscores if
    docs have such columns). Repeated rows may go to any shards."""
    return sharding.sharded_documents(docs, Scratch(spark, "stage-sharding"), shards=24)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("kd_sharding", sharding_stage),
]

#: Shards are found by recursive weighted medians, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return docs
