"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cotrain, decontam, langid, lm, mixing, neardup, quality_rules, repeats, sharding, warc
from .common import Scratch, fold_of, table
from .queries_sql import ORACLE  # noqa: F401


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = cotrain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark, "op1"))
    toxic = F.col("toxic_all") >= 0.5
    return p.select("doc_id", F.col("quality_text").alias("text_score"), F.col("quality_meta").alias("meta_score"), F.col("quality_all").alias("score"), F.col("toxic_all").alias("toxic_score"), toxic.alias("toxic"), ((F.col("quality_all") >= 0.5) & ~toxic).alias("kept"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    c = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "op2"))
    c = c.select("doc_id", "contamination.*")
    n_hit = decontam.n_hit(F.col("spans"))
    return c.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages"), Scratch(spark, "op3"))
    return warc.parsed(warc.read_archive(*archive))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 5) == 0
    profiles = langid.learn(docs.filter(~held_out))
    out = docs.select("doc_id", held_out.alias("held_out"), langid.predict(F.col("text"), profiles).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), Scratch(spark, "op5"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id"), 7) == 2
    return lm.score_texts(docs, ~held_out, Scratch(spark, "op6"), [F.col("doc_id"), held_out.alias("held_out")])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # only ids, hosts and counts are written between the two passes
    m = docs.select("doc_id", "source", quality_rules.metrics("text").alias("q"))
    scratch = Scratch(spark, "op7")
    out = quality_rules.judge(scratch.put(m, "measured"), scratch, "source", "q")
    q = "quality."
    return out.select("doc_id", *(F.col(q + c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.kd_shards(table(spark, sf_dir, "documents"), Scratch(spark, "op8"))
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op9"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, Scratch(spark, "op10"), size=4, percent=80)


QUERIES = {
    "op1_cotraining": op1_cotraining,
    "op2_decontamination": op2_decontamination,
    "op3_warc": op3_warc,
    "op4_langid": op4_langid,
    "op5_mixing": op5_mixing,
    "op6_lm": op6_lm,
    "op7_quality_rules": op7_quality_rules,
    "op8_sharding": op8_sharding,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_minhash": op10_minhash,
}
