"""Retrieval metrics and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def retrieval_metrics(hits: DataFrame, expected: DataFrame, query: str, label: str, depths: tuple[int, ...] = (5, 10)) -> DataFrame:
    """Per query: rank of the first relevant hit (null if none), reciprocal
    rank, and recall of the distinct expected labels at each depth.

    hits: query, label, rank; expected: query, label (one row each)."""
    e = expected.select(query, label).distinct()
    total = e.groupBy(query).agg(F.count(F.lit(1)).alias("n_expected"))
    good = hits.join(e, [query, label])
    g = good.groupBy(query).agg(F.min("rank").alias("first_rank"), *(F.count_distinct(F.when(F.col("rank") <= d, F.col(label))).alias(f"found_{d}") for d in depths))
    out = total.join(g, query, "left")
    return out.select(query, "first_rank", F.round(F.coalesce(1 / F.col("first_rank"), F.lit(0.0)), 6).alias("reciprocal_rank"), *(F.round(F.coalesce(F.col(f"found_{d}"), F.lit(0)) / F.col("n_expected"), 6).alias(f"recall_{d}") for d in depths))


def summary(per_query: DataFrame, by: list[str] | None = None, depths: tuple[int, ...] = (5, 10)) -> DataFrame:
    return per_query.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n_queries"), F.round(F.avg("reciprocal_rank"), 6).alias("mrr"), *(F.round(F.avg(f"recall_{d}"), 6).alias(f"recall_{d}") for d in depths))


def compare(a: DataFrame, b: DataFrame, query: str) -> DataFrame:
    """Wins of two models by rank of the first relevant hit."""
    j = a.select(query, F.col("first_rank").alias("ra")).join(b.select(query, F.col("first_rank").alias("rb")), query, "full")
    outcome = F.when(F.col("ra").eqNullSafe(F.col("rb")), "tie").when(F.col("rb").isNull() | (F.col("ra") < F.col("rb")), "first").otherwise("second")
    return j.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def matrix(results: DataFrame, rows: str, columns: str, values: list[str], metric: str) -> DataFrame:
    """A metric by model and method, with each model's best method."""
    best = results.groupBy(rows).agg(F.max_by(columns, F.struct(metric, columns)).alias("best"))
    return results.groupBy(rows).pivot(columns, values).agg(F.round(F.first(metric), 6)).join(best, rows)
