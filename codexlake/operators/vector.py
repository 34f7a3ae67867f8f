"""Exact vector search: the queries (a few) against all rows."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def knn(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, vector: str = "embedding", block: int = 1024, digits: int = 6) -> DataFrame:
    """(query_id, item_id, score, rank): the k nearest items by cosine.

    Queries go to the executors in blocks of at most ``block``; each task
    multiplies its items by a block's matrix and keeps k rows a query, so what
    is shuffled is k rows for each task and query. Ties go to the lower id."""
    spark = items.sparkSession
    rows = queries.select(query_id, vector).orderBy(query_id).toLocalIterator()
    found, ids, vecs = None, [], []

    def flush(found):
        if not ids:
            return found
        shared = spark.sparkContext.broadcast((np.array(ids, np.int64), np.array(vecs, np.float64)))

        def run(batches):
            qid, q = shared.value
            q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
            best: list = [None] * len(qid)
            for b in batches:
                v = b.column(1)
                if not len(v):
                    continue
                x = np.asarray(v.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(v), -1)
                own = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                s = np.round((x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)) @ q.T, digits)
                for i in range(len(qid)):
                    pair = (s[:, i], own) if best[i] is None else (np.append(best[i][0], s[:, i]), np.append(best[i][1], own))
                    order = np.lexsort((pair[1], -pair[0]))[:k]
                    best[i] = (pair[0][order], pair[1][order])
            have = [i for i in range(len(qid)) if best[i] is not None]
            if have:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qid[have], [len(best[i][1]) for i in have])), pa.array(np.concatenate([best[i][1] for i in have])), pa.array(np.concatenate([best[i][0] for i in have]))], ["q", "i", "s"])

        schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("i", T.LongType()), T.StructField("s", T.DoubleType())])
        part = items.filter(F.col(vector).isNotNull()).select(F.col(item_id).cast("long"), vector).mapInArrow(run, schema)
        return part if found is None else found.unionByName(part)

    for r in rows:
        if r[vector] is not None:
            ids.append(r[query_id])
            vecs.append(r[vector])
        if len(ids) == block:
            found = flush(found)
            ids, vecs = [], []
    found = flush(found)
    if found is None:
        return spark.createDataFrame([], f"{query_id} long, {item_id} long, score double, rank int")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "i"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select(F.col("q").alias(query_id), F.col("i").alias(item_id), F.col("s").alias("score"), "rank")


def filtered_search(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, where: Column, prefilter: bool = True, **options) -> DataFrame:
    """Search among items that meet a condition; prefilter=False filters the k
    nearest afterwards, which may leave fewer."""
    if prefilter:
        return knn(queries, items.filter(where), k, query_id, item_id, **options)
    return knn(queries, items, k, query_id, item_id, **options).join(items.filter(where).select(item_id), item_id, "left_semi")


def related(seeds: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str, parent: str, vector: str = "embedding") -> DataFrame:
    """For each seed the k parents with the highest mean score of their items
    among its 3k nearest, its own parent left out; ties by parent."""
    near = knn(seeds, items, 3 * k, query_id, item_id, vector)
    own = seeds.select(query_id, F.col(parent).alias("own"))
    scored = near.join(items.select(item_id, parent), item_id).join(own, query_id).filter(~F.col(parent).eqNullSafe(F.col("own")))
    g = scored.groupBy(query_id, parent).agg(F.round(F.avg("score"), 4).alias("score"), F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("score"), parent))
    return g.withColumn("rank", rank).filter(F.col("rank") <= k)


def best_by_parent(hits: DataFrame, items: DataFrame, query_id: str, item_id: str, parent: str) -> DataFrame:
    return hits.join(items.select(item_id, parent), item_id).groupBy(query_id, parent).agg(F.max("score").alias("score"))


def either_search(a: DataFrame, b: DataFrame, query_id: str, item_id: str) -> DataFrame:
    """Union of two searches' hits, each item once with its better score."""
    both = a.select(query_id, item_id, "score").unionByName(b.select(query_id, item_id, "score"))
    return both.groupBy(query_id, item_id).agg(F.max("score").alias("score"))


def text_index(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Inverted index: (token, key, n), lower-case runs of letters and digits."""
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return docs.select(F.col(key), F.explode(tokens).alias("token")).groupBy("token", key).agg(F.count(F.lit(1)).alias("n"))


def text_search(index: DataFrame, total: int, query: str, key: str, k: int) -> DataFrame:
    """The k documents that score highest: the sum over the query's words of
    (1 + ln n) * ln(1 + total / documents with the word); ties by key."""
    words = [w for w in re.split(r"[^\w]+", query.lower()) if w]
    hits = index.filter(F.col("token").isin(words))
    weight = hits.groupBy("token").agg(F.log1p(F.lit(float(total)) / F.count(F.lit(1))).alias("weight"))
    scored = hits.join(weight, "token").groupBy(key).agg(F.round(F.sum((1 + F.log("n")) * F.col("weight")), 6).alias("score"))
    return scored.orderBy(F.desc("score"), key).limit(k)


def command(line: str, articles: DataFrame, search, related_to) -> DataFrame:
    """A search line: "article:NAME" gives the article's rows, "related:NAME"
    calls ``related_to``, anything else ``search`` with the text."""
    kind, _, rest = line.strip().partition(":")
    if rest and kind.lower() == "article":
        return articles.filter(F.upper("headword") == rest.strip().upper()).orderBy("edition_year", "volume_num")
    if rest and kind.lower() == "related":
        return related_to(rest.strip().upper())
    return search(line.strip())
