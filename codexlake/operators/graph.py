"""Article graph: edges, successors, new topics, paths."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def has_chunk(chunks: DataFrame, articles: DataFrame) -> DataFrame:
    """Edges from articles to their chunks by headword and year."""
    return articles.select("article_id", "headword", "edition_year").join(chunks.select("chunk_id", "chunk_index", "headword", "edition_year"), ["headword", "edition_year"]).select("article_id", "chunk_id", "chunk_index")


def successors(articles: DataFrame) -> DataFrame:
    """The same headword in the next edition that has it; the first sense of
    each edition stands for it."""
    one = articles.groupBy("headword", "edition_year").agg(F.min_by("article_id", F.struct("volume_num", "char_start")).alias("article_id"), F.min_by("word_count", F.struct("volume_num", "char_start")).alias("word_count"))
    w = Window.partitionBy("headword").orderBy("edition_year")
    s = one.select("headword", F.col("article_id").alias("src"), F.col("edition_year").alias("from_year"), F.lead("article_id").over(w).alias("dst"), F.lead("edition_year").over(w).alias("to_year"), (F.lead("word_count").over(w) - F.col("word_count")).alias("word_count_change"))
    return s.filter("dst is not null")


def new_topics(articles: DataFrame, year: int) -> DataFrame:
    old = articles.filter(F.col("edition_year") < year).select("headword").distinct()
    return articles.filter(F.col("edition_year") == year).select("headword").distinct().join(old, "headword", "left_anti")


def paths(spark: SparkSession, edges: DataFrame, start: DataFrame, most: int = 20) -> DataFrame:
    """(root, node, depth): everything reached from the start nodes along
    edges (src, dst), by a recursive query."""
    views = [f"codexlake_{name}_{uuid.uuid4().hex}" for name in ("edges", "start")]
    for df, view in zip((edges, start), views, strict=True):
        df.createOrReplaceTempView(view)
    try:  # names are resolved here, and calls at the same time have their own
        return spark.sql(f"""
            with recursive walk(root, node, depth) as (
              select node, node, 0 from {views[1]}
              union all
              select w.root, e.dst, w.depth + 1 from walk w join {views[0]} e on e.src = w.node where w.depth < {most})
            select root, node, depth from walk where depth > 0""")
    finally:
        for view in views:
            spark.catalog.dropTempView(view)


def in_degree(edges: DataFrame, most: int) -> DataFrame:
    return edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dst").limit(most)


def growth(articles: DataFrame, a: int, b: int) -> DataFrame:
    """Words of a headword in two editions, and their ratio."""
    g = articles.filter(F.col("edition_year").isin(a, b)).groupBy("headword").agg(F.sum(F.when(F.col("edition_year") == a, F.col("word_count"))).alias("words_a"), F.sum(F.when(F.col("edition_year") == b, F.col("word_count"))).alias("words_b"))
    return g.filter("words_a > 0 and words_b is not null").withColumn("ratio", F.round(F.col("words_b") / F.col("words_a"), 6))


def pair_similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Jaccard of words and length ratio of two text columns."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: w != ""))
    both, either = F.size(F.array_intersect(words(a), words(b))), F.size(F.array_union(words(a), words(b)))
    return pairs.withColumn("jaccard", F.round(F.when(either > 0, both / either).otherwise(0.0), 6)).withColumn("length_ratio", F.round(F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b)), 6))


def article_chunks(edges: DataFrame, articles: DataFrame, chunks: DataFrame, headword: str) -> DataFrame:
    """The chunks of the articles of a headword, in order."""
    a = articles.filter(F.upper("headword") == headword.upper()).select("article_id", "edition_year")
    return edges.select("article_id", "chunk_id", "chunk_index").join(a, "article_id").join(chunks.select("chunk_id", "text"), "chunk_id").orderBy("edition_year", "article_id", "chunk_index")


def entity_links(hits: DataFrame, entities: DataFrame) -> DataFrame:
    """(article_id, entity, kind, count) of dictionary hits (article_id, term)
    that name an entity (entity, kind)."""
    named = hits.join(entities.select(F.upper("entity").alias("term"), "entity", "kind"), "term")
    return named.groupBy("article_id", "entity", "kind").agg(F.count(F.lit(1)).alias("count"))


def shared_entities(links: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Entities that articles of both sides mention, with the numbers of
    articles; sides are summed before they meet, so no pair is made."""
    side = lambda ids, name: links.join(ids.select("article_id").distinct(), "article_id", "left_semi").groupBy("entity", "kind").agg(F.count_distinct("article_id").alias(name))
    return side(a, "articles_a").join(side(b, "articles_b"), ["entity", "kind"])


def topic_growth(articles: DataFrame, topics: DataFrame, a: int, b: int) -> DataFrame:
    """Words on each topic in two editions, and their ratio; topics are
    (headword, topic)."""
    t = articles.join(topics.select("headword", "topic").distinct(), "headword")
    words = lambda y, name: F.sum(F.when(F.col("edition_year") == y, F.col("word_count"))).alias(name)
    g = t.filter(F.col("edition_year").isin(a, b)).groupBy("topic").agg(words(a, "words_a"), words(b, "words_b"))
    return g.filter("words_a > 0 and words_b is not null").withColumn("ratio", F.round(F.col("words_b") / F.col("words_a"), 6))


def sentence_similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Cosine of word counts and the number of sentences two texts share."""
    words = lambda c: F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: w != "")
    sentences = lambda c: F.array_distinct(F.filter(F.transform(F.split(c, r"(?<=[.!?])\s+"), lambda s: F.trim(s)), lambda x: x != ""))
    every = F.array_union(words(a), words(b))
    counts = lambda c: F.transform(every, lambda w: F.size(F.filter(words(c), lambda x: x == w)).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda t, v: t + v)
    x, y = counts(a), counts(b)
    size = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    out = pairs.withColumn("cosine", F.round(F.when(size > 0, dot(x, y) / size).otherwise(0.0), 6))
    return out.withColumn("shared_sentences", F.size(F.array_intersect(sentences(a), sentences(b))))
