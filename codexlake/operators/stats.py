"""Statistics, dedupe, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def type_counts(articles: DataFrame) -> DataFrame:
    return articles.groupBy("edition_year", "article_type").agg(F.count(F.lit(1)).alias("n"), F.floor(F.avg(F.length("text"))).alias("avg_chars"))


def edition_stats(articles: DataFrame) -> DataFrame:
    kind = lambda k: F.count_if(F.col("article_type") == k).alias(f"n_{k}")
    return articles.groupBy("edition_year").agg(F.count_distinct("volume_num").alias("n_volumes"), F.count(F.lit(1)).alias("n_articles"), kind("treatise"), kind("biographical"), kind("geographical"))


def volume_stats(articles: DataFrame) -> DataFrame:
    return articles.groupBy("edition_year", "volume_num").agg(F.count(F.lit(1)).alias("n_articles"), F.count_if(F.col("article_type") == "treatise").alias("n_treatises"))


def classification_stats(articles: DataFrame) -> DataFrame:
    from ..functions.text import coordinates, cross_references, person_dates

    return articles.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size(cross_references("text")) > 0).alias("with_references"), F.count_if(coordinates("text").isNotNull()).alias("with_coordinates"), F.count_if(person_dates("text").isNotNull()).alias("with_dates"), F.floor(F.avg(F.length("text"))).alias("avg_chars"))


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).filter("__rn = 1").drop("__rn")


def dedupe_articles(articles: DataFrame, order: list[Column | str]) -> DataFrame:
    """The first of the articles of one edition and volume that share headword
    and first 100 characters."""
    return keep_first(articles, ["edition_year", F.upper("headword"), "volume_num", F.left("text", F.lit(100))], order)


def senses(articles: DataFrame, order: list[Column | str]) -> DataFrame:
    return articles.withColumn("sense_number", F.row_number().over(Window.partitionBy("edition_year", "volume_num", F.upper("headword")).orderBy(*order)))


def every_nth(df: DataFrame, step: int, order: Column | str, within: str) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(within).orderBy(order)) - 1
    return df.withColumn("__rn", rn).filter(F.col("__rn") % step == 0).drop("__rn")


def length_strata(df: DataFrame, within: str, key: str, ends: int, middle: int) -> DataFrame:
    """Shortest and longest texts and some from a third of the way on."""
    by = Window.partitionBy(within).orderBy(F.length("text"), key)
    r, n = F.row_number().over(by), F.count(F.lit(1)).over(Window.partitionBy(within))
    third = F.floor(F.col("__n") / 3)
    keep = (F.col("__r") <= ends) | (F.col("__r") > F.col("__n") - ends) | ((F.col("__r") > third) & (F.col("__r") <= third + middle))
    return df.withColumn("__r", r).withColumn("__n", n).filter(keep).drop("__r", "__n")


def first_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(text, r"\s+"), 1, n), " ")


def chunks_per_article(chunks: DataFrame) -> DataFrame:
    """Chunks of each (headword, year)."""
    return chunks.groupBy("parent_headword", "edition_year").agg(F.count(F.lit(1)).alias("n_chunks"))


def processing_totals(articles: DataFrame, sections: DataFrame, chunks: DataFrame) -> DataFrame:
    """Volumes, articles, treatises, sections, chunks and words of each edition;
    sections and chunks carry edition_year."""
    a = articles.groupBy("edition_year").agg(F.count_distinct("volume_num").alias("volumes"), F.count(F.lit(1)).alias("articles"), F.count_if(F.col("article_type") == "treatise").alias("treatises"), F.sum("word_count").alias("words"))
    for name, df in (("sections", sections), ("chunks", chunks)):
        a = a.join(df.groupBy("edition_year").agg(F.count(F.lit(1)).alias(name)), "edition_year", "left").fillna(0, [name])
    return a


def volume_lists(articles: DataFrame, most: int = 1000) -> DataFrame:
    """The first ``most`` headwords of each volume, in order, and their number:
    a page's table of contents; lists are cut before they are gathered."""
    w = Window.partitionBy("edition_year", "volume_num").orderBy(F.upper("headword"), "char_start")
    top = articles.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= most)
    lists = top.groupBy("edition_year", "volume_num").agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", "headword"))), lambda x: x["headword"]).alias("headwords"))
    return lists.join(articles.groupBy("edition_year", "volume_num").agg(F.count(F.lit(1)).alias("n")), ["edition_year", "volume_num"])


def first_distinct(df: DataFrame, by: list[str], value: str, most: int = 5) -> DataFrame:
    """The first ``most`` distinct values of each group, sorted; the group is
    cut before it is gathered."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(value))
    few = df.select(*by, value).dropna(subset=[value]).distinct().withColumn("__r", rank).filter(F.col("__r") <= most)
    return few.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("values"))
