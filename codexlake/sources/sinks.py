"""Writers. Each writes to a new path through Spark's committers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_corpus(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Tables (volumes, articles, sections, chunks) by edition year."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy("edition_year").format(fmt).save(f"{path}/{name}")


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def summary_lines(articles: DataFrame) -> DataFrame:
    """Fixed-width lines: headword, sense, volume, page, flags."""
    flag = F.when(F.coalesce(F.col("is_cross_reference"), F.lit(False)), " [xref]").otherwise("")
    sense = F.when(F.col("sense_number") > 1, F.format_string(" (%d)", "sense_number")).otherwise("")
    return articles.select(F.format_string("%-30s V%02d p%04d%s%s", "headword", "volume_num", F.coalesce("start_page", F.lit(0)), sense, flag).alias("line"))


def volume_parts(volumes: DataFrame) -> DataFrame:
    """A name for each text of an (edition, volume), numbered in file order."""
    part = F.row_number().over(Window.partitionBy("edition_year", "volume").orderBy("file"))
    return volumes.withColumn("part", part).withColumn("out_name", F.format_string("edition_%d_vol%02d_part%d_%s", "edition_year", "volume", "part", F.coalesce("letters", F.lit("unknown"))))


def merged_sorted(articles: DataFrame) -> DataFrame:
    return articles.orderBy(F.upper("headword"), "volume_num", "char_start")


def volume_page_data(articles: DataFrame) -> DataFrame:
    """The JSON a volume's page loads: rows of headword, type and pages."""
    row = F.struct(F.col("headword").alias("h"), F.col("article_type").alias("t"), F.col("start_page").alias("sp"), F.col("end_page").alias("ep"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("char_start", row.alias("r")))), lambda x: x["r"])
    return articles.groupBy("edition_year", "volume_num").agg(F.to_json(rows).alias("data"))


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace those of the same keys; both sides are keyed."""
    return existing.join(new.select(keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1)
    if twice:
        raise ValueError(f"{keys} are not unique: {twice[0]}")


def write_statistics(articles: DataFrame, path: str) -> None:
    """One JSON line for each edition: volumes, articles, articles by type."""
    kinds = articles.groupBy("edition_year", "article_type").agg(F.count(F.lit(1)).alias("n"))
    types = kinds.groupBy("edition_year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("article_type", "n")))).alias("types"), F.sum("n").alias("articles"))
    volumes = articles.groupBy("edition_year").agg(F.count_distinct("volume_num").alias("volumes"))
    types.join(volumes, "edition_year").orderBy("edition_year").coalesce(1).write.mode("overwrite").json(path)


def write_registry(registry: DataFrame, variations: DataFrame, path: str) -> None:
    """The registry and the variations, as lines that the readers read."""
    registry.write.mode("overwrite").json(f"{path}/registry")
    variations.select("variant", "canonical").write.mode("overwrite").json(f"{path}/variations")


def replace_with_backup(df: DataFrame, path: str) -> None:
    """Writes df, as lines, in place of a folder whose content is kept beside it
    as ``.backup``; df may read that folder, as it is written elsewhere first."""
    spark = df.sparkSession
    df.write.mode("overwrite").json(f"{path}.new")
    place = spark._jvm.org.apache.hadoop.fs.Path
    new, old, backup = place(f"{path}.new"), place(path), place(f"{path}.backup")
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(old):
        fs.delete(backup, True)
        fs.rename(old, backup)
    fs.rename(new, old)


def site_pages(articles: DataFrame, preview: int = 300) -> DataFrame:
    """A page for each volume: its file name and HTML, a heading, and for each
    article anchor, headword, kind, pages and the start of its text."""
    from ..functions import text as X

    pages = F.when(F.col("start_page").isNotNull(), F.concat(F.lit(", p. "), F.concat_ws("-", "start_page", F.nullif("end_page", "start_page")))).otherwise("")
    row = F.concat(F.lit('<article id="'), X.anchor_id("headword"), F.lit('"><h2>'), X.escape_html("headword"), F.lit("</h2><p class=\"kind\">"), "article_type", pages, F.lit("</p><p>"), X.escape_html(X.preview("text", preview)), F.lit("</p></article>"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("char_start", row.alias("r")))), lambda x: x["r"]), "\n")
    g = articles.groupBy("edition_year", "volume_num").agg(rows.alias("rows"), F.count(F.lit(1)).alias("n"))
    head = F.format_string("<!doctype html><title>%d, volume %d</title><h1>%d, volume %d: %d articles</h1>\n", "edition_year", "volume_num", "edition_year", "volume_num", "n")
    return g.select(F.format_string("%d/vol%d.html", "edition_year", "volume_num").alias("file"), F.concat(head, "rows").alias("html"))


def site_index(articles: DataFrame) -> DataFrame:
    """The page of each edition: its volumes with their numbers of articles."""
    v = articles.groupBy("edition_year", "volume_num").agg(F.count(F.lit(1)).alias("n"))
    line = F.format_string('<li><a href="vol%d.html">Volume %d</a> (%d)</li>', "volume_num", "volume_num", "n")
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("volume_num", line.alias("r")))), lambda x: x["r"]), "\n")
    return v.groupBy("edition_year").agg(rows.alias("rows")).select(F.format_string("%d/index.html", "edition_year").alias("file"), F.concat(F.lit("<ul>\n"), "rows", F.lit("\n</ul>")).alias("html"))
