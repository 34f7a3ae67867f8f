"""Readers of volumes, articles, chunks, indexes and registries.

All of them are Spark data sources, so any path Spark can open will do, and
nothing is read on the driver. Malformed lines are kept apart, not lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions.patterns import FILE_VOLUMES
from ..functions.text import edition_of_title, group, letter_range, volume_of_title


def file_name() -> Column:
    """The file's name; Spark gives it with its signs escaped."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def volume_of_file(name: Column) -> Column:
    """Volume number in a file's name, by the first pattern that fits."""
    return F.coalesce(*(group(name, p, 1, True).cast("int") for p in FILE_VOLUMES))


def read_markdown(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """A file is a volume: file, volume_num, text."""
    t = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).text(path)
    return t.select(file_name().alias("file"), volume_of_file(file_name()).alias("volume_num"), F.col("value").alias("text"))


def page_map(raw: Column) -> Column:
    return F.transform(raw, lambda p: F.struct(p[0].alias("start"), p[1].alias("end"), p[2].cast("int").alias("page")))


def read_ocr_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """One document a line: file, volume_num, text, pages, total_pages, and
    ``malformed`` with the line where it did not parse."""
    r = spark.read.schema(schemas.OCR_DOCUMENT).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("pathGlobFilter", pattern).json(path)
    return _ocr(r)


def read_ocr_array(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Files that hold an array of documents, all of them."""
    r = spark.read.schema(schemas.OCR_DOCUMENT).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").option("pathGlobFilter", pattern).json(path)
    return _ocr(r)


def _ocr(r: DataFrame) -> DataFrame:
    source = F.col("metadata.`Source-File`")
    volume = F.coalesce(group(source, r"Volume\s+(\d+)", 1, True).cast("int"), volume_of_file(file_name()))
    return r.select(file_name().alias("file"), F.col("_metadata.file_size").alias("file_size"), source.alias("source_file"), volume.alias("volume_num"), "text", page_map(F.col("attributes.pdf_page_numbers")).alias("pages"), F.col("metadata.`pdf-total-pages`").alias("total_pages"), F.col("_bad").alias("malformed"))


def longest_per_volume(volumes: DataFrame, by: Column | None = None) -> DataFrame:
    """The volume's longest text (or largest ``by``); the first file on ties."""
    w = Window.partitionBy("volume_num").orderBy(F.desc(by if by is not None else F.length("text")), "file")
    return volumes.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def texts_of_edition(volumes: DataFrame, phrase: str, header: int = 1000, least: int = 1000) -> DataFrame:
    """Texts over a length whose head, in capitals, holds a phrase."""
    return volumes.filter((F.length("text") > least) & F.contains(F.upper(F.left("text", F.lit(header))), F.lit(phrase)))


def discover(volumes: DataFrame) -> DataFrame:
    """Edition, volume and letter range by title; of several sources of one
    volume the best by pages, JSON lines counting ten more; first on ties."""
    head = F.left("text", F.lit(2000))
    v = volumes.select("*", edition_of_title(head).alias("edition_year"), F.coalesce("volume_num", volume_of_title(head)).alias("volume"), letter_range(head).alias("letters"), (F.coalesce("total_pages", F.lit(0)) + F.when(F.col("file").endswith(".jsonl"), 10).otherwise(0)).alias("score"))
    w = Window.partitionBy("edition_year", "volume").orderBy(F.desc("score"), "file")
    return v.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Article lines of all generations, with one name for each field."""
    a = spark.read.schema(schemas.ARTICLE).json(path)
    return a.withColumns({"sense_number": F.coalesce("sense_number", "sense", F.lit(1)), "volume_num": F.coalesce("volume_num", "volume", F.lit(0)), "article_type": F.coalesce("article_type", F.lit("unknown"))}).drop("sense", "volume")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CHUNK).json(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REGISTRY).json(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index lines taken apart; lines that are no entries are left out."""
    from ..functions.text import index_entry

    t = spark.read.text(path)
    return t.select(F.col("value").alias("raw_line"), index_entry("value").alias("e")).filter("e is not null").select("e.*", "raw_line")


def read_index_entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.INDEX_ENTRY).json(path)


def locate(volumes: DataFrame, identifier: str) -> DataFrame:
    """The first file, by name, whose first record's source holds an identifier:
    file and source_file."""
    first = Window.partitionBy("file").orderBy("source_file")
    one = volumes.select("file", "source_file").withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("rn")
    return one.filter(F.contains("source_file", F.lit(identifier))).orderBy("file").limit(1)


def with_sidecars(texts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Texts joined to the metadata files of the same stem; texts without any
    are left out."""
    stem = lambda c: F.regexp_replace(c, r"(?:\.[A-Za-z0-9]{1,5})+$", "")
    return texts.withColumn("stem", stem(F.col("file"))).join(metadata.withColumn("stem", stem(F.col("file"))).drop("file"), "stem")


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """Cached embeddings, by chunk and never by place: chunk_id, embedding."""
    return spark.read.schema("chunk_id string, embedding array<float>").json(path)


def read_variations(spark: SparkSession, path: str) -> DataFrame:
    """Variations that were registered: variant, canonical."""
    return spark.read.schema("variant string, canonical string").json(path)


def line_errors(volumes: DataFrame) -> DataFrame:
    """Records and malformed ones of each file."""
    return volumes.groupBy("file").agg(F.count(F.lit(1)).alias("records"), F.count("malformed").alias("malformed"))


def index_terms(entries: DataFrame) -> DataFrame:
    """Main entries with references and more than one letter."""
    return entries.filter((F.col("entry_type") == "main") & (F.size("references") > 0) & (F.length("term") > 1))
