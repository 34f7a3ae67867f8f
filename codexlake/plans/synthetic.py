"""Volumes made from the part table, so that Spark and SQL agree on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEARS = (1771, 1778, 1797, 1810, 1815, 1823, 1842, 1860)

#: Entry bodies by p_partkey mod 6; @HW@ is the headword, @N@ the key.
BODIES = (
    "@HW@, a term in commerce used by the merchants of several towns for goods of the kind numbered @N@, and for no other goods that are sold there.",
    "@HW@, a town situated @N@ miles north of the river in the county of the same name. E. Long. 73. N. Lat. 45. It has a market on the third day.",
    "@HW@, a celebrated writer on many subjects of the age, was born in 17@NN@, and died 18@NN@ in the city of London, where a statue stands.",
    "@HW@, See ASTRONOMY.",
    "**@HW@**, an instrument of the workshop described at length under the article COMMERCE, with ten figures. See **Optics** for the theory of it.",
    "**@HW@**.\nPART I. Of the parts of the subject, which has been treated by many authors at great length in the older books on this matter.\nPART II. Of the use of it, and of the number @N@ of the trials that were made of it.",
)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, headword, edition_year, volume_num, volume_id, text: one a part."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"), F.upper("p_name").alias("headword"))
    k = F.col("k")
    body = F.element_at(F.array(*(F.lit(b) for b in BODIES)), (k % 6 + 1).cast("int"))
    for mark, value in (("@HW@", F.col("headword")), ("@NN@", F.lpad((k % 90 + 10).cast("string"), 2, "0")), ("@N@", k.cast("string"))):
        body = F.replace(body, F.lit(mark), value)
    year = F.element_at(F.array(*(F.lit(y) for y in YEARS)), (k % 8 + 1).cast("int"))
    volume = (F.floor(k / 8) % 3 + 1).cast("int")
    e = p.select("k", "headword", year.alias("edition_year"), volume.alias("volume_num"), body.alias("text"))
    return e.withColumn("volume_id", F.format_string("%d_v%02d", "edition_year", "volume_num"))


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a volume joined in order, after a single-letter entry."""
    e = entries(spark, sf_dir)
    text = F.concat(F.lit("A\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "\n\n"))
    return e.groupBy("volume_id", "edition_year", "volume_num").agg(text.alias("text"))


def _sql_text() -> str:
    case = " ".join(f"when {i} then '{b}'" for i, b in enumerate(BODIES)).replace("\n", "' || chr(10) || '")
    return f"replace(replace(replace(case p_partkey % 6 {case} end, '@HW@', upper(p_name)), '@NN@', lpad(cast(p_partkey % 90 + 10 as varchar), 2, '0')), '@N@', cast(p_partkey as varchar))"


#: The same as a common table expression ``e``.
ENTRIES_SQL = f"e0 as (select p_partkey as k, upper(p_name) as headword, [{', '.join(map(str, YEARS))}][p_partkey % 8 + 1] as edition_year, (p_partkey // 8) % 3 + 1 as volume_num, {_sql_text()} as text from part), e as (select *, printf('%d_v%02d', edition_year, volume_num) as volume_id from e0)"


def doc_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as articles: the first word is the headword."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hw = F.upper(F.regexp_extract("text", "^[A-Za-z]+", 0))
    year = F.element_at(F.array(*(F.lit(y) for y in YEARS)), (F.col("doc_id") % 8 + 1).cast("int"))
    a = d.select("doc_id", hw.alias("headword"), year.alias("edition_year"), (F.floor(F.col("doc_id") / 8) % 20 + 1).cast("int").alias("volume_num"), "text")
    return a.withColumn("article_type", F.when(F.length("text") > 5000, "treatise").when(F.length("text") < 100, "cross_reference").otherwise("dictionary"))


DOC_SQL = f"a as (select doc_id, upper(regexp_extract(text, '^[A-Za-z]+')) as headword, [{', '.join(map(str, YEARS))}][doc_id % 8 + 1] as edition_year, (doc_id // 8) % 20 + 1 as volume_num, text, case when length(text) > 5000 then 'treatise' when length(text) < 100 then 'cross_reference' else 'dictionary' end as article_type from documents)"
