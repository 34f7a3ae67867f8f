"""Expected headwords by edition: long facts (headword, year, kind)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import INFERENCE_RULES
from ..functions.text import normalize_headword


def expected_from_index(index: DataFrame, year: int, need_references: bool = False) -> DataFrame:
    """Main entries of more than one letter: headword, year, source,
    confidence and the volumes they refer to."""
    main = index.filter((F.col("entry_type") == "main") & (F.length("term") > 1))
    if need_references:
        main = main.filter(F.size("references") > 0)
    vols = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform("references", lambda r: r["vol"])))))
    return main.groupBy(normalize_headword("term").alias("headword")).agg(vols.alias("volumes")).select("headword", F.lit(year).alias("year"), F.lit("index").alias("source"), F.lit(1.0).alias("confidence"), "volumes")


def found(articles: DataFrame) -> DataFrame:
    return articles.select(normalize_headword("headword").alias("headword"), F.col("edition_year").alias("year")).filter(F.length("headword") > 1).distinct()


def infer(facts: DataFrame, rules=INFERENCE_RULES) -> DataFrame:
    """(headword, year, confidence, source) that editions found imply for
    another one. It depends on what was found alone, so one pass is enough."""
    by = facts.groupBy("headword").agg(F.collect_set("year").alias("years"))
    rule = F.array(*(F.struct(F.array(*(F.lit(y) for y in src)).alias("src"), F.lit(dst).alias("dst")) for src, dst in rules))
    hit = F.filter(rule, lambda r: (F.size(F.array_except(r["src"], F.col("years"))) == 0) & ~F.array_contains("years", r["dst"]))
    return by.select("headword", F.explode(hit).alias("r")).select("headword", F.col("r.dst").alias("year"), F.lit(0.7).alias("confidence"), F.lit("found+inferred").alias("source")).distinct()


def coverage(expected: DataFrame, facts: DataFrame) -> DataFrame:
    """Expected, found, missing and extra headwords of each edition."""
    e = expected.select("headword", "year", F.lit(1).alias("e")).distinct()
    f = facts.select("headword", "year", F.lit(1).alias("f")).distinct()
    both = e.join(f, ["headword", "year"], "full")
    n = lambda c: F.count_if(c)
    has_e, has_f = F.col("e").isNotNull(), F.col("f").isNotNull()
    g = both.groupBy("year").agg(n(has_e).alias("expected"), n(has_f).alias("found"), n(has_e & has_f).alias("covered"), n(has_e & ~has_f).alias("missing"), n(~has_e & has_f).alias("extra"))
    return g.withColumn("pct", F.when(F.col("expected") > 0, F.round(100 * F.col("covered") / F.col("expected"), 2)))


def missing(expected: DataFrame, facts: DataFrame) -> DataFrame:
    return expected.select("headword", "year").distinct().join(facts, ["headword", "year"], "left_anti")


def missing_profile(absent: DataFrame) -> DataFrame:
    """Missing headwords by length and first letter."""
    return absent.groupBy(F.length("headword").alias("length"), F.left("headword", F.lit(1)).alias("letter")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("headword").contains(" ")).alias("multi_word"), F.count_if(F.col("headword").contains("-")).alias("hyphenated"), F.count_if(F.col("headword").contains("'")).alias("apostrophe"))


def merge_recovered(articles: DataFrame, recovered: DataFrame) -> DataFrame:
    """Adds recovered articles whose headword is absent; keeps all senses."""
    new = recovered.join(articles.select(F.upper("headword").alias("u")).distinct(), F.upper("headword") == F.col("u"), "left_anti")
    return articles.unionByName(new, allowMissingColumns=True)


def register_variations(known: DataFrame, new: DataFrame) -> DataFrame:
    """Known variations with new ones (variant, canonical) added, once each, in
    the headwords' normal form; a form isn't a variation of itself."""
    both = known.select("variant", "canonical").unionByName(new.select("variant", "canonical"))
    normal = both.select(normalize_headword("variant").alias("variant"), normalize_headword("canonical").alias("canonical"))
    return normal.filter("variant <> canonical").distinct()


def build(index: DataFrame, index_year: int, articles: DataFrame) -> DataFrame:
    """The whole registry: a row for each headword with the editions where it is
    expected (index, or all source editions have it) and found, confidence (the
    highest) and source (of that)."""
    expected = expected_from_index(index, index_year).select("headword", "year", "confidence", "source")
    facts = found(articles)
    implied = infer(facts).select("headword", "year", "confidence", "source")
    both = expected.unionByName(implied)
    e = both.groupBy("headword").agg(F.array_sort(F.collect_set("year")).alias("editions_expected"), F.max("confidence").alias("confidence"), F.max_by("source", F.struct("confidence", "source")).alias("source"))
    f = facts.groupBy("headword").agg(F.array_sort(F.collect_set("year")).alias("editions_found"))
    none = F.array().cast("array<int>")
    out = e.join(f, "headword", "full")
    return out.select("headword", F.coalesce("editions_expected", none).alias("editions_expected"), F.coalesce("editions_found", none).alias("editions_found"), F.coalesce("confidence", F.lit(0.95)).alias("confidence"), F.coalesce("source", F.lit("found")).alias("source"))


def recovery_report(expected: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Coverage of each edition before and after recovery, and the gain."""
    side = lambda facts, name: coverage(expected, facts).select("year", "expected", F.col("covered").alias(name), F.col("pct").alias(f"pct_{name}"))
    b, a = side(before, "before"), side(after, "after").drop("expected")
    return b.join(a, "year").withColumn("recovered", F.col("after") - F.col("before")).filter("expected > 0")
