"""Dictionary tagging and links between articles."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.spread import spread
from ..functions.text import anchor_id, escape_html


HIT = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("term", T.StringType())]))
_HIT = pa.list_(pa.struct([("pos", pa.int32()), ("term", pa.string())]))
#: Dictionaries of up to so many terms (some 100 MB) are sent to the executors.
SENT_TERMS = 500_000


def _first_places(hits) -> list[dict]:
    """Leftmost and longest hits of (pos, words, term) in order that don't
    overlap; the first place of each term."""
    end, first = 0, {}
    for pos, n, term in hits:
        if pos >= end:
            end = pos + n
            first.setdefault(term, pos)
    return [{"pos": p, "term": t} for t, p in first.items()]


def _scan(terms: list[str]):
    """Arrow UDF that looks a text's words up in the dictionary."""
    by_first: dict[str, dict[int, set[str]]] = {}
    for t in terms:
        words = t.split(" ")
        by_first.setdefault(words[0], {}).setdefault(len(words), set()).add(t)

    def hits(words: list[str]):
        for i, w in enumerate(words):
            for n in sorted(by_first.get(w, ()), reverse=True):
                if (t := " ".join(words[i : i + n])) in by_first[w][n]:
                    yield i + 1, n, t

    @F.arrow_udf(HIT)
    def scan(words: pa.Array) -> pa.Array:
        return pa.array([_first_places(hits(x)) if x else [] for x in words.to_pylist()], _HIT)

    return scan


@F.arrow_udf(HIT)
def _settle(found: pa.Array) -> pa.Array:
    return pa.array([_first_places((h["pos"], -h["minus"], h["term"]) for h in x) for x in found.to_pylist()], _HIT)


def term_hits(docs: DataFrame, terms: DataFrame, key: str, most_words: int, sent: int = SENT_TERMS) -> DataFrame:
    """(key, term, pos): first place, in words, of each term in each text;
    overlapping terms give way to the leftmost and longest.

    A dictionary of up to ``sent`` terms, which is counted first, goes to the
    executors, and only hits leave the scan of the texts. A larger one is joined
    to the texts' n-grams of up to ``most_words`` words."""
    words = F.filter(F.split(F.upper("text"), r"[^\p{L}\p{N}'\-]+"), lambda w: w != "")
    w = spread(docs.select(F.col(key), F.col("text"))).select(F.col(key), words.alias("w"))
    terms = terms.select(F.upper("term").alias("term")).filter("term <> ''").distinct()
    small = terms.limit(sent + 1).collect()
    if len(small) <= sent:
        known = [r["term"] for r in small if r["term"].count(" ") < most_words]
        found = _scan(known)("w")
        return w.select(key, F.explode(found).alias("h")).select(key, "h.term", "h.pos")
    sizes = F.sequence(F.lit(1), F.least(F.lit(most_words), F.size("w")))
    grams = F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.struct(i.alias("pos"), (-n).alias("minus"), F.array_join(F.slice("w", i, n), " ").alias("term")))))
    hits = w.filter(F.size("w") > 0).select(key, F.explode(grams).alias("g")).select(key, "g.pos", "g.minus", "g.term").join(terms, "term")
    rows = hits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "minus", "term"))).alias("found"))
    return rows.select(key, F.explode(_settle("found")).alias("h")).select(key, "h.term", "h.pos")


def valid_terms(index_terms: DataFrame, article_terms: DataFrame) -> DataFrame:
    """Terms that the index and the articles both have."""
    return index_terms.select("term").intersect(article_terms.select("term"))


def article_lookup(articles: DataFrame) -> DataFrame:
    """term and its first volume in each edition, as a map."""
    first = articles.groupBy(F.upper("headword").alias("term"), "edition_year").agg(F.min("volume_num").alias("volume"))
    return first.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("edition_year", "volume"))).alias("volumes"))


def link_year(volumes: Column, year: Column, preferred: int = 1842) -> Column:
    """Edition to link to: the same, else the preferred, else the oldest."""
    return F.when(F.map_contains_key(volumes, year), year).when(F.map_contains_key(volumes, F.lit(preferred)), preferred).otherwise(F.array_min(F.map_keys(volumes)))


def resolved(hits: DataFrame, articles: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """(key, term, target_year, target_volume, href) of hits that have a
    target other than the article itself."""
    a = articles.select(key, F.col("edition_year").alias("year"), F.upper("headword").alias("own"))
    j = hits.join(a, key).join(lookup, "term").filter("term != own").withColumn("target_year", link_year(F.col("volumes"), F.col("year")))
    volume = F.element_at("volumes", F.col("target_year"))
    return j.select(key, "term", "target_year", volume.alias("target_volume"), F.concat(F.col("target_year").cast("string"), F.lit("/vol"), volume.cast("string"), F.lit(".html#"), anchor_id("term")).alias("href"))


def linked_html(text: Column, term: Column, href: Column) -> Column:
    """Escaped text with the first occurrence of a term, as a whole word and
    in any case, made a link. The text is parted before it is escaped, so that
    no entity is taken for a word."""
    quoted = F.concat(F.lit(r"(?iuUs)\A(.*?)(?<![\p{L}\p{N}])(\Q"), term, F.lit(r"\E)(?![\p{L}\p{N}])(.*)\z"))
    part = lambda i: F.call_function("regexp_extract", text, quoted, F.lit(i))
    link = F.concat(F.lit('<a href="'), href, F.lit('">'), escape_html(part(2)), F.lit("</a>"))
    return F.when(part(2) != "", F.concat(escape_html(part(1)), link, escape_html(part(3)))).otherwise(escape_html(text))


def link_count(html: Column) -> Column:
    return F.regexp_count(html, F.lit("<a href="))


def search_index(articles: DataFrame) -> DataFrame:
    """One row for each (lower-case headword, year, volume): the first."""
    w = Window.partitionBy(F.lower("headword"), "edition_year", "volume_num").orderBy("char_start", "headword")
    return articles.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(F.col("headword").alias("h"), F.col("edition_year").alias("y"), F.col("volume_num").alias("v"), F.col("article_type").alias("t"))


def search_headwords(index: DataFrame, query: str, most: int = 100) -> DataFrame:
    """Headwords that contain the query (two letters at least), first 100."""
    if len(query) < 2:
        return index.limit(0)
    return index.filter(F.lower("h").contains(query.lower())).orderBy("h", "y", "v").limit(most)
