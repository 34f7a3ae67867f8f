"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.chunk import packed_chunks
from ..operators.sections import explicit_sections
from ..operators.segment import merge_treatises, segment, typed
from ..operators.stats import dedupe_articles


def extract_corpus(volumes: DataFrame) -> dict[str, DataFrame]:
    """volumes to the tables articles, sections and chunks. Articles are
    deduped first, so no section or chunk is left without its article."""
    articles = typed(merge_treatises(segment(volumes)))
    articles = dedupe_articles(articles, ["edition_year", "char_start"])
    long = articles.filter("article_type = 'treatise'")
    sections = explicit_sections(long, "article_id")
    keyed = sections.selectExpr("concat(article_id, '_s', lpad(cast(index as string), 2, '0')) as section_id", "*")
    chunks = packed_chunks(keyed, "section_id")
    return {"articles": articles, "sections": keyed, "chunks": chunks}


def recover(articles: DataFrame, candidates: DataFrame, expected: DataFrame, cutoff: float = 88) -> DataFrame:
    """Missing headwords found in the text: (pos, candidate, canonical,
    match_type), by exact, learned and fuzzy match in this order."""
    from ..operators import fuzzy as Z

    known = articles.selectExpr("headword as canonical").distinct()
    absent = expected.join(known, "canonical", "left_anti")
    exact = Z.exact_matches(candidates, absent).selectExpr("*", "candidate as canonical")
    variations = Z.learn_variations(candidates.select("candidate").distinct(), expected)
    named = Z.variation_matches(candidates, variations).join(absent, "canonical", "left_semi")
    near = candidates.join(Z.best_match(candidates, absent, cutoff).drop("score"), "candidate")
    cols = ["pos", "candidate", "canonical"]
    return Z.by_priority(exact.select(cols), named.select(cols), near.select(cols))
