import re

import pytest
from pyspark.sql import functions as F

from codexlake.functions import text as X
from codexlake.operators import chunk, classify, evaluate, fuzzy, graph, registry, sections, segment


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("line", "want"),
    [("II. 449", [(2, [449])]), ("XII. 277, 280", [(12, [277, 280])]), ("II. 225; IX. 377", [(2, [225]), (9, [377])]), ("none", [])],
)
def test_index_references(spark, line, want):
    assert [(r.vol, r.pages) for r in one(spark, X.index_references(F.lit(line)))] == want


@pytest.mark.parametrize(
    ("line", "kind", "term"),
    [("ASTRONOMY, II. 449", "main", "ASTRONOMY"), ("ABANGA. See ADY.", "cross_ref", "ABANGA"), ("Abaddé Arabs, II. 225", "sub", "Abaddé Arabs"), ("INK, XII. 277; VIII. 311", "main", "INK"), ("ABA—ABB", None, None), ("", None, None), ("![x]", None, None)],
)
def test_index_lines(spark, line, kind, term):
    got = one(spark, X.index_entry(F.lit(line)))
    assert (got and got.entry_type, got and got.term) == (kind, term)


def test_anchor(spark):
    assert [one(spark, X.anchor_id(F.lit(h))) for h in ("ASTRONOMY", "CHEMISTRY (History of)", "ABD-EL-KADER")] == ["article-ASTRONOMY", "article-CHEMISTRY_HISTORY_OF", "article-ABD_EL_KADER"]


def test_coordinates(spark):
    assert one(spark, X.coordinates(F.lit("E. Long. 73.35. N. Lat. 45.30."))) is None
    assert tuple(one(spark, X.coordinates(F.lit("E. Long. 73. N. Lat. 45.")))) == (73.0, 45.0)


@pytest.mark.parametrize(("text", "want"), [("(1723-1790)", "1723-1790"), ("born 1642 and died 1727", "1642-1727"), ("born 1650", "born 1650"), ("nothing", None)])
def test_dates(spark, text, want):
    assert one(spark, X.person_dates(F.lit(text))) == want


def test_greedy_cross_reference(spark):
    got = one(spark, X.cross_references(F.lit("See astronomy and OPTICS now.")))
    assert [(r.target, r.kind) for r in got] == [("ASTRONOMY AND OPTICS NOW", "see")]


def test_near_matches_compare_with_the_last_kept():
    text = "AAAA, b c d efgh\nBBBB, c d\nCCCC, d e f g h\n"
    at = [m.start() for m in re.finditer(r"^[A-Z]{4},", text, re.M)]
    kept = [m[0] for m in segment.marks(text, "package")]
    want = []
    for p in at:
        if not want or p - want[-1] > 20:
            want.append(p)
    assert kept == want


def test_ratio():
    assert fuzzy.ratio("AALSMEEB", "AALSMEER") == 87.5
    assert fuzzy.ratio("", "") == 100 and fuzzy.ratio("A", "") == 0


def test_blocking_loses_no_pair(spark):
    a = ["AALSMEEB", "AACHEN", "ABACUS", "ABACU", "ZZ", "ABACUSES LONG"]
    b = ["AALSMEER", "ABACUS", "AACHEN", "ABBACUS"]
    got = fuzzy.fuzzy_pairs(spark.createDataFrame([(x,) for x in a], "candidate string"), spark.createDataFrame([(x,) for x in b], "canonical string"), 80).collect()
    assert {(r.candidate, r.canonical) for r in got} == {(x, y) for x in a for y in b if fuzzy.ratio(x, y) >= 80}


def test_inference(spark):
    f = spark.createDataFrame([("X", 1815), ("X", 1823), ("Y", 1815)], "headword string, year int")
    assert [(r.headword, r.year) for r in registry.infer(f).collect()] == [("X", 1810)]


def test_packing_covers_the_text():
    text = "\n\n".join("p" * n for n in (100, 200, 3900, 50, 300, 5000, 20))
    got = chunk.pack(text, r"\n\n+", "\n\n", 4000, 300, 0)
    assert "".join(c for _, _, c in got).replace("\n", "") == text.replace("\n", "")
    assert chunk.pack("short", r"\n\n+", "\n\n", 4000, 300, 200) == [(0, 5, "short")]


def test_fill_and_slide():
    assert chunk.fill(["a" * 5, "b" * 5, "c" * 20], " ", 11) == ["a" * 5 + " " + "b" * 5, "c" * 20]
    got = chunk.slide("x" * 9000, 4000, 800, "\n\n")
    assert [(a, b) for a, b, _ in got] == [(0, 4000), (3200, 7200), (6400, 9000)]


def test_sections(spark):
    body = "Lead " * 30 + "\nPART I. One\n" + "a " * 300 + "\nCHAP. II. Two\n" + "b " * 300
    got = sections.explicit_sections(spark.createDataFrame([("k", body), ("s", "no heads"), ("n", None)], "article_id string, text string")).orderBy("article_id", "index").collect()
    assert [(r.article_id, r.title, r.method) for r in got if r.article_id != "n"] == [("k", "Introduction", "explicit"), ("k", "PART I. One", "explicit"), ("k", "CHAP. II. Two", "explicit"), ("s", "[Full Article]", "fallback")]


@pytest.mark.parametrize(("before", "after", "want"), [("x\n", ", a son", ("ARTICLE_START", 0.9)), ("x\n", " (Name), a son", ("ARTICLE_START", 0.9)), ("See ", ", a", ("MENTION", 0.85)), ("the ", " b", ("MENTION", 0.7)), ("x\n", ". See OTHER", ("ARTICLE_START", 0.85)), ("x\n", " runs", ("UNCERTAIN", 0.5))])
def test_boundary(spark, before, after, want):
    assert tuple(one(spark, classify.boundary(F.lit(before), F.lit(after)))) == want


def test_metrics(spark):
    hits = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, "c", 1)], "q int, label string, rank int")
    want = spark.createDataFrame([(1, "a"), (1, "z"), (2, "c"), (3, "q")], "q int, label string")
    got = {r.q: (r.first_rank, r.reciprocal_rank, r.recall_5) for r in evaluate.retrieval_metrics(hits, want, "q", "label").collect()}
    assert got == {1: (2, 0.5, 0.5), 2: (1, 1.0, 1.0), 3: (None, 0.0, 0.0)}


def test_paths(spark):
    e = spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")
    got = graph.paths(spark, e, spark.createDataFrame([(1,)], "node long")).collect()
    assert sorted((r.node, r.depth) for r in got) == [(2, 1), (3, 2)]
