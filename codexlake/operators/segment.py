"""Headword segmentation: volumes to articles.

Rules propose marks (an Arrow UDF over the text column finds all matches), near
marks are settled by search in the sorted positions, and each body is cut once,
from one pass over the text. Senses, pages, merges and kinds are columns.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import patterns as P
from ..functions.text import is_structural
from .classify import article_type, is_artifact

NEAR = 20
FIELDS = {"pos": T.IntegerType(), "stop": T.IntegerType(), "headword": T.StringType(), "kind": T.StringType(), "body": T.StringType()}
_ARROW = pa.list_(pa.struct([("pos", pa.int32()), ("stop", pa.int32()), ("headword", pa.string()), ("kind", pa.string()), ("body", pa.string())]))
_TOKEN = re.compile(r"\S+")
_SINGLE = re.compile(P.ALPHABET_ENTRY, re.M)
_STRUCTURE = re.compile(P.STRUCTURAL, re.I)
_FRONT = [re.compile(p) for p in P.FRONT_MATTER_HEADWORDS]
_SHORT = re.compile(r"[^\W\d_]+")


class Mark(NamedTuple):
    """Where an entry starts, where its body does, and the rule that says so."""

    pos: int
    rank: int
    body: int
    headword: str
    kind: str


class Rule(NamedTuple):
    """A pattern that proposes marks. ``body`` gives the body's start."""

    kind: str
    pattern: re.Pattern
    body: Callable[[str, re.Match], int]
    least: int = 1
    barred: frozenset[str] = frozenset()
    after_see: bool = True


def _after_token(text: str, m: re.Match) -> int:
    """Verb entries keep the last letters of the headword as far as the blank
    lines before it are long: published articles start there."""
    first = _TOKEN.search(text, m.start())
    return m.start() + 1 + first.end() - first.start()


def _at_line(text: str, m: re.Match) -> int:
    return m.start()


def _at_end(text: str, m: re.Match) -> int:
    return m.end()


PACKAGE = tuple(Rule(kind, re.compile(p, re.M), _at_line) for kind, p, _ in P.HEADWORDS)
CORPUS = (
    Rule("comma", re.compile(P.ENTRY_COMMA, re.M), _at_end),
    Rule("verb", re.compile(P.ENTRY_VERB, re.M | re.I), _after_token, 3, frozenset(P.STOPWORDS)),
    Rule("treatise", re.compile(P.ENTRY_TREATISE, re.M), _at_end, 3, after_see=False),
)


def proposed(text: str, rules: tuple[Rule, ...]) -> list[Mark]:
    """All rules' marks, by place and then by the rules' order."""
    def of(rank: int, rule: Rule) -> Iterator[Mark]:
        for m in rule.pattern.finditer(text):
            name = m[1].strip()
            if len(m[1]) < rule.least or name.upper() in rule.barred:
                continue
            if rule.after_see or not re.search(r"see\s*\Z", text[max(0, m.start() - NEAR) : m.start()], re.I):
                yield Mark(m.start(), rank, rule.body(text, m), name, rule.kind)

    return sorted((x for i, r in enumerate(rules) for x in of(i, r)), key=lambda x: (x.pos, x.rank))


def settled(marks: list[Mark], stronger: str | None = None) -> list[Mark]:
    """Marks more than ``NEAR`` apart from the last one kept. The first of a
    group stays, unless another in reach is of the stronger kind."""
    places = [m.pos for m in marks]
    out, i = [], 0
    while i < len(marks):
        reach = bisect_right(places, places[i] + NEAR)
        if stronger and marks[i].kind != stronger:
            rival = next((k for k in range(i + 1, reach) if marks[k].kind == stronger), i)
            if rival != i:
                i = rival
                continue
        out.append(marks[i])
        i = reach
    return out


def _first_of_package(text: str, marks: list[Mark]) -> int:
    """Where articles begin: at a lone letter, else at the first real headword
    behind the first 1,000 characters."""
    lone = _SINGLE.search(text)
    if lone:
        return lone.start()
    return next((m.pos for m in marks if m.pos >= 1000 and len(m.headword) > 1 and not _STRUCTURE.match(m.headword)), 0)


def _first_of_corpus(text: str, marks: list[Mark]) -> int:
    """At the first headword of up to six letters that isn't front matter."""
    for m in marks:
        name = m.headword.upper()
        if len(name) < 7 and not any(p.match(name) for p in _FRONT) and _SHORT.fullmatch(name.translate({39: None, 45: None})):
            return m.pos
    return 0


#: rules, the kind that wins among near marks, and where articles begin
PROFILES = {"package": (PACKAGE, None, _first_of_package), "corpus": (CORPUS, "treatise", _first_of_corpus)}


def marks(text: str, profile: str = "corpus") -> list[Mark]:
    """The entries of a volume, without its front matter."""
    rules, stronger, first = PROFILES[profile]
    kept = settled(proposed(text, rules), stronger)
    begin = first(text, kept)
    return [m for m in kept if m.pos >= begin]


def bodies_udf(profile: str):
    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField(k, v) for k, v in FIELDS.items()])))
    def bodies(text: pa.Array) -> pa.Array:
        out = []
        for t in text.to_pylist():
            found = marks(t, profile) if t else []
            stops = [m.pos for m in found[1:]] + [len(t or "")]
            out.append([{"pos": m.pos, "stop": stop, "headword": m.headword, "kind": m.kind, "body": t[m.body : stop].strip()} for m, stop in zip(found, stops, strict=True)])
        return pa.array(out, _ARROW)

    return bodies


def segment(volumes: DataFrame, profile: str = "corpus") -> DataFrame:
    """One row per article of volumes (volume_id, edition_year, volume_num,
    text and, if there is one, the page map ``pages``): headword, sense_number,
    char span, kind of match, body, start_page and end_page (null without map).

    ``text`` of the package profile starts at the headword's line, that of the
    corpus profile after the headword. Bodies under ten characters are dropped;
    so are recognition artefacts in the corpus profile."""
    keys = ["volume_id", "edition_year", "volume_num"]
    paged = "pages" in volumes.columns
    v = volumes.select(*keys, *(["pages"] if paged else []), F.explode(bodies_udf(profile)("text")).alias("m"))
    page = (lambda at: page_of(F.col("pages"), at)) if paged else (lambda at: F.lit(None).cast("int"))
    a = v.select(
        *keys,
        F.upper(F.trim("m.headword")).alias("headword"),
        F.col("m.kind").alias("kind"),
        F.col("m.pos").alias("char_start"),
        F.col("m.stop").alias("char_end"),
        F.col("m.body").alias("text"),
        page(F.col("m.pos")).cast("int").alias("start_page"),
        page(F.col("m.stop") - 1).cast("int").alias("end_page"),
    ).filter(F.length("text") >= 10)
    if profile == "corpus":
        a = a.filter(~is_artifact(F.col("headword"), F.col("text")))
    sense = F.row_number().over(Window.partitionBy("volume_id", "headword").orderBy("char_start"))
    return a.withColumn("sense_number", sense)


def merge_treatises(articles: DataFrame) -> DataFrame:
    """Joins consecutive articles of one listed treatise in a volume."""
    order = Window.partitionBy("volume_id").orderBy("char_start")
    joins = F.col("headword").isin(list(P.TREATISES)) & (F.lag("headword").over(order) == F.col("headword"))
    a = articles.withColumn("run", F.sum(F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("char_start", "text", "kind", "sense_number")))
    g = a.groupBy("volume_id", "edition_year", "volume_num", "headword", "run").agg(
        parts.alias("parts"),
        F.min("char_start").alias("char_start"),
        F.max("char_end").alias("char_end"),
        F.min_by("start_page", "char_start").alias("start_page"),
        F.max_by("end_page", "char_start").alias("end_page"),
    )
    return g.select(
        "volume_id", "edition_year", "volume_num", "headword",
        F.col("parts")[0]["kind"].alias("kind"),
        "char_start", "char_end",
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n\n").alias("text"),
        "start_page", "end_page",
        F.col("parts")[0]["sense_number"].alias("sense_number"),
    )


def typed(articles: DataFrame, profile: str = "corpus") -> DataFrame:
    """Adds article_type, article_id, is_cross_reference and word_count."""
    hw, text, year = F.col("headword"), F.col("text"), F.col("edition_year")
    marked = F.col("kind").isin("treatise", "bold_period", "caps_period") if profile == "corpus" else None
    kind = article_type(hw, text, year, profile, marked)
    base = F.format_string("%d_v%02d_%s", "edition_year", "volume_num", F.replace("headword", F.lit(" "), F.lit("_")))
    sense = F.when(F.col("sense_number") > 1, F.concat(F.lit("_s"), F.col("sense_number").cast("string"))).otherwise("")
    a = articles.select("*", kind.alias("article_type"), F.concat(base, sense).alias("article_id"))
    words = F.regexp_count(F.col("text"), F.lit(r"(?U)\S+"))
    return a.withColumns({"is_cross_reference": F.col("article_type") == "cross_reference", "word_count": words})


def confidence(articles: DataFrame, valid: Column | None = None) -> DataFrame:
    """Weight of the pattern, halved if invalid, less 20 % for short text, 20 %
    more for listed treatises; at most 1."""
    weight = F.coalesce(*(F.when(F.col("kind") == name, w) for name, _, w in P.HEADWORDS), F.lit(0.5))
    ok = valid if valid is not None else ~is_structural("headword") & (F.length("headword") >= 2)
    c = weight * F.when(ok, 1.0).otherwise(0.5) * F.when(F.length("text") < 50, 0.8).otherwise(1.0)
    listed = F.col("headword").isin(list(P.TREATISES))
    return articles.withColumn("confidence", F.round(F.when(listed, F.least(c * 1.2, F.lit(1.0))).otherwise(c), 3))


def page_of(pages: Column, position: Column) -> Column:
    """First page whose closed interval holds the offset; stays in the row."""
    return F.get(F.filter(pages, lambda p: (p["start"] <= position) & (position <= p["end"])), 0)["page"]


def page_as_of(marks: Column, position: Column) -> Column:
    """Page of the last marker at or before the offset."""
    return F.element_at(F.filter(marks, lambda m: m["pos"] <= position), -1)["page"]


def page_range(pages: Column, start: Column, end: Column) -> Column:
    """Pages (start_page, end_page) of a span. Entries (0, 0) of the map are
    unset. The map is read up to the first entry that holds the end or begins
    behind it; the former's page is the end's, the latter's less one (1 at least).
    Of the entries read that hold the start the last counts."""
    real = F.filter(pages, lambda p: (p["start"] != 0) | (p["end"] != 0))
    stops = F.transform(real, lambda p: ((p["start"] <= end) & (end <= p["end"])) | (p["start"] > end))
    n = F.coalesce(F.array_position(stops, F.lit(True)), F.lit(0)).cast("int")
    stop = F.get(real, n - 1)
    end_page = F.when(n > 0, F.when(stop["start"] <= end, stop["page"]).otherwise(F.greatest(stop["page"] - 1, F.lit(1))))
    holds = F.filter(F.when(n > 0, F.slice(real, 1, n)).otherwise(real), lambda p: (p["start"] <= start) & (start <= p["end"]))
    start_page = F.when(F.size(holds) > 0, F.element_at(holds, -1)["page"])
    return F.struct(start_page.cast("int").alias("start_page"), end_page.cast("int").alias("end_page"))


def article_end(text: Column, start: Column, boundaries: Column, skip: int = 50, most: int = 100_000) -> Column:
    """Where an article that starts at ``start`` ends: the next of the sorted
    ``boundaries`` (an array of offsets) from ``skip`` on, within ``most``."""
    later = F.filter(boundaries, lambda b: b >= start + skip)
    return F.least(F.coalesce(F.get(later, 0), F.length(text)), start + most, F.length(text))
