"""Sections of long articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

import pyarrow as pa
import re

from ..functions.patterns import PACKAGE_SECTIONS, SECTIONS

_CORPUS = [(re.compile(p, re.I), level) for p, level in SECTIONS]
_PACKAGE = [(re.compile(p), level) for p, level in PACKAGE_SECTIONS]
_MARK = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("body", T.IntegerType()), T.StructField("title", T.StringType()), T.StructField("level", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("pos", pa.int32()), ("body", pa.int32()), ("title", pa.string()), ("level", pa.int32())]))


def section_marks(text: str, prose_follows: bool) -> list[dict]:
    """Headings by position; with prose_follows, those that run on in lower
    case are no headings, and titles are one line of 100 characters."""
    out = []
    for p, level in _PACKAGE if prose_follows else _CORPUS:
        for m in p.finditer(text):
            if prose_follows and text[m.end() : m.end() + 1].islower():
                continue
            title = " ".join(m[1].split())[:100] if prose_follows else m[1].strip()
            out.append({"pos": m.start(), "body": m.start() if prose_follows else m.end(), "title": title, "level": level})
    out.sort(key=lambda s: (s["pos"], s["level"]))
    return [s for i, s in enumerate(out) if not i or s["pos"] != out[i - 1]["pos"]]


def _marks(prose_follows: bool):
    @F.arrow_udf(_MARK)
    def marks(text: pa.Array) -> pa.Array:
        return pa.array([section_marks(t, prose_follows) if t else [] for t in text.to_pylist()], _ARROW)

    return marks


def _spans(marks: Column, text: Column, intro: int) -> Column:
    """Sections as structs, with an introduction before the first heading if
    it is at least ``intro`` characters in."""
    own = F.transform(marks, lambda m, i: F.struct(m["title"].alias("title"), m["level"].alias("level"), m["pos"].alias("char_start"), m["body"].alias("body"), F.coalesce(F.get(marks, i + 1)["pos"], F.length(text)).alias("char_end"), F.lit("explicit").alias("method")))
    lead = lambda name, end, how: F.array(F.struct(F.lit(name).alias("title"), F.lit(1).alias("level"), F.lit(0).alias("char_start"), F.lit(0).alias("body"), end.alias("char_end"), F.lit(how).alias("method")))
    first = F.get(marks, 0)["pos"]
    return F.when(F.size(marks) == 0, lead("[Full Article]", F.length(text), "fallback")).when(first >= intro, F.concat(lead("Introduction", first, "explicit"), own)).otherwise(own)


def explicit_sections(articles: DataFrame, key: str = "article_id", profile: str = "corpus", least: int = 500) -> DataFrame:
    """(key, index, title, level, method, char_start, char_end, text).

    corpus: any introduction over 100 characters, no least length. package:
    introductions of 1,000 or more; sections under ``least`` are dropped, headings belong to the
    text."""
    package = profile == "package"
    a = articles.select(F.col(key), F.col("text").alias("whole"), _marks(package)("text").alias("marks"))
    s = a.select(key, "whole", F.explode(_spans(F.col("marks"), F.col("whole"), 1000 if package else 101)).alias("s"))
    body = F.expr("substring(whole, s.body + 1, s.char_end - s.body)")
    if not package:
        body = F.regexp_replace(body, r"(?U)\A\s+|\s+\z", "")
    s = s.select(key, "s.title", "s.level", "s.method", "s.char_start", "s.char_end", body.alias("text"))
    if package:
        s = s.filter((F.length("text") >= least) | (F.col("method") == "fallback"))
    index = F.row_number().over(Window.partitionBy(key).orderBy("char_start")) - 1
    return s.withColumn("index", index)


def length_sections(articles: DataFrame, key: str = "article_id", unit: int = 10000, sep: str = r"\n\s*\n", joint: str = "\n\n") -> DataFrame:
    """clamp(length div unit, 2, 10) parts of equally many paragraphs, the last
    with the rest; even slices if there are fewer paragraphs than parts."""
    n = F.greatest(F.lit(2), F.least(F.lit(10), F.floor(F.length("text") / unit))).cast("int")
    a = articles.select(F.col(key), "text", n.alias("n"), F.split("text", sep).alias("p"))
    i, size = F.col("i"), F.floor(F.length("text") / F.col("n")).cast("int")
    a = a.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    last = i == F.col("n") - 1
    even = F.substring(F.col("text"), i * size + 1, F.when(last, F.length("text")).otherwise(size))
    per = F.floor(F.size("p") / F.col("n")).cast("int")
    some = F.array_join(F.slice("p", i * per + 1, F.when(last, F.size("p")).otherwise(per)), joint)
    return a.select(key, i.alias("index"), F.concat(F.lit("Part "), (i + 1).cast("string")).alias("title"), F.when(F.size("p") < F.col("n"), even).otherwise(some).alias("text"))


def choose_sections(articles: DataFrame, key: str = "article_id", short: int = 5000) -> DataFrame:
    """Short texts stay whole; headings if there are two or more; else length."""
    whole = articles.filter(F.length("text") < short).select(F.col(key), F.lit(0).alias("index"), F.lit("single").alias("method"), "text")
    long = articles.filter(F.length("text") >= short)
    own = explicit_sections(long, key, "package").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    good = own.filter("n >= 2").select(key, "index", F.lit("explicit").alias("method"), "text")
    rest = length_sections(long.join(good.select(key).distinct(), key, "left_anti"), key).select(key, "index", F.lit("fallback").alias("method"), "text")
    return whole.unionByName(good).unionByName(rest)


def section_stats(sections: DataFrame) -> DataFrame:
    return sections.groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("total_chars"), F.min(F.length("text")).alias("min_chars"), F.max(F.length("text")).alias("max_chars"), F.floor(F.avg(F.length("text"))).alias("avg_chars"))
