"""Registered queries: each an operator on the driver's tables, with SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import chunk, classify, evaluate, fuzzy, graph, link, registry, sections, segment, stats, vector
from .plans.synthetic import DOC_SQL, ENTRIES_SQL, doc_articles, entries, volumes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WITH_E, WITH_A = f"with {ENTRIES_SQL}", f"with {DOC_SQL}"

# --- statistics and dedupe ---------------------------------------------------


@query(f"{WITH_A} select edition_year, article_type, count(*) as n, cast(floor(avg(length(text))) as bigint) as avg_chars from a group by all")
def article_type_counts(spark, sf_dir):
    return stats.type_counts(doc_articles(spark, sf_dir))


@query(f"{WITH_A} select edition_year, count(distinct volume_num) as n_volumes, count(*) as n_articles, count(*) filter (article_type = 'treatise') as n_treatise, count(*) filter (article_type = 'biographical') as n_biographical, count(*) filter (article_type = 'geographical') as n_geographical from a group by all")
def edition_stats(spark, sf_dir):
    return stats.edition_stats(doc_articles(spark, sf_dir))


@query(f"{WITH_A} select edition_year, volume_num, count(*) as n_articles, count(*) filter (article_type = 'treatise') as n_treatises from a group by all")
def volume_stats(spark, sf_dir):
    return stats.volume_stats(doc_articles(spark, sf_dir))


@query(f"{WITH_A} select doc_id, headword, volume_num from a qualify row_number() over (partition by edition_year, upper(headword), volume_num, left(text, 100) order by doc_id) = 1")
def article_dedupe(spark, sf_dir):
    return stats.dedupe_articles(doc_articles(spark, sf_dir), ["doc_id"]).select("doc_id", "headword", "volume_num")


@query(f"{WITH_A} select doc_id, edition_year, volume_num, headword, cast(row_number() over (partition by edition_year, volume_num, upper(headword) order by doc_id) as int) as sense_number from a")
def sense_numbers(spark, sf_dir):
    return stats.senses(doc_articles(spark, sf_dir), ["doc_id"]).select("doc_id", "edition_year", "volume_num", "headword", "sense_number")


@query(f"{WITH_A} select headword as h, edition_year as y, volume_num as v, article_type as t from a qualify row_number() over (partition by lower(headword), edition_year, volume_num order by doc_id, headword) = 1")
def search_index(spark, sf_dir):
    return link.search_index(doc_articles(spark, sf_dir).withColumnRenamed("doc_id", "char_start"))


@query(f"{WITH_A}, b as (select distinct headword as h, edition_year as y, volume_num as v from a where contains(lower(headword), 'th')) select h, y, v from b order by h, y, v limit 100")
def headword_search(spark, sf_dir):
    index = link.search_index(doc_articles(spark, sf_dir).withColumnRenamed("doc_id", "char_start"))
    return link.search_headwords(index, "th").select("h", "y", "v")


@query(f"{WITH_A}, p as (select unnest(string_split(text, chr(10))) as t from a) select count(*) as num_chunks, min(length(t)) as min_size, max(length(t)) as max_size, cast(floor(avg(length(t))) as bigint) as avg_size, median(length(t)) as median_size, count(*) filter (length(t) < 100) as tiny, count(*) filter (length(t) >= 100 and length(t) < 500) as small, count(*) filter (length(t) >= 500 and length(t) < 2000) as medium, count(*) filter (length(t) >= 2000 and length(t) < 5000) as large, count(*) filter (length(t) >= 5000) as huge from p")
def chunk_size_histogram(spark, sf_dir):
    return chunk.size_profile(doc_articles(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("text")))


@query(f"{WITH_A} select doc_id from a qualify (row_number() over (partition by edition_year order by doc_id) - 1) % 7 = 0")
def systematic_sample(spark, sf_dir):
    return stats.every_nth(doc_articles(spark, sf_dir), 7, "doc_id", "edition_year").select("doc_id")


@query(f"{WITH_A}, r as (select doc_id, row_number() over (partition by edition_year order by length(text), doc_id) as r, count(*) over (partition by edition_year) as n from a) select doc_id from r where r <= 5 or r > n - 5 or (r > floor(n / 3) and r <= floor(n / 3) + 10)")
def length_strata(spark, sf_dir):
    return stats.length_strata(doc_articles(spark, sf_dir), "edition_year", "doc_id", 5, 10).select("doc_id")


# --- text functions -----------------------------------------------------------

_REFS = " union all ".join(
    f"select k, '{kind}' as kind, upper(trim(unnest(regexp_extract_all(text, '(?i){p}', 1)))) as target from e"
    for kind, p in (("see", r"\bSee\s+([A-Z][A-Z''\-]+(?:\s+[A-Z][A-Z''\-]+)*)"), ("article", r"\bSee\s+(?:the\s+)?article\s+([A-Z][A-Z''\-]+)"), ("bold", r"\bSee\s+\*\*([A-Za-z][A-Za-z''\-\s]+)\*\*"), ("under", r"\bunder\s+(?:the\s+(?:article|head|word)\s+)?([A-Z][A-Z''\-]+)"))
)


@query(f"{WITH_E} select distinct k, kind, target from ({_REFS})")
def cross_refs(spark, sf_dir):
    return entries(spark, sf_dir).select("k", F.explode(X.cross_references("text")).alias("r")).select("k", "r.kind", "r.target")


@query(WITH_E + r""", m as (select k, try_cast(regexp_extract(text, '(?i)[EW]\.\s*Long\.\s*([\d\.]+)', 1) as double) as lon, try_cast(regexp_extract(text, '(?i)[NS]\.\s*Lat\.\s*([\d\.]+)', 1) as double) as lat from e) select k, lon, lat from m where lon is not null and lat is not null""")
def coordinates(spark, sf_dir):
    return entries(spark, sf_dir).select("k", X.coordinates("text").alias("c")).filter("c is not null").select("k", "c.lon", "c.lat")


@query(WITH_E + r""", m as (select k, regexp_extract(text, '(?i)\bborn\s+(?:in\s+)?(\d{4})', 1) as b, regexp_extract(text, '(?i)\bdied\s+(?:in\s+)?(\d{4})', 1) as d from e) select k, case when b <> '' and d <> '' then b || '-' || d when b <> '' then 'born ' || b when d <> '' then 'died ' || d end as dates from m""")
def person_dates(spark, sf_dir):
    return entries(spark, sf_dir).select("k", X.person_dates("text").alias("dates"))


@query(r"select p_partkey as k, regexp_replace(regexp_replace(upper(trim('  ' || p_name || ',; ')), '\s+', ' ', 'g'), '[,;:]+$', '') as headword from part")
def normalize_headword(spark, sf_dir):
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), X.normalize_headword(F.concat(F.lit("  "), "p_name", F.lit(",; "))).alias("headword"))


_NUMERALS = ("I", "II", "IV", "V", "IX", "XII", "XIV", "XIX", "XXI")


@query(f"select p_partkey as k, [1, 2, 4, 5, 9, 12, 14, 19, 21][p_partkey % 9 + 1] as vol, unnest([p_partkey % 400 + 1, p_partkey % 400 + 4]) as page from part")
def roman_refs(spark, sf_dir):
    n = F.element_at(F.array(*(F.lit(x) for x in _NUMERALS)), (F.col("p_partkey") % 9 + 1).cast("int"))
    line = F.concat(F.upper("p_name"), F.lit(", "), n, F.lit(". "), (F.col("p_partkey") % 400 + 1).cast("string"), F.lit(", "), (F.col("p_partkey") % 400 + 4).cast("string"))
    r = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.explode(X.index_references(line)).alias("r"))
    return r.select("k", F.col("r.vol").alias("vol"), F.explode("r.pages").alias("page"))


@query("select page_id, 'article-' || regexp_replace(regexp_replace(upper(url), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as anchor, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') as escaped from pages")
def html_and_anchor(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", X.anchor_id("url").alias("anchor"), X.escape_html("html").alias("escaped"))


@query(f"{WITH_A} select doc_id, cast(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) as bigint) as n_words, cast(len(string_split(left(text, 500), chr(10))) as int) as line_at_500 from a")
def word_counts(spark, sf_dir):
    return doc_articles(spark, sf_dir).select("doc_id", X.word_count("text").alias("n_words"), X.line_number(F.col("text"), F.lit(500)).alias("line_at_500"))


# --- kinds, artefacts, boundaries ------------------------------------------------

_BIO = r"edition_year <> 1771 and (regexp_matches(text, '(?i)\bborn\s+(?:in\s+)?(?:about\s+)?\d{4}') or regexp_matches(text, '(?i)\bdied\s+(?:in\s+)?(?:about\s+)?\d{4}') or regexp_matches(text, '(?i)\b(?:he|she)\s+was\s+(?:a\s+)?(?:celebrated|famous|eminent|distinguished)'))"
_GEO = r"(regexp_matches(text, '(?i)[EW]\.\s*Long\.|[NS]\.\s*Lat\.') or (regexp_matches(lower(text), '\b(?:city|town|village|river|mountain|island|county|district)\s+(?:of|in)\b')::int + regexp_matches(lower(text), '\b(?:lies|situated|bounded|borders)\b')::int + regexp_matches(lower(text), '\bmiles?\s+(?:north|south|east|west|from)\b')::int) >= 2)"


@query(f"{WITH_E}, t as (select k, case when regexp_matches(text, '(?i)^See\\s+[A-Z]') then 'cross_reference' when length(text) > 10000 then 'treatise' when {_BIO} then 'biographical' when {_GEO} then 'geographical' else 'dictionary' end as article_type from e) select k, article_type from t")
def classify_corpus(spark, sf_dir):
    return entries(spark, sf_dir).select("k", classify.article_type(F.col("headword"), F.col("text"), F.col("edition_year"), "corpus").alias("article_type"))


@query(f"{WITH_E}, t as (select k, case when regexp_matches(text, '(?i)^See\\s+[A-Z]') or (length(trim(text)) < 100 and regexp_matches(text, '(?i)\\bSee\\s+[A-Z]')) then 'cross_reference' when {_GEO} then 'geographical' when {_BIO} then 'biographical' when edition_year not in (1771, 1815, 1842) and (length(text) > 5000 or regexp_matches(left(text, 2000), '\\bPART\\s+[IVXLCDM]+\\b')) then 'treatise' else 'dictionary' end as article_type from e) select k, article_type from t")
def classify_package(spark, sf_dir):
    return entries(spark, sf_dir).select("k", classify.article_type(F.col("headword"), F.col("text"), F.col("edition_year"), "package").alias("article_type"))


@query(f"{WITH_E} select count(*) as total, count(*) filter (regexp_matches(text, '(?i)\\b(See\\s+(\\*\\*)?[A-Z]|under\\s+)')) as with_references, count(*) filter (regexp_matches(text, '(?i)[EW]\\.\\s*Long\\.')) as with_coordinates, count(*) filter (regexp_matches(text, '(?i)\\b(born|died)\\s+(in\\s+)?\\d{{4}}')) as with_dates, cast(floor(avg(length(text))) as bigint) as avg_chars from e")
def classification_stats(spark, sf_dir):
    return stats.classification_stats(entries(spark, sf_dir))


@query(r"""with c as (select doc_id, upper(regexp_extract(text, '^[A-Za-z]+')) as h, text, len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) as n from documents)
select doc_id, h as headword from c where h <> '' and (regexp_matches(h, '^(GRAPHY|OLOGY|ATION|MENT|NESS|ICAL|IOUS|EOUS|ABLE|IBLE|TURE|SION|TION)$') or (length(h) between 3 and 5 and len(list_distinct(string_split(h, ''))) <= 3 and n < 100)
 or (length(h) <= 4 and (n < 50 or regexp_matches(lower(left(text, 200)), 'fig\.|figure|plate|the point|the line'))) or (n < 10 and not starts_with(lower(text), 'see ')) or (length(h) between 2 and 5 and len(list_distinct(list_transform(range(1, length(h) + 1), lambda i: ascii(h[i]) - i))) = 1)
 or h in ('FINIS','INDEX','ERRATA','ADDENDA','CORRIGENDA','APPENDIX','CONTENTS','PREFACE','INTRODUCTION','ADVERTISEMENT','DIRECTIONS','SUPPLEMENT','PLATES','FIGURES','TABLES','END','CONCLUSION','NOTES','REMARKS','OBSERVATIONS','POSTSCRIPT') or (length(h) > 1 and h = repeat(h[1], length(h))))""")
def artifact_filter(spark, sf_dir):
    a = doc_articles(spark, sf_dir).filter("headword <> ''")
    return a.filter(classify.is_artifact(F.col("headword"), F.col("text"))).select("doc_id", "headword")


@query(f"{WITH_A} select doc_id, concat_ws('; ', case when length(headword) < 2 then 'headword too short' end, case when regexp_matches(headword, '^(PLATE|VOL|CHAPTER|PART|PAGE)') then 'running head' end, case when headword in ('I','II','III','IV','V','VI','VII','VIII','IX','X','XI','XII','XIII','XIV','XV','XVI','XVII','XVIII','XIX','XX','XXI','XXX','XL','L','LX','LXX','LXXX','XC','C','CC','CCC','CD','D','DC','DCC','DCCC','CM','M','MM','MMM') then 'roman numeral' end, case when length(trim(text)) < 20 then 'text too short' end, case when length(case when position(headword in text) > 0 then regexp_replace(trim(substr(text, position(headword in text) + length(headword))), '^[,.:;]+', '') else trim(text) end) < 10 then 'no content after headword' end, case when not (left(headword, 1) >= 'A' and left(headword, 1) <= 'M') then 'outside volume range' end) as errors from a")
def validate_articles(spark, sf_dir):
    a = doc_articles(spark, sf_dir)
    return a.select("doc_id", classify.validation_errors(F.col("headword"), F.col("text"), F.lit("A"), F.lit("M")).alias("errors"))


@query(f"{WITH_E} select k, case k % 6 when 4 then 'UNCERTAIN' when 5 then 'UNCERTAIN' else 'ARTICLE_START' end as label, cast(case k % 6 when 3 then 0.75 when 5 then 0.5 when 4 then 0.5 else 0.9 end as double) as confidence from e")
def boundary_heuristic(spark, sf_dir):
    after = F.expr("substring(text, length(headword) + case when startswith(text, '**') then 3 else 1 end)")
    b = classify.boundary(F.lit("the end.\n"), after)
    return entries(spark, sf_dir).select("k", b.alias("b")).select("k", "b.label", "b.confidence")


# --- segmentation ---------------------------------------------------------------------

_BODY = r"trim(case when k % 6 = 5 then substr(text, length(headword) + 7) when k % 6 = 4 then substr(text, length(headword) + 6) else substr(text, length(headword) + 2) end)"


@query(f"{WITH_E} select volume_id, headword, cast(row_number() over (partition by volume_id, headword order by k) as int) as sense_number, md5({_BODY}) as body_md5 from e")
def segment_corpus(spark, sf_dir):
    a = segment.segment(volumes(spark, sf_dir), "corpus")
    return a.select("volume_id", "headword", "sense_number", F.md5(F.col("text").cast("binary")).alias("body_md5"))


@query(f"{WITH_E} select volume_id, headword, case k % 6 when 4 then 'bold_comma' when 5 then 'bold_period' else 'caps_comma' end as kind, cast(row_number() over (partition by volume_id, headword order by k) as int) as sense_number, md5(text) as body_md5 from e")
def segment_package(spark, sf_dir):
    a = segment.segment(volumes(spark, sf_dir), "package")
    return a.select("volume_id", "headword", "kind", "sense_number", F.md5(F.col("text").cast("binary")).alias("body_md5"))


@query(f"{WITH_E}, t as (select volume_id, headword, edition_year, case when k % 6 = 5 then 'treatise' when k % 6 = 3 then 'cross_reference' when k % 6 = 2 and edition_year <> 1771 then 'biographical' when k % 6 = 1 then 'geographical' else 'dictionary' end as article_type from e) select edition_year, article_type, count(*) as n from t group by all")
def corpus_types(spark, sf_dir):
    return segment.typed(segment.segment(volumes(spark, sf_dir), "corpus")).groupBy("edition_year", "article_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"{WITH_E} select volume_id, headword, k % 6 as form, count(*) as n, sum(round(case k % 6 when 4 then 1.0 when 5 then 0.95 else 0.9 end * case when length(text) < 50 then 0.8 else 1 end, 3))::double as confidence from e group by all")
def segment_confidence(spark, sf_dir):
    a = segment.confidence(segment.segment(volumes(spark, sf_dir), "package"))
    form = F.when(F.col("kind") == "bold_comma", 4).when(F.col("kind") == "bold_period", 5).when(F.col("text").contains(", See "), 3).when(F.col("text").contains("celebrated"), 2).when(F.col("text").contains("situated"), 1).otherwise(0)
    return a.groupBy("volume_id", "headword", form.cast("long").alias("form")).agg(F.count(F.lit(1)).alias("n"), F.sum("confidence").alias("confidence"))


@query(f"{WITH_A}, x as (select doc_id, length(text) as n, (doc_id * 37) % greatest(length(text), 1) as pos from a) select doc_id, pos, cast(pos // 2000 + 1 as int) as page, cast(pos // 500 * 500 // 500 + 10 as int) as marker_page from x")
def page_lookup(spark, sf_dir):
    n = F.length("text")
    pages = F.transform(F.sequence(F.lit(0), F.floor(n / 2000).cast("int")), lambda i: F.struct((i * 2000).alias("start"), (i * 2000 + 1999).alias("end"), (i + 1).alias("page")))
    marks = F.transform(F.sequence(F.lit(0), F.floor(n / 500).cast("int")), lambda i: F.struct((i * 500).alias("pos"), (i + 10).alias("page")))
    pos = F.col("doc_id") * 37 % F.greatest(n, F.lit(1))
    a = doc_articles(spark, sf_dir).select("doc_id", pos.alias("pos"), pages.alias("pages"), marks.alias("marks"))
    return a.select("doc_id", "pos", segment.page_of(F.col("pages"), F.col("pos")).alias("page"), segment.page_as_of(F.col("marks"), F.col("pos")).alias("marker_page"))


# --- sections and chunks -------------------------------------------------------------------


@query(f"{WITH_E}, s as (select k, unnest(case when k % 6 = 5 then [0, 1] else [0] end) as i, text, headword, position(chr(10) || 'PART II.' in text) as p2 from e) select k, cast(i as int) as index, case when k % 6 <> 5 then '[Full Article]' when i = 0 then regexp_extract(text, '\\n(PART I\\.[^\\n]*)', 1) else regexp_extract(text, '\\n(PART II\\.[^\\n]*)', 1) end as title, case when k % 6 = 5 then 'explicit' else 'fallback' end as method from s")
def explicit_sections(spark, sf_dir):
    s = sections.explicit_sections(entries(spark, sf_dir), "k", "corpus")
    return s.select("k", "index", "title", "method")


@query(f"{WITH_A}, p as (select doc_id, text, cast(least(10, greatest(2, length(text) // 10000)) as int) as n, string_split(text, chr(10)) as p from a where length(text) > 5000), q as (select *, unnest(range(0, n)) as i from p) select doc_id, cast(i as int) as index, length(case when len(p) < n then case when i = n - 1 then substr(text, i * (length(text) // n) + 1) else substr(text, i * (length(text) // n) + 1, length(text) // n) end when i = n - 1 then array_to_string(p[i * (len(p) // n) + 1:], chr(10)) else array_to_string(p[i * (len(p) // n) + 1:(i + 1) * (len(p) // n)], chr(10)) end) as n_chars from q")
def length_sections(spark, sf_dir):
    s = sections.length_sections(doc_articles(spark, sf_dir).filter(F.length("text") > 5000), "doc_id", sep="\n", joint="\n")
    return s.select("doc_id", "index", F.length("text").alias("n_chars"))


@query(f"{WITH_A}, p as (select doc_id, case when length(text) < 500 then [text] else list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') end as l, headword, edition_year from a) select doc_id, cast(generate_subscripts(l, 1) - 1 as int) as index, '[' || headword || ', ' || edition_year || '] ' || unnest(l) as text from p")
def chunk_context(spark, sf_dir):
    a = doc_articles(spark, sf_dir)
    p = chunk.paragraphs(a, "doc_id", "\n").join(a.select("doc_id", "headword", "edition_year"), "doc_id")
    return chunk.with_context(p, F.col("headword"), F.col("edition_year")).select("doc_id", "index", "text")


def _chunk_summary(chunks: DataFrame) -> DataFrame:
    return chunks.select("doc_id", "index", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _edges(split: str, joint: int) -> str:
    """Common table expressions: p with a text's parts, e with the places where
    they begin when laid end to end."""
    return f"""p as (select doc_id, text, {split} as parts from a where text is not null),
q as (select doc_id, text, parts, unnest(range(0, len(parts) + 1)) as j from p),
e as (select doc_id, text, parts, list(c order by j) as edge from (select *, coalesce(sum(case when j > 0 then length(parts[j]) + {joint} end) over (partition by doc_id order by j), 0) as c from q) group by all)"""


def _numbered(chunks: str) -> str:
    return f"select doc_id, cast(row_number() over (partition by doc_id order by pos) - 1 as int) as index, cast(length(t) as int) as n_chars, md5(t) as text_md5 from ({chunks}) where t <> ''"


_PACKED_SQL = f"""{WITH_A}, {_edges("string_split_regex(text, chr(10) || '+')", 1)},
w as (with recursive walk(doc_id, k, lo, to_k) as (
  select doc_id, 0, 0, 0 from e where length(text) > 4000
  union all
  select doc_id, n, case when edge[n + 1] - lo > 200 and step > 0 then edge[n + 1] - 200 else edge[n + 1] end, step from (
    select walk.doc_id, edge, lo, k + 1 as step, greatest(k + 1, len(list_filter(edge, lambda x: x < lo + 300)), len(list_filter(edge, lambda x: x <= lo + 4000)) - 1) as n0, least(greatest(k + 1, len(list_filter(edge, lambda x: x < lo + 300)), len(list_filter(edge, lambda x: x <= lo + 4000)) - 1), len(edge) - 1) as n from walk join e on walk.doc_id = e.doc_id where k < len(edge) - 1))
  select * from walk),
c as (select w.doc_id, lo, lead(k) over (partition by w.doc_id order by k) as k2 from w)
{_numbered(f"select c.doc_id, lo as pos, trim(substr(array_to_string(parts, chr(10)) || chr(10), lo + 1, (edge[k2 + 1] - lo)::bigint), {_STRIP}) as t from c join e on c.doc_id = e.doc_id where k2 is not null union all select doc_id, 0, text from e where length(text) <= 4000")}"""


def _filled_sql(split: str, joint: str) -> str:
    bare = f"list_filter(list_transform({split}, lambda x: trim(x, {_STRIP})), lambda x: x <> '')"
    return f"""{WITH_A}, {_edges(bare, 1)},
w as (with recursive walk(doc_id, k) as (
  select doc_id, 0 from e
  union all
  select walk.doc_id, greatest(k + 1, len(list_filter(edge, lambda x: x - 1 <= edge[k + 1] + 800)) - 1) from walk join e on walk.doc_id = e.doc_id where k < len(edge) - 1)
  select * from walk),
c as (select doc_id, k, lead(k) over (partition by doc_id order by k) as k2 from w)
{_numbered(f"select c.doc_id, k as pos, array_to_string(parts[k + 1:k2], '{joint}') as t from c join e on c.doc_id = e.doc_id where k2 is not null")}"""


_SLIDE_SQL = f"""{WITH_A}, s as (with recursive walk(doc_id, n, lo, hi) as (
  select doc_id, length(text), 0, 0 from a where length(text) > 0
  union all
  select doc_id, n, lo2, case when lo2 + 4000 >= n then n when contains(z, chr(10)) and lo2 + 4000 - length(list_last(string_split(z, chr(10)))) - 1 > lo2 then lo2 + 4000 - length(list_last(string_split(z, chr(10)))) - 1 else lo2 + 4000 end from (
    select walk.doc_id, n, case when hi = 0 then 0 else greatest(hi - 800, lo + 1) end as lo2, substr(text, case when hi = 0 then 0 else greatest(hi - 800, lo + 1) end + 3201, 800) as z from walk join a on a.doc_id = walk.doc_id where hi < n))
  select * from walk where hi > 0)
{_numbered(f"select s.doc_id, lo as pos, trim(substr(text, lo + 1, hi - lo), {_STRIP}) as t from s join a on a.doc_id = s.doc_id")}"""


@query(_PACKED_SQL)
def chunk_paragraphs(spark, sf_dir):
    return _chunk_summary(chunk.packed_chunks(doc_articles(spark, sf_dir), "doc_id", r"\n+", "\n"))


@query(_filled_sql("string_split_regex(text, chr(10) || '+')", "' || chr(10) || '"))
def chunk_pack_800(spark, sf_dir):
    return _chunk_summary(chunk.filled_chunks(doc_articles(spark, sf_dir), "doc_id", r"\n+", "\n", 800))


@query(_filled_sql("string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))", " "))
def chunk_sentences(spark, sf_dir):
    return _chunk_summary(chunk.filled_chunks(doc_articles(spark, sf_dir), "doc_id", chunk.SENTENCE, " ", 800))


@query(_SLIDE_SQL)
def sliding_window(spark, sf_dir):
    return _chunk_summary(chunk.window_chunks(doc_articles(spark, sf_dir), "doc_id", 4000, 800, "\n"))


@query()
def semantic_breaks(spark, sf_dir):
    return _chunk_summary(chunk.semantic_chunks(doc_articles(spark, sf_dir), "doc_id"))


@query(f"{WITH_A} select count(*) as n_articles, cast(sum(length(text) // 4) as bigint) as tokens, round(sum(length(text) // 4) / 1e6 * 0.06, 6) as cost from a where length(text) >= 5000")
def chunk_cost(spark, sf_dir):
    return chunk.chunk_cost(doc_articles(spark, sf_dir))


# --- registry --------------------------------------------------------------------------------


def _index(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    refs = F.array(F.struct((F.col("p_partkey") % 21 + 1).cast("int").alias("vol"), F.array((F.col("p_partkey") % 400).cast("int")).alias("pages")))
    kind = F.when(F.col("p_partkey") % 5 == 4, "sub").otherwise("main")
    return p.select(F.upper("p_name").alias("term"), kind.alias("entry_type"), F.when(F.col("p_partkey") % 7 == 0, F.slice(refs, 1, 0)).otherwise(refs).alias("references"))


_FOUND = "f as (select distinct headword, edition_year as year from e)"
_EXPECTED = "x as (select distinct upper(p_name) as headword, 1842 as year from part where p_partkey % 5 <> 4)"


@query("select upper(p_name) as headword, 1842 as year, array_to_string(list_sort(list_distinct(list(p_partkey % 21 + 1) filter (p_partkey % 7 <> 0))), ',') as volumes from part where p_partkey % 5 <> 4 group by 1")
def expected_registry(spark, sf_dir):
    return registry.expected_from_index(_index(spark, sf_dir), 1842).select("headword", "year", F.array_join("volumes", ",").alias("volumes"))


def _found(spark, sf_dir):
    return registry.found(entries(spark, sf_dir))


@query(f"{WITH_E}, {_FOUND}, y as (select headword, list(year) as ys from f group by 1) select headword, 1810 as year, 0.7::double as confidence from y where list_contains(ys, 1815) and list_contains(ys, 1823) and not list_contains(ys, 1810) union all select headword, 1797 as year, 0.7::double as confidence from y where list_contains(ys, 1810) and list_contains(ys, 1815) and not list_contains(ys, 1797) union all select headword, 1778 as year, 0.7::double as confidence from y where list_contains(ys, 1797) and list_contains(ys, 1810) and not list_contains(ys, 1778) union all select headword, 1842 as year, 0.7::double as confidence from y where list_contains(ys, 1823) and list_contains(ys, 1860) and not list_contains(ys, 1842)")
def infer_cross_edition(spark, sf_dir):
    return registry.infer(_found(spark, sf_dir)).select("headword", "year", "confidence")


@query(f"{WITH_E}, {_FOUND}, {_EXPECTED} select coalesce(x.year, f.year) as year, count(x.year) as expected, count(f.year) as found, count(*) filter (x.year is not null and f.year is not null) as covered, count(*) filter (f.year is null) as missing, count(*) filter (x.year is null) as extra, case when count(x.year) > 0 then round(100 * count(*) filter (x.year is not null and f.year is not null) / count(x.year), 2) end as pct from x full join f on x.headword = f.headword and x.year = f.year group by 1")
def coverage_stats(spark, sf_dir):
    return registry.coverage(registry.expected_from_index(_index(spark, sf_dir), 1842), _found(spark, sf_dir))


@query(f"{WITH_E}, {_FOUND}, {_EXPECTED} select length(headword) as length, left(headword, 1) as letter, count(*) as n, count(*) filter (contains(headword, ' ')) as multi_word, count(*) filter (contains(headword, '-')) as hyphenated, count(*) filter (contains(headword, '''')) as apostrophe from x where not exists (select 1 from f where f.headword = x.headword and f.year = x.year) group by 1, 2")
def missing_profile(spark, sf_dir):
    return registry.missing_profile(registry.missing(registry.expected_from_index(_index(spark, sf_dir), 1842), _found(spark, sf_dir)))


@query(f"{WITH_E}, a as (select k, headword from e where edition_year = 1771), r as (select k, headword from e where edition_year = 1778) select k, headword from a union all select k, headword from r where headword not in (select headword from a)")
def merge_recovered(spark, sf_dir):
    e = entries(spark, sf_dir).select("k", "headword", "edition_year")
    return registry.merge_recovered(e.filter("edition_year = 1771"), e.filter("edition_year = 1778")).select("k", "headword")


# --- matching --------------------------------------------------------------------------------------


def _candidates(spark, sf_dir):
    """Names with one letter read for another in every third."""
    p = read(spark, sf_dir, "part")
    name = F.upper("p_name")
    return p.select(F.col("p_partkey").alias("pos"), F.when(F.col("p_partkey") % 3 == 0, F.replace(name, F.lit("L"), F.lit("I"))).otherwise(name).alias("candidate"))


def _canonical(spark, sf_dir):
    return read(spark, sf_dir, "part").select(F.upper("p_name").alias("canonical")).distinct()


_CANDIDATES = "c as (select p_partkey as pos, case when p_partkey % 3 = 0 then replace(upper(p_name), 'L', 'I') else upper(p_name) end as candidate from part), x as (select distinct upper(p_name) as canonical from part)"


@query(f"with {_CANDIDATES} select pos, candidate from c where candidate in (select canonical from x)")
def exact_match(spark, sf_dir):
    return fuzzy.exact_matches(_candidates(spark, sf_dir), _canonical(spark, sf_dir))


#: The ratio of all pairs whose lengths allow 80: a row of the table of common
#: subsequences for each letter of the candidate.
_LCS = """pr as (select candidate, canonical from (select distinct candidate from c), x where 200.0 * least(length(candidate), length(canonical)) >= 80 * (length(candidate) + length(canonical))),
lcs as (with recursive w(candidate, canonical, k, row) as (
  select candidate, canonical, 0, list_transform(range(1, length(canonical) + 1), lambda j: 0) from pr
  union all
  select candidate, canonical, k + 1, list_transform(range(1, length(canonical) + 1), lambda j: greatest(row[j], list_max(list_transform(range(1, j + 1), lambda i: case when canonical[i] = candidate[k + 1] then case when i > 1 then row[i - 1] else 0 end + 1 else 0 end)))) from w where k < length(candidate))
  select candidate, canonical, 200.0::double * row[length(canonical)] / (length(candidate) + length(canonical)) as score from w where k = length(candidate)),
v as (select candidate as variant, canonical, score from lcs where candidate not in (select canonical from x) and score >= 80 qualify row_number() over (partition by candidate order by score desc, canonical) = 1)"""


@query(f"with {_CANDIDATES}, {_LCS} select candidate, canonical, score from lcs where score >= 85 qualify row_number() over (partition by candidate order by score desc, canonical) = 1")
def fuzzy_top1(spark, sf_dir):
    return fuzzy.best_match(_candidates(spark, sf_dir), _canonical(spark, sf_dir), 85)


@query(f"with {_CANDIDATES}, {_LCS} select variant, canonical, score from v where score < 100")
def learned_variations(spark, sf_dir):
    return fuzzy.learn_variations(_candidates(spark, sf_dir), _canonical(spark, sf_dir))


@query(f"with {_CANDIDATES}, v as (select distinct replace(upper(p_name), 'L', 'I') as variant, upper(p_name) as canonical from part where contains(upper(p_name), 'L')) select pos, candidate, canonical from c join v on c.candidate = v.variant")
def variation_match(spark, sf_dir):
    name = F.upper("p_name")
    v = read(spark, sf_dir, "part").filter(F.contains(name, F.lit("L"))).select(F.replace(name, F.lit("L"), F.lit("I")).alias("variant"), name.alias("canonical")).distinct()
    return fuzzy.variation_matches(_candidates(spark, sf_dir), v).select("pos", "candidate", "canonical")


@query(
    f"{WITH_E}, {_CANDIDATES}, {_LCS}, absent as (select canonical from x where canonical not in (select headword from e where edition_year = 1842)), "
    "n as (select candidate, lcs.canonical from lcs join absent using (canonical) where score >= 85 qualify row_number() over (partition by candidate order by score desc, lcs.canonical) = 1), "
    "m as (select pos, candidate, candidate as canonical, 'exact' as match_type, 0 as r from c where candidate in (select canonical from absent) "
    "union all select pos, candidate, canonical, 'variation', 1 from c join v on candidate = variant where score < 100 and canonical in (select canonical from absent) "
    "union all select pos, candidate, canonical, 'fuzzy', 2 from c join n using (candidate)) select pos, candidate, canonical, match_type from m qualify row_number() over (partition by pos order by r, candidate) = 1"
)
def match_priority(spark, sf_dir):
    from .plans.corpus import recover

    known = entries(spark, sf_dir).filter("edition_year = 1842").select("headword")
    return recover(known, _candidates(spark, sf_dir), _canonical(spark, sf_dir), 85)


@query("with d as (select unnest(range(1, length(p_name) + 1)) as i, upper(p_name) as c, replace(upper(p_name), 'L', 'I') as v from (select distinct p_name from part)) select c[i] as letter, v[i] as read_as, count(*) as n from d where c[i] <> v[i] group by all")
def ocr_errors(spark, sf_dir):
    name = F.upper("p_name")
    return fuzzy.substitutions(read(spark, sf_dir, "part").select(F.replace(name, F.lit("L"), F.lit("I")).alias("variant"), name.alias("canonical")).distinct())


# --- links -----------------------------------------------------------------------------------------------

_TERMS = "t as (select distinct upper(regexp_extract(text, '^[A-Za-z]+')) as term from documents where regexp_extract(text, '^[A-Za-z]+') <> '')"


def _terms(spark, sf_dir):
    return doc_articles(spark, sf_dir).filter("headword <> ''").select(F.col("headword").alias("term")).distinct()


@query(f"{WITH_A}, {_TERMS}, w as (select doc_id, list_filter(string_split_regex(upper(replace(text, 'ß', 'ss')), '[^\\p{{L}}\\p{{N}}''\\-]+'), lambda x: x <> '') as l from a), u as (select doc_id, unnest(l) as term, generate_subscripts(l, 1) as pos from w) select doc_id, term, cast(min(pos) as int) as pos from u where term in (select term from t) group by 1, 2")
def link_terms(spark, sf_dir):
    return link.term_hits(doc_articles(spark, sf_dir), _terms(spark, sf_dir), "doc_id", 2)


@query(f"{WITH_A}, {_TERMS}, w as (select doc_id, edition_year as y, headword as own, list_distinct(list_filter(string_split_regex(upper(replace(text, 'ß', 'ss')), '[^\\p{{L}}\\p{{N}}''\\-]+'), lambda x: x <> '')) as l from a), u as (select doc_id, y, own, unnest(l) as term from w), v as (select headword as term, edition_year as y, min(volume_num) as vol from a group by 1, 2), m as (select term, max(case when y = 1842 then 1842 end) as y42, min(y) as y0 from v group by 1), j as (select u.doc_id, u.term, coalesce(case when v.y is not null then u.y end, m.y42, m.y0) as target_year from u join t on u.term = t.term join m on m.term = u.term left join v on v.term = u.term and v.y = u.y where u.own <> u.term) select j.doc_id, j.term, j.target_year, v.vol as target_volume from j join v on v.term = j.term and v.y = j.target_year")
def link_targets(spark, sf_dir):
    a = doc_articles(spark, sf_dir)
    hits = link.term_hits(a, _terms(spark, sf_dir), "doc_id", 2)
    return link.resolved(hits, a, link.article_lookup(a), "doc_id").select("doc_id", "term", "target_year", "target_volume")


# --- vectors and evaluation ---------------------------------------------------------------------------------

_SIM = "s as (select q.vec_id as query_id, i.vec_id, i.label, q.label as qlabel, round(list_cosine_similarity(q.embedding::double[], i.embedding::double[]), 6) as score from embeddings q, embeddings i where q.vec_id % 50 = 0), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)"


def _vectors(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    return v.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), v


@query(f"with {_SIM} select query_id, vec_id, score, cast(rank as int) as rank from r where rank <= 10")
def knn_topk(spark, sf_dir):
    q, v = _vectors(spark, sf_dir)
    return vector.knn(q, v, 10, "query_id", "vec_id")


@query(f"with {_SIM}, f as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rk from s where label = 3) select query_id, vec_id, score, cast(rk as int) as rank from f where rk <= 5")
def knn_filtered(spark, sf_dir):
    q, v = _vectors(spark, sf_dir)
    return vector.filtered_search(q, v, 5, "query_id", "vec_id", F.col("label") == 3)


_RELATED = "n as (select query_id, label, round(avg(score), 4) as score, count(*) as n from r where rank <= 15 and label <> qlabel group by 1, 2)"


@query(f"with {_SIM}, {_RELATED}, k as (select *, cast(row_number() over (partition by query_id order by score desc, label) as int) as rank from n) select * from k where rank <= 5")
def related_articles(spark, sf_dir):
    q, v = _vectors(spark, sf_dir)
    return vector.related(q, v, 5, "query_id", "vec_id", "label")


@query(f"with {_SIM} select query_id, label, max(score) as score from r where rank <= 10 group by 1, 2")
def search_by_parent(spark, sf_dir):
    q, v = _vectors(spark, sf_dir)
    return vector.best_by_parent(vector.knn(q, v, 10, "query_id", "vec_id"), v, "query_id", "vec_id", "label")


def _metrics(spark, sf_dir, k=10):
    q, v = _vectors(spark, sf_dir)
    hits = vector.knn(q, v.filter("vec_id % 50 <> 0"), k, "query_id", "vec_id").join(v.select("vec_id", "label"), "vec_id")
    expected = q.select("query_id", "label").union(q.select("query_id", ((F.col("label") + 1) % 10).cast("int").alias("label")))
    return evaluate.retrieval_metrics(hits, expected, "query_id", "label")


_EVAL = "s as (select q.vec_id as query_id, i.vec_id, i.label, q.label as ql, round(list_cosine_similarity(q.embedding::double[], i.embedding::double[]), 6) as score from embeddings q, embeddings i where q.vec_id % 50 = 0 and i.vec_id % 50 <> 0), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s), m as (select query_id, min(case when rank <= 10 and (label = ql or label = (ql + 1) % 10) then rank end) as first_rank, count(distinct case when rank <= 5 and (label = ql or label = (ql + 1) % 10) then label end) as f5, count(distinct case when rank <= 10 and (label = ql or label = (ql + 1) % 10) then label end) as f10 from r group by 1)"


@query(f"with {_EVAL} select query_id, cast(first_rank as int) as first_rank, round(coalesce(1 / first_rank, 0), 6) as reciprocal_rank, round(f5 / 2, 6) as recall_5, round(f10 / 2, 6) as recall_10 from m")
def retrieval_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query(f"with {_EVAL} select count(*) as n_queries, round(avg(round(coalesce(1 / first_rank, 0), 6)), 6) as mrr, round(avg(f5 / 2), 6) as recall_5, round(avg(f10 / 2), 6) as recall_10 from m")
def mrr_recall(spark, sf_dir):
    return evaluate.summary(_metrics(spark, sf_dir))


@query(f"with {_EVAL}, p as (select query_id, first_rank as ra, case when first_rank <= 2 then first_rank end as rb from m) select case when ra is not distinct from rb then 'tie' when rb is null or ra < rb then 'first' else 'second' end as outcome, count(*) as n from p group by 1")
def model_compare(spark, sf_dir):
    return evaluate.compare(_metrics(spark, sf_dir, 10), _metrics(spark, sf_dir, 2), "query_id")


@query(f"{WITH_A}, m as (select edition_year, 'c' || (volume_num % 3) as method, round(avg(length(text)), 6) as value from a group by 1, 2) select edition_year, max(case when method = 'c0' then value end) as c0, max(case when method = 'c1' then value end) as c1, max(case when method = 'c2' then value end) as c2, max_by(method, value) as best from m group by 1")
def chunking_pivot(spark, sf_dir):
    m = doc_articles(spark, sf_dir).groupBy("edition_year", F.concat(F.lit("c"), (F.col("volume_num") % 3).cast("string")).alias("method")).agg(F.round(F.avg(F.length("text")), 6).alias("value"))
    return evaluate.matrix(m, "edition_year", "method", ["c0", "c1", "c2"], "value")


# --- graph --------------------------------------------------------------------------------------------------------

_G = "g as (select k, headword, edition_year, volume_num, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) as word_count from e), o as (select headword, edition_year, arg_min(k, volume_num * 1000000000 + k) as k, arg_min(word_count, volume_num * 1000000000 + k) as word_count from g group by 1, 2), s as (select headword, k as src, edition_year as from_year, lead(k) over w as dst, lead(edition_year) over w as to_year, lead(word_count) over w - word_count as word_count_change from o window w as (partition by headword order by edition_year))"


def _graph(spark, sf_dir):
    return entries(spark, sf_dir).select(F.col("k").alias("article_id"), F.col("k").alias("char_start"), "headword", "edition_year", "volume_num", X.word_count("text").alias("word_count"))


@query(f"{WITH_E}, {_G} select * from s where dst is not null")
def successor_edges(spark, sf_dir):
    return graph.successors(_graph(spark, sf_dir))


@query(f"{WITH_E} select distinct headword from e where edition_year = 1797 and headword not in (select headword from e where edition_year < 1797)")
def new_topics(spark, sf_dir):
    return graph.new_topics(_graph(spark, sf_dir), 1797)


@query(f"{WITH_E}, {_G}, d as (select src, dst from s where dst is not null), z as (with recursive walk(root, node, depth) as (select k, k, 0 from o where edition_year = 1771 union all select root, d.dst, depth + 1 from walk join d on d.src = walk.node) select * from walk) select root, node, cast(depth as int) as depth from z where depth > 0")
def evolution_path(spark, sf_dir):
    a = _graph(spark, sf_dir)
    edges = graph.successors(a).select("src", "dst")
    start = a.filter("edition_year = 1771").groupBy("headword").agg(F.min_by("article_id", F.struct("volume_num", "char_start")).alias("node")).select("node")
    return graph.paths(spark, edges, start)


@query(f"{WITH_E}, r as (select k as src, headword, unnest(regexp_extract_all(text, '(?i)\\b(?:See\\s+(?:\\*\\*)?|article\\s+)([A-Z]{{5,}})', 1)) as dst from e) select upper(dst) as dst, count(*) as n from r group by 1 order by n desc, dst limit 20")
def in_degree(spark, sf_dir):
    e = entries(spark, sf_dir).select("k", F.explode(F.regexp_extract_all("text", F.lit(r"(?i)\b(?:See\s+(?:\*\*)?|article\s+)([A-Z]{5,})"), 1)).alias("d"))
    return graph.in_degree(e.select(F.upper("d").alias("dst")), 20)


@query(f"{WITH_E}, g as (select headword, edition_year as y, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) as w from e) select headword, sum(w) filter (y = 1771) as words_a, sum(w) filter (y = 1778) as words_b, round(sum(w) filter (y = 1778) / sum(w) filter (y = 1771), 6) as ratio from g where y in (1771, 1778) group by 1 having sum(w) filter (y = 1771) > 0 and sum(w) filter (y = 1778) is not null")
def growth(spark, sf_dir):
    return graph.growth(_graph(spark, sf_dir), 1771, 1778)


@query(f"{WITH_E}, g as (select headword, edition_year as y, min_by(text, k) as t from e group by 1, 2), p as (select a.headword, a.t as ta, b.t as tb, list_distinct(list_filter(string_split_regex(lower(a.t), '[^a-z0-9]+'), lambda x: x <> '')) as wa, list_distinct(list_filter(string_split_regex(lower(b.t), '[^a-z0-9]+'), lambda x: x <> '')) as wb from g a join g b on a.headword = b.headword and a.y = 1771 and b.y = 1778) select headword, round(len(list_intersect(wa, wb)) / len(list_distinct(list_concat(wa, wb))), 6) as jaccard, round(least(length(ta), length(tb)) / greatest(length(ta), length(tb)), 6) as length_ratio from p")
def text_similarity(spark, sf_dir):
    g = entries(spark, sf_dir).groupBy("headword", "edition_year").agg(F.min_by("text", "k").alias("t"))
    pairs = g.filter("edition_year = 1771").select("headword", F.col("t").alias("ta")).join(g.filter("edition_year = 1778").select("headword", F.col("t").alias("tb")), "headword")
    return graph.pair_similarity(pairs, "ta", "tb").select("headword", "jaccard", "length_ratio")


@query("select conv_id as article_id, turn as chunk_index, role, length(text) as n_chars from conversations")
def has_chunk_edges(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    a = c.select(F.col("conv_id").alias("article_id"), F.col("conv_id").alias("headword"), F.lit(1).alias("edition_year")).distinct()
    chunks = c.select(F.concat_ws("/", "role", F.length("text").cast("string")).alias("chunk_id"), F.col("turn").alias("chunk_index"), F.col("conv_id").alias("headword"), F.lit(1).alias("edition_year"))
    e = graph.has_chunk(chunks, a)
    return e.select("article_id", "chunk_index", F.split("chunk_id", "/")[0].alias("role"), F.split("chunk_id", "/")[1].cast("int").alias("n_chars"))


from . import queries_recovery  # noqa: E402,F401  registers its queries
