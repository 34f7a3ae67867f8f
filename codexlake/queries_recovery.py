"""More registered queries: headers, recovery, registry, reports, searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import text as X
from .operators import chunk, classify, graph, recover, registry, segment, stats, vector
from .plans.synthetic import doc_articles, entries, volumes
from .queries import WITH_A, WITH_E, _index, _vectors, query, read

# --- headers, index lines, text --------------------------------------------------

_HEADS = ("The First  Edition of it", "printed in 1778", "THIRD EDITION", "in the year 1810", "The Fifth Edition, Vol. XII", "VOLUME 7, A-AME", "MDCCCXLII", "of no year at all")


@query(
    "select p_partkey as k, [1771, 1778, 1797, 1810, 1815, null, 1842, null][p_partkey % 8 + 1] as edition, "
    "[null, null, null, null, 12, 7, null, null][p_partkey % 8 + 1] as volume, [null, null, null, null, null, 'A-AME', null, null][p_partkey % 8 + 1] as letters from part"
)
def header_editions(spark, sf_dir):
    head = F.element_at(F.array(*(F.lit(h) for h in _HEADS)), (F.col("p_partkey") % 8 + 1).cast("int"))
    h = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), head.alias("head"))
    h = h.select("k", X.edition_of_header("head").alias("edition"), X.volume_of_header("head").alias("v"))
    return h.select("k", "edition", "v.volume", "v.letters")


_LINES = "[upper(p_name) || ', of the ' || p_size || ' kinds. Vol 3:' || p_partkey, upper(p_name) || '. See OPTICS', '   the rest, 4:' || p_partkey, 'nothing']"


@query(
    "select p_partkey as k, ['main', 'cross_ref', 'sub'][p_partkey % 4 + 1] as entry_type, case when p_partkey % 4 < 2 then upper(p_name) end as term, "
    "case p_partkey % 4 when 0 then 'of the ' || p_size || ' kinds' when 2 then 'the rest' end as subtopic, case when p_partkey % 4 = 1 then 'OPTICS' end as see_also, "
    "case p_partkey % 4 when 0 then 3 when 2 then 4 end as volume, case when p_partkey % 4 in (0, 2) then cast(p_partkey as int) end as page from part where p_partkey % 4 < 3"
)
def index_lines_arabic(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    name, k, size = F.upper("p_name"), F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    lines = F.array(F.concat(name, F.lit(", of the "), size, F.lit(" kinds. Vol 3:"), k), F.concat(name, F.lit(". See OPTICS")), F.concat(F.lit("   the rest, 4:"), k), F.lit("nothing"))
    line = F.element_at(lines, (F.col("p_partkey") % 4 + 1).cast("int"))
    e = p.select(F.col("p_partkey").alias("k"), X.index_entry_arabic(line).alias("e")).filter("e is not null")
    return e.select("k", "e.entry_type", "e.term", "e.subtopic", "e.see_also", "e.volume", "e.page")


_WORDS = "list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')"


@query(f"with w as (select doc_id, text, {_WORDS} as l from documents) select doc_id, strpos(lower(text), lower(l[3])) - 1 as at, case when length(text) > 100 then left(text, 100) || '...' else text end as preview from w where len(l) >= 3")
def tolerant_finds(spark, sf_dir):
    """The third word of a text, followed by one that it doesn't hold."""
    l = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    d = read(spark, sf_dir, "documents").withColumn("l", l).filter(F.size("l") >= 3)
    phrase = F.concat(F.col("l")[2], F.lit(" qqxxqqxx"))
    return d.select("doc_id", X.tolerant_position("text", phrase).cast("long").alias("at"), X.preview("text", 100).alias("preview"))


@query("select p_partkey as k, case p_partkey % 3 when 0 then ['MUSIC', 'OPTICS'] when 1 then ['LAW'] else [] end as targets from part")
def further_references(spark, sf_dir):
    texts = F.array(*(F.lit(t) for t in ("Vid. Optics. Also Music, which see.", "the Law, q.v. and others", "see nothing")))
    t = F.element_at(texts, (F.col("p_partkey") % 3 + 1).cast("int"))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), X.further_references(t).alias("targets"))


# --- headwords, pages, recovery ------------------------------------------------------


@query(
    f"{WITH_E} select k, case when edition_year = 1771 and volume_num = 1 and not left(headword, 1) between 'A' and 'B' then 'Headword ' || headword || ' outside volume 1 range (A-B)' "
    "when edition_year = 1771 and volume_num = 2 and not left(headword, 1) between 'C' and 'L' then 'Headword ' || headword || ' outside volume 2 range (C-L)' "
    "when edition_year = 1771 and volume_num = 3 and not left(headword, 1) between 'M' and 'Z' then 'Headword ' || headword || ' outside volume 3 range (M-Z)' end as reason from e"
)
def edition_headwords(spark, sf_dir):
    e = entries(spark, sf_dir)
    return e.select("k", classify.valid_in_edition(F.col("headword"), F.col("edition_year"), F.col("volume_num")).alias("reason"))


@query(f"{WITH_A}, x as (select doc_id, length(text) as n, 100 + (doc_id * 37) % greatest(length(text), 1) as pos from a) select doc_id, pos, cast(case when pos >= 500 then pos // 500 + 9 end as int) as start_page, cast((pos + n) // 500 + 9 as int) as end_page from x where pos + n >= 500")
def page_spans(spark, sf_dir):
    """Pages of 500 characters from page 10 on, the first of which starts at
    500; an unset entry stands before them."""
    a = doc_articles(spark, sf_dir).withColumn("pos", 100 + F.col("doc_id") * 37 % F.greatest(F.length("text"), F.lit(1))).withColumn("stop", F.col("pos") + F.length("text")).filter("stop >= 500")
    entry = lambda lo, hi, page: F.struct(lo.cast("int").alias("start"), hi.cast("int").alias("end"), page.cast("int").alias("page"))
    pages = F.concat(F.array(entry(F.lit(0), F.lit(0), F.lit(99))), F.transform(F.sequence(F.lit(1), F.floor(F.col("stop") / 500).cast("int")), lambda i: entry(i * 500, i * 500 + 499, i + 9)))
    return a.select("doc_id", "pos", segment.page_range(pages, F.col("pos"), F.col("stop")).alias("p")).select("doc_id", "pos", "p.start_page", "p.end_page")


@query(f"{WITH_A} select doc_id, cast(least(length(text), ((doc_id % 300 + 50 + 699) // 700) * 700) as int) as char_end from a where text is not null")
def article_ends(spark, sf_dir):
    """Boundaries every 700 characters; articles start at doc_id modulo 300."""
    a = doc_articles(spark, sf_dir).filter("text is not null")
    bounds = F.transform(F.sequence(F.lit(1), F.lit(1 + 200)), lambda i: i * 700)
    start = (F.col("doc_id") % 300).cast("int")
    return a.select("doc_id", F.least(segment.article_end(F.col("text"), start, bounds), F.length("text")).alias("char_end"))


@query(
    f"{WITH_E}, v as (select volume_id, 'A' || chr(10) || chr(10) || string_agg(text, chr(10) || chr(10) order by k) as text from e group by 1), "
    "c as (select volume_id, trim(unnest(regexp_extract_all(text, '(?m)(?:^|\\n\\n?)([A-Z][A-Z\\s\\-''\\.]+?),\\s+[a-z]', 1)), ' ' || chr(10)) as candidate from v) select volume_id, candidate, count(*) as n from c group by all"
)
def headword_candidates(spark, sf_dir):
    return recover.candidates(volumes(spark, sf_dir), "capitals").groupBy("volume_id", "candidate").agg(F.count(F.lit(1)).alias("n"))


_SWEPT = "s as (select *, row_number() over (partition by volume_id order by k) as r from e where k % 6 < 4)"


@query(f"{WITH_E}, {_SWEPT} select volume_id, headword as canonical, cast(case when k % 6 = 3 then 0.75 else 0.9 end as double) as confidence, count(*) as n from s where r <= 500 group by all")
def candidate_sweep(spark, sf_dir):
    names = read(spark, sf_dir, "part").select(F.col("p_name").alias("canonical"))
    found = recover.sweep(volumes(spark, sf_dir), names)
    return found.groupBy("volume_id", "canonical", F.col("confidence").cast("double").alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


@query()
def recovered_bodies(spark, sf_dir):
    v = volumes(spark, sf_dir)
    found = recover.sweep(v, read(spark, sf_dir, "part").select(F.col("p_name").alias("canonical")))
    return recover.recovered_bodies(v, found.select("volume_id", "pos", "canonical")).select("volume_id", "canonical", F.md5(F.col("text").cast("binary")).alias("body_md5"))


_HEADER_WORDS = "('PART','VOL','VOLUME','PLATE','FIGURE','PAGE','CHAPTER','SECTION','INDEX','CONTENTS')"


@query(
    f"with h as (select doc_id, upper(regexp_extract(text, '^[A-Za-z]+')) as h, trim(text, ' ' || chr(10)) as t from documents where text is not null) "
    "select doc_id, concat_ws('; ', case when length(t) < 20 and not regexp_matches(t, '(?i)^See\\s+[A-Z]') then 'very_short_entry_' || length(t) || 'chars' end, "
    f"case when h in {_HEADER_WORDS} then 'common_header_word' end, case when regexp_matches(h, '^[IVX]{{1,4}}$') and h not in ('VI','VII') then 'short_roman_numeral' end, "
    "case when upper(t) = h or starts_with(upper(t), h || ' ' || h) then 'repeated_headword_only' end) as reasons from h"
)
def header_errors(spark, sf_dir):
    a = doc_articles(spark, sf_dir).filter("text is not null")
    return a.select("doc_id", classify.header_errors(F.col("headword"), F.col("text")).alias("reasons"))


# --- registry and reports ----------------------------------------------------------------

_FACTS = "f as (select distinct headword, edition_year as year from e), y as (select headword, list_sort(list(year)) as ys from f group by 1)"
_RULES = " union all ".join(
    f"select headword, {dst} as year, 0.7::double as confidence, 'found+inferred' as source from y where list_has_all(ys, [{', '.join(map(str, src))}]) and not list_contains(ys, {dst})"
    for src, dst in (((1815, 1823), 1810), ((1810, 1815), 1797), ((1797, 1810), 1778), ((1823, 1860), 1842))
)


@query(
    f"{WITH_E}, {_FACTS}, x as (select distinct upper(p_name) as headword, 1842 as year, 1.0::double as confidence, 'index' as source from part where p_partkey % 5 <> 4 union all {_RULES}), "
    "g as (select headword, list_sort(list_distinct(list(year))) as ys, max(confidence) as confidence, max_by(source, confidence) as source from x group by 1) "
    "select coalesce(g.headword, y.headword) as headword, coalesce(array_to_string(g.ys, ','), '') as editions_expected, coalesce(array_to_string(y.ys, ','), '') as editions_found, coalesce(confidence, 0.95) as confidence, coalesce(source, 'found') as source from g full join y on g.headword = y.headword"
)
def registry_build(spark, sf_dir):
    r = registry.build(_index(spark, sf_dir), 1842, entries(spark, sf_dir))
    return r.select("headword", F.array_join("editions_expected", ",").alias("editions_expected"), F.array_join("editions_found", ",").alias("editions_found"), "confidence", "source")


@query("with p as (select upper(p_name) as n from part) select distinct replace(n, 'L', 'I') as variant, n as canonical from p where contains(n, 'L') union select distinct replace(n, 'E', 'F'), n from p where contains(n, 'E')")
def register_variations(spark, sf_dir):
    name = F.upper("p_name")
    read_as = lambda a, b: read(spark, sf_dir, "part").select(F.replace(name, F.lit(a), F.lit(b)).alias("variant"), name.alias("canonical"))
    return registry.register_variations(read_as("L", "I"), read_as("E", "F"))


@query(
    f"{WITH_E}, x as (select distinct upper(p_name) as headword, 1842 as year from part where p_partkey % 5 <> 4), b as (select distinct headword, edition_year as year from e where volume_num = 1), f as (select distinct headword, edition_year as year from e), "
    "t as (select x.year, count(*) as expected, count(b.headword) as before, count(f.headword) as after from x left join b using (headword, year) left join f using (headword, year) group by 1) "
    "select year, expected, before, round(100 * before / expected, 2) as pct_before, after, round(100 * after / expected, 2) as pct_after, after - before as recovered from t"
)
def recovery_report(spark, sf_dir):
    e = entries(spark, sf_dir)
    return registry.recovery_report(registry.expected_from_index(_index(spark, sf_dir), 1842), registry.found(e.filter("volume_num = 1")), registry.found(e))


@query("select cast(conv_id as varchar) as parent_headword, 1771 as edition_year, count(*) as n_chunks from conversations group by 1")
def chunks_per_article(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("parent_headword"), F.lit(1771).alias("edition_year"))
    return stats.chunks_per_article(c)


@query(
    f"{WITH_A}, s as (select edition_year, unnest(string_split(text, chr(10))) as l from a), n as (select edition_year, count(*) as sections, count(*) filter (length(l) >= 100) as chunks from s group by 1), "
    f"t as (select edition_year, count(distinct volume_num) as volumes, count(*) as articles, count(*) filter (article_type = 'treatise') as treatises, sum(len({_WORDS}))::bigint as words from a group by 1) select t.*, coalesce(sections, 0) as sections, coalesce(chunks, 0) as chunks from t left join n using (edition_year)"
)
def processing_totals(spark, sf_dir):
    a = doc_articles(spark, sf_dir).withColumn("word_count", X.word_count("text"))
    lines = a.select("edition_year", F.explode(F.split("text", "\n")).alias("l"))
    return stats.processing_totals(a, lines, lines.filter(F.length("l") >= 100))


@query(f"{WITH_A}, r as (select *, row_number() over (partition by edition_year, volume_num order by upper(headword), doc_id) as r from a) select edition_year, volume_num, array_to_string(list(headword order by r) filter (r <= 20), ',') as headwords, count(*) as n from r group by all")
def volume_lists(spark, sf_dir):
    v = stats.volume_lists(doc_articles(spark, sf_dir).withColumnRenamed("doc_id", "char_start"), 20)
    return v.select("edition_year", "volume_num", F.array_join("headwords", ",").alias("headwords"), "n")


@query(f"{WITH_E} select edition_year, array_to_string(list_sort(list_distinct(list(headword)))[1:5], ',') as values from e group by 1")
def first_distinct(spark, sf_dir):
    return stats.first_distinct(entries(spark, sf_dir), ["edition_year"], "headword").select("edition_year", F.array_join("values", ",").alias("values"))


# --- graph, searches, chunks ------------------------------------------------------------------


@query("select conv_id as article_id, turn as chunk_index, text from conversations where conv_id % 2 = 0")
def article_chunks(spark, sf_dir):
    """Conversations as articles, those of even number under one headword."""
    c = read(spark, sf_dir, "conversations")
    chunk_id = F.concat_ws("/", "conv_id", "turn")
    a = c.select(F.col("conv_id").alias("article_id"), F.when(F.col("conv_id") % 2 == 0, "Even").otherwise("odd").alias("headword"), F.lit(1771).alias("edition_year")).distinct()
    edges = c.select(F.col("conv_id").alias("article_id"), chunk_id.alias("chunk_id"), F.col("turn").alias("chunk_index"))
    return graph.article_chunks(edges, a, c.select(chunk_id.alias("chunk_id"), "text"), "EVEN").select("article_id", "chunk_index", "text")


_ENTITIES = "n as (select upper(n_name) as term, n_name as entity from nation), hits as (select o_orderkey as article_id, term, o_orderstatus as st from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey join n on n.entity = n_name)"


def _entity_links(spark, sf_dir):
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    n = read(spark, sf_dir, "nation")
    hits = o.join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("o_orderkey").alias("article_id"), F.upper("n_name").alias("term"), "o_orderstatus")
    return hits, graph.entity_links(hits.select("article_id", "term"), n.select(F.col("n_name").alias("entity"), F.lit("place").alias("kind")))


@query(f"with {_ENTITIES} select article_id, entity, 'place' as kind, count(*) as count from hits join n using (term) group by all")
def entity_links(spark, sf_dir):
    return _entity_links(spark, sf_dir)[1]


@query(f"with {_ENTITIES} select entity, 'place' as kind, count(distinct article_id) filter (st = 'F') as articles_a, count(distinct article_id) filter (st = 'O') as articles_b from hits join n using (term) group by 1 having count(*) filter (st = 'F') > 0 and count(*) filter (st = 'O') > 0")
def shared_entities(spark, sf_dir):
    hits, links = _entity_links(spark, sf_dir)
    return graph.shared_entities(links, hits.filter("o_orderstatus = 'F'"), hits.filter("o_orderstatus = 'O'"))


@query(f"{WITH_E}, w as (select left(headword, 1) as topic, edition_year as y, len({_WORDS}) as n from e), g as (select topic, sum(n) filter (y = 1771) as words_a, sum(n) filter (y = 1860) as words_b from w group by 1) select topic, words_a::bigint as words_a, words_b::bigint as words_b, round(words_b / words_a, 6) as ratio from g where words_a > 0 and words_b is not null")
def topic_growth(spark, sf_dir):
    e = entries(spark, sf_dir).withColumn("word_count", X.word_count("text"))
    return graph.topic_growth(e, e.select("headword", F.left("headword", F.lit(1)).alias("topic")), 1771, 1860)


_NEAR = "s as (select q.vec_id as query_id, i.vec_id, i.label, round(list_cosine_similarity(q.embedding::double[], i.embedding::double[]), 6) as score from embeddings q, embeddings i where q.vec_id % 50 = 0), a as (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from s), b as (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from s where label = 3)"


@query(f"with {_NEAR} select query_id, vec_id, max(score) as score from (select query_id, vec_id, score from a where r <= 5 union all select query_id, vec_id, score from b where r <= 5) group by 1, 2")
def either_search(spark, sf_dir):
    q, v = _vectors(spark, sf_dir)
    return vector.either_search(vector.knn(q, v, 5, "query_id", "vec_id"), vector.filtered_search(q, v, 5, "query_id", "vec_id", F.col("label") == 3), "query_id", "vec_id")


_TOKENS = "t as (select page_id, unnest(list_filter(string_split_regex(lower(html), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) as token from pages), i as (select token, page_id, count(*) as n from t group by all)"


@query(f"with {_TOKENS} select token, count(*) as documents, sum(n)::bigint as n from i group by 1")
def text_index(spark, sf_dir):
    i = vector.text_index(read(spark, sf_dir, "pages"), "page_id", "html")
    return i.groupBy("token").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("n"))


@query(f"with {_TOKENS}, h as (select * from i where token in ('the', 'title', 'body')), w as (select token, ln(1 + (select count(*) from pages) / count(*)) as w from h group by 1) select page_id, round(sum((1 + ln(n)) * w), 6) as score from h join w using (token) group by 1 order by score desc, page_id limit 20")
def text_search(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return vector.text_search(vector.text_index(p, "page_id", "html"), p.count(), "The title, body", "page_id", 20)


@query(
    f"{WITH_A}, s as (select doc_id, unnest(string_split(text, chr(10))) as t, generate_subscripts(string_split(text, chr(10)), 1) as i, len(string_split(text, chr(10))) as n from a) "
    "select doc_id, string_agg('  - ' || left(t, 20), chr(10) order by i) || case when max(n) > 5 then chr(10) || '... ' || (max(n) - 3) || ' more' else '' end as tree from s where n <= 5 or i <= 3 group by 1"
)
def section_outline(spark, sf_dir):
    s = doc_articles(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("index", "t"))
    return chunk.outline(s.select("doc_id", "index", F.lit(2).alias("level"), F.left("t", F.lit(20)).alias("title")), "doc_id")


@query(f"{WITH_A}, p as (select doc_id, length(text) as n, text from a where text is not null) select doc_id, cast(0 as int) as section, cast(0 as int) as chunk_index, md5(text) as text_md5 from p where n < 5000")
def section_chunks_short(spark, sf_dir):
    """Sections too short to be cut."""
    a = doc_articles(spark, sf_dir).filter("length(text) < 5000").select("doc_id", F.lit(0).alias("index"), F.lit(0).alias("char_start"), "text")
    return chunk.section_chunks(a, "doc_id").select("doc_id", "section", "chunk_index", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query()
def section_chunks(spark, sf_dir):
    a = doc_articles(spark, sf_dir).filter("text is not null").select("doc_id", F.lit(0).alias("index"), F.lit(0).alias("char_start"), "text")
    return chunk.section_chunks(a, "doc_id").select("doc_id", "section", "chunk_index", "char_start", F.length("text").alias("n_chars"))
