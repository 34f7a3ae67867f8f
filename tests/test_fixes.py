"""Results that were wrong once."""

import re

from pyspark.sql import functions as F

from codexlake.functions import patterns as P
from codexlake.operators import chunk, classify, graph, link, segment, stats
from codexlake.plans.corpus import extract_corpus
from codexlake.sources import sinks

VOLUME = "volume_id string, edition_year int, volume_num int, text string, pages array<struct<start:int,end:int,page:int>>"
TEXT = "A\n\nABBEY, a house of monks that was built long ago by many hands in the old town.\n\nABBOT, the head of an abbey, who is chosen by the monks of it for all his life here."


def volumes(spark):
    pages = [(0, 60, 1), (61, 200, 2)]
    return spark.createDataFrame([("a", 1771, 1, TEXT, pages), ("b", 1815, 1, TEXT, pages)], VOLUME)


def test_articles_of_later_editions_stay(spark):
    got = extract_corpus(volumes(spark))["articles"].select("edition_year", "headword").collect()
    assert sorted(map(tuple, got)) == [(y, h) for y in (1771, 1815) for h in ("ABBEY", "ABBOT")]


def test_pages_and_sinks_of_extracted_articles(spark):
    a = extract_corpus(volumes(spark))["articles"].filter("edition_year = 1771")
    assert sorted((r.headword, r.start_page, r.end_page) for r in a.collect()) == [("ABBEY", 1, 2), ("ABBOT", 2, 2)]
    assert sinks.summary_lines(a).count() == 2
    assert '"h":"ABBEY"' in sinks.volume_page_data(a).first().data


def brute_hits(words, terms):
    out, i = {}, 0
    while i < len(words):
        fit = [t for t in terms if words[i : i + len(t.split())] == t.split()]
        if fit:
            t = max(fit, key=lambda t: len(t.split()))
            out.setdefault(t, i + 1)
            i += len(t.split())
        else:
            i += 1
    return out


def test_terms_leftmost_longest_by_both_ways(spark):
    docs = spark.createDataFrame([(1, "x y z"), (2, "y z x y, Z z"), (3, None), (4, ""), (5, "a x y z y")], "id long, text string")
    terms = ["X Y", "Y Z", "Z", "A X Y Z"]
    t = spark.createDataFrame([(x,) for x in terms], "term string")
    want = sorted((i, k, p) for i, s in ((1, "X Y Z"), (2, "Y Z X Y Z Z"), (5, "A X Y Z Y")) for k, p in brute_hits(s.split(), terms).items())
    for sent in (100, 0):
        assert sorted(map(tuple, link.term_hits(docs, t, "id", 4, sent=sent).select("id", "term", "pos").collect())) == want


def test_link_is_no_entity_and_no_part_of_a_word(spark):
    df = spark.createDataFrame([("amps & AMP, amp", "AMP", "x.html")], "t string, w string, h string")
    got = df.select(link.linked_html(F.col("t"), F.col("w"), F.col("h")).alias("x")).first().x
    assert got == 'amps &amp; <a href="x.html">AMP</a>, amp'


def test_stop_words_are_no_verb_entries():
    assert [m.headword for m in segment.marks("A\n\n\nMYSELF means much.\n\nOPTICS means sight.\n")] == ["OPTICS"]
    assert len(set(P.STOPWORDS)) == len(P.STOPWORDS)


def test_treatise_lists_of_editions(spark):
    rows = [("EUROPE", 1815), ("EUROPE", 1771), ("PHYSICS", 1842), ("PHYSICS", 1815), ("BREWING", 1771), ("BREWING", 1860)]
    df = spark.createDataFrame([(h, y, "a short text of no kind") for h, y in rows], "h string, y int, t string")
    got = df.select(classify.is_treatise(F.col("h"), F.col("t"), F.col("y"), "package").alias("x")).collect()
    assert [r.x for r in got] == [True, False, True, False, True, False]


def test_edition_headwords(spark):
    rows = [("PLATE IV", 1771, 1), ("ZEBRA", 1771, 1), ("ABBEY", 1771, 1), ("INDEX", 1815, 3), ("VOL. 3", 1842, 2), ("INDEX", 1810, 1)]
    df = spark.createDataFrame(rows, "h string, y int, v int")
    got = [r.x for r in df.select(classify.valid_in_edition(F.col("h"), F.col("y"), F.col("v")).alias("x")).collect()]
    assert got == ["Matches OCR artifact pattern", "Headword ZEBRA outside volume 1 range (A-B)", None, "Known OCR artifact: INDEX", "Matches OCR artifact pattern", None]


def test_chunk_spans_are_exact():
    text = "\n\n\n\n".join(f"paragraph {i} " + "word " * (i % 50) for i in range(400))
    got = chunk.pack(text, r"\n\n+", "\n\n", 4000, 300, 200)
    for a, b, t in got:
        assert re.sub(r"\n\n+", "\n\n", text[a:b]) == t
    assert got[-1][1] == len(text.rstrip())
    assert [x[0] for x in got[1:]] < [x[1] for x in got]


def test_dedupe_within_an_edition(spark):
    df = spark.createDataFrame([(1, "A", 1771, 1, "t"), (2, "A", 1771, 1, "t"), (3, "A", 1815, 1, "t")], "k int, headword string, edition_year int, volume_num int, text string")
    assert sorted(r.k for r in stats.dedupe_articles(df, ["k"]).collect()) == [1, 3]


def test_stream_and_batch_agree(spark, tmp_path):
    from codexlake.streaming.ingest import ingest

    text = TEXT + "\n\nOPTICS.\n\nThe science of light, which is treated here at length by us all.\n\nOPTICS.\n\nThe second part of the science of light, on its colours and on glasses."
    lines = [(y, str(y), v, None, f"f{v}", text) for y in (1771, 1815) for v in (1, 2)]
    spark.createDataFrame(lines, "edition int, edition_name string, volume int, range string, source_file string, text string").write.json(f"{tmp_path}/in")
    ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    cols = ["edition_year", "volume_num", "headword", "sense_number", "text", "article_type"]
    got = spark.read.parquet(f"{tmp_path}/out").select(cols).collect()
    v = spark.createDataFrame([(f"{x[0]}_{x[2]}", x[0], x[2], text) for x in lines], "volume_id string, edition_year int, volume_num int, text string")
    want = extract_corpus(v)["articles"].select(cols).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) == 12


def test_site_statistics_registry_and_backup(spark, tmp_path):
    import json

    from codexlake.sources import readers

    a = extract_corpus(volumes(spark))["articles"]
    pages = {r.file: r.html for r in sinks.site_pages(a).collect()}
    assert set(pages) == {"1771/vol1.html", "1815/vol1.html"} and 'id="article-ABBEY"' in pages["1771/vol1.html"] and "p. 1-2" in pages["1771/vol1.html"]
    assert '<a href="vol1.html">Volume 1</a> (2)' in sinks.site_index(a).first().html
    sinks.write_statistics(a, f"{tmp_path}/stats")
    got = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/stats").collect()]
    assert [(r["edition_year"], r["articles"], r["volumes"]) for r in got] == [(1771, 2, 1), (1815, 2, 1)]
    v = spark.createDataFrame([("ASTR0NOMY", "ASTRONOMY")], "variant string, canonical string")
    r = spark.createDataFrame([("ASTRONOMY", [1771])], "headword string, editions_found array<int>")
    sinks.write_registry(r, v, f"{tmp_path}/reg")
    assert readers.read_variations(spark, f"{tmp_path}/reg/variations").collect() == v.collect()
    assert readers.read_registry(spark, f"{tmp_path}/reg/registry").first().editions_found == [1771]
    where = f"{tmp_path}/lines"
    for n in (1, 2):
        sinks.replace_with_backup(spark.range(n).selectExpr("id as k"), where)
    assert spark.read.json(where).count() == 2 and spark.read.json(f"{where}.backup").count() == 1


def test_sources_by_name(spark):
    from codexlake.sources import readers

    t = spark.createDataFrame([("b.md", "x"), ("c.md", "y")], "file string, text string")
    m = spark.createDataFrame([("b.meta.json", 3)], "file string, pages int")
    assert [(r.stem, r.text, r.pages) for r in readers.with_sidecars(t, m).collect()] == [("b", "x", 3)]
    v = spark.createDataFrame([("f1", "scan 12", None), ("f2", "scan 123", "{"), ("f2", "z", None)], "file string, source_file string, malformed string")
    assert readers.locate(v, "123").first().file == "f2"
    assert sorted(map(tuple, readers.line_errors(v).collect())) == [("f1", 1, 0), ("f2", 2, 1)]


def test_search_commands(spark):
    from codexlake.operators import vector

    a = spark.createDataFrame([("OPTICS", 1815, 2), ("OPTICS", 1771, 1), ("LAW", 1771, 1)], "headword string, edition_year int, volume_num int")
    said = []
    ask = lambda line: vector.command(line, a, lambda q: said.append(("text", q)), lambda n: said.append(("related", n)))
    assert [r.edition_year for r in ask("article: optics").collect()] == [1771, 1815]
    ask("related:Law")
    ask(" the law of light ")
    assert said == [("related", "LAW"), ("text", "the law of light")]


def test_large_sections_are_cut_between_paragraphs():
    text = "\n \n".join("word " * 60 for _ in range(100))
    got = chunk.even_parts(text, 2000)
    assert all(len(t) <= 2000 for _, _, t in got) and got[0][0] == 0 and got[-1][1] == len(text.rstrip())
    assert " ".join(t for _, _, t in got).split() == text.split()


def test_paragraphs_and_sentences_keep_the_digits_at_their_ends(spark):
    docs = spark.createDataFrame([(1, "x" * 500 + "\n one, of 11 \n2 and 22\n\n")], "doc_id long, text string")
    got = chunk.paragraphs(docs, "doc_id", "\n").orderBy("index").collect()
    assert [(r["index"], r.text) for r in got] == [(0, "x" * 500), (1, "one, of 11"), (2, "2 and 22")]
    pairs = spark.createDataFrame([("First. Of 1!", "Of 1!"), (" Of it. ", "Of it.")], "a string, b string")
    assert [r.shared_sentences for r in graph.sentence_similarity(pairs, "a", "b").collect()] == [1, 1]


def test_a_sharp_s_is_no_repeated_headword(spark):
    texts = ["SS ßen, der", "SS ß", "ss Ss ist", "Ab", "AB \n", "Ab ab", "Ab abc", "Ab ac", "", None, "\U0001d400 x"]
    a = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    headword = F.upper(F.regexp_extract("text", "^[A-Za-z]+", 0))
    got = a.select("i", F.contains(classify.header_errors(headword, F.col("text")), F.lit("repeated_headword_only")).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == [False, False, True, True, True, True, True, False, True, False, False]
