import json

from codexlake.sources import readers, sinks
from codexlake.streaming.ingest import ingest


def test_ocr_lines_keep_malformed_apart(spark, tmp_path):
    doc = {"text": "A", "attributes": {"pdf_page_numbers": [[0, 10, 1], [10, 20, 2]]}, "metadata": {"Source-File": "x Volume 3.pdf", "pdf-total-pages": 2}}
    (tmp_path / "a.jsonl").write_text(json.dumps(doc) + "\n{broken\n")
    rows = readers.read_ocr_lines(spark, str(tmp_path)).cache().collect()
    good = [r for r in rows if r.malformed is None]
    assert len(rows) == 2 and len(good) == 1
    assert good[0].volume_num == 3 and [(p.start, p.end, p.page) for p in good[0].pages] == [(0, 10, 1), (10, 20, 2)]


def test_markdown_volumes(spark, tmp_path):
    (tmp_path / "Volume 2.md").write_text("**ABACUS**, a table")
    (tmp_path / "note.txt").write_text("no")
    got = readers.read_markdown(spark, str(tmp_path)).collect()
    assert [(r.volume_num, r.text) for r in got] == [(2, "**ABACUS**, a table")]


def test_longest_per_volume(spark):
    v = spark.createDataFrame([("a", 1, "xx"), ("b", 1, "xxx"), ("c", 1, "yyy")], "file string, volume_num int, text string")
    assert [r.file for r in readers.longest_per_volume(v).collect()] == ["b"]


def test_round_trip_and_upsert(spark, tmp_path):
    a = spark.createDataFrame([("A", 1771, 1), ("B", 1771, 2)], "headword string, edition_year int, n int")
    sinks.write_corpus({"articles": a}, str(tmp_path / "c"))
    back = spark.read.parquet(str(tmp_path / "c/articles"))
    assert sorted((r.headword, r.n) for r in back.collect()) == [("A", 1), ("B", 2)]
    new = spark.createDataFrame([("B", 1771, 9)], "headword string, edition_year int, n int")
    assert sorted((r.headword, r.n) for r in sinks.upsert(a, new, ["headword"]).collect()) == [("A", 1), ("B", 9)]


def test_incremental_ingest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    body = "ABACUS, " + "a table of wood for counting with beads. " * 4 + "\n\nABBEY, " + "a house of monks under an abbot. " * 4
    row = {"edition": 1771, "edition_name": "1st", "volume": 1, "range": None, "source_file": "f", "text": body}
    (src / "a.json").write_text(json.dumps(row) + "\n")
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.headword for r in got) == ["ABACUS", "ABBEY"]
