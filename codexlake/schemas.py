"""Table schemas and the edition dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .functions.patterns import EDITIONS

OCR_DOCUMENT = "text string, attributes struct<pdf_page_numbers: array<array<bigint>>>, metadata struct<`Source-File`: string, `pdf-total-pages`: int>, _bad string"
ORGANISED = "edition int, edition_name string, volume int, range string, source_file string, text string"
ARTICLE = "article_id string, headword string, text string, article_type string, edition_year int, edition_name string, volume_id string, volume_num int, start_page int, end_page int, char_start bigint, char_end bigint, sense_number int, word_count int, is_cross_reference boolean, sense int, volume int, source string, match_type string, confidence double, ocr_matched string"
CHUNK = "chunk_id string, text string, index int, section_id string, section_title string, section_index int, article_id string, parent_headword string, edition_year int, volume_id string, char_start bigint, char_end bigint, start_page int, end_page int, word_count int"
INDEX_ENTRY = "term string, entry_type string, references array<struct<vol: int, pages: array<int>>>, see_also array<string>, raw_line string"
REGISTRY = "headword string, editions_expected array<int>, editions_found array<int>, confidence double, source string, known_variations array<string>, volume_refs map<string, array<int>>"


def editions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EDITIONS), "edition_year int, edition_name string, edition_number int, has_biography boolean, treatise_length int")
