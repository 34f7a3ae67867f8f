"""Column functions over article text, headwords and index lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import (
    BORN, CHUNK_TITLES, FURTHER_REFERENCES, HEADER_EDITIONS, HEADER_RANGES, HEADER_VOLUME, INDEX_CROSS_ARABIC, INDEX_MAIN_ARABIC, INDEX_SUB_ARABIC, CROSS_REFERENCES, DATES, DIED, EDITION_PHRASES, EDITIONS, INDEX_CROSS, INDEX_MAIN, INDEX_REFERENCE, INDEX_SEE, INDEX_SKIP, LAT_LONG, LONG_LAT, STRUCTURAL, FRONT_MATTER_TEXT, java,
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    return text.rlike(java(pattern, ignore_case))


def group(text: Column, pattern: str, n: int = 1, ignore_case: bool = False) -> Column:
    """A group of the first match, null if there is none."""
    flagged = java(pattern, ignore_case)
    return F.when(text.rlike(flagged), F.regexp_extract(text, flagged, n))


def word_count(text: Column | str) -> Column:
    return F.size(F.filter(F.split(_c(text), r"(?U)\s+"), lambda w: w != "")).cast("long")


def upper_by_letter(text: Column | str) -> Column:
    """Upper case, but letters whose upper case is several stay as they are."""
    return F.array_join(F.transform(F.split(_c(text), ""), lambda c: F.when(F.length(F.upper(c)) == 1, F.upper(c)).otherwise(c)), "")


def normalize_headword(hw: Column | str) -> Column:
    """Upper case, single blanks, no comma, semicolon or colon at the end."""
    return F.regexp_replace(F.regexp_replace(F.upper(F.trim(_c(hw))), r"\s+", " "), r"[,;:]+$", "")


def matcher_form(hw: Column | str) -> Column:
    """Upper case, trimmed, one pass of double to single blanks."""
    return F.replace(F.upper(F.trim(_c(hw))), F.lit("  "), F.lit(" "))


def cross_references(text: Column | str) -> Column:
    """Sorted distinct (target, kind) structs of all reference patterns."""
    def of(kind: str, pattern: str) -> Column:
        targets = F.regexp_extract_all(_c(text), F.lit(java(pattern, True)), 1)
        return F.transform(targets, lambda t: F.struct(F.upper(F.trim(t)).alias("target"), F.lit(kind).alias("kind")))

    return F.array_sort(F.array_distinct(F.concat(*(of(k, p) for k, p in CROSS_REFERENCES))))


def coordinates(text: Column | str) -> Column:
    """(lon, lat) of the first pattern whose two numbers parse."""
    t = _c(text)

    def pair(pattern: str, lon: int, lat: int) -> Column:
        x, y = group(t, pattern, lon, True).try_cast("double"), group(t, pattern, lat, True).try_cast("double")
        return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("lon"), y.alias("lat")))

    return F.coalesce(pair(LONG_LAT, 1, 2), pair(LAT_LONG, 2, 1))


def person_dates(text: Column | str) -> Column:
    t = F.left(_c(text), F.lit(500))
    born, died = group(t, BORN, 1, True), group(t, DIED, 1, True)
    return (
        F.when(has(t, DATES), F.concat_ws("-", group(t, DATES, 1), group(t, DATES, 2)))
        .when(born.isNotNull() & died.isNotNull(), F.concat_ws("-", born, died))
        .when(born.isNotNull(), F.concat(F.lit("born "), born))
        .when(died.isNotNull(), F.concat(F.lit("died "), died))
    )


def roman_to_int(numeral: Column | str) -> Column:
    """Roman numeral to number; other signs count nothing."""
    values = F.create_map(*(F.lit(x) for kv in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in kv))
    digits = F.transform(F.reverse(F.split(F.upper(_c(numeral)), "")), lambda d: F.coalesce(values[d], F.lit(0)))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("last"))
    step = lambda s, v: F.struct(F.when(v < s["last"], s["total"] - v).otherwise(s["total"] + v).alias("total"), v.alias("last"))
    return F.aggregate(digits, start, step, lambda s: s["total"])


def index_references(line: Column | str) -> Column:
    """'XII. 277, 280; II. 5' to an array of (vol, pages)."""
    vols, pages = (F.regexp_extract_all(_c(line), F.lit(INDEX_REFERENCE), n) for n in (1, 2))
    return F.zip_with(vols, pages, lambda v, p: F.struct(roman_to_int(v).alias("vol"), F.transform(F.split(p, r"\s*,\s*"), lambda x: x.cast("int")).alias("pages")))


def see_also(line: Column | str) -> Column:
    return F.transform(F.regexp_extract_all(_c(line), F.lit(INDEX_SEE), 1), lambda t: F.regexp_replace(F.upper(F.trim(t)), r"\.$", ""))


def index_entry(line: Column | str) -> Column:
    """(term, entry_type, references, see_also) of an index line; null for a
    line that is none. Main terms are in capitals, sub-terms are not."""
    t = F.trim(_c(line))
    head = F.trim(F.split(F.split(t, ",")[0], r"\.")[0])
    capitals = (head == F.upper(head)) & head.rlike("[A-Z]")
    main, cross = F.regexp_extract(t, INDEX_MAIN, 1), F.regexp_extract(t, INDEX_CROSS, 1)
    rest = F.when(main != "", F.regexp_extract(t, INDEX_MAIN, 2)).otherwise(t)
    none = F.slice(index_references(t), 1, 0)
    refs, see = index_references(rest), see_also(rest)
    entry = lambda term, kind, r: F.struct(F.trim(term).alias("term"), F.lit(kind).alias("entry_type"), r.alias("references"), see.alias("see_also"))
    return (
        F.when(t.rlike(INDEX_SKIP) | (head == ""), None)
        .when(capitals & (F.length(head) > 1) & (main != ""), entry(main, "main", refs))
        .when(capitals & (F.length(head) > 1) & (cross != ""), entry(cross, "cross_ref", none))
        .when(capitals, None)
        .when((F.size(refs) > 0) | (F.size(see) > 0), entry(F.regexp_extract(t, r"^([^,.]+)", 1), "sub", refs))
    )


def escape_html(text: Column | str) -> Column:
    out = _c(text)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def anchor_id(hw: Column | str) -> Column:
    return F.concat(F.lit("article-"), F.regexp_replace(F.regexp_replace(F.upper(_c(hw)), "[^A-Z0-9]+", "_"), "^_+|_+$", ""))


def edition_of_title(title: Column | str) -> Column:
    """The first of the eight ordinal phrases, as the edition's year."""
    t = F.upper(_c(title))
    return F.coalesce(*(F.when(t.contains(p), year) for p, (year, *_) in zip(EDITION_PHRASES, EDITIONS, strict=True)))


def volume_of_title(title: Column | str) -> Column:
    """Volume number, Arabic or Roman, as written after Volume or Vol."""
    arabic = group(_c(title), r"\bVOL(?:UME)?\.?\s+(\d+)", 1, True)
    roman = group(_c(title), r"\bVOL(?:UME)?\.?\s+([IVXLC]+)\b", 1, True)
    return F.coalesce(arabic.cast("int"), roman_to_int(roman))


def letter_range(title: Column | str) -> Column:
    return group(_c(title), r"\b([A-Z]{3})\s*[-–—]\s*([A-Z]{3})\b", 0)


def line_number(text: Column, position: Column) -> Column:
    """1-based line of a 0-based offset."""
    return F.size(F.split(F.left(text, position.cast("int")), "\n"))


def context_window(text: Column, position: Column, length: Column, around: int = 50) -> Column:
    """Text around a match on one line, dots where it is cut."""
    a = F.greatest(position - around, F.lit(0))
    b = F.least(position + length + around, F.length(text))
    body = F.trim(F.replace(F.substring(text, a.cast("int") + 1, (b - a).cast("int")), F.lit("\n"), F.lit(" ")))
    return F.concat(F.when(a > 0, "...").otherwise(""), body, F.when(b < F.length(text), "...").otherwise(""))


def is_structural(hw: Column | str) -> Column:
    return F.regexp_like(_c(hw), F.lit(r"(?iu)\A" + STRUCTURAL[1:]))


def is_front_matter(text: Column | str) -> Column:
    t = F.left(_c(text), F.lit(2000))
    out = F.lit(False)
    for p in FRONT_MATTER_TEXT:
        out = out | has(t, p, True)
    return out


def page_range(start: Column, end: Column) -> Column:
    a, b = (F.coalesce(x.cast("string"), F.lit("?")) for x in (start, end))
    return F.when(a == b, a).otherwise(F.concat_ws("-", a, b))


def section_title(text: Column | str) -> Column:
    """A heading at the start of the first 200 characters, or null."""
    t = F.trim(F.left(_c(text), F.lit(200)))
    return F.trim(F.coalesce(*(group(t, p, 1, True) for p in CHUNK_TITLES)))


def modern_spelling(text: Column | str) -> Column:
    return F.replace(F.replace(_c(text), F.lit("AE"), F.lit("E")), F.lit("CHYM"), F.lit("CHEM"))


def markdown(headword: Column, year: Column, body: Column) -> Column:
    return F.concat(F.lit("# "), headword, F.lit("\n\n*Edition: "), year.cast("string"), F.lit("*\n\n"), body, F.lit("\n"))


def edition_of_header(text: Column | str) -> Column:
    """Edition year by the head of a text: ordinals first, then years."""
    head = F.upper(F.left(_c(text), F.lit(2000)))
    return F.coalesce(*(F.when(has(head, p), year) for p, year in HEADER_EDITIONS))


def volume_of_header(text: Column | str) -> Column:
    """(volume, letters): the first volume number, Arabic or Roman, in the first
    2,000 characters and the first range of letters, three each, in 500."""
    found = group(F.left(_c(text), F.lit(2000)), HEADER_VOLUME, 1, True)
    volume = F.coalesce(found.try_cast("int"), roman_to_int(F.upper(found)))
    head = F.left(_c(text), F.lit(500))
    part = lambda p, n: F.left(group(head, p, n), F.lit(3))
    letters = F.coalesce(*(F.concat(part(p, 1), F.lit("-"), part(p, 2)) for p in HEADER_RANGES))
    return F.struct(volume.alias("volume"), letters.alias("letters"))


def index_entry_arabic(line: Column | str) -> Column:
    """An index line with volume:page in figures: entry_type, term, subtopic,
    volume, page, see_also; null if it is none. Indented lines are entries below
    a term."""
    raw = _c(line)
    t = F.trim(raw)

    def entry(kind: str, when: Column, **fields: Column) -> Column:
        names = ("term", "subtopic", "see_also")
        cols = [fields.get(n, F.lit(None)).cast("string").alias(n) for n in names]
        figures = [fields.get(n, F.lit(None)).cast("int").alias(n) for n in ("volume", "page")]
        return F.when(when, F.struct(F.lit(kind).alias("entry_type"), *cols, *figures))

    main = lambda n: group(t, INDEX_MAIN_ARABIC, n)
    cross = lambda n: group(t, INDEX_CROSS_ARABIC, n, True)
    sub = lambda n: group(raw, INDEX_SUB_ARABIC, n)
    return F.coalesce(
        entry("main", main(1).isNotNull(), term=F.upper(main(1)), subtopic=F.trim(main(2)), volume=main(3), page=main(4)),
        entry("cross_ref", cross(1).isNotNull(), term=F.upper(cross(1)), see_also=F.upper(cross(2))),
        entry("sub", sub(1).isNotNull(), subtopic=F.trim(sub(1)), volume=sub(2), page=sub(3)),
    )


def tolerant_position(text: Column | str, phrase: Column | str, words: int = 5) -> Column:
    """0-based place of the longest run of the phrase's first words, at most
    five, that the text holds; -1 if it holds none."""
    parts = F.slice(F.filter(F.split(F.lower(_c(phrase)), r"\s+"), lambda w: w != ""), 1, words)
    low = F.lower(_c(text))
    found = [F.when(F.size(parts) >= n, F.nullif(F.position(F.array_join(F.slice(parts, 1, n), " "), low), F.lit(0))) for n in range(words, 0, -1)]
    return F.coalesce(*found, F.lit(0)) - 1


def preview(text: Column | str, most: int = 200) -> Column:
    """The first characters, with an ellipsis if there are more."""
    t = _c(text)
    return F.when(F.length(t) > most, F.concat(F.left(t, F.lit(most)), F.lit("..."))).otherwise(t)


def further_references(text: Column | str) -> Column:
    """Sorted distinct targets of Vid., q.v. and which see."""
    found = [F.regexp_extract_all(_c(text), F.lit(java(p)), 1) for p in FURTHER_REFERENCES]
    return F.array_sort(F.array_distinct(F.transform(F.concat(*found), F.upper)))
