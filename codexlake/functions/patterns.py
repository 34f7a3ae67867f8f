"""Patterns, word lists and tables that decide results.

Patterns are written for Python; ``java`` turns one into Spark's dialect
(Unicode classes, line ends only at newline).
"""

# --- fixed values: headwords, in order of priority -------------------------
_CAPS = r"[A-Z][A-Z'\-]+(?:\s+[A-Z][A-Z'\-]+)*"
HEADWORDS = (
    ("bold_comma", rf"^\*\*({_CAPS})\*\*,\s*", 1.0),
    ("bold_period", rf"^\*\*({_CAPS})\*\*\.\s*$", 0.95),
    ("bold_subentry", r"^\*\*([A-Z][a-z][A-Za-z'\-\s]+)\*\*[,.]", 0.85),
    ("caps_comma", rf"^({_CAPS}),\s+", 0.9),
    ("caps_period", rf"^({_CAPS})\.\s*$", 0.85),
    ("standalone", rf"^({_CAPS})\s*$\n\n(?=[A-Z])", 0.7),
    ("parenthetical", rf"^\*?\*?({_CAPS})\s*[,]?\s*\([^)]+\)\*?\*?[,.]", 0.8),
)
ALPHABET_ENTRY = r"^([A-Z])\s*$\n\n"
ENTRY_COMMA = rf"(?:^|\n+)(?:\*\*)?({_CAPS})(?:\*\*)?(?:\s*\([^)]+\))?,\s+"
ENTRY_VERB = r"(?:\n\n+)(?:\*\*)?([A-Z][A-Z'\-]{2,}(?:\s+[A-Z][A-Z'\-]+)*)(?:\*\*)?\s+(?:denotes|signifies|means|expresses|implies|indicates)\b"
ENTRY_TREATISE = rf"(?:\n+|---\s*\n+)(?:\*\*)?({_CAPS})(?:\*\*)?\.\s*\n+"
STRUCTURAL = r"^(?:CHAPTER|PART|SECT(?:ION)?|PLATE|FIG(?:URE)?|TABLE|VOL(?:UME)?|BOOK)\s*[IVXLCDM\d]+"
FRONT_MATTER_TEXT = (r"ENCYCLOP[AÆ]DIA\s+BRITANNICA", r"DICTIONARY\s+OF\s+ARTS", r"PREFACE", r"DEDICATION", r"TO\s+THE\s+KING", r"ADVERTISEMENT", r"TABLE\s+OF\s+CONTENTS", r"COPPERPLATES", r"EDINBURGH[\s\S]*Printed")
FRONT_MATTER_HEADWORDS = (r"^OR$", r"^DICTIONARY", r"^OF$", r"^ARTS", r"^SCIENCES", r"^PREFACE", r"^ENCYCLOP", r"^LONDON", r"^EDINBURGH", r"^PRINTED")

# --- fixed values: references, coordinates, dates --------------------------
CROSS_REFERENCES = (
    ("see", rf"\bSee\s+({_CAPS})"),
    ("article", r"\bSee\s+(?:the\s+)?article\s+([A-Z][A-Z'\-]+)"),
    ("bold", r"\bSee\s+\*\*([A-Za-z][A-Za-z'\-\s]+)\*\*"),
    ("under", r"\bunder\s+(?:the\s+(?:article|head|word)\s+)?([A-Z][A-Z'\-]+)"),
)
LONG_LAT = r"[EW]\.\s*Long\.\s*([\d\.]+)[\s\S]*?[NS]\.\s*Lat\.\s*([\d\.]+)"
LAT_LONG = r"Lat\.\s*([\d\.]+)\s*[NS]?[\s\S]*?Long\.\s*([\d\.]+)\s*[EW]?"
DATES = r"\((\d{4})\s*[-–—]\s*(\d{4})\)"
BORN = r"\b(?:born|b\.)\s+(?:in\s+)?(\d{4})"
DIED = r"\b(?:died|d\.)\s+(?:in\s+)?(\d{4})"
CENTURY = r"\b(\d{1,2})(?:st|nd|rd|th)\s+century"

# --- fixed values: kinds of article ----------------------------------------
BIOGRAPHICAL = (
    r"\bborn\s+(?:in\s+)?(?:about\s+)?\d{4}",
    r"\bdied\s+(?:in\s+)?(?:about\s+)?\d{4}",
    r"\(\d{4}\s*[-–—]\s*\d{4}\)",
    r"\bflourished\s+(?:about\s+)?\d{4}",
    r"\b(?:he|she)\s+was\s+(?:a\s+)?(?:celebrated|famous|eminent|distinguished)",
)
KINSHIP = r"\b(?:son|daughter)\s+of\b"
PLACE_MARK = r"[EW]\.\s*Long\.|[NS]\.\s*Lat\."
GEOGRAPHICAL = (
    r"\b(?:city|town|village|river|mountain|island|county|district)\s+(?:of|in)\b",
    r"\b(?:lies|situated|bounded|borders)\b",
    r"\bmiles?\s+(?:north|south|east|west|from)\b",
    r"\bpopulation\s+(?:of\s+)?\d",
)
TREATISE_MARKS = (r"\bPART\s+[IVXLCDM]+\b", r"\bSECT(?:ION)?\.?\s+[IVXLCDM\d]+\b", r"\bCHAPTER\s+[IVXLCDM\d]+\b")
TREATISES = (
    "AGRICULTURE", "ALGEBRA", "ANATOMY", "ARCHITECTURE", "ARITHMETIC", "ASTRONOMY", "BOOK-KEEPING", "BOTANY", "CHEMISTRY",
    "COMMERCE", "ELECTRICITY", "FARRIERY", "GEOGRAPHY", "GEOLOGY", "GEOMETRY", "GRAMMAR", "HERALDRY", "HISTORY", "LAW",
    "LOGIC", "MECHANICS", "MEDICINE", "METAPHYSICS", "MIDWIFERY", "MINERALOGY", "MUSIC", "NAVIGATION", "OPTICS", "PHARMACY",
    "PHILOSOPHY", "POETRY", "RELIGION", "SCOTLAND", "SURGERY", "SURVEYING", "THEOLOGY",
)
#: editions with lists of their own
EDITION_TREATISES = {
    1771: (
        "AGRICULTURE", "ALGEBRA", "ANATOMY", "ARCHITECTURE", "ARITHMETIC", "ASTRONOMY", "BOTANY", "BREWING", "CHEMISTRY", "CHRONOLOGY",
        "COMMERCE", "COSMOGRAPHY", "CRITICISM", "DISTILLING", "DYEING", "ELECTRICITY", "ETHICS", "FARRIERY", "FLUXIONS",
        "FORTIFICATION", "GEOGRAPHY", "GEOMETRY", "GRAMMAR", "HERALDRY", "HISTORY", "HYDRAULICS", "HYDROSTATICS", "LAW", "LOGIC",
        "MAGNETISM", "MECHANICS", "MEDICINE", "METAPHYSICS", "MIDWIFERY", "MUSIC", "NAVIGATION", "OPTICS", "PAINTING", "PERSPECTIVE",
        "PHARMACY", "PHILOSOPHY", "PHYSIOLOGY", "PNEUMATICS", "POETRY", "RHETORIC", "SCULPTURE", "SURGERY", "THEOLOGY",
        "TRIGONOMETRY", "WAR",
    ),
    1815: (
        "AGRICULTURE", "ALGEBRA", "ANATOMY", "ARCHITECTURE", "ARITHMETIC", "ASTRONOMY", "BOTANY", "CHEMISTRY", "CHRONOLOGY",
        "CRYSTALLIZATION", "ELECTRICITY", "FLUXIONS", "GEOGRAPHY", "GEOLOGY", "GEOMETRY", "HYDRAULICS", "HYDROSTATICS", "MAGNETISM",
        "MECHANICS", "MEDICINE", "METAPHYSICS", "MINERALOGY", "MUSIC", "NAVIGATION", "OPTICS", "PHARMACY", "PHILOSOPHY", "PHYSIOLOGY",
        "PNEUMATICS", "SURGERY", "THEOLOGY", "TRIGONOMETRY", "BREWING", "COMMERCE", "DISTILLING", "DYEING", "FARRIERY",
        "FORTIFICATION", "HERALDRY", "MIDWIFERY", "CRITICISM", "ETHICS", "GRAMMAR", "HISTORY", "LAW", "LOGIC", "PAINTING",
        "PERSPECTIVE", "POETRY", "RHETORIC", "SCULPTURE", "WAR", "SCOTLAND", "ENGLAND", "IRELAND", "FRANCE", "AMERICA", "AFRICA",
        "ASIA", "EUROPE",
    ),
    1842: (
        "AGRICULTURE", "ANATOMY", "ARCHITECTURE", "ASTRONOMY", "BIOGRAPHY", "BOTANY", "CHEMISTRY", "COMMERCE", "ELECTRICITY",
        "GEOGRAPHY", "GEOLOGY", "GEOMETRY", "GRAMMAR", "HERALDRY", "HISTORY", "LAW", "MECHANICS", "MEDICINE", "MINERALOGY", "MUSIC",
        "NAVIGATION", "OPTICS", "PAINTING", "PHILOSOPHY", "PHYSICS", "PHYSIOLOGY", "POETRY", "RELIGION", "SCULPTURE", "SURGERY",
        "THEOLOGY",
    ),
}
#: words and patterns that editions with rules of their own don't take for headwords
EDITION_ARTIFACTS = {
    1771: ("PLATE", "PLATES", "FIG", "FIGURE", "FIGURES", "CONTINUED", "CONCLUSION", "ERRATA", "ERRATUM"),
    1815: ("PLATE", "PLATES", "FIG", "FIGURE", "FIGURES", "CONTINUED", "CONCLUSION", "ERRATA", "ERRATUM", "ADDENDA", "CORRIGENDA", "ENCYCLOPAEDIA", "BRITANNICA", "INDEX"),
    1842: ("PLATE", "PLATES", "FIG", "FIGURE", "FIGURES", "CONTINUED", "CONCLUSION", "ERRATA", "ERRATUM", "ADDENDA", "CORRIGENDA", "GENERAL INDEX", "INDEX"),
}
EDITION_ARTIFACT_PATTERNS = {
    1771: (r"^PLATE\s+[IVXLCDM]+$", r"^FIG\.\s*\d+$", r"^[IVXLCDM]+\.$"),
    1815: (r"^PLATE\s+[IVXLCDM\d]+$", r"^FIG\.\s*\d+$", r"^[IVXLCDM]+\.$", r"^PAGE\s+\d+$"),
    1842: (r"^PLATE\s+[IVXLCDM\d]+$", r"^FIG\.\s*\d+$", r"^PAGE\s+\d+$", r"^VOL\.?\s*[IVXLCDM\d]+$"),
}
#: first letters of the volumes of 1771
VOLUME_LETTERS_1771 = {1: ("A", "B"), 2: ("C", "L"), 3: ("M", "Z")}
#: an index line with volume and page in Arabic figures
INDEX_MAIN_ARABIC = r"^([A-Z][A-Z'\-]+(?:\s+[A-Z][A-Z'\-]+)*),\s*([^.]+)\.\s*(?:Vol\.?\s*)?(\d+):(\d+)"
INDEX_CROSS_ARABIC = r"^([A-Z][A-Z'\-]+(?:\s+[A-Z][A-Z'\-]+)*)\.\s*See\s+([A-Z][A-Z'\-]+(?:\s+[A-Z][A-Z'\-]+)*)"
INDEX_SUB_ARABIC = r"^\s{2,}([^,]+),\s*(?:Vol\.?\s*)?(\d+):(\d+)"
#: year, name, number, biographies allowed, treatise length
EDITIONS = (
    (1771, "1st", 1, False, 20000), (1778, "2nd", 2, True, 5000), (1797, "3rd", 3, True, 5000), (1810, "4th", 4, True, 5000),
    (1815, "5th", 5, True, 50000), (1823, "6th", 6, True, 5000), (1842, "7th", 7, True, 50000), (1860, "8th", 8, True, 5000),
)
EDITION_PHRASES = ("FIRST EDITION", "SECOND EDITION", "THIRD EDITION", "FOURTH EDITION", "FIFTH EDITION", "SIXTH EDITION", "SEVENTH EDITION", "EIGHTH EDITION")
#: editions that imply another if all have an article
INFERENCE_RULES = (((1815, 1823), 1810), ((1810, 1815), 1797), ((1797, 1810), 1778), ((1823, 1860), 1842))

# --- fixed values: artefacts of recognition --------------------------------
NON_ARTICLES = (
    "FINIS", "INDEX", "ERRATA", "ADDENDA", "CORRIGENDA", "APPENDIX", "CONTENTS", "PREFACE", "INTRODUCTION", "ADVERTISEMENT",
    "DIRECTIONS", "SUPPLEMENT", "PLATES", "FIGURES", "TABLES", "END", "CONCLUSION", "NOTES", "REMARKS", "OBSERVATIONS",
    "POSTSCRIPT", "GENERAL INDEX", *EDITION_PHRASES, "ENCYCLOPAEDIA BRITANNICA",
)
SECTION_HEADING = r"^(SECTION|CHAPTER|PART|BOOK|NOTE|NOTES)\s+[IVXLCDM\dA-Z]+$"
SUBHEADINGS = (r"^(THE|A|AN|BUT|AND|OR|BY|TO|OF|IN|ON|FOR|WITH|FROM)\s", r"^MR\s+[A-Z]+\s+TO\s+MR", r"^(ANTAGONISTS|ADVOCATES|OPPONENTS|DEFENDERS)\s+OF\s", r"^(EARL|LORD|SIR|LADY|DUKE|BARON|COUNT|PRINCE)\s+OF\s")
FRAGMENTS = r"^(GRAPHY|OLOGY|ATION|MENT|NESS|ICAL|IOUS|EOUS|ABLE|IBLE|TURE|SION|TION)$"
FIGURE_WORDS = ("fig.", "figure", "plate", "the point", "the line")
#: common words that the verb rule takes for headwords
STOPWORDS = (
    "I", "ME", "MY", "MYSELF", "WE", "OUR", "OURS", "OURSELVES", "YOU", "YOUR", "YOURS", "YOURSELF", "YOURSELVES", "HE", "HIM", "HIS",
    "HIMSELF", "SHE", "HER", "HERS", "HERSELF", "IT", "ITS", "ITSELF", "THEY", "THEM", "THEIR", "THEIRS", "THEMSELVES", "WHAT", "WHICH",
    "WHO", "WHOM", "THIS", "THAT", "THESE", "THOSE", "AM", "IS", "ARE", "WAS", "WERE", "BE", "BEEN", "BEING", "HAVE", "HAS", "HAD",
    "HAVING", "DO", "DOES", "DID", "DOING", "A", "AN", "THE", "AND", "BUT", "IF", "OR", "BECAUSE", "AS", "UNTIL", "WHILE", "OF", "AT",
    "BY", "FOR", "WITH", "ABOUT", "AGAINST", "BETWEEN", "INTO", "THROUGH", "DURING", "BEFORE", "AFTER", "ABOVE", "BELOW", "TO", "FROM",
    "UP", "DOWN", "IN", "OUT", "ON", "OFF", "OVER", "UNDER", "AGAIN", "FURTHER", "THEN", "ONCE", "HERE", "THERE", "WHEN", "WHERE", "WHY",
    "HOW", "ALL", "EACH", "FEW", "MORE", "MOST", "OTHER", "SOME", "SUCH", "NO", "NOR", "NOT", "ONLY", "OWN", "SAME", "SO", "THAN", "TOO",
    "VERY", "S", "T", "CAN", "WILL", "JUST", "DON", "SHOULD", "NOW", "D", "LL", "M", "O", "RE", "VE", "Y", "AIN", "AREN", "COULDN",
    "DIDN", "DOESN", "HADN", "HASN", "HAVEN", "ISN", "MA", "MIGHTN", "MUSTN", "NEEDN", "SHAN", "SHOULDN", "WASN", "WEREN", "WON",
    "WOULDN", "HENCE", "THUS", "THEREFORE", "HOWEVER", "MOREOVER", "FURTHERMORE", "NEVERTHELESS", "ACCORDINGLY", "CONSEQUENTLY",
    "MEANWHILE", "FORMERLY", "SAID", "CALLED", "NAMED", "KNOWN", "MADE", "FOUND", "GIVEN", "TAKEN", "ONE", "TWO", "THREE", "FOUR",
    "FIVE", "SIX", "SEVEN", "EIGHT", "NINE", "TEN", "FIRST", "SECOND", "THIRD", "FOURTH", "FIFTH", "LAST", "NEXT", "MANY", "MUCH",
    "SEVERAL", "EVERY", "BOTH", "EITHER", "NEITHER", "ANOTHER", "VARIOUS", "CERTAIN", "WHOLE", "ENTIRE", "HALF",
)

# --- fixed values: sections and index lines --------------------------------
SECTIONS = (
    (r"\n(PART\s+[IVX\d]+\.?[^\n]*)", 1),
    (r"\n(CHAP(?:TER)?\.?\s+[IVX\d]+\.?[^\n]*)", 2),
    (r"\n(SECT(?:ION)?\.?\s+[IVX\d]+\.?[^\n]*)", 2),
    (r"\n(§\s*\d+\.?[^\n]*)", 2),
    (r"\n(BOOK\s+[IVX\d]+\.?[^\n]*)", 1),
)
INDEX_REFERENCE = r"([IVXLCDM]+)\.\s*(\d+(?:\s*,\s*\d+)*)"
INDEX_SEE = r"(?i)See\s+([A-Za-z][A-Za-z'\-\s]+)"
INDEX_MAIN = r"^([A-Z][A-Z'\-\s]+(?:\([^)]+\))?),\s*(.+)$"
INDEX_CROSS = r"(?i)^([A-Z][A-Z'\-\s]+)\.\s*See\s+(.+)"
INDEX_SKIP = r"^$|^\d+[-–—]+$|^[A-Z]{2,3}[-–—][A-Z]{2,3}$|^!\[|^#"
PACKAGE_SECTIONS = (
    (r"(?:^|\n)(PART\s+[IVXLCDM]+\.?\s*[^\n]*)", 1),
    (r"(?:^|\n)(§\s*\d+\.?\s*[^\n.]{3,80}?)(?:\n|\.(?:\s|$))", 2),
    (r"(?:^|\n)(SECT\.?\s*[IVXLCDM\d]+\.?\s*[^\n]*)", 2),
    (r"(?:^|\n)(CHAP\.?\s*[IVXLCDM\d]+\.?\s*[^\n]*)", 2),
    (r"(?:^|\n)(Chapter\s+[IVXLCDM\d]+\.?\s*[^\n]*)", 2),
    (r"(?:^|\n)(Division\s+[IVXLCDM\d]+\.?\s*[^\n]*)", 2),
    (r"(?:^|\n)(Article\s+[IVXLCDM\d]+\.?\s*[^\n]*)", 2),
)
CHUNK_TITLES = (r"^(PART\s+[IVXLCDM]+\.?)", r"^(SECT(?:ION)?\.?\s+[IVXLCDM\d]+\.?)", r"^(CHAPTER\s+[IVXLCDM\d]+\.?)", r"^(Section\s+\d+\.?\s*[^\n]{0,50})", r"^([A-Z][a-z]+\s+[IVXLCDM]+\.)")
FILE_VOLUMES = (r"Volume\s*(\d+)", r"Vol\.?\s*(\d+)", r"v(\d+)", r"_(\d+)(?:_|\.)")
ROMAN_HEADWORDS = (
    "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI", "XVII", "XVIII", "XIX", "XX",
    "XXI", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM", "M", "MM", "MMM",
)
RUNNING_HEADS = ("PLATE", "VOLUME", "VOL", "CHAPTER", "PART", "PAGE")


# --- fixed values: headers, candidates, further references ------------------
#: editions by ordinal, then by year; both in the order in which they are tried
HEADER_EDITIONS = (
    (r"FIRST\s+EDITION", 1771), (r"SECOND\s+EDITION", 1778), (r"THIRD\s+EDITION", 1797), (r"FOURTH\s+EDITION", 1810),
    (r"FIFTH\s+EDITION", 1815), (r"SIXTH\s+EDITION", 1823), (r"SEVENTH\s+EDITION", 1842), (r"EIGHTH\s+EDITION", 1860),
    (r"\b1771\b", 1771), (r"\b1778\b", 1778), (r"\b1797\b", 1797), (r"\b1810\b", 1810), (r"\b1815\b", 1815), (r"\b1823\b", 1823),
    (r"M\.?D\.?C\.?C\.?C\.?X\.?L\.?I\.?I", 1842), (r"\b1842\b", 1842), (r"MDCCCLX\b", 1860), (r"\b1860\b", 1860),
)
HEADER_VOLUME = r"VOL(?:UME)?\.?\s*([IVXLCDM]+|\d+)"
HEADER_RANGES = (r",\s*([A-Z](?:[A-Z]*)?)\s*[-–—]\s*([A-Z][A-Za-z]*)", r"([A-Z]{1,3})\s*[-–—]\s*([A-Z][A-Za-z]{2,})")
CANDIDATES = {
    "capitals": r"(?:^|\n\n?)([A-Z][A-Z\s\-'\.]+?),\s+[a-z]",
    "title": r"(?:^|\n\n?)([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*),\s+[a-z]",
    "any": r"(?:^|\n\n?)([A-Za-z][A-Za-z\s\-'\.]+?),\s+[a-z]",
}
FURTHER_REFERENCES = (r"\bVid\.\s+([A-Z][A-Za-z'\-]+)", r"\b([A-Z][A-Za-z'\-]+),?\s+q\.\s?v\.", r"\b([A-Z][A-Za-z'\-]+),?\s+which\s+see\b")


#: words of running heads, and words that look like small Roman numerals
HEADER_WORDS = ("PART", "VOL", "VOLUME", "PLATE", "FIGURE", "PAGE", "CHAPTER", "SECTION", "INDEX", "CONTENTS")
NOT_NUMERALS = ("VI", "MIX", "VIM", "MIC", "MID", "VIA", "VIC", "VII")


def java(pattern: str, ignore_case: bool = False) -> str:
    return ("(?iuUmd)" if ignore_case else "(?Umd)") + pattern
