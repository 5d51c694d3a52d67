"""String functions as column expressions; all stay inside the JVM.

Lengths and positions are code points.  Unless said otherwise null gives null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` and ``\s`` see it.
WS = r"[\s\x{1c}-\x{1f}\x{85}]"
LINE_ENDS = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def strip(col: Column) -> Column:
    return F.regexp_replace(col, rf"(?U)^{WS}+|{WS}+$", "")


def squeeze(col: Column) -> Column:
    """Every run of white space becomes one space, none is left around the text."""
    return F.regexp_replace(F.regexp_replace(col, rf"(?U){WS}+", " "), "^ +| +$", "")


def lines(col: Column) -> Column:
    """The lines of a text; a line end at the very end opens no further line, an empty text has none."""
    parts = F.split(col, LINE_ENDS)
    cut = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.when(col == "", F.array().cast("array<string>")).otherwise(cut)


def nonblank(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


# ------------------------------------------------------------ dates and references


def parse_date(raw: Column) -> Column:
    """``yyyy-MM-dd`` of the first day-first date in the text; null if there is none or it is impossible."""
    found = F.regexp_extract(raw, r"(\d{1,2}[-/]\d{1,2}[-/]\d{4})", 1)
    return F.date_format(F.try_to_date(F.translate(found, "/", "-"), "d-M-yyyy"), "yyyy-MM-dd")


def safe_date(value: Column) -> Column:
    """The date in the first ten characters (year-month-day), or null."""
    head = F.substring(value, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(head, "yyyy-M-d"))


# Department codes of reference numbers, and the codes that stand for another.
DEPARTMENTS = ["NL", "HLT", "F&I", "F&A", "ACTL", "ACT", "LGL", "LEGAL", "REIN", "PP&GR", "PPGR", "INT", "LIFE", "GA&HR", "GAHR", "SDD", "IT"]
DEPARTMENT_ALIASES = {"PPGR": "PP&GR", "GAHR": "GA&HR", "ACT": "ACTL", "LEGAL": "LGL", "F&A": "F&I"}


def ref_department(ref: Column) -> Column:
    """The first department code among the second to fourth slash-separated parts."""
    parts = F.transform(F.slice(F.split(ref, "/"), 2, 3), lambda p: F.upper(strip(p)))
    known = F.filter(parts, lambda p: p.isin(DEPARTMENTS))
    first = F.get(known, F.lit(0))
    alias = F.create_map(*[F.lit(x) for kv in DEPARTMENT_ALIASES.items() for x in kv])
    return F.coalesce(F.element_at(alias, first), first)


def ref_year(ref: Column) -> Column:
    """The last year 1900 to 2099 that stands alone in the reference."""
    years = F.regexp_extract_all(ref, F.lit(r"(?U)\b(19\d{2}|20\d{2})\b"), F.lit(1))
    return F.get(years, F.size(years) - 1).cast("int")


def compact_ref(ref: Column) -> Column:
    """Reference number for matching: no white space, upper case, no full stops around it; '' for null."""
    return F.regexp_replace(F.upper(F.regexp_replace(F.coalesce(ref, F.lit("")), rf"(?U){WS}+", "")), r"^\.+|\.+$", "")


def clause_ref(ref: Column) -> Column:
    """Clause reference for matching: no white space, no brackets or full stops around it, upper case; '' for null."""
    bare = F.regexp_replace(F.coalesce(ref, F.lit("")), rf"(?U){WS}+", "")
    return F.upper(F.regexp_replace(bare, r"^[().]+|[().]+$", ""))


# ------------------------------------------------------------ titles


def slugify(text: Column, most: int = 44) -> Column:
    dashed = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.regexp_replace(F.substring(dashed, 1, most), "-+$", "")


def bare_title(title: Column) -> Column:
    """Only ASCII letters and digits of the lower-cased title; '' for null."""
    return F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9]+", "")


def latin_ratio(text: Column) -> Column:
    """Share of ASCII letters among letters, 0 where there are none."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.when(letters == 0, F.lit(0.0)).otherwise(F.regexp_count(text, F.lit("[A-Za-z]")) / letters)


def best_title(candidates: Column) -> Column:
    """The candidate with the greatest share of Latin letters (to three places), then the longest, then the first; '' if none."""
    ranked = F.transform(
        candidates,
        lambda c, i: F.struct(F.bround(latin_ratio(c), 3).alias("ratio"), F.length(c).alias("n"), (-i).alias("i"), c.alias("text")),
    )
    return F.coalesce(F.array_max(ranked)["text"], F.lit(""))


# Words that say nothing about which instrument a title names, and expansions.
TITLE_STOPWORDS = ["of", "the", "and", "for", "india", "indian"]
TITLE_EXPANSIONS = [
    (r"\birdai?\b", "insurance regulatory development authority"),
    (r"\breg\b\.?", "regulations"),
    (r"\bregulation\b", "regulations"),
]


def title_tokens(title: Column) -> Column:
    """Distinct content words of a title, sorted; empty for null."""
    plain = F.lower(F.regexp_replace(F.coalesce(title, F.lit("")), "[^A-Za-z0-9]+", " "))
    spelled = reduce(lambda c, x: F.regexp_replace(c, x[0], x[1]), TITLE_EXPANSIONS, plain)
    words = F.filter(F.split(spelled, " +"), lambda w: w != "")
    return F.array_sort(F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in TITLE_STOPWORDS])))


def title_score(wanted: Column, have: Column) -> Column:
    """Similarity of two token sets: Jaccard, at least 0.99 if one holds the other, halved if the wanted years are missing."""
    common = F.size(F.array_intersect(wanted, have))
    jaccard = common / F.size(F.array_union(wanted, have))
    held = (common == F.size(wanted)) | (common == F.size(have))
    years = F.filter(wanted, lambda w: w.rlike(r"^(?:19|20)\d\d$"))
    other_year = (F.size(years) > 0) & ~F.arrays_overlap(years, have)
    score = F.when(held, F.greatest(jaccard, F.lit(0.99))).otherwise(jaccard)
    return F.when((F.size(wanted) == 0) | (F.size(have) == 0), F.lit(0.0)).otherwise(F.when(other_year, score * 0.5).otherwise(score))


def shared_word_ratio(title: Column, name: Column) -> Column:
    """Share of the title's words of three letters or more that the file name has too; 0 without such words."""

    def words(c: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([a-z0-9]{3,})"), F.lit(1)))

    mine = words(title)
    return F.when(F.size(mine) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(mine, words(name))) / F.size(mine))


# ------------------------------------------------------------ scripts


def devanagari_share(text: Column) -> Column:
    """Devanagari characters among all characters (0 for empty)."""
    return F.regexp_count(text, F.lit(r"[\x{900}-\x{97F}]")) / F.greatest(F.length(text), F.lit(1))


def mostly_devanagari(line: Column, most: float = 0.5) -> Column:
    """Whether more than ``most`` of a line's letters are Devanagari; false without letters."""
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    return (letters > 0) & (F.regexp_count(line, F.lit(r"(?=[\x{900}-\x{97F}])\p{L}")) > letters * most)


def drop_devanagari_lines(text: Column) -> Column:
    """The text without its lines that are mostly Devanagari."""
    return F.array_join(F.filter(lines(text), lambda l: ~mostly_devanagari(l)), "\n")


# ------------------------------------------------------------ extracted text

# Where front matter begins, what footnotes look like, and the replacements, in order.
FRONT_MATTER = r"(?iU)^#{0,6}\s*LIST OF (?:AMENDING|ABBREVIATIONS)"
ANY_HEADER = r"(?U)^#{1,6}\s+\S"
FOOTNOTE = r"(?U)^\s*(?:>\s*)+\d{1,3}\.\s"
CITATION = (
    r"(?iU)^\s*(?:>\s*)*\d{1,3}\s*[\.\)]\s+.{0,160}?(?:\b(?:Ins|Subs|Rep|Omitted|Added|Renumbered)\.?\s+by\s+(?:Act|Ord|the)\b"
    r"|\bGazette of India\b|\bnotifn\b|\bvide\s+notification\b)"
)
SHALL_BE = r"(?iU)\bshall\s+be\b"
LINE_REPLACEMENTS = [
    (r"(?U)^\s*(?:>\s*)+", ""),
    (r"(?U)^(\s*)-\s+", "$1"),
    (r"<sup>.*?</sup>", ""),
    (r"(?U)\b\d{1,3}\[", ""),
    (r"(?U)\(\s*_\s*([0-9A-Za-z]{1,6})\s*_\s*\)", "($1)"),
    (r"_([^_\n]{1,60})_", "$1"),
    (r"(?U)\s*\d*\*{2,}\s*\.?\]|\*{3,}", ""),
    (r"\*\*", ""),
    (r"(?U)^#{1,6}\s*", ""),
]


def normalize_extracted(text: Column) -> Column:
    """Text of an extraction without front matter, footnotes and the marks the extraction left.

    Front matter runs from its header to the next header of any kind; that header is judged anew.
    """

    def place(marked: Column) -> Column:
        return F.transform(marked, lambda x: x["i"])

    def last_before(marks: Column, i: Column) -> Column:
        return F.coalesce(F.array_max(F.filter(marks, lambda m: m <= i)), F.lit(-1))

    def kept(x: Column, opens: Column, closes: Column) -> Column:
        skipped = (F.size(opens) > 0) & (last_before(opens, x["i"]) > last_before(closes, x["i"]))
        return ~(skipped | x["l"].rlike(FOOTNOTE) | (x["l"].rlike(CITATION) & ~x["l"].rlike(SHALL_BE)))

    def clean(line: Column) -> Column:
        # Every replacement needs one of these characters.
        return F.when(line.rlike(r"[>\[_*#<]|^\s*-"), reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), LINE_REPLACEMENTS, line)).otherwise(line)

    def numbered(l: Column, i: Column) -> Column:
        return F.struct(i.alias("i"), F.regexp_replace(l, rf"(?U){WS}+$", "").alias("l"), F.regexp_replace(l, rf"(?U)^{WS}+|{WS}+$", "").alias("s"))

    def marks(n: Column) -> Column:
        front = F.filter(n, lambda x: x["s"].rlike(FRONT_MATTER))
        header = F.filter(n, lambda x: x["s"].startswith("#") & x["s"].rlike(ANY_HEADER) & ~x["s"].rlike(FRONT_MATTER))
        return F.struct(n.alias("n"), place(front).alias("o"), place(header).alias("c"))

    # Arrays of one element bind their element, so that it is computed once and not anew for each line.
    bound = F.transform(F.transform(F.array(F.transform(lines(text), numbered)), marks), lambda b: F.transform(F.filter(b["n"], lambda x: kept(x, b["o"], b["c"])), lambda x: clean(x["l"])))
    return F.array_join(bound[0], "\n")


# ------------------------------------------------------------ names and addresses


def safe_filename(name: Column, index: Column) -> Column:
    """A file name of safe characters, at most 80 plus ``.pdf``; ``attachment-<index>`` where nothing is left."""
    base = F.substring(F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", ""), 1, 80)
    named = F.when(base == "", F.concat(F.lit("attachment-"), index.cast("string"))).otherwise(base)
    return F.when(F.lower(named).endswith(".pdf"), named).otherwise(F.concat(named, F.lit(".pdf")))


def join_url(base: Column, href: Column) -> Column:
    """``href`` seen from ``base``: absolute, scheme-relative, rooted and plain relative addresses."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(F.length(path) > F.length(root), F.regexp_replace(path, r"[^/]*$", "")).otherwise(F.concat(root, F.lit("/")))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(path, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href == "", base)
        .otherwise(F.concat(folder, href))
    )


def file_of_url(url: Column) -> Column:
    """The file name in an address: its first .pdf or .doc segment, else its longest segment with letters, decoded."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    parts = F.filter(F.transform(F.split(path, "/"), lambda p: F.coalesce(F.try_url_decode(p), p)), lambda p: p != "")
    named = F.filter(parts, lambda p: F.lower(p).rlike(r"\.(?:pdf|docx?)$"))
    lettered = F.transform(F.filter(parts, lambda p: p.rlike("[A-Za-z]")), lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("i"), p.alias("p")))
    return F.coalesce(F.get(named, F.lit(0)), F.array_max(lettered)["p"])


def vector_literal(vector: Column) -> Column:
    """``[0.123456,...]`` with six places."""
    return F.concat(F.lit("["), F.array_join(F.transform(vector, lambda x: F.format_string("%.6f", x)), ","), F.lit("]"))


def sha1_id(*parts: Column) -> Column:
    return F.sha1(F.concat_ws("|", *parts))
