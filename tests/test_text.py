import re

import pytest
from pyspark.sql import functions as F

from clauseforge.functions import text as X
from clauseforge.functions.times import iso_micros, month_utc
from clauseforge.operators import chunking


def values(spark, expr, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_dates(spark):
    assert values(spark, X.parse_date, ["on 19-06-2024", "19/6/2024", "31-02-2024", "02-92-2015", "", None, "1219-06-20245"]) == ["2024-06-19", "2024-06-19", None, None, None, None, "2024-06-19"]
    assert [str(d) for d in values(spark, X.safe_date, ["2015-6-2", "2015-06-02T10:00", "2015-92-02", "x", None])] == ["2015-06-02", "2015-06-02", "None", "None", "None"]
    us = values(spark, iso_micros, ["1970-01-01T00:00:01Z", "1970-01-01T05:30:00.5+05:30", "1970-01-01T05:30:00+0530", "1970-01-02", "1970-01-01T00:00:02", "bad", None])
    assert us == [1_000_000, 500_000, 0, 86_400_000_000, 2_000_000, None, None]
    assert values(spark, month_utc, [0, -1, None], "bigint") == ["1970-01", "1969-12", None]


def test_references(spark):
    refs = ["X/HLT/CIR/PRO/84/5/2024", "x/ gahr /2019/1998", "HLT/A/B/C", "a/b/c/d/HLT", "", None]
    assert values(spark, X.ref_department, refs) == ["HLT", "GA&HR", None, None, None, None]
    assert values(spark, X.ref_year, ["a/2019/1998", "12024", "x 2101", None]) == [1998, None, None, None]
    assert values(spark, X.compact_ref, [" ab / c. ", None]) == ["AB/C", ""]
    assert values(spark, X.clause_ref, ["( 7A )", "2(a)", None]) == ["7A", "2(A", ""]


def test_titles(spark):
    assert values(spark, X.slugify, ["Hello,  World! " + "x" * 60, "--a--", "हिन्दी", None]) == ["hello-world-" + "x" * 32, "a", "", None]
    tied = [["परिपत्र / Circular", "Long English title", "English title too"], ["aa", "bb"], []]
    assert values(spark, X.best_title, tied, "array<string>") == ["Long English title", "aa", ""]
    assert values(spark, X.title_tokens, ["The IRDAI reg. of India, 2016", None, ""]) == [["2016", "authority", "development", "insurance", "regulations", "regulatory"], [], []]
    pairs = [(["a", "b"], ["a", "b", "c"]), (["a", "2019"], ["a", "2020"]), (["a", "b", "c"], ["a", "x", "y"]), ([], ["a"])]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p array<string>, q array<string>")
    got = [r.s for r in df.select("i", X.title_score(F.col("p"), F.col("q")).alias("s")).orderBy("i").collect()]
    assert got == pytest.approx([0.99, 1 / 3 / 2, 0.2, 0.0])


def test_lines_and_scripts(spark):
    texts = ["a\r\nb\n", "", "a\x0bb c", "\n\n", None]
    assert values(spark, X.lines, texts) == [t.splitlines() if t is not None else None for t in texts]
    assert values(spark, X.drop_devanagari_lines, ["नमस्ते\nhello\n123", "नम ab", ""]) == ["hello\n123", "नम ab", ""]
    assert values(spark, X.devanagari_share, ["अअab", ""]) == [0.5, 0.0]


def test_normalized_extraction(spark):
    text = "\n".join([
        "keep", "# LIST OF AMENDING ACTS", "1. The Act", "2. Another", "# Next", "> 6. Subs. by Act 5 of 2015",
        "8. Ins. by Act 6 of 1946, s. 25", "9. Ins. by Act 6 shall be kept", "> 6[( _7A_ ) text", "- item **bold** _it_ 4***.]", "  trailing  ",
    ])
    (got,) = values(spark, X.normalize_extracted, [text])
    assert got.split("\n") == ["keep", "Next", "9. Ins. by Act 6 shall be kept", "(7A) text", "item bold it", "  trailing"]


def test_urls_and_names(spark):
    df = spark.createDataFrame([("https://h.example/a/b?x=1", h) for h in ("/c", "d", "?q", "//o.example/z", "http://p.example", "#f")], "b string, h string")
    from urllib.parse import urljoin

    assert [r.u for r in df.select(X.join_url(F.col("b"), F.col("h")).alias("u")).collect()] == [urljoin(r.b, r.h) for r in df.collect()]
    assert values(spark, lambda c: X.safe_filename(c, F.lit(3)), ["a b/ç.pdf", "", None, "x"]) == ["a-b-.pdf", "attachment-3.pdf", "attachment-3.pdf", "x.pdf"]
    assert values(spark, X.file_of_url, ["https://h/a/My%20File.pdf/abc?x", "https://h/ab/long-name/1"]) == ["My File.pdf", "long-name"]
    assert values(spark, X.vector_literal, [[0.5, -1.0]], "array<float>") == ["[0.500000,-1.000000]"]


def plain_windows(body, size=1800, overlap=200):
    """The windows by a plain loop."""
    out, at = [], 0
    while at < len(body):
        a, b = at, min(at + size, len(body))
        if a and (m := re.search(r"[.।]\s+", body[a : a + 250])):
            a += m.end()
        if b < len(body) and (m := re.search(r"[.।]\s", body[b : b + 200])):
            b += m.end()
        if body[a:b].strip():
            out.append(body[a:b].strip())
        if at + size >= len(body):
            break
        at += size - overlap
    return out


def test_windows_equal_a_plain_loop(spark):
    bodies = ["", "x" * 1800, "x" * 1801, "y" * 3400, "z" * 3401, "One. Two। " * 700, "word " * 1000, "अ। " * 2000, "a" + " " * 5000 + "b"]
    assert values(spark, chunking.windows, bodies) == [plain_windows(b) for b in bodies]


def test_chunks_of_documents(spark):
    texts = [("d", 0, "one.pdf", "intro\n# Head *x*\nbody\n**3. Registration.** — (1) text\n**CHAPTER IV**\n"), ("d", 1, "two.pdf", "second"), ("e", 0, "only.pdf", "  "), ("f", 0, None, None)]
    df = spark.createDataFrame(texts, "doc string, attachment_no int, label string, text string")
    rows = chunking.number_chunks(chunking.chunk_texts(df, "doc", "text", "label")).orderBy("doc_id", "chunk_index").collect()
    assert [(r.doc_id, r.chunk_index, r.heading, r.attachment, r.content) for r in rows] == [
        ("d", 0, None, "one.pdf", "intro"), ("d", 1, "Head *x*", "one.pdf", "body"), ("d", 2, "3. Registration", "one.pdf", "— (1) text"), ("d", 3, None, "two.pdf", "second"),
    ]


def test_overlapping_pieces_join_again(spark):
    text = "".join(f"Sentence number {i} of the text. " for i in range(300))
    pieces = [text[a : a + 500] for a in range(0, len(text), 400)]
    assert values(spark, chunking.join_overlapping, [pieces, [], ["a", "", "b"]], "array<string>") == [text, "", "ab"]
