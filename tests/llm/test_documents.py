"""Operators on single documents against brute force, libraries and hand-made cases."""

import collections
import os
import random
import time

import pytest
import regex

from clauseforge.llm import leakage, markup, repetition, tokenizing

SCHEMA = "doc_id long, text string, source string, key string, item string"
WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
random.seed(3)


def frame(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, (sources or [None])[i % len(sources or [0])], "clash", "clash") for i, t in enumerate(texts)], SCHEMA)


ODD = [None, "", " \n\t", "!!!", "a", "İstanbul ΣΑΣ ΑΣ", "x" * 20_000, "कि" * 500, "😀 e\u0301é 1²Ⅷ"]


@pytest.fixture(scope="module")
def texts():
    v = ["fee", "Cover", "दावा", "rate", "rule", "form", "1", "É"]
    out = list(ODD)
    for _ in range(40):
        w = [random.choice(v) + random.choice(v) for _ in range(random.randrange(20, 90))]
        if random.random() < 0.5:
            a = random.randrange(len(w) - 10)
            w += w[a : a + random.randrange(5, 30)] * random.randrange(1, 4)
        out.append(random.choice([" ", ". ", "\n"]).join(w))
    return out


def brute_repeated(w, n=6):
    seen = collections.defaultdict(list)
    for i in range(len(w) - n + 1):
        seen[tuple(w[i : i + n])].append(i)
    return len({i + k for p in seen.values() if len(p) > 1 for i in p for k in range(n)})


def test_repetition(spark, texts):
    df = frame(spark, texts, ["h1", "h2", None])
    rows = {r.doc_id: r for r in repetition.document_repetition(df).collect()}
    assert set(rows) == set(range(len(texts)))
    found = set()
    for i, t in enumerate(texts):
        w = WORD.findall((t or "").lower())
        assert (rows[i].n_words, rows[i].repeated_words) == (len(w), brute_repeated(w)), i
        if len(w) >= 30 and 10 * brute_repeated(w) >= 4 * len(w):
            found.add(i)
    assert found and {r.doc_id for r in repetition.repetitive_documents(df).collect()} == found
    hosts = {r.source: (r.host_docs, r.host_fails) for r in rows.values()}
    assert sum(n for n, _ in hosts.values()) == len(texts) and None in hosts
    for r in rows.values():
        assert min(r.host_fails / r.host_docs, 0) <= r.host_rate <= 1
    assert repetition.repetitive_documents(df.limit(0)).count() == 0


def test_leakage(spark, texts):
    items = {}
    for n in range(8):
        items[n] = " ".join(f"item{n}word{k % 17}" for k in range(40))
    items[8] = items[7][:200]
    held = {**items, 9: None, 10: "too short", 11: ""}
    docs = list(texts)
    for n in range(8):
        w = items[n].split()
        docs += ["start, " + "; ".join(w[5:18]).upper() + " end", " ".join(w[5:17]) + " other", " ".join(w[:13] + ["gap"] + w[13:30])]
    docs += [docs[-1]]
    df = frame(spark, docs)
    it = spark.createDataFrame([(i, t, "x") for i, t in held.items()] * 2, "item_id long, text string, key string")

    def runs(t):
        w = WORD.findall((t or "").lower())
        return {tuple(w[i : i + 13]) for i in range(len(w) - 12)}

    want = {(d, i) for d, t in enumerate(docs) for i, u in held.items() if runs(t) & runs(u)}
    assert len(want) > 10
    assert {tuple(r) for r in leakage.leaked_pairs(df, it).collect()} == want
    assert {tuple(r) for r in leakage.leaks(df, it, items_per_pass=500).select("doc_id", "item_id").collect()} == want
    assert leakage.leaked_pairs(df.limit(0), it).count() == 0 and leakage.leaked_pairs(df, it.limit(0)).count() == 0


def test_leakage_of_short_texts_only(spark):
    it = spark.createDataFrame([(0, " ".join(f"w{k}" for k in range(20)))], "item_id long, text string")
    df = frame(spark, ["", "  \n", "a few words", " ".join(f"w{k}" for k in range(12)), None]).coalesce(1)
    assert leakage.leaks(df, it).count() == 0 and leakage.leaked_pairs(df, it).count() == 0


@pytest.mark.skipif(not os.path.exists(tokenizing.VOCABULARY), reason="no vocabulary files here")
def test_tokenizing(spark, texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizing.VOCABULARY)
    own.encode_special_tokens = True
    docs = [*texts, "aaaaaaaaaaaaaaaaa", "<|endoftext|>", "it's we'll I'd", "".join(map(chr, range(32, 0x1200))), " " * 99 + "x"]
    got = {r.doc_id: r.ids for r in tokenizing.encode(frame(spark, docs)).collect()}
    want = own.encode_batch([t or "" for t in docs], add_special_tokens=False)
    assert got == {i: e.ids for i, e in enumerate(want)}
    assert tokenizing.encode(frame(spark, docs).limit(0)).count() == 0


MARKED = [
    "<p>a</p>", "x <BR/> y", "<font size=2>x", "a &amp; b", "&#8377;5", "&lt;b&gt;x&lt;/b&gt;", "<!-- note -->", "# Head", "## Head ##", "a **b** c", "a __b__ c", "*Provided further* that", "the _only_ one", "~~gone~~ kept",
    "|a|b|\n|---|---|\n|1|2|", "see [x](http://y/z)", "![i](a.png)", "note.[^1]", "> quoted", "```\ncode\n```", "~~~\ncode\n~~~", "the `field` x", "- [x] done", "== Head ==", "[[Page|x]]", "[[Category:A]]", "'''b''' and ''i''",
    "{{Notice|a=1}}", "{| class=\"x\"\n|-\n| a\n|}", "#REDIRECT [[X]]", "[https://a.b label]", r"\section{X}", r"\begin{itemize}", r"\item x", "$x_1 + y$", r"\(x\)", r"\[ x \]", r"17\% of", r"\textbf{x}", "<https://a.b/c>", "<title>x</title>",
]
PLAIN = [
    None, "", "1. Plain numbering", "(a) clause", "<name of the insurer>", "fill in <date> here", "the <title> of <section number>", "US$ 366 or US$ 406", "Fee Rs 36* (*conditions apply).", "5 * 3 * 2 = 30", "403 < cover and cover > 201", "C:\\returns\\q4\\new",
    "returns_q3_final_v2.xlsx", "x_686_y", "|a - b| stays", "Units F&I; R&D; and PP&GR", "[A] text", "{B} text", "note [40] and {draft}", "Refund ~ 5, i.e. a - b - c.", "it’s ‘nil’", "query #12", "A = B.", "- plain item", "don't 'quote'",
]


def test_markup_grammar():
    assert [t for t in MARKED if not markup.has_markup(t)] == []
    assert [t for t in PLAIN if markup.has_markup(t)] == []
    for piece in ("<" * 30_000, "*a" * 20_000, "[" * 20_000, "$ " * 20_000, "`" * 9_999, "&amp" * 9_999, "| " * 9_999):
        markup.has_markup(piece)


def test_conversion_keeps_structure():
    text = "<h2>Title</h2><p>One &amp; two</p><ul><li>a<li>b</ul><table><tr><th>x</th><th>y</th></tr></table><pre>k = 1\n  z</pre>\n# Head #\n- **i** [l](u)\n|a|b|\n|---|---|\n|1|2|\n> q\n```py\nf(*x)\n```\nuse `a_b_c` and $x_1$.\n\\[ y^2 \\]\n\\section{S}\n{| class=x\n! h !! i\n|-\n| c || d\n|}\n== W ==\nIt is '''b''' [[P|shown]]{{N|v=1}}<script>var a;</script>"
    got = markup.convert(text)
    assert got == [
        ("heading", 2, "Title"), ("text", 0, "One & two"), ("item", 0, "a"), ("item", 0, "b"), ("row", 0, "x | y"), ("code", 0, "k = 1\n  z"), ("heading", 1, "Head"), ("item", 0, "i l"), ("row", 0, "a | b"), ("row", 0, "1 | 2"),
        ("quote", 0, "q"), ("code", 0, "f(*x)"), ("text", 0, "use a_b_c and x_1."), ("formula", 0, "y^2"), ("heading", 1, "S"), ("row", 0, "h | i"), ("row", 0, "c | d"), ("heading", 2, "W"), ("text", 0, "It is b shownN: 1"),
    ]


def test_conversion_of_deep_nesting_and_escapes():
    assert markup.convert("{{a|" * 7 + "x" + "}}" * 7) == [("text", 0, "a: " * 7 + "x")]
    assert "x" in (got := " ".join(t for _, _, t in markup.convert("&amp;amp;amp;lt;code>&amp;amp;lt;code>&amp;lt;code><code>x</code>&amp;lt;/code>&amp;amp;lt;/code>&amp;amp;amp;lt;/code>"))) and "\ue000" not in got
    for depth in range(6):
        assert markup.convert("&" + "amp;" * depth + "lt;b&" + "amp;" * depth + "gt;bold&" + "amp;" * depth + "lt;/b&" + "amp;" * depth + "gt; R&" + "amp;" * depth + "D") == [("text", 0, "bold R&D")]


def test_template_classes(spark):
    schema = "id string, doc_id string, content string, loaded_at int, page string, text string"
    rows = [(f"p{i}", "host", f"<div class='t'><b>Name</b>: {w} <i>{i}</i></div>", 1, None, None) for i, w in enumerate(["alpha", "beta", "gamma", "delta"])]
    rows += [("plain", "host", "no markup", 1, None, None), ("null", "host", None, 1, None, None), ("lone", None, "<p>x</p>", 1, None, None), rows[0], ("p0", "host", "<p>older</p>", 0, None, None)]
    out = {r.id: r for r in markup.clean_records(spark.createDataFrame(rows, schema)).collect()}
    assert set(out) == {"p0", "p1", "p2", "p3", "lone"}
    assert out["p1"].template_classes == 1 and any("beta" in s for s in out["p1"].slots) and out["lone"].template_classes == 0
    assert out["p0"].text == "Name: alpha 0"
    assert markup.clean_records(spark.createDataFrame(rows, schema).limit(0)).count() == 0


def test_template_blocks_are_told_apart(spark):
    page = "== Public Notice ==\n<p>issued by <b>the Authority</b></p>\
'''Date:''' {} {}\n"
    rows = [(f"p{i}", "h", page.format(i + 1, w), 1) for i, w in enumerate(["May", "June", "July", "March"])] + [("other", "h2", "== Public Notice ==", 1)]
    df = spark.createDataFrame(rows, "id string, doc_id string, content string, loaded_at int")
    out = {r.id: r for r in markup.clean_records(df).collect()}
    assert out["p2"].text == "Date: 3 July" and [b.template for b in out["p2"].blocks] == [True, True, False] and out["p2"].blocks[1].text == "issued by the Authority"
    assert out["other"].text == "Public Notice"
    templates = markup.host_templates(df).collect()
    assert [(t.host, t.pages) for t in templates] == [("h", 4)] and {"w:Notice", "m:wiki_emphasis", "m:<b>"} <= set(templates[0].tokens)
    assert markup.host_templates(df.limit(0)).count() == 0


OPENERS = ["''a ", "**a ", "__a ", "~~a ", "![a ", "[http://a ", "\\(a ", "\\[a ", "<!DOCTYPE ", "<?xml ", "<code> a", "`a ``a ```a ", "$$a ", "{{a|", "<pre>", "<script ", "\\begin{equation}", "  ", "== a ", "&amp;", "&lt;b&gt;"]


def test_openers_without_closers_take_linear_time():
    slow = []
    for opener in OPENERS:
        text = "x " + opener * (60_000 // len(opener))
        began = time.process_time()
        markup.tokens(text), markup.convert(text)
        if time.process_time() - began > 2:  # a quadratic scan takes many times that
            slow.append(opener)
    assert not slow


def test_masking_openers_changes_nothing_around_them():
    pieces = ["''it''", "''a", "**b**", "**a", "a**b**c", "__u__", "__u", "`c`", "``c` d``", "`", "[l](u)", "![i](u)", "![i", "[http://x y]", "[http://x", "\\(x\\)", "\\(", "<code>x</code>", "<b>", "\n", "w"]
    rng = random.Random(8)
    for _ in range(3000):
        text = " ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60)))
        whole = [(m.start(), m.end(), m.lastgroup) for m in markup.MARKUP.finditer(text)]
        few, markup.FEW = markup.FEW, 0
        try:
            masked = markup.tokens(text)
        finally:
            markup.FEW = few
        assert whole == masked, text


def test_slots_hold_what_stands_outside_and_within_tokens():
    text = "Ref 7\n== Notice 12 ==\n'''Date:''' 3 May\nplain line"
    page = markup.page_tokens(text)
    assert [t for t, _, _ in page] == ["m:wiki_heading", "w:Notice", "w:12", "m:/wiki_heading", "m:wiki_emphasis", "w:Date", "m:/wiki_emphasis", "w:3", "w:May"]
    names = {"m:wiki_heading", "w:Notice", "m:/wiki_heading", "m:wiki_emphasis", "w:Date", "m:/wiki_emphasis"}
    assert markup.slots(text, page, {1: names}) == (["Ref 7", "12", "3 May plain line"], 1, {"Notice", "Date"})
    assert markup.slots(text, page, {}) == ([], 0, set())
    assert [t for t, _, _ in markup.page_tokens("<b>x</b> one <i>two\nthree")] == ["m:<b>", "w:x", "m:</b>", "w:one", "m:<i>", "w:two"]


def test_templates_are_read_from_whole_pages(spark):
    page = "<div>\nIssued by the Authority\n</div>\n<p>Seal and Date</p>\n{} {}\n{}"
    rows = [(f"p{i}", "h", page.format(i + 1, w, "Seal" if i == 3 else "no more"), 1) for i, w in enumerate(["May", "June", "July", "March"])]
    df = spark.createDataFrame(rows, "id string, doc_id string, content string, loaded_at int")
    out = {r.id: r for r in markup.clean_records(df).collect()}
    assert out["p2"].text == "Seal and Date\n3 July\nno more" and [b.template for b in out["p2"].blocks] == [True, False, False, False]
    assert out["p2"].slots == ["Seal", "3 July no more"] and out["p3"].text == "Seal and Date\n4 March\nSeal"  # twice on one page: no part of the class
    assert {"w:Issued", "w:Authority", "m:<div>"} <= set(markup.host_templates(df).collect()[0].tokens)


def test_page_holds_tokens_within_tokens():
    assert [t for t, _, _ in markup.whole_page("one\n## <b>Notice 7</b>\ntwo\n\nthree")] == ["w:one", "m:heading", "m:<b>", "w:Notice", "w:7", "m:</b>", "m:/heading", "w:two", "w:three"]
    assert [t for t, _, _ in markup.page_tokens("__Date:__ _3_")] == ["m:strong", "w:Date", "m:/strong", "m:emphasis", "w:3", "m:/emphasis"]
    text = "## <b>Notice 7</b>"
    page = markup.whole_page(text)
    assert markup.slots(text, page, {1: {t for t, _, _ in page} - {"w:7"}})[0] == ["7"]


def test_classes_nest_or_one_is_left_out():
    page = [(t, 2 * i, 2 * i + 1) for i, t in enumerate("a x y b a x y b".split())]
    text = "".join(t + "-" for t, _, _ in page)
    assert markup.slots(text, page, {1: {"a", "b"}, 2: {"x", "y"}})[1] == 2  # x y lies between a and b, twice
    crossed = [(t, 2 * i, 2 * i + 1) for i, t in enumerate("a x b y".split())]
    assert markup.slots(text, crossed, {1: {"a", "b"}, 2: {"x", "y"}})[1] == 1
    assert markup.slots(text, page, {1: {"a", "z"}, 2: {"x", "y", "b"}})[1] == 2
    unordered = [(t, 2 * i, 2 * i + 1) for i, t in enumerate("a b b a".split())]
    assert markup.slots(text, unordered, {1: {"a", "b"}})[1] == 0


def test_queries_match_sql(compare):
    from clauseforge.llm.queries import ORACLES, QUERIES

    for name, sql in ORACLES.items():
        compare(QUERIES[name], sql)


def test_all_queries_run(spark, sf):
    from clauseforge.llm.queries import QUERIES

    for query in QUERIES.values():
        assert query(spark, sf).count() >= 0
