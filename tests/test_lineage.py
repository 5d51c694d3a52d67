import pytest
from pyspark.sql import functions as F

from clauseforge.functions import text as X
from clauseforge.operators import audit, grammar, lineage, resolution, segmentation


def parsed(spark, texts):
    """Each text's edges and unread lines."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(2)
    return [r for r in grammar.parse_amendments(df).orderBy("doc_id").collect()]


CASES = [
    ("1. The clause (a) shall be renumbered", dict(rule="renumber", action="renumber", confidence="low")),
    ("Throughout the Schedule I, for the words “a”, “b” and “c”, the words “d” shall be substituted", dict(rule="global_word_sub", old=["a", "b", "c"], new="d", is_global=True, scope="Schedule I", confidence="high")),
    ("for the words “old”, wherever they occur, the words “ new ” shall be inserted", dict(rule="word_sub_fwd", old=["old"], new="new", is_global=True, confidence="low")),
    ("the word “x” shall be substituted with “y”", dict(rule="word_sub_inv", old=["x"], new="y")),
    ("the heading “Old” shall be substituted as “New”", dict(rule="heading_sub", unit="heading", old=["Old"], new="New")),
    ("In regulation 2, heading shall be substituted as Some plain heading", dict(rule="heading_sub", new="Some plain heading", confidence="medium")),
    ("after the words “x”, the words “y” shall be inserted", dict(rule="word_insert_after", action="insert", level="words", anchor="x", new="y")),
    ("the words “x” and “y” shall be omitted", dict(rule="word_omit", old=["x", "y"])),
    ("For the existing clause (3) of regulation 7, the following clause shall be substituted", dict(rule="unit_sub", unit="clause", target_ref="(3)", path="regulation 7", confidence="high")),
    ("Form II shall be substituted, namely", dict(rule="unit_sub_first", unit="form", target_ref="II")),
    ("for the Explanation, the following shall be substituted", dict(rule="unit_sub_refless", target_ref="(whole)")),
    ("the following note shall be substituted for note VII", dict(rule="note_sub_for", unit="note", target_ref="VII")),
    ("After 7 of the Act, the following shall be inserted", dict(rule="insert_after", unit="clause", anchor="7", position="after", path="the Act")),
    ("After clause (a), new clause (b) and clause (c) shall be inserted", dict(rule="insert_new_units", anchor="(a)", new_ref="clause (b) and clause (c)")),
    ("the following proviso shall be inserted after clause (b) as clause (c)", dict(rule="insert_after_inv", unit="proviso", anchor="(b)", new_ref="(c)")),
    ("Before clause 1, the following shall be inserted", dict(rule="insert_before", unit="clause", anchor="1", position="before")),
    ("Entries 5 of Schedule I shall be omitted", dict(rule="unit_omit", unit="entrie", target_ref="5", path="Schedule I")),
    ("In row 17, the following shall be substituted", dict(rule="loc_bare_sub", target_ref="row 17", confidence="medium")),
    ("the following shall be substituted", dict(rule="loc_bare_sub", target_ref=None, confidence="low")),
    ("“X” the words “Y” shall be substituted", dict(rule="word_sub_defective", old=["X"], new="Y", confidence="low")),
    ("In clause 2, for the word “a”, the word “b” shall be substituted except where it means c.", dict(exception="except where it means c", confidence="medium")),
    ("clause (c), (e) shall be omitted", dict(target_ref="(c), (e)")),
]


def test_rules(spark):
    assert {r.name for r in grammar.RULES} - {w.get("rule") for _, w in CASES} <= {"word_sub_paired", "unit_sub"} | {None}
    for row, (line, want) in zip(parsed(spark, [c for c, _ in CASES]), CASES):
        (e,) = row.edges
        assert {k: e[k] for k in want} == want, line


def test_expansion_and_scope(spark):
    text = "\n".join([
        "SCHEDULE II shall be omitted", "clause 1 shall be omitted", "3. In Part II of the Schedule I of principal Regulations:", "clause 2 shall be omitted",
        "4. clause 3 shall be omitted", "the words “a” and “b” shall be substituted with “c” respectively", "clauses (c) and (d) shall be omitted. After section 9, the following shall be inserted", "foo shall be deleted",
    ])
    (got,) = parsed(spark, [text])
    rows = [(e["target_ref"] or e["anchor"], e["scope"]) for e in got.edges]
    assert rows == [("1", "Schedule II"), ("2", "Part II of the Schedule I of principal Regulations"), ("3", "Schedule II"), (None, "Schedule II"), ("(c)", "Schedule II"), ("(d)", "Schedule II"), ("9", "Schedule II")]
    assert got.edges[3].confidence == "low" and got.edges[3].news == ["c"] and got.unparsed == ["foo shall be deleted"]


def test_spans_never_overlap():
    body = "for the words “a”, the words “b” shall be substituted and clause 3 shall be omitted, after clause 4, the following shall be inserted"
    spans = [m.span() for _, m in grammar.Matcher().spans(body)]
    assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and len(spans) == 3


def segments(spark, text):
    df = spark.createDataFrame([("p", text), ("none", None), ("empty", "")], "doc_id string, text string").repartition(3)
    return segmentation.segment(df)


def test_segmentation(spark):
    text = "lost\nCHAPTER I – General\n1. First regulation here\nbody one\n\nbody two\n(1) clause\n(a) sub\n2. Second regulation\nPart II(A): Forms\n(b) under part\nSCHEDULE I\nPart in prose"
    got = [(r.seq, r.level, r.ref, r.path, r.text) for r in segments(spark, text).orderBy("seq").collect()]
    assert got == [
        (0, "chapter", "I", "cha-I", ""), (1, "regulation", "1", "cha-I/reg-1", "body one body two"), (2, "clause", "1", "cha-I/reg-1/cla-1", ""), (3, "subclause", "a", "cha-I/reg-1/cla-1/sub-a", ""),
        (4, "regulation", "2", "cha-I/reg-2", ""), (5, "part", "II", "par-II", ""), (6, "subclause", "b", "par-II/sub-b", ""), (7, "schedule", "I", "sch-I", ""), (8, "part", "i", "sch-I/par-i", ""),
    ]
    twice = segments(spark, "1. First regulation here\n(1) a\n1. First regulation again\n(1) b\n2. Other regulation x\n(1) c")
    kept = segmentation.once_per_identity(twice).orderBy("seq").collect()
    assert [(r.level, r.path) for r in kept] == [("regulation", "reg-1"), ("clause", "reg-1/cla-1"), ("regulation", "reg-2"), ("clause", "reg-2/cla-1")]


BASE = [("reg-7", "regulation", "7"), ("reg-7/cla-a", "clause", "a"), ("reg-8", "regulation", "8"), ("reg-8/cla-a", "clause", "a")]


def folded(spark, *lines):
    held = spark.createDataFrame([("p", n, f"p#{path}", level, ref, "", path) for n, (path, level, ref) in enumerate(BASE)], "slug string, seq int, id string, level string, ref string, heading string, path string")
    read = grammar.read(spark.createDataFrame([("am", "\n".join(lines))], "doc_id string, text string"))
    instruments = spark.createDataFrame([("p", "am", "2024-01-01", 0)], "slug string, doc string, date string, pos int")
    (r,) = lineage.fold(instruments, read, held).collect()
    return r, (r.amendments[0].applied, r.amendments[0].unresolved)


def test_anchoring(spark):
    line, done = folded(spark, "In regulation 8: clause (a) of regulation 8 shall be omitted")
    assert done == (1, 0) and [p.id for p in line.provisions if p.events] == ["p#reg-8/cla-a"]
    line, done = folded(spark, "For the clause (z) of regulation 9, the following shall be substituted")  # a ghost under its scope
    assert done == (1, 0) and line.provisions[-1].path == "reg-9/cla-Z" and line.provisions[-1].ghost
    line, done = folded(spark, "For the clause (z) of regulation 9, the following shall be substituted", "For the clause (z) of regulation 10, the following shall be substituted")
    assert [p.path for p in line.provisions if p.ghost] == ["reg-9/cla-Z", "reg-10/cla-Z"]
    line, done = folded(spark, "In regulation 7, for the words “a”, the words “b” shall be substituted", "In regulation 7, for the words “a”, the words “b” shall be substituted")
    assert done == (1, 0) and line.stats["events_deduped"] == 1 and line.provisions[0].events[0].action == "amend" and line.provisions[0].events[0].detail == "“a” → “b”"
    line, done = folded(spark, "After clause (a) of regulation 8, the following shall be inserted", "After clause (a) of regulation 8, the following shall be inserted")
    assert done == (2, 0) and [p.path for p in line.provisions if p.introducedBy] == ["reg-8/cla-AFTERA"]
    line, done = folded(spark, "clause (a) shall be omitted")
    assert done == (0, 1) and "low confidence" in line.notes[0].note


def test_units_and_words(spark):
    rows = [("section", "27A(5)(a)", "In clause (b) of Schedule II", "sub-clause"), (None, "(c)", None, None), ("note", None, "note 3 of Part I", "form")]
    got = spark.createDataFrame(rows, "unit string, ref string, said string, other string").select(
        lineage.units_of_reference(F.col("unit"), F.col("ref")).alias("a"), lineage.units_in(F.col("said")).alias("b"), lineage.units_of_reference(F.col("other"), F.lit("(a)(b)")).alias("c")
    ).collect()
    assert [[tuple(u) for u in r.a] for r in got] == [[("regulation", "27A"), ("clause", "5"), ("subclause", "A")], [("regulation", "C")], []]
    assert [[tuple(u) for u in r.b] for r in got] == [[("clause", "B"), ("schedule", "II")], [], [("part", "I")]]
    assert [tuple(u) for u in got[0].c] == [("subclause", "A"), ("subclause", "B")]


def test_resolution(spark):
    docs = spark.createDataFrame([
        ("a", 0, "Cover Regulations, 2016", "Regulations"), ("b", 1, "Cover Regulations, 2016", "Regulations"), ("c", 2, "Cover Regulations, 2020", "Regulations"),
        ("am", 3, "Cover (First Amendment) Regulations, 2016", "Regulations"), ("z", 4, None, "Acts"), ("long", 5, "Cover Regulations, 2016 with all schedules of forms", "Regulations"),
    ], "slug string, pos int, title string, type string")
    parsed = spark.createDataFrame([("am", "Cover Regulations, 2016"), ("am2", None), ("x", "Nothing alike at all")], "doc_id string, principal string")
    got = {r.doc_id: (r.slug, round(r.score, 2)) for r in resolution.resolve_principals(parsed, docs).collect()}
    assert got == {"am": ("a", 1.0), "am2": (None, 0.0), "x": (None, 0.0)}
    own = resolution.resolve_principals(spark.createDataFrame([("am", None)], parsed.schema), docs).first()
    assert own.slug == "a"
    wanted = spark.createDataFrame([("a", "am")], "slug string, amendment string")
    texts = spark.createDataFrame([("long", "text"), ("am", "text")], "slug string, text string")
    assert [tuple(r) for r in resolution.text_variants(wanted, docs, texts).collect()] == [("a", "long")]


def test_needed_words_are_looked_for_once():
    """Which words a line holds is found once a line, not once a rule; the spans are those of looking rule by rule."""

    class Low(str):
        asked = 0

        def lower(self):
            return Low(str.lower(self))

        def __contains__(self, word):
            Low.asked += 1
            return str.__contains__(self, word)

    matcher = grammar.Matcher()

    def slowly(body):
        free, found = [True] * len(body), []
        for rule, pattern in matcher.rules:
            for m in pattern.finditer(body) if all(w in body.lower() for w in rule.needs) else ():
                if all(free[m.start() : m.end()]):
                    free[m.start() : m.end()] = [False] * (m.end() - m.start())
                    found.append((rule.name, m.span()))
        return sorted(found, key=lambda x: x[1][0])

    lines = [c[0] for c in CASES]
    for body in [*lines, *(f"{a}; {b}" for a in lines for b in lines), ""]:
        Low.asked = 0
        assert [(r.name, m.span()) for r, m in matcher.spans(Low(body))] == slowly(body)
        assert Low.asked <= len({w for r, _ in matcher.rules for w in r.needs})


def _shuffled_rows(spark):
    """Rows written to shuffles so far."""
    gateway = spark.sparkContext._gateway
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = gateway.jvm.java.util.ArrayList()
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_resolution_without_rows_of_pairs(spark, monkeypatch):
    """Titles of few words: the best of each are those of comparing all with all, and no pair is written to a shuffle."""
    import random

    rnd, words = random.Random(5), ["cover", "fees", "solvency", "health", "irda", "rules", "act", "2016", "2017", "1999"]
    titles = [(f"s{i}", i if i != 50 else None, None if i == 9 else " ".join(rnd.sample(words, rnd.randint(0, 6))), "Acts") for i in range(300)]
    docs = spark.createDataFrame(titles, "slug string, pos int, title string, type string")
    wanted = docs.select(F.col("slug").alias("doc_id"), "title", F.expr("CASE WHEN pos % 2 = 0 THEN slug END").alias("self"))
    pairs = wanted.select("doc_id", "self", X.title_tokens(F.col("title")).alias("w")).crossJoin(docs.select("slug", "pos", X.title_tokens(F.col("title")).alias("c")))
    each = pairs.filter("self IS NULL OR slug <> self").withColumn("score", X.title_score(F.col("w"), F.col("c"))).filter(F.arrays_overlap("w", "c"))
    best = each.groupBy("doc_id").agg(F.max_by(F.struct("slug", "score"), F.struct("score", -F.col("pos"))).alias("b"))
    want = {r.doc_id: (r.b.slug if r.b.score >= 0.7 else None, r.b.score) for r in best.collect()}
    for blocks in ((100_000, 250_000), (40, 70)):
        monkeypatch.setattr(resolution, "ASKED_PER_BLOCK", blocks[0])
        monkeypatch.setattr(resolution, "TITLES_PER_BLOCK", blocks[1])
        before = _shuffled_rows(spark)
        got = {r.doc_id: (r.slug, r.score) for r in resolution.resolve(wanted, docs, ["doc_id"]).collect()}
        made = _shuffled_rows(spark) - before
        assert blocks[0] == 40 or made < 4000, made
        assert len(got) == 300 and {k: v for k, v in got.items() if v != (None, 0.0)} == want


def test_variants_broadcast_no_titles(spark):
    """Small files can hold many titles: whatever size the planner takes them for, none are broadcast."""
    docs = spark.createDataFrame([("a", 0, "Cover Rules", "Rules"), ("b", 1, "Cover Rules with schedules", "Rules")], "slug string, pos int, title string, type string")
    found = resolution.text_variants(docs.select("slug", F.lit("").alias("amendment")), docs, docs.filter("slug = 'b'").select("slug", F.lit("x").alias("text")))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("a", "b")] and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_build_is_independent_of_order(spark):
    principal = "CHAPTER I\n1. First regulation text\n(a) clause a\n2. Second regulation text\n(a) clause a"
    first = "to amend the Insurance Regulatory (Cover) Regulations, 2016\nFor clause (a) of regulation 2, the following shall be substituted\nSub-clause (q) of regulation 5 shall be omitted\nfoo shall be deleted"
    second = "to amend the Insurance Regulatory (Cover) Regulations, 2016\nFor sub-clause (q) of regulation 5, the following shall be substituted"
    docs = spark.createDataFrame([
        ("p", 0, "Insurance Regulatory (Cover) Regulations, 2016", "Regulations", "2016-01-01"), ("s", 1, "Insurance Regulatory (Cover) (Second Amendment) Regulations, 2018", "Regulations", "2018-01-01"),
        ("f", 2, "Insurance Regulatory (Cover) (Amendment) Regulations, 2017", "Regulations", "2017-01-01"), ("lost", 3, "Some Amendment", "Acts", None),
    ], "slug string, pos int, title string, type string, dateIssued string")
    texts = spark.createDataFrame([("p", principal), ("f", first), ("s", second), ("lost", "bar shall be deleted")], "slug string, text string")
    results = []
    for n in (1, 5):
        lines, notes, stats = lineage.build(docs.repartition(n, "title"), texts.repartition(n, "slug"))
        r = lines.first()
        results.append((r, sorted(map(tuple, notes.collect())), sorted(map(tuple, stats.collect()))))
    assert results[0] == results[1]
    r, notes, stats = results[0]
    assert [a.doc for a in r.amendments] == ["f", "s"] and r.cutoffs == ["2017-01-01", "2018-01-01"] and r.textFrom == "p"
    for a in r.amendments:
        assert a.edges == a.applied + a.unresolved
    ghost = [p for p in r.provisions if p.ghost]
    assert [(p.path, len(p.events)) for p in ghost] == [("reg-5/sub-Q", 2)]
    assert dict(stats)["principal_unresolved"] == 1 and dict(stats)["lineages"] == 1 and any("unparsed operative line" in n[2] for n in notes)


def test_audit(spark):
    line = "In regulation 2, clause (a) shall be omitted, and some more words to make the text long enough to be looked at by the audit. " + "x" * 120
    chunks = spark.createDataFrame([("d", "en", 0, line), ("d", "hi", 0, line), ("d", "tiny", 0, "short"), ("e", None, 0, None)], "doc_id string, attachment string, chunk_index int, content string")
    docs = spark.createDataFrame([("d", 0, "The Amendments", "Acts"), ("e", 1, "amendment two", "Acts"), ("f", 2, "Consolidated incorporating amendment", "Acts")], "slug string, pos int, title string, type string")
    records = audit.audit(docs, chunks)
    got = {r.slug: (r.operative_lines, r.edges, r.confidence) for r in records.collect()}
    assert got == {"d": (1, 1, {"medium": 1}), "e": (None, None, None)}
    assert tuple(audit.summary(records).first())[:3] == (2, 1, 1)


def test_detail_and_empty(spark):
    said = [(r.action, r.words) for r in grammar.edges(spark.createDataFrame([("a", "the words “x” shall be omitted")], "doc_id string, text string")).select("action", lineage.event_words().alias("words")).collect()]
    assert said == [("omit", "“x” omitted")]
    none = spark.createDataFrame([], "doc_id string, text string")
    assert grammar.parse_amendments(none).count() == 0 and segmentation.segment(none).count() == 0
    assert grammar.parse_amendments(spark.createDataFrame([("a", None)], none.schema)).select(F.size("edges")).first()[0] == 0


def test_texts_of_a_slug_count_as_one(spark):
    """Several texts of a slug give what their concatenation gives: scope, paths and edges run on from text to text."""
    principal = ["CHAPTER I\n1. First regulation text\n(a) clause a", "(b) clause b of regulation 1", "2. Second regulation text\n(a) clause a"]
    act = ["to amend the Insurance Regulatory (Cover) Regulations, 2016\nIn regulation 1:\nclause (a) shall be omitted", " \n", "clause (b) shall be omitted\nfoo shall be deleted", "4. For clause (a) of regulation 2, the following shall be substituted"]
    docs = spark.createDataFrame([
        ("p", 0, "Insurance Regulatory (Cover) Regulations, 2016", "Regulations", "2016-01-01"), ("am", 1, "Insurance Regulatory (Cover) (Amendment) Regulations, 2017", "Regulations", "2017-01-01"),
    ], "slug string, pos int, title string, type string, dateIssued string")
    apart = spark.createDataFrame([(s, n, t) for s, ts in (("p", principal), ("am", act)) for n, t in enumerate(ts)], "slug string, part bigint, text string")
    whole = spark.createDataFrame([("p", "\n".join(principal)), ("am", "\n".join(act))], "slug string, text string")
    want = [sorted(map(str, df.collect())) for df in lineage.build(docs, whole)]
    for n in (1, 4):
        lines, notes, stats = lineage.build(docs, apart.orderBy(F.col("part").desc()).repartition(n))
        assert [sorted(map(str, df.collect())) for df in (lines, notes, stats)] == want
        (r,) = lines.collect()
    assert r.textFrom == "p" and [(a.edges, a.unparsed) for a in r.amendments] == [(3, 1)]
    assert {p.path: p.events[0].action for p in r.provisions if p.events} == {"cha-I/reg-1/sub-a": "omit", "cha-I/reg-1/sub-b": "omit", "cha-I/reg-2/sub-a": "substitute"}


@pytest.mark.parametrize("of", [0, 1, 2], ids=["lineages", "notes", "stats"])
def test_texts_pass_no_shuffle(spark, monkeypatch, of):
    """Of many texts only those of amendments and their principals are picked, without a shuffle of all; too many slugs are joined by sorting."""
    docs = spark.createDataFrame([
        ("p", 0, "Insurance Regulatory (Cover) Regulations, 2016", "Regulations", "2016-01-01"), ("am", 1, "Insurance Regulatory (Cover) (Amendment) Regulations, 2017", "Regulations", "2017-01-01"),
    ], "slug string, pos int, title string, type string, dateIssued string")
    own = [("p", "1. First regulation text"), ("am", "to amend the Insurance Regulatory (Cover) Regulations, 2016\nRegulation 1 shall be omitted")]
    texts = spark.createDataFrame([*own, *(("other", f"{n}. Some other regulation text") for n in range(2000))], "slug string, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = _shuffled_rows(spark)
        rows = lineage.build(docs, texts)[of].collect()
        made = _shuffled_rows(spark) - before
        assert made < 1000, made
        assert of != 1 or [n.note[:35] for n in rows] == ["low confidence, not applied: Regula"]
        monkeypatch.setattr(lineage, "SLUGS_BROADCAST", 0)
        assert sorted(map(str, lineage.build(docs, texts)[of].collect())) == sorted(map(str, rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lineage_queries_read_every_text(spark, tmp_path):
    from clauseforge.plans import queries

    spark.createDataFrame([(1, "a", "first"), (2, "a", "second"), (3, "b", " "), (4, None, "x"), (5, "b", None)], "doc_id bigint, slug string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries._text_of_docs(spark, str(tmp_path)).orderBy("part")
    assert [tuple(r) for r in got.select("slug", "part", "text").collect()] == [("a", 1, "first"), ("a", 2, "second"), ("b", 3, " ")]
