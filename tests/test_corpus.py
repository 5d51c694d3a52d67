import json

from pyspark.sql import functions as F

from clauseforge import schemas
from clauseforge.operators import classify, corpus, relations
from clauseforge.sources import files

NOW, LATER = "2026-01-01T00:00:00+00:00", "2026-02-01T00:00:00+00:00"


def listing(spark, rows):
    names = "liferay_id string, category string, title string, reference_no string, date_issued string, archived boolean, detail_page string, pdf_links array<string>, pdf_filenames array<string>, file_sizes array<string>, source_page string, pos bigint, extra int"
    return spark.createDataFrame([(i, c, t, r, None, None, "d", [f"l{p}"], None, None, "s", p, 1) for i, c, t, r, p in rows], names)


def empty(spark):
    return spark.createDataFrame([], schemas.DOCS)


def test_upsert_is_idempotent_and_renews(spark):
    rows = [("1", "Acts", "Broker Act", "X/HLT/2/2020", 0), ("1", "Acts", "Other title", "", 1), ("2", "Acts", "Broker Act", "X/HLT/2/2020", 2), (None, "Notices", "Note", None, 3)]
    first, new = corpus.upsert(empty(spark), listing(spark, rows), NOW, 2026)
    got = {r._source.liferay_id: r for r in first.collect()}
    assert len(got) == 3 and new.count() == 3
    assert got["1"].title == "Broker Act" and got["1"]._source.pdf_links == ["l1"] and got["1"].dept == "HLT" and got["1"].year == 2020
    assert sorted(r.slug for r in got.values()) == ["act-broker-act-2020", "act-broker-act-2020-2", "ntc-note-2026"]
    saved = spark.createDataFrame(first.collect(), schemas.DOCS)
    second, none = corpus.upsert(saved, listing(spark, rows), LATER, 2026)
    assert none.count() == 0 and {r.slug for r in second.collect()} == {r.slug for r in got.values()}
    assert {r._source.last_seen for r in second.collect()} == {LATER} and {r._source.first_seen for r in second.collect()} == {NOW}
    third, made = corpus.upsert(saved, listing(spark, [("9", "Acts", "Broker Act", "X/HLT/2/2020", 0)]), LATER, 2026)
    assert [r.slug for r in made.collect()] == ["act-broker-act-2020-3"] and third.count() == 4
    assert corpus.upsert(saved, listing(spark, []), LATER, 2026)[0].count() == 3


def test_classification(spark):
    df = spark.createDataFrame([("Circulars", "Master Circular on Brokers"), ("Updated Regulations", "Life insurance (Amendment) Regulations"), ("Exposure Drafts", "Amendment"), ("Acts", "as amended amendment"), ("Acts", None)], "c string, t string")
    got = df.select(classify.document_type(F.col("c"), F.col("t")).alias("a"), classify.entity(F.col("t"))["subtype"].alias("b"), classify.is_amendment(F.col("c"), F.col("t")).alias("d")).collect()
    assert [tuple(r) for r in got] == [("Master Circulars", "Insurance Brokers", False), ("Regulations", "Life Insurers", True), ("Exposure Drafts", "—", False), ("Acts", "—", False), ("Acts", "—", False)]


def test_migration_is_idempotent(spark):
    row = {"slug": "a", "title": "T", "status": "Unclassified", "maintenance": ["stub", "x"], "lede": "pending human review", "history": "Auto-created by z. Classification pending.", "_source": (None,) * 9}
    once = classify.migrate(spark.createDataFrame([row], schemas.DOCS))
    r = once.first()
    assert (r.status, r.maintenance, r.lede, r.history) == ("Existing", ["x"], "T.", "Auto-classified by z.")
    assert classify.migrate(once).first() == r


def test_relations(spark):
    rows = [
        ("w", 0, "Withdrawal of circular no. AB/1 dated today", None), ("t1", 1, "Target", "ab / 1"), ("t2", 2, "Target two", "AB/1."), ("u", 3, "Withdrawal of circular no ZZ/9", None),
        ("m", 4, "Cover Rules (First Amendment) 2020", None), ("p", 5, "Cover Rules", None), ("q", 6, "The Cover Rules of all", None), ("o", 7, "Xyz (2nd Amendment)", None),
        ("f", 8, "Modification to the Cover Rules dated 1", None), ("n", 9, None, None),
    ]
    docs = spark.createDataFrame(rows, "slug string, pos int, title string, refNo string")
    edges, pending = relations.mine(docs)
    got = {tuple(r) for r in edges.collect()}
    assert got == {("w", "withdraws", "t2"), ("m", "amends", "f"), ("f", "modifies", "m")}  # the longest title that holds the stripped one
    assert {tuple(r) for r in pending.collect()} == {("u", "withdraws:ZZ/9"), ("o", "amends:?")}
    maps = {r.slug: r.relations for r in relations.relation_maps(edges).collect()}
    assert maps["f"] == {"amendedBy": ["m"], "modifies": ["m"]} and maps["t2"] == {"withdrawnBy": ["w"]}


def test_merge_and_files(spark, tmp_path):
    a = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    b = spark.createDataFrame([(2, "c")], "k int, v string")
    assert {tuple(r) for r in corpus.merge_columns(a, b, "k", ["v"]).collect()} == {(1, "a", "x"), (2, "c", "y")}
    assert {tuple(r) for r in corpus.replace_rows(a, spark.createDataFrame([(2, "z", "z"), (3, "n", "n")], a.schema), "k").collect()} == {(1, "a", "x"), (2, "z", "z"), (3, "n", "n")}
    for body in ({"docs": {"s": {"title": "T", "relations": {"amends": ["x"]}}}}, {"s": {"title": "T", "relations": {"amends": ["x"]}}}):
        path = tmp_path / f"c{len(json.dumps(body))}.json"
        path.write_text(json.dumps(body))
        r = files.read_corpus(spark, str(path)).first()
        assert (r.pos, r.slug, r.title, r.relations) == (0, "s", "T", {"amends": ["x"]})
    first, _ = corpus.upsert(empty(spark), listing(spark, [("1", "Acts", 'A "quoted" act', "", 0), ("2", "Acts", "B", "", 1)]), NOW, 2026)
    script = tmp_path / "p.js"
    script.write_text(files.script_payload(first, "DOCS", NOW))
    assert {r.slug: r.title for r in files.read_script(spark, str(script)).collect()} == {"act-a-quoted-act-2026": 'A "quoted" act', "act-b-2026": "B"}
    for _ in range(2):
        files.append_log(files.log_rows(first, NOW), str(tmp_path / "log"))
    log = files.read_log(spark, str(tmp_path / "log"))
    assert log.count() == 4 and {tuple(json.loads(r.pdf_links)) for r in log.collect()} == {("l0",), ("l1",)}


def test_pages_and_walk(spark):
    from clauseforge.sources import pages

    def row(n, cells=4):
        return f'<tr><td><input class="checkSingle" value="{n}">Archived</td><td>{n:02d}-03-2024</td><td>AB/HLT/{n}</td><td>परिपत्र<br><a href="/document-detail?documentId={n}">Title number {n}</a><a href="/f{n}.pdf?download=true">f</a></td></tr>'

    def page(ids):
        return f"<nav><a href='/x?download=true'>nav</a></nav><table class='table'><tbody>{''.join(row(n) for n in ids)}<tr><td>spacer</td></tr></tbody></table>"

    df = spark.createDataFrame([("c", 1, "https://h.example/l", page([1, 2])), ("c", 2, "https://h.example/l", page([3])), ("c", 3, "https://h.example/l", page([1, 3])), ("c", 4, "https://h.example/l", page([9])), ("e", 1, "https://h.example/l", None)], "category string, cur int, url string, html string")
    rows = pages.walk(pages.parse_pages(df), per_page=2).orderBy("pos").collect()
    assert [r.liferay_id for r in rows] == ["1", "2", "3"]
    r = rows[0]
    assert (r.title, r.reference_no, r.date_issued, r.archived, r.detail_page, r.pdf_links) == ("Title number 1", "AB/HLT/1", "2024-03-01", True, "https://h.example/document-detail?documentId=1", ["https://h.example/f1.pdf?download=true"])
    detail = spark.createDataFrame([("c", "s", "7", "T", "https://h.example/d", page([5])), ("c", "s", "8", "T", "https://h.example/d", "<p>none</p>")], "category string, source_page string, document_id string, title string, detail_url string, html string")
    assert [(r.liferay_id, r.pdf_links) for r in pages.resolve_details(detail).collect()] == [("7", ["https://h.example/f5.pdf?download=true"])]
    assert [r.document_id for r in pages.stub_rows(df.filter("cur = 1 AND category = 'c'")).collect()] == ["1", "2"]


def fake_fetch(url):
    if "cur=2" in url:
        raise OSError("down")
    return "<html>" + url


def test_portal_source(spark):
    from clauseforge.sources import portal

    portal.register(spark)
    df = spark.read.format("listing_portal").options(base="https://h.example", pages="2", categories='{"A": "/a", "B": "/b"}', only='["A"]', fetcher="tests.test_corpus:fake_fetch").load()
    rows = sorted(df.collect(), key=lambda r: r.cur)
    assert [(r.category, r.cur, r.html is None) for r in rows] == [("A", 1, False), ("A", 2, True)] and rows[1].error == "OSError: down"


def test_attachments_and_embedding(spark, tmp_path):
    from clauseforge.operators import embedding
    from clauseforge.sources import attachments as at

    data = [("s", 0, "a.pdf", "u", bytearray(b"  %PDF-1 hello")), ("s", 1, None, "u", bytearray(b"%PDF boom")), ("s", 2, "c", "u", bytearray(b"<html>")), ("s", 3, "d", "u", None), ("t", 0, "e", "u", bytearray(b"PKzip"))]
    df = spark.createDataFrame(data, "slug string, number int, label string, url string, content binary")

    def reader(b, lean):
        if b"boom" in b:
            raise ValueError("broken")
        return b.decode(), "plain", 2

    parts = at.extract(df, at.with_fallbacks(reader))
    assert sorted((r.slug, r.number, r.error) for r in parts.collect() if r.error) == [("s", 1, "ValueError: broken"), ("s", 2, "no PDF: html"), ("s", 3, "missing"), ("t", 0, "no PDF: zip")]
    done = at.assemble(parts)
    r = done.first()
    assert done.count() == 1 and (r.full_text, r.extraction_method, r.page_count) == ("  %PDF-1 hello", "plain", 2)
    stored = spark.createDataFrame([("s", r.content_sha1)], "slug string, content_sha1 string")
    assert at.changed(done, stored).count() == 0 and at.changed(done, stored.limit(0)).count() == 1
    chunks = embedding.embed(at.chunk_extractions(done))
    assert len(chunks.first().embedding) == 384
    texts = spark.createDataFrame([("a", "some words"), ("b", "हिन्दी"), ("c", None), ("d", "")], "id string, content string")
    assert {r.id: r.embedding is None for r in embedding.embed(texts).collect()} == {"a": False, "b": True, "c": True, "d": False}
    (tmp_path / "x.pdf").write_bytes(b"%PDF")
    assert at.read_binaries(spark, str(tmp_path), "*.pdf").select(at.looks_like_pdf(F.col("content")).alias("p")).first().p


def test_top_k_in_blocks_equals_brute_force(spark):
    import numpy as np

    from clauseforge.operators import embedding

    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 8))
    v[7] = v[3]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(99, None)], "vec_id long, embedding array<float>")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = embedding.top_k(df, df.filter("vec_id % 10 = 0"), 4, block=2).collect()
    assert len(got) == 24
    for q in range(0, 60, 10):
        s = unit @ unit[q]
        want = [i for i in sorted(range(60), key=lambda i: (-round(s[i], 5), i)) if i != q][:4]
        assert [r.neighbour for r in sorted((r for r in got if r.query == q), key=lambda r: r["rank"])] == want
    assert embedding.top_k(df, df.limit(0), 3).count() == 0


def test_stream_upserts_and_runs_again(spark, tmp_path):
    from clauseforge.streaming import listing as stream

    rows = listing(spark, [("1", "Acts", "A", "", 0), ("2", "Acts", "B", "", 1), ("3", "Acts", "", "", 2)]).drop("pos", "extra").withColumn("scanned_at", F.lit("2026-01-01").cast("timestamp"))
    source = str(tmp_path / "in")
    rows.write.parquet(source)
    store = stream.SnapshotStore(spark, str(tmp_path / "store"))
    stream.start(spark, source, store, str(tmp_path / "off"), NOW, 2026).awaitTermination()
    assert store.current().count() == 2 and store.delta(store.versions()[-1]).count() == 2
    listing(spark, [("2", "Acts", "B", "", 5), ("4", "Acts", "C", "", 6)]).drop("pos", "extra").withColumn("scanned_at", F.lit("2026-01-02").cast("timestamp")).write.mode("append").parquet(source)
    stream.start(spark, source, store, str(tmp_path / "off"), LATER, 2026).awaitTermination()
    got = {r._source.liferay_id: (r._source.first_seen, r._source.last_seen, r._source.pdf_links) for r in store.current().collect()}
    assert got == {"1": (NOW, NOW, ["l0"]), "2": (NOW, LATER, ["l5"]), "4": (LATER, LATER, ["l6"])}
    assert [r._source.liferay_id for r in store.delta(store.versions()[-1]).collect()] == ["4"]
    stream.upsert_batch(store, spark.read.parquet(source).filter("scanned_at >= '2026-01-02'"), store.versions()[-1], LATER, 2026)  # the same batch again
    assert store.current().count() == 3


def test_sightings_per_day_are_exact(spark, tmp_path):
    from clauseforge.streaming import listing as stream

    rows = spark.range(6000).selectExpr(
        "if(id % 10 = 9, null, concat('id', id % 3000)) AS liferay_id", "if(id % 2 = 0, 'a', 'b') AS category", "timestamp'2026-01-01 05:00:00' + make_interval(0, 0, 0, CAST(id >= 5000 AS INT)) AS scanned_at"
    )
    day = F.date_format("window.start", "dd").alias("day")
    want = {tuple(r) for r in rows.groupBy(F.date_format("scanned_at", "dd"), "category").agg(F.count("*"), F.count_distinct("liferay_id")).collect()}
    assert {tuple(r) for r in stream.sightings_per_day(rows).select(day, "category", "sightings", "ids").collect()} == want
    rows.coalesce(1).write.parquet(f"{tmp_path}/in/1")
    rows.limit(1).selectExpr("liferay_id", "category", "timestamp'2026-02-01 05:00:00' AS scanned_at").write.parquet(f"{tmp_path}/in/2")  # moves the watermark on
    source = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    query = stream.sightings_per_day(source).writeStream.format("memory").queryName("per_day").outputMode("append").option("checkpointLocation", f"{tmp_path}/offsets").trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(100)
        assert {tuple(r) for r in spark.table("per_day").select(day, "category", "sightings", "ids").collect()} == want
    finally:
        query.stop()
