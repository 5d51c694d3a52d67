"""Driver-facing queries of the core, and SQL for each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X
from ..operators import audit, chunking, classify, corpus, embedding, grammar, lineage, orphans, relations, resolution, segmentation
from ..session import checkpoint, checkpoint_dir, table
from ..sources import files
from ..streaming import listing as stream

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = 2026
NOW = "2026-07-01T00:00:00+00:00"


def current_docs(s: SparkSession, d: str) -> DataFrame:
    """One record per slug, the one seen last, with ``pos`` as its order."""
    docs = table(s, d, "docs")
    rank = F.struct(orphans.iso_micros(F.col("_source.last_seen")).alias("t"), F.col("pos").alias("p"))
    return docs.groupBy("slug").agg(F.max_by(F.struct(*[c for c in docs.columns if c != "slug"]), rank).alias("r")).select("slug", "r.*")


def records(s: SparkSession, d: str) -> DataFrame:
    """Chunks without second deliveries."""
    return table(s, d, "chunks").groupBy("id").agg(F.max_by(F.struct("doc_id", "chunk_index", "heading", "attachment", "content"), "loaded_at").alias("r")).select("id", "r.*")


def sightings(s: SparkSession, d: str) -> DataFrame:
    """Listing rows in order of scanning, with ids for those that have none."""
    rows = corpus.with_surrogate_ids(table(s, d, "listing_rows"))
    return rows.withColumn("pos", F.row_number().over(W.partitionBy("liferay_id").orderBy("scanned_at", "title", "date_issued", "reference_no")).cast("bigint"))


def chunk_windows(s: SparkSession, d: str, snap: bool) -> DataFrame:
    docs = table(s, d, "documents").filter("text IS NOT NULL").select("doc_id", X.strip(F.col("text")).alias("body"))
    return docs.select("doc_id", F.posexplode(chunking.windows(F.col("body"), snap=snap)).alias("part", "content"))


def chunk_ids(s: SparkSession, d: str) -> DataFrame:
    numbered = chunk_windows(s, d, True)
    return numbered.select("doc_id", "part", X.sha1_id(F.col("doc_id").cast("string"), F.col("part").cast("string"), F.col("content")).alias("id"), (X.devanagari_share(F.col("content")) < chunking.HINDI_GATE).alias("embeddable"))


def full_chunks(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").filter("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("doc"), "text")
    return chunking.number_chunks(chunking.chunk_texts(docs, "doc", "text"))


def reassembled(s: SparkSession, d: str) -> DataFrame:
    out = chunking.reassemble(_one_per_index(records(s, d)))
    return out.select("doc_id", "attachment", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


def _one_per_index(rows: DataFrame) -> DataFrame:
    rank = F.struct("id")
    return rows.groupBy("doc_id", "attachment", "chunk_index").agg(F.min_by("content", rank).alias("content"))


def titles_of_amendments(s: SparkSession, d: str) -> DataFrame:
    docs = checkpoint(current_docs(s, d).select("slug", "pos", "title", "type"))  # read on both sides
    amending = docs.filter(classify.is_amendment(F.col("type"), F.col("title")))
    wanted = amending.select(F.col("slug").alias("doc_id"), resolution.stripped_title(F.col("title")).alias("title"), F.col("slug").alias("self"))
    rest = docs.filter(~classify.is_amendment(F.col("type"), F.col("title")))
    return resolution.resolve(wanted, rest, ["doc_id"]).select("doc_id", "slug", F.bround("score", 6).alias("score"))


def title_variants(s: SparkSession, d: str) -> DataFrame:
    docs = current_docs(s, d).select("slug", "pos", "title", "type")
    return resolution.text_variants(docs.select("slug", F.lit("").alias("amendment")), docs, docs.select("slug", F.lit("x").alias("text")))


def _text_of_docs(s: SparkSession, d: str) -> DataFrame:
    """The texts of each document, in order of ``part``."""
    return table(s, d, "documents").filter("slug IS NOT NULL AND text IS NOT NULL").select("slug", F.col("doc_id").alias("part"), "text")


def build(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return lineage.build(current_docs(s, d).select("slug", "pos", "type", "title", "dateIssued"), _text_of_docs(s, d))


def provisions(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "provisions").distinct()


def events(s: SparkSession, d: str) -> DataFrame:
    return provisions(s, d).select("doc", "id", "seq", F.posexplode("events").alias("n", "e")).select("doc", "id", "seq", "n", "e.action", F.col("e.doc").alias("source"), "e.date", "e.detail", "e.verified")


def event_dedup(s: SparkSession, d: str) -> DataFrame:
    kept = events(s, d).groupBy("id", "action", "source", "detail").agg(F.min_by(F.struct("n", "date", "verified"), "n").alias("r"))
    return kept.select("id", "action", "source", "detail", F.col("r.n").alias("n"), F.col("r.date").alias("date"), F.col("r.verified").alias("verified"))


def identities(s: SparkSession, d: str) -> DataFrame:
    rows = provisions(s, d).select(F.col("doc").alias("doc_id"), "seq", "id", "level", "ref", "heading", "path", "text")
    return segmentation.once_per_identity(rows).select("doc_id", "seq", "level", "ref", "path")


def _order_lines(s: SparkSession, d: str, line: Column) -> DataFrame:
    """A document per order with one instruction per line item."""
    items = table(s, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", line.alias("t")).alias("x"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n")
    return items.groupBy(F.col("l_orderkey").alias("doc_id")).agg(text.alias("text"))


def _edges(df: DataFrame, *columns: str) -> DataFrame:
    return grammar.edges(df).select("doc_id", F.col("line_no").alias("n"), *columns)


def grammar_unit_sub(s: SparkSession, d: str) -> DataFrame:
    line = F.format_string("For clause %d of regulation %d, the following shall be substituted", F.col("l_linenumber"), F.col("l_partkey"))
    return _edges(_order_lines(s, d, line), "action", "level", "unit", "target_ref", "path", "confidence")


def grammar_words(s: SparkSession, d: str) -> DataFrame:
    line = F.format_string("In regulation %d, for the words “part %d”, the words “supplier %d” shall be substituted", F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"))
    return _edges(_order_lines(s, d, line), "action", "level", F.array_join("old", "|").alias("old"), "new", "scope", "confidence")


def grammar_omit(s: SparkSession, d: str) -> DataFrame:
    line = F.format_string("Clauses (%s) and %d shall be omitted; after section %d, the following shall be inserted", F.lit("a"), F.col("l_linenumber"), F.col("l_partkey"))
    return _edges(_order_lines(s, d, line), "action", "unit", F.coalesce("target_ref", "anchor").alias("ref"), "confidence")


def grammar_scope(s: SparkSession, d: str) -> DataFrame:
    head = F.format_string("%d. In Part II of the Schedule %s of principal Regulations:\n", F.col("l_linenumber"), F.when(F.col("l_returnflag") == "R", "I").otherwise("V"))
    line = F.concat(head, F.format_string("clause %d shall be omitted", F.col("l_suppkey")))
    return _edges(_order_lines(s, d, line), "action", "target_ref", "scope", "confidence")


def grammar_pairs(s: SparkSession, d: str) -> DataFrame:
    line = F.format_string("the words “a%d” and “b%d” shall be substituted with “c%d” and “d%d” respectively", *[F.col("l_linenumber")] * 2, *[F.col("l_suppkey")] * 2)
    return _edges(_order_lines(s, d, line), "action", F.array_join("old", "|").alias("old"), "new", "paired", "confidence")


#: A line for each rule that the other grammar queries do not reach; %d is the part's key.
RULE_LINES = [
    "The clause %d shall be renumbered", "Throughout the Schedule I, for the words “a%d”, “b” and “c”, the words “d” shall be substituted", "In clause %d, the word “x” shall be substituted with “y”",
    "In Part II, heading shall be substituted as Some plain heading %d", "In rule %d, after the words “x”, the words “y” shall be inserted", "In section %d, the words “x” and “y” shall be omitted",
    "Form %d shall be substituted, namely", "In regulation %d, for the Explanation, the following shall be substituted", "the following note shall be substituted for note %d", "After clause (a), new clause %d and clause (c) shall be inserted",
    "the following proviso shall be inserted after clause %d as clause (c)", "Before clause %d, the following shall be inserted", "In row %d, the following shall be substituted", "“X%d” the words “Y” shall be substituted",
]


def grammar_rules(s: SparkSession, d: str) -> DataFrame:
    lines = F.posexplode(F.array(*[F.format_string(t, F.col("p_partkey")) for t in RULE_LINES])).alias("n", "text")
    docs = table(s, d, "part").select("p_partkey", lines).select(F.concat_ws("-", F.col("p_partkey").cast("string"), F.col("n").cast("string")).alias("doc_id"), "text")
    fields = ["rule", "action", "level", "unit", "target_ref", "anchor", "position", "new_ref", "new", "scope", "confidence", "is_global"]
    return grammar.edges(docs).select("doc_id", *fields, F.array_join("old", "|").alias("old"))


def edge_tallies(s: SparkSession, d: str) -> DataFrame:
    """Edges of each line twice over, once per identity, counted by rule."""
    line = F.format_string("Clauses (%s) and %d shall be omitted; after section %d, the following shall be inserted", F.lit("a"), F.col("l_linenumber"), F.col("l_partkey"))
    found = grammar.edges(_order_lines(s, d, line))
    twice = found.withColumn("attachment", F.explode(F.array(F.lit("en"), F.lit("hi"))))
    return audit.once_per_edge(twice, ["doc_id"], ["attachment", "line_no", "edge_no"]).groupBy("rule", "action", "level", "confidence").agg(F.count("*").alias("edges"))


def variants_made(s: SparkSession, d: str) -> DataFrame:
    """Principals without text, named by the parts, and longer titles that have one."""
    key = F.col("p_partkey")
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("shift"), F.lit(t).alias("tail")) for k, n, t in (("p", 0, ""), ("q", 10_000_000, " with schedules"), ("r", 20_000_000, " with all schedules"))])).alias("x")
    docs = table(s, d, "part").select(key, kinds).select(F.concat_ws("-", "x.k", key.cast("string")).alias("slug"), (key + F.col("x.shift")).alias("pos"), F.concat(F.lit("Cover rules "), key.cast("string"), F.col("x.tail")).alias("title"), F.lit("Rules").alias("type"))
    return resolution.text_variants(docs.filter("slug LIKE 'p-%'").select("slug", F.lit("").alias("amendment")), docs, docs.filter("slug NOT LIKE 'p-%'").select("slug", F.lit("x").alias("text")))


def cutoff_dates(s: SparkSession, d: str) -> DataFrame:
    listed = provisions(s, d).groupBy("doc").agg(F.collect_list(F.struct("introducedOn", "events")).alias("p"))
    return listed.select("doc", F.array_join(lineage.cutoffs(F.col("p")), ",").alias("cutoffs")).filter("cutoffs <> ''")


def segments(s: SparkSession, d: str) -> DataFrame:
    line = F.format_string("%d. Heading of part %d\n(%d) first clause\n(a) its subclause\nand more", F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"))
    docs = _order_lines(s, d, line).withColumn("text", F.concat(F.lit("Chapter II – General\n"), "text")).withColumn("doc_id", F.col("doc_id").cast("string"))
    return segmentation.segment(docs).select("doc_id", "seq", "id", "level", "ref", "heading", "text")


def lineage_events(s: SparkSession, d: str) -> DataFrame:
    """Each order a principal of outlined text, amended by one instrument with an instruction per line item; the events as anchored."""
    outline = F.format_string("%d. Heading of part %d\n(%d) first clause", F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"))
    texts = _order_lines(s, d, outline).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = segmentation.once_per_identity(segmentation.segment(texts)).withColumnRenamed("doc_id", "slug")
    line = F.format_string("For clause %d of regulation %d, the following shall be substituted", F.col("l_suppkey"), F.col("l_linenumber"))
    instruments = table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("slug"), F.col("o_orderkey").cast("string").alias("doc"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit(0).alias("pos"))
    read = checkpoint(grammar.read(_order_lines(s, d, line).withColumn("doc_id", F.col("doc_id").cast("string"))))
    folded = lineage.fold(instruments, read, found.select("slug", "seq", "id", "level", "ref", "heading", "path"))
    return lineage.flatten_provisions(folded).select("id", F.explode("events").alias("e")).select("id", "e.action", F.concat(F.lit("am-"), "e.doc").alias("doc"), "e.date", "e.detail", "e.verified")


def _parsed_documents(s: SparkSession, d: str) -> DataFrame:
    return grammar.edges(table(s, d, "documents").filter("text IS NOT NULL"), "doc_id", "text")


def upserted(s: SparkSession, d: str) -> DataFrame:
    """The listing's sightings put into the corpus of current documents: new and renewed records by type."""
    snapshot, _ = corpus.upsert(current_docs(s, d), sightings(s, d), NOW, AS_OF)
    return snapshot.groupBy("type").agg(F.count("*").alias("docs"), F.sum((F.col("_source.last_seen") == NOW).cast("long")).alias("seen"), F.sum((F.col("_source.first_seen") == NOW).cast("long")).alias("made"))


def streamed(s: SparkSession, d: str) -> DataFrame:
    """The same through the stream, in one micro-batch, from an empty corpus: ids and their newest links."""
    import uuid

    base = f"{checkpoint_dir(s)}/stream-{uuid.uuid4().hex}"
    store = stream.SnapshotStore(s, f"{base}/store")
    path = f"{d}/listing_rows.parquet"
    query = stream.start(s, path if not _is_file(s, path) else _folder_with(s, path, base), store, f"{base}/offsets", NOW, AS_OF)
    query.awaitTermination()
    return store.current().select(F.col("_source.liferay_id").alias("liferay_id"), F.array_join("_source.pdf_links", " ").alias("links"))


def _is_file(s: SparkSession, path: str) -> bool:
    p = s.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(s.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def _folder_with(s: SparkSession, path: str, base: str) -> str:
    """A stream reads folders: a single file is written once more into one."""
    s.read.parquet(path).write.parquet(f"{base}/in")
    return f"{base}/in"


def orphans_by_changes(s: SparkSession, d: str) -> DataFrame:
    """Problem 5 by change deltas: from nothing to what was there by the middle of the time, then to all of it."""
    docs, provisions = table(s, d, "docs"), table(s, d, "provisions")
    seen, built = orphans.iso_micros(F.col("_source.last_seen")), orphans.micros(provisions, "built_at")
    middle = docs.agg(((F.min(seen) + F.max(seen)) / 2).alias("t")).join(F.broadcast(provisions.agg(((F.min(built) + F.max(built)) / 2).alias("u"))))  # one row
    early = docs.join(F.broadcast(middle.select("t"))).filter(seen <= F.col("t")).drop("t"), provisions.join(F.broadcast(middle.select("u"))).filter(built <= F.col("u")).drop("u")
    return orphans.orphans_after_changes([early, (docs, provisions)])


def made_documents(s: SparkSession, d: str) -> DataFrame:
    """Documents with titles that name each other, from the suppliers and customers."""

    def rows(name: str, key: str, kind: str, shift: int, title: Column, ref: Column) -> DataFrame:
        t = table(s, d, name)
        source = F.from_json(F.lit("{}"), schemas.SOURCE)
        held = F.when(F.lit(kind == "a"), F.create_map(F.lit("amends"), F.array(F.concat(F.lit("s-"), key)))).otherwise(F.create_map().cast("map<string,array<string>>"))
        return t.select(F.concat(F.lit(f"{kind}-"), key).alias("slug"), (F.col(key) + shift).cast("bigint").alias("pos"), title.alias("title"), ref.alias("refNo"), F.when(F.col(key) % 7 == 0, F.lit("Lapsed")).otherwise(F.lit("Existing")).alias("status"),
                        F.when(F.col(key) % 3 == 0, held).alias("relations"), source.alias("_source"))

    none = F.lit(None).cast("string")
    return (
        rows("supplier", "s_suppkey", "s", 0, F.concat(F.lit("Cover of "), "s_name", F.lit(" Regulations, 2016")), F.concat(F.lit("IRDAI/REF/"), "s_suppkey"))
        .unionByName(rows("customer", "c_custkey", "c", 10_000_000, F.concat(F.lit("Withdrawal of circular no. IRDAI/REF/"), "c_custkey", F.lit(" dated today")), none))
        .unionByName(rows("supplier", "s_suppkey", "a", 20_000_000, F.concat(F.lit("Cover of "), "s_name", F.lit(" (First Amendment) Regulations, 2018")), none))
        .unionByName(rows("supplier", "s_suppkey", "m", 30_000_000, F.concat(F.lit("Modification to the Cover of "), "s_name", F.lit(" Regulations dated 5 May")), none))
    )


def docs_after_relations(s: SparkSession, d: str, docs: DataFrame) -> DataFrame:
    docs = checkpoint(docs)
    out = relations.written_back(docs, *relations.mine(docs))
    flat = F.array_join(F.array_sort(F.transform(F.map_entries("relations"), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(F.array_sort(e["value"]), ",")))), ";")
    return out.select("slug", "status", flat.alias("relations"), F.array_join(F.array_sort("_source.pending_relations"), ";").alias("pending"))


QUERIES: dict[str, Query] = {
    "p5_changes": orphans_by_changes,
    "p5_found": lambda s, d: orphans.orphan_references(table(s, d, "docs"), table(s, d, "provisions")),
    "p5_report": lambda s, d: orphans.orphan_report(orphans.orphan_references(table(s, d, "docs"), table(s, d, "provisions"))),
    "q_chunk_windows": lambda s, d: chunk_windows(s, d, False),
    "q_chunk_snap": lambda s, d: chunk_windows(s, d, True),
    "q_chunk_ids": chunk_ids,
    "q_chunk_full": full_chunks,
    "q_reassemble": reassembled,
    "q_script_gate": lambda s, d: table(s, d, "documents").filter("text IS NOT NULL").select(
        "doc_id", F.bround(X.devanagari_share(F.col("text")), 6).alias("share"), F.bround(X.latin_ratio(F.col("text")), 6).alias("latin"), X.mostly_devanagari(F.col("text")).alias("mostly")
    ),
    "q_drop_hindi_lines": lambda s, d: table(s, d, "documents").filter("text IS NOT NULL").select("doc_id", F.md5(X.drop_devanagari_lines(F.col("text"))).alias("digest")),
    "q_normalized_text": lambda s, d: table(s, d, "documents").filter("text IS NOT NULL").select("doc_id", F.md5(X.normalize_extracted(F.col("text"))).alias("digest")),
    "q_best_title": lambda s, d: table(s, d, "listing_rows").filter("title IS NOT NULL").select("title", X.best_title(F.split("title", " / ")).alias("best")).distinct(),
    "q_slugs": lambda s, d: current_docs(s, d).select("slug", classify.base_slug(F.col("type"), F.col("title"), F.col("year")).alias("base")),
    "q_references": lambda s, d: table(s, d, "listing_rows").select("reference_no", X.compact_ref(F.col("reference_no")).alias("compact"), X.ref_department(F.col("reference_no")).alias("dept"), X.ref_year(F.col("reference_no")).cast("string").alias("year")).distinct(),
    "q_clause_refs": lambda s, d: provisions(s, d).select("ref", X.clause_ref(F.col("ref")).alias("norm")).distinct(),
    "q_dates": lambda s, d: table(s, d, "listing_rows").select("date_issued", X.parse_date(F.col("date_issued")).alias("parsed"), X.safe_date(F.col("date_issued")).cast("string").alias("safe")).distinct(),
    "q_surrogate_ids": lambda s, d: corpus.with_surrogate_ids(table(s, d, "listing_rows")).select("liferay_id", "category").distinct(),
    "q_classify": lambda s, d: table(s, d, "listing_rows").select(
        "title", "category", classify.document_type(F.col("category"), F.col("title")).alias("type"), classify.entity(F.col("title"))["entity"].alias("entity"),
        classify.entity(F.col("title"))["subtype"].alias("subtype"), classify.is_amendment(F.col("category"), F.col("title")).alias("amends"), classify.is_audited(F.col("title")).alias("audited"),
    ).distinct(),
    "q_latest_sighting": lambda s, d: corpus.latest_by(sightings(s, d).select("liferay_id", "pos", F.array_join("pdf_links", " ").alias("links")), ["liferay_id"], [F.col("pos")]),
    "q_first_last_seen": lambda s, d: sightings(s, d).groupBy("liferay_id").agg(F.min("scanned_at").cast("string").alias("first"), F.max("scanned_at").cast("string").alias("last"), F.count("*").alias("n")),
    "q_upsert": upserted,
    "q_stream_upsert": streamed,
    "q_migrate": lambda s, d: classify.migrate(current_docs(s, d)).groupBy("status").agg(F.count("*").alias("docs"), F.sum(F.size("maintenance").cast("long")).alias("marks")),
    "q_title_tokens": lambda s, d: current_docs(s, d).select("slug", F.array_join(X.title_tokens(F.col("title")), " ").alias("tokens")),
    "q_resolve_titles": titles_of_amendments,
    "q_title_variants": title_variants,
    "q_variants_made": variants_made,
    "q_pending_made": lambda s, d: corpus.pending(current_docs(s, d), provisions(s, d).select(F.col("doc").alias("slug"), F.sha1("text").alias("content_sha1"))).select("slug"),
    "q_relations": lambda s, d: relations.mine(current_docs(s, d))[0],
    "q_relations_open": lambda s, d: relations.mine(current_docs(s, d))[1],
    "q_relations_made": lambda s, d: relations.mine(made_documents(s, d))[0],
    "q_relations_made_open": lambda s, d: relations.mine(made_documents(s, d))[1],
    "q_docs_after_relations": lambda s, d: docs_after_relations(s, d, current_docs(s, d)),
    "q_made_after_relations": lambda s, d: docs_after_relations(s, d, made_documents(s, d)),
    "q_pending": lambda s, d: corpus.pending(current_docs(s, d), table(s, d, "documents").select("slug", F.when(F.length("text") > 0, F.sha1("text")).alias("content_sha1"))).select("slug"),
    "q_chunks_of_known": lambda s, d: records(s, d).join(current_docs(s, d).filter("status <> 'Deleted'").select(F.col("slug").alias("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(F.count("*").alias("chunks")),
    "q_top_provisions": lambda s, d: provisions(s, d).withColumn("rank", F.row_number().over(W.partitionBy("doc").orderBy("seq", "id"))).filter("rank <= 10").select("doc", "id", "rank"),
    "q_cutoffs": cutoff_dates,
    "q_event_counts": lambda s, d: events(s, d).groupBy("action", "verified").agg(F.count("*").alias("events"), F.countDistinct("id").alias("provisions")),
    "q_event_dedup": event_dedup,
    "q_identities": identities,
    "q_amendment_totals": lambda s, d: table(s, d, "amendments").distinct().groupBy("lineage").agg(F.count("*").alias("amendments"), F.sum("edges").alias("edges"), F.sum("applied").alias("applied"), F.sum("unresolved").alias("unresolved"), F.sum("unparsed").alias("unparsed"), F.max("date").alias("last")),
    "q_grammar_unit_sub": grammar_unit_sub,
    "q_grammar_words": grammar_words,
    "q_grammar_omit_insert": grammar_omit,
    "q_grammar_scope": grammar_scope,
    "q_grammar_pairs": grammar_pairs,
    "q_grammar_rules": grammar_rules,
    "q_edge_tallies": edge_tallies,
    "q_grammar_edges": _parsed_documents,
    "q_segments": segments,
    "q_edge_dedup": lambda s, d: audit.once_per_edge(_parsed_documents(s, d), ["doc_id"], ["line_no", "edge_no"]).groupBy("rule", "action", "level", "confidence").agg(F.count("*").alias("edges")),
    "q_lineage_events": lineage_events,
    "q_lineages": lambda s, d: lineage.flatten_provisions(build(s, d)[0]),
    "q_lineage_notes": lambda s, d: build(s, d)[1],
    "q_lineage_stats": lambda s, d: build(s, d)[2],
    "q_audit": lambda s, d: audit.audit(current_docs(s, d), records(s, d)).drop("edge_list"),
    "q_audit_counters": lambda s, d: audit.counters(audit.audit(current_docs(s, d), records(s, d))),
    "q_audit_latest": lambda s, d: audit.audited(current_docs(s, d), limit=20).select("slug", "title", "year"),
    "q_audit_summary": lambda s, d: audit.summary(audit.audit(current_docs(s, d), records(s, d))),
    "q_database_rows": lambda s, d: files.database_rows(current_docs(s, d)).select("slug", "status", "attachments", "archived", F.col("date_issued").cast("string").alias("date_issued"), F.size("subjects").alias("subjects"), F.size("pending_relations").alias("pending")),
    "q_log_rows": lambda s, d: files.log_rows(current_docs(s, d), NOW).select("id", "slug", "type", "title", "dept", "year", "date_issued", "attachments", "pdf_links"),
    "q_payloads": lambda s, d: files.payloads(
        current_docs(s, d).select("slug", "title", F.lit("text").alias("extraction_method"), F.lit(1).alias("page_count"), F.col("lede").alias("full_text"), F.array().cast("array<struct<name:string,url:string,source:string>>").alias("pdf_storage")),
        records(s, d).withColumn("embedding", F.lit(None).cast("array<float>")), NOW,
    ).select("slug", F.size("chunks").alias("chunks")),
    "q_embed": lambda s, d: embedding.embed(records(s, d).select("id", "content")).select("id", F.col("embedding").isNotNull().alias("embedded")),
    "q_cosine_topk": lambda s, d: embedding.top_k(table(s, d, "embeddings"), table(s, d, "embeddings").filter("vec_id % 50 = 0"), 10).select("query", "neighbour", "rank", F.bround("score", 5).alias("score")),
}

from .oracles import ORACLES  # noqa: E402, F401
