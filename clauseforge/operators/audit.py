"""Coverage of the grammar over amending instruments, from stored chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import checkpoint
from . import chunking, classify, grammar, resolution

#: What makes two edges the same.
EDGE_IDENTITY = ["action", "level", "unit", "target_ref", "anchor", "position", "old", "new", "news", "scope", "path"]
LEAST_TEXT = 200


def once_per_edge(edges: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """The first edge of each identity within a document (the two attachments of a gazette repeat each other)."""
    keys = [*within, *EDGE_IDENTITY]
    rest = [c for c in edges.columns if c not in keys]
    return edges.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def audited(docs: DataFrame, slugs: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Documents that the audit looks at, newest year first (unknown years before all), then by slug; of ``slugs`` only, the
    first ``limit`` only.  The order is that of the rows asked for with ``limit``; without it nothing is sorted."""
    chosen = docs.filter(classify.is_audited(F.col("title")))
    if slugs is not None:
        chosen = chosen.filter(F.col("slug").isin(slugs))
    return chosen if limit is None else chosen.orderBy(F.desc_nulls_first("year"), F.asc_nulls_last("slug")).limit(limit)


def audit(docs: DataFrame, chunks: DataFrame, slugs: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """One record per audited document: ``slug, title, operative_lines, edges, unparsed, confidence, actions, principal, principal_slug, principal_score, edge_list``.

    ``docs``: unique ``slug``, ``pos, title, type`` (and ``year`` with ``limit``); ``chunks``: ``doc_id, attachment, chunk_index, content``.  Texts are put
    together per attachment and attachments under 200 characters are left out; documents without text
    have null counts.  A title that leads to the document itself is unresolved.
    """
    chosen = audited(docs, slugs, limit).select("slug", "title")
    own = chunks.join(chosen.select(F.col("slug").alias("doc_id")), "doc_id", "left_semi")
    whole = chunking.reassemble(own).select("doc_id", "attachment", X.drop_devanagari_lines(F.col("text")).alias("text"))
    texts = checkpoint(whole.filter(F.length("text") >= LEAST_TEXT))  # read three times below
    keyed = texts.select(F.struct("doc_id", "attachment").alias("k"), "text")
    read = grammar.read(keyed, "k", "text").drop("part").withColumnRenamed("doc_id", "k")
    read = checkpoint(read.select("k.doc_id", "k.attachment", *[c for c in read.columns if c != "k"]))
    edges = once_per_edge(read.filter("rule IS NOT NULL").drop("unparsed"), ["doc_id"], ["attachment", "line_no", "edge_no"])
    lists = edges.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("attachment", "line_no", "edge_no", *[c for c in edges.columns if c not in ("doc_id", "attachment", "line_no", "edge_no")]))).alias("edge_list")
    )
    lines = texts.select("doc_id", F.explode(X.lines(F.col("text"))).alias("line")).filter(F.col("line").rlike(f"(?iU){grammar.OPERATIVE}") & ~F.col("line").contains("come into force"))
    titled = grammar.principals(keyed, "k", "text").select("doc_id.doc_id", F.struct(F.coalesce("doc_id.attachment", F.lit("")).alias("at"), "principal").alias("p"))
    # All tallies of a document in one two-step aggregation: what is counted, by value, then by document.
    marks = (
        edges.select("doc_id", F.lit("confidence").alias("kind"), F.col("confidence").alias("value"))
        .union(edges.select("doc_id", F.lit("action"), "action"))
        .union(read.filter("rule IS NULL").select("doc_id", F.lit("unparsed"), "unparsed"))
        .union(lines.select("doc_id", F.lit("line"), X.strip(F.col("line"))))
        .union(texts.select("doc_id", F.lit("text"), F.lit("")))
    )

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    def counted(kind: str) -> Column:
        found = F.array_sort(F.collect_list(of(kind, F.struct("value", "n"))))
        return F.when(F.size(found) > 0, F.map_from_entries(found))

    tally = marks.groupBy("doc_id", "kind", "value").agg(F.count("*").alias("n")).groupBy("doc_id").agg(
        F.count(of("line", F.lit(1))).alias("operative_lines"), F.coalesce(F.sum(of("confidence", F.col("n"))), F.lit(0)).cast("int").alias("edges"),
        F.array_sort(F.collect_list(of("unparsed", F.col("value")))).alias("unparsed"), counted("confidence").alias("confidence"), counted("action").alias("actions"),
    )
    principal = titled.filter("p.principal IS NOT NULL").groupBy("doc_id").agg(F.min("p").alias("p")).select("doc_id", "p.principal")
    named = resolution.resolve(principal.select("doc_id", F.col("principal").alias("title"), F.lit(None).cast("string").alias("self")), docs.select("slug", "pos", "title"), ["doc_id"])
    known = principal.join(named.select("doc_id", F.col("slug").alias("p"), "score"), "doc_id", "left")
    out = chosen.withColumnRenamed("slug", "doc_id").join(tally, "doc_id", "left").join(lists, "doc_id", "left").join(known, "doc_id", "left")
    return out.select(
        F.col("doc_id").alias("slug"), "title", "operative_lines", "edges", "unparsed", "confidence", "actions", "principal",
        F.when(F.col("p") != F.col("doc_id"), F.col("p")).alias("principal_slug"), F.bround(F.coalesce("score", F.lit(0.0)), 2).alias("principal_score"), "edge_list",
    )


def counters(records: DataFrame) -> DataFrame:
    """``counter, value, n``: edges of all records by confidence and by action."""
    each = records.select(F.explode(F.array(F.struct(F.lit("confidence").alias("counter"), F.col("confidence").alias("m")), F.struct(F.lit("action").alias("counter"), F.col("actions").alias("m")))).alias("c"))
    return each.select("c.counter", F.explode("c.m").alias("value", "n")).groupBy("counter", "value").agg(F.sum("n").alias("n"))


def summary(records: DataFrame) -> DataFrame:
    """Totals: audited documents, without text, edges, resolved and pending principals, unparsed lines."""
    pending = F.col("principal").isNotNull() & F.col("principal_slug").isNull()

    def total(c):  # noqa: ANN001, ANN202
        return F.coalesce(F.sum(c.cast("long")), F.lit(0))

    return records.agg(
        F.count("*").alias("docs"),
        total(F.col("edges").isNull()).alias("no_text"),
        total(F.col("edges")).alias("edges"),
        total(F.col("principal_slug").isNotNull()).alias("resolved"),
        total(pending).alias("pending"),
        total(F.size(F.coalesce("unparsed", F.array().cast("array<string>")))).alias("unparsed"),
    )
