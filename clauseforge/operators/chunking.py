"""Heading-aware chunks of text in overlapping windows, and their way back to whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X

# Window, overlap, language gate, and what a heading line looks like.
CHUNK_CHARS, CHUNK_OVERLAP, HINDI_GATE = 1800, 200, 0.3
HEADING = (
    r"^(?:#{1,4}\s+([^\n]+)"
    r"|\*\*(\d{1,3}[A-Z]{0,3}\.\s[^*\n]{2,140}?)\.?\*\*"
    r"|\*\*((?:CHAPTER|PART|SCHEDULE)\s+[IVXLCM\d][^*\n]{0,100}?)\*\*)"
)
SNAP_START, SNAP_END = 250, 200

_OPEN, _CLOSE = "\x01", "\x02"


def sections(text: Column) -> Column:
    """``array<struct<heading, body>>``: the text cut at its headings; bodies are stripped, empty ones left out.

    A text without any body is one section without heading (empty if the text is blank).
    """
    marked = F.regexp_replace(text, rf"(?mUd){HEADING}", f"{_OPEN}$0{_CLOSE}")
    parts = F.split(marked, _OPEN)

    def section(part: Column) -> Column:
        head = F.when(part.contains(_CLOSE), F.substring_index(part, _CLOSE, 1))
        body = F.when(part.contains(_CLOSE), F.substr(part, F.instr(part, _CLOSE) + 1)).otherwise(part)
        named = F.coalesce(*[X.nonblank(F.regexp_extract(head, rf"(?Ud){HEADING}", g)) for g in (1, 2, 3)])
        return F.struct(F.substring(X.strip(named), 1, 180).alias("heading"), X.strip(body).alias("body"))

    cut = F.filter(F.transform(parts, section), lambda s: s["body"] != "")
    whole = F.array(F.struct(F.lit(None).cast("string").alias("heading"), X.strip(text).alias("body")))
    return F.when(F.size(cut) > 0, cut).otherwise(whole)


def window_count(n: Column, size: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP) -> Column:
    """How many windows a body of ``n`` characters has."""
    return F.when(n == 0, F.lit(0)).when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / F.lit(size - overlap)) + 1).cast("int")


def _after(body: Column, at: Column, reach: int, pattern: str) -> Column:
    """``at``, or the place behind the first match of ``pattern`` in the ``reach`` characters from ``at`` on."""
    ahead = F.substr(body, at + 1, F.lit(reach))
    found = F.regexp_substr(ahead, F.lit(pattern))
    return F.when(found.isNull(), at).otherwise(at + F.regexp_instr(ahead, F.lit(pattern)) - 1 + F.length(found))


def windows(body: Column, size: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP, snap: bool = True) -> Column:
    """The windows of a body as an array of stripped texts without empty ones; ends lie behind a sentence end where one is near."""
    n = F.length(body)

    def window(i: Column) -> Column:
        start = i * (size - overlap)
        end = F.least(start + size, n)
        if snap:
            start = F.when(start > 0, _after(body, start, SNAP_START, r"(?U)[.।]\s+")).otherwise(start)
            end = F.when(end < n, _after(body, end, SNAP_END, r"(?U)[.।]\s")).otherwise(end)
        return X.strip(F.substr(body, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int")))

    count = window_count(n, size, overlap)
    indexes = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(indexes, window), lambda w: w != "")


def chunk_texts(df: DataFrame, doc: str, text: str, attachment: str | None = None, size: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP, snap: bool = True) -> DataFrame:
    """``doc_id, attachment_no, part, heading, attachment, content`` in order (``part`` counts within an attachment).

    ``attachment`` names a column with the label; without it the label is null.  Null texts give no chunk.
    """
    label = F.col(attachment) if attachment else F.lit(None).cast("string")
    number = F.col("attachment_no") if "attachment_no" in df.columns else F.lit(0)
    cut = df.select(F.col(doc).alias("doc_id"), number.alias("attachment_no"), label.alias("attachment"), F.posexplode(sections(F.col(text))).alias("section", "s"))
    rows = cut.select("doc_id", "attachment_no", "attachment", "section", F.col("s.heading").alias("heading"), F.posexplode(windows(F.col("s.body"), size, overlap, snap)).alias("window", "content"))
    return rows.select("doc_id", "attachment_no", (F.col("section") * F.lit(1 << 32) + F.col("window")).alias("part"), "heading", "attachment", "content")


def number_chunks(chunks: DataFrame) -> DataFrame:
    """The loader's chunks: one running index per document across its attachments, label only if there are several, id and gate."""
    per_doc = W.partitionBy("doc_id")
    order = per_doc.orderBy("attachment_no", "part")
    several = F.min("attachment_no").over(per_doc) != F.max("attachment_no").over(per_doc)
    indexed = chunks.withColumn("chunk_index", F.row_number().over(order) - 1).withColumn("attachment", F.when(several, F.col("attachment")))
    return indexed.select(
        X.sha1_id(F.col("doc_id"), F.col("chunk_index").cast("string"), F.col("content")).alias("id"),
        "doc_id", "chunk_index", "heading", "attachment", "content",
        (X.devanagari_share(F.col("content")) < HINDI_GATE).alias("embeddable"),
    )


def join_attachments(parts: Column) -> Column:
    """Full text of ``array<struct<label, text>>``: one part is itself, several get a header line each."""
    return F.when(F.size(parts) == 1, parts[0]["text"]).otherwise(
        F.array_join(F.transform(parts, lambda p: F.concat(F.lit("# [Attachment: "), p["label"], F.lit("]\n\n"), p["text"])), "\n\n")
    )


# Overlaps looked for when chunks are joined again (longer than, at most).
OVERLAP_OVER, OVERLAP_MOST = 40, 260


def join_overlapping(pieces: Column) -> Column:
    """The pieces end to end, each without the longest beginning that is also the end of what stands before it.

    Only the last 260 characters can overlap, so the fold carries these and the cuts, not the growing text.
    """
    state = "struct<tail:string,cuts:array<int>>"

    def step(done: Column, piece: Column) -> Column:
        most = F.least(F.length(done["tail"]), F.length(piece))
        sizes = F.when(most > OVERLAP_OVER, F.sequence(most, F.lit(OVERLAP_OVER + 1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
        head, tail = F.left(piece, F.lit(OVERLAP_MOST)), done["tail"]
        cut = F.coalesce(F.get(F.filter(sizes, lambda n: F.right(tail, n) == F.left(head, n)), F.lit(0)), F.lit(0))
        rest = F.right(F.concat(tail, F.right(F.substr(piece, cut + 1), F.lit(OVERLAP_MOST))), F.lit(OVERLAP_MOST))
        return F.struct(rest.alias("tail"), F.concat(done["cuts"], F.array(cut)).alias("cuts")).cast(state)

    start = F.struct(F.lit("").alias("tail"), F.array().cast("array<int>").alias("cuts")).cast(state)
    cuts = F.aggregate(pieces, start, step)["cuts"]
    return F.array_join(F.zip_with(pieces, cuts, lambda p, c: F.substr(p, c + 1)), "")


def reassemble(chunks: DataFrame) -> DataFrame:
    """``doc_id, attachment, text``: whole texts from chunks, one per attachment; null contents count as empty."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", F.coalesce("content", F.lit("")).alias("c")))), lambda x: x["c"])
    return chunks.groupBy("doc_id", "attachment").agg(ordered.alias("pieces")).select("doc_id", "attachment", join_overlapping(F.col("pieces")).alias("text"))
