"""Attachments: bytes to text, with the extractor passed in (no PDF library is needed to import this)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chunking

# Size limit, how few characters a page of a scan has, and from how many pages on layout analysis is lean.
MOST_BYTES, SCAN_CHARS, LEAN_PAGES = 40 * 1024 * 1024, 16, 120

#: (bytes, lean) -> (text, method, pages)
Extractor = Callable[[bytes, bool], tuple[str, str, int]]
PARTS = "array<struct<label:string,text:string>>"


def read_binaries(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files as ``path, length, content`` up to the size limit (pushed down to the file listing)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).filter(F.col("length") <= MOST_BYTES).select("path", "length", "content")


def looks_like_pdf(content: Column) -> Column:
    """Whether the first 1024 bytes begin with the PDF mark, after white space."""
    return F.decode(F.substring(content, 1, 1024), "ISO-8859-1").rlike(r"^[\s\x{0b}]*%PDF")


def sniff(content: Column) -> Column:
    """What bytes that are no PDF seem to be: ``html``, ``zip`` or ``unknown``."""
    head = F.lower(F.decode(F.substring(content, 1, 300), "ISO-8859-1"))
    return F.when(head.rlike(r"^[\s\x{0b}]*<(?:!doctype|html|\?xml)"), F.lit("html")).when(F.hex(F.substring(content, 1, 2)) == "504B", F.lit("zip")).otherwise(F.lit("unknown"))


def is_scan(chars: Column, pages: Column) -> Column:
    """Too few characters for a text layer."""
    return chars < SCAN_CHARS * F.greatest(pages, F.lit(1))


def with_fallbacks(plain: Extractor, layout: Extractor | None = None, ocr: Extractor | None = None) -> Extractor:
    """Layout extraction if it works and finds text, else plain text, else recognition if that finds more in a scan."""

    def extract(data: bytes, lean: bool) -> tuple[str, str, int]:
        if layout is not None:
            try:
                found = layout(data, lean)
                if found[0] and found[0].strip():
                    return found
            except Exception:  # the next tier may still read it
                pass
        text, method, pages = plain(data, lean)
        if ocr is not None and len(text.strip()) < SCAN_CHARS * max(pages, 1):
            seen = ocr(data, lean)
            if len(seen[0].strip()) > len(text.strip()):
                return seen[0], seen[1], pages
        return text, method, pages

    return extract


def extract(files: DataFrame, extractor: Extractor, count_pages: Callable[[bytes], int] | None = None) -> DataFrame:
    """``slug, number, label, url, text, method, pages, error`` of attachments ``slug, number, label, url, content``.

    A file that is missing, too large, no PDF or fails in the extractor has its reason in ``error`` and no
    text; the others of the document are not affected.  With ``count_pages`` the extractor is asked for lean analysis
    (no tables, few graphics) of files with more than ``LEAN_PAGES`` pages.
    """
    reason = (
        F.when(F.col("content").isNull(), F.lit("missing"))
        .when(F.length("content") > MOST_BYTES, F.lit("too large"))
        .when(~looks_like_pdf(F.col("content")), F.concat(F.lit("no PDF: "), sniff(F.col("content"))))
    )
    rows = files.select("slug", F.col("number").cast("int").alias("number"), F.coalesce(F.nullif("label", F.lit("")), F.concat(F.lit("attachment-"), (F.col("number") + 1).cast("string"))).alias("label"), "url", F.when(reason.isNull(), F.col("content")).alias("content"), reason.alias("error"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            text, method, pages, errors = [], [], [], []
            for data, error in zip(batch.column("content"), batch.column("error").to_pylist()):
                found: tuple = (None, None, None)
                if error is None:
                    try:
                        body = data.as_py()
                        found = extractor(body, count_pages is not None and count_pages(body) > LEAN_PAGES)
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"[:500]
                text.append(found[0])
                method.append(found[1])
                pages.append(found[2])
                errors.append(error)
            columns = [*(batch.column(c) for c in ("slug", "number", "label", "url")), pa.array(text, pa.string()), pa.array(method, pa.string()), pa.array(pages, pa.int32()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["slug", "number", "label", "url", "text", "method", "pages", "error"])

    return rows.mapInArrow(run, "slug string, number int, label string, url string, text string, method string, pages int, error string")


def assemble(parts: DataFrame) -> DataFrame:
    """One row per document with text: ``slug, full_text, content_sha1, extraction_method, page_count, parts, pdfs``."""
    ok = parts.filter("error IS NULL")
    grouped = ok.groupBy("slug").agg(
        F.array_sort(F.collect_list(F.struct("number", "label", "text", "url"))).alias("x"),
        F.array_join(F.array_sort(F.collect_set("method")), "+").alias("extraction_method"),
        F.sum("pages").cast("int").alias("page_count"),
    )
    listed = grouped.withColumn("parts", F.transform("x", lambda p: F.struct(p["label"].alias("label"), p["text"].alias("text"))))
    full = chunking.join_attachments(F.col("parts"))
    pdfs = F.transform("x", lambda p: F.struct(p["label"].alias("name"), F.lit(None).cast("string").alias("url"), p["url"].alias("source")))
    return listed.select("slug", full.alias("full_text"), F.sha1(full).alias("content_sha1"), "extraction_method", "page_count", "parts", pdfs.alias("pdfs"))


def changed(extractions: DataFrame, stored: DataFrame) -> DataFrame:
    """Extractions whose text hash is new or differs from the stored one."""
    known = stored.select("slug", F.col("content_sha1").alias("__known"))
    return extractions.join(known, "slug", "left").filter(~F.col("content_sha1").eqNullSafe(F.col("__known"))).drop("__known")


def chunk_extractions(extractions: DataFrame) -> DataFrame:
    """The loader's chunks of extracted documents."""
    rows = extractions.select("slug", F.posexplode("parts").alias("attachment_no", "p")).select("slug", "attachment_no", F.col("p.label").alias("label"), F.col("p.text").alias("text"))
    return chunking.number_chunks(chunking.chunk_texts(rows, "slug", "text", "label"))


def storage_path(slug: Column, number: Column, name: Column) -> Column:
    """Where a mirrored attachment lies: slug, two-digit number and safe name."""
    return F.concat(slug, F.lit("/"), F.lpad(number.cast("string"), 2, "0"), F.lit("-"), X.safe_filename(name, number))
