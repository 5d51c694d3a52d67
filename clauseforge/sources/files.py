"""Files the pipeline reads and writes: corpus JSON, text payloads, script payloads, CSV log, JSON lines, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X

# Columns of the append-only log.
LOG_COLUMNS = [
    "id", "slug", "category", "type", "title", "reference_no", "dept", "year", "date_issued", "archived", "attachments",
    "detail_page", "pdf_links", "file_sizes", "source_page", "first_seen", "scraped_at",
]


def _exploded(df: DataFrame, body: Column) -> DataFrame:
    wrapped = F.from_json(body, f"docs map<string,{schemas.DOC}>")["docs"]
    bare = F.from_json(body, f"map<string,{schemas.DOC}>")
    rows = df.select(F.posexplode(F.map_entries(F.coalesce(wrapped, bare))).alias("pos", "e"))
    return rows.select(F.col("pos").cast("bigint").alias("pos"), F.col("e.key").alias("slug"), "e.value.*")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a corpus file, a map from slug to record, bare or under ``docs``; ``pos`` is their order."""
    return _exploded(spark.read.text(path, wholetext=True), F.col("value"))


def read_script(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a script payload ``window.NAME = {...};``."""
    body = F.regexp_extract("value", r"(?s)window\.\w+\s*=\s*(\{.*\})\s*;\s*$", 1)
    return _exploded(spark.read.text(path, wholetext=True).select(body.alias("value")), F.col("value"))


def write_corpus(docs: DataFrame, path: str) -> None:
    """The corpus as JSON lines, one record each, in parts (a single JSON object would need one task)."""
    docs.repartitionByRange("pos").sortWithinPartitions("pos").write.mode("overwrite").json(path)


def write_corpus_file(docs: DataFrame, path: str, generated_at: str) -> None:
    """The corpus in the wrapped form ``{"generated_at", "count", "docs"}``, one object over text lines; a single object needs a
    single file, so this is for corpora that one task can write (:func:`write_corpus` writes parts)."""
    n = docs.count()
    fields = F.to_json(F.struct(*[c for c in docs.columns if c not in ("slug", "pos")]))
    key = F.regexp_extract(F.to_json(F.struct("slug")), r'^\{"slug":(.*)\}$', 1)
    first = docs.agg(F.min("pos").alias("__first"))
    rows = docs.join(F.broadcast(first)).select("pos", F.concat(F.when(F.col("pos") == F.col("__first"), F.lit("")).otherwise(F.lit(",")), key, F.lit(":"), fields).alias("value"))  # one row
    spark = docs.sparkSession
    ends = spark.createDataFrame([(-(2**62), f'{{"generated_at":"{generated_at}","count":{n},"docs":{{'), (2**62, "}}")], "pos long, value string")
    rows.union(ends).coalesce(1).sortWithinPartitions("pos").select("value").write.mode("overwrite").text(path)


def database_rows(docs: DataFrame) -> DataFrame:
    """Documents as rows of the database table, with its defaults for what is missing."""
    source, none = F.col("_source"), F.array().cast("array<string>")
    return docs.select(
        "slug", source["liferay_id"].alias("liferay_id"), "type", F.col("sourceCategory").alias("source_category"), "title", F.col("refNo").alias("ref_no"), "dept", "entity", "subtype",
        F.coalesce("status", F.lit("Unclassified")).alias("status"), "year", X.safe_date(F.col("dateIssued")).alias("date_issued"), F.coalesce("archived", F.lit(False)).alias("archived"),
        F.coalesce("subjects", none).alias("subjects"), F.coalesce("maintenance", none).alias("maintenance"), F.coalesce("aliases", none).alias("aliases"),
        F.to_json(F.coalesce("relations", F.create_map().cast("map<string,array<string>>"))).alias("relations"), F.coalesce(source["pending_relations"], none).alias("pending_relations"),
        F.coalesce(F.nullif("attachments", F.lit(0)), F.lit(1)).alias("attachments"), source["detail_page"].alias("detail_page"), F.coalesce(source["pdf_links"], none).alias("pdf_links"),
        source["source_page"].alias("source_page"), source["first_seen"].alias("first_seen"), source["last_seen"].alias("last_seen"),
    )


def script_payload(docs: DataFrame, name: str, generated_at: str) -> str:
    """``window.NAME = {...};`` for a front end; made by the driver, so for corpora that a browser can load."""
    fields = F.to_json(F.struct(*[c for c in docs.columns if c not in ("slug", "pos")]))
    rows = docs.orderBy("pos").select(F.to_json(F.struct("slug")).alias("k"), fields.alias("v")).toLocalIterator()
    body = ",\n".join(r["k"][len('{"slug":') : -1] + ": " + r["v"] for r in rows)
    return f"/* Generated {generated_at}. */\nwindow.{name} = {{\n{body}\n}};\n"


def log_rows(new: DataFrame, scraped_at: str) -> DataFrame:
    """Log rows of new records; lists are written as JSON text."""
    source = {c: F.col(f"_source.{c}") for c in ("detail_page", "source_page", "first_seen")}
    made = {
        "id": F.col("_source.liferay_id"), "category": F.col("sourceCategory"), "reference_no": F.col("refNo"), "date_issued": F.col("dateIssued"),
        "pdf_links": F.to_json("_source.pdf_links"), "file_sizes": F.to_json("_source.file_sizes"), "scraped_at": F.lit(scraped_at), **source,
    }
    return new.select(*[made.get(c, F.col(c)).cast("string").alias(c) for c in LOG_COLUMNS])


def append_log(rows: DataFrame, path: str) -> None:
    rows.select(*LOG_COLUMNS).write.mode("append").option("header", True).option("escape", '"').csv(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{c} string" for c in LOG_COLUMNS)).option("header", True).option("escape", '"').csv(path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Text payloads, one JSON file per document."""
    return spark.read.schema(schemas.PAYLOAD).option("multiLine", True).json(path)


def payloads(docs: DataFrame, chunks: DataFrame, generated_at: str) -> DataFrame:
    """Documents with text and their ordered chunks in the form of text payloads.

    ``docs``: ``slug, title, extraction_method, page_count, full_text, pdf_storage``; ``chunks``: ``doc_id, chunk_index, heading,
    attachment, content, embedding``.
    """
    chunk = F.struct(F.col("chunk_index").alias("i"), "heading", "attachment", "content", F.col("embedding").isNotNull().alias("embedded"))
    lists = chunks.groupBy(F.col("doc_id").alias("slug")).agg(F.array_sort(F.collect_list(chunk)).alias("chunks"))
    none = F.array().cast("array<struct<i:int,heading:string,attachment:string,content:string,embedded:boolean>>")
    return docs.filter("full_text IS NOT NULL").join(lists, "slug", "left").select(
        "slug", "title", F.col("extraction_method").alias("method"), F.col("page_count").alias("pages"), "full_text",
        F.coalesce("chunks", none).alias("chunks"), F.col("pdf_storage").alias("pdfs"), F.lit(generated_at).alias("generated_at"),
    )


def write_payloads(rows: DataFrame, path: str) -> None:
    """One folder per slug."""
    rows.withColumn("__slug", F.col("slug")).write.mode("overwrite").partitionBy("__slug").json(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files: ``path, text``."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def write_audit(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").json(path)


def replace_chunks(new: DataFrame, path: str) -> None:
    """Replace the chunks of the documents in ``new`` and leave other documents' (dynamic overwrite by ``doc_id``); ids stay unique."""
    rows = new.dropDuplicates(["doc_id", "id"]).withColumn("__doc", F.col("doc_id"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__doc").parquet(path)


def lineage_payload(lineages: DataFrame) -> DataFrame:
    """Lineages as JSON text per slug, without null fields."""
    return lineages.select("slug", F.to_json(F.struct("provisions", "amendments", "cutoffs", "textFrom")).alias("json"))
