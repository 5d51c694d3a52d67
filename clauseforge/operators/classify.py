"""From a raw listing row to a typed document record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

VERSION_BUCKETS = ["Consolidated & Gazette Notified Regulations", "Updated Regulations"]

# Title patterns with entity, subtype and subjects; the first that matches counts.
ENTITY_RULES = [
    (r"\bbroker", "Intermediaries", "Insurance Brokers", ["distribution"]),
    (r"\bcorporate agent", "Intermediaries", "Corporate Agents", ["distribution"]),
    (r"\bweb aggregator", "Intermediaries", "Web Aggregators", ["distribution"]),
    (r"\bsurveyor|loss assessor", "Intermediaries", "Surveyors & Loss Assessors", ["distribution"]),
    (r"\bthird party administrator|\btpa\b", "Intermediaries", "Third Party Administrators (TPAs)", ["health"]),
    (r"insurance marketing firm|\bimf\b", "Intermediaries", "Insurance Marketing Firms (IMFs)", ["distribution"]),
    (r"\brepositor", "Intermediaries", "Insurance Repositories", ["distribution"]),
    (r"\bmisp\b|motor insurance service provider", "Intermediaries", "MISPs", ["distribution"]),
    (r"\breinsur|lloyd", "Insurers", "Reinsurers", ["reinsurance"]),
    (r"standalone health|health insur", "Insurers", "Standalone Health Insurers", ["health"]),
    (r"life insur", "Insurers", "Life Insurers", ["governance"]),
    (r"general insur", "Insurers", "General Insurers", ["governance"]),
    (r"\binsurer", "Insurers", "—", ["governance"]),
    (r"corporate governance|advertis|grievance|policyholder", "Common", "Applicable across multiple regulated entities", ["governance"]),
]
# Beginnings of slugs by document type.
SLUG_PREFIXES = {
    "Acts": "act", "Rules": "rules", "Regulations": "reg", "Notifications": "not", "Master Circulars": "mc", "Circulars": "cir",
    "Guidelines": "gl", "Orders": "ord", "Notices": "ntc", "Exposure Drafts": "ed",
}


def document_type(category: Column, title: Column) -> Column:
    """The listing category, but for titles and version buckets that mean another type."""
    t = F.lower(title)
    return (
        F.when(t.contains("master circular"), F.lit("Master Circulars"))
        .when(t.contains("exposure draft"), F.lit("Exposure Drafts"))
        .when(category.isin(VERSION_BUCKETS), F.lit("Regulations"))
        .otherwise(category)
    )


def entity(title: Column, rules: list = ENTITY_RULES) -> Column:
    """``struct<entity, subtype, subjects>`` of the first rule that matches the title."""

    def value(e: str, s: str, subjects: list[str]) -> Column:
        return F.struct(F.lit(e).alias("entity"), F.lit(s).alias("subtype"), F.array(*[F.lit(x) for x in subjects]).cast("array<string>").alias("subjects"))

    t = F.lower(title)
    first = reduce(lambda c, r: F.when(t.rlike(f"(?U){r[0]}"), value(*r[1:])).otherwise(c), reversed(rules), value("Common", "—", []))
    return first


def is_amendment(doc_type: Column, title: Column) -> Column:
    """An amending instrument in force: *amendment* as a word, no draft, no consolidated text."""
    t = F.coalesce(title, F.lit(""))
    draft = F.coalesce(doc_type, F.lit("")).eqNullSafe("Exposure Drafts") | t.rlike(r"(?iU)exposure\s+draft|consultation\s+paper|draft\b")
    return ~draft & t.rlike(r"(?iU)\bamendment\b") & ~t.rlike("(?iu)as amended|incorporating|updated with")


def is_audited(title: Column) -> Column:
    """The audit's wider choice: *amendment* anywhere in the title, no consolidated text."""
    t = F.coalesce(title, F.lit(""))
    return t.rlike("(?iu)amendment") & ~t.rlike("(?iu)as amended|incorporating")


def to_records(rows: DataFrame, now: Column, as_of_year: int) -> DataFrame:
    """Listing rows as document records (without slug); ``now`` is the ISO time of the scan as text.

    The year is that of the reference number, else of the date, else ``as_of_year``.  Null arrays count
    as empty.
    """
    ref, title, category = F.coalesce("reference_no", F.lit("")), F.coalesce("title", F.lit("")), F.col("category")
    links = F.coalesce("pdf_links", F.array().cast("array<string>"))
    year = F.coalesce(X.ref_year(ref), F.substring("date_issued", 1, 4).try_cast("int"), F.lit(as_of_year))
    who = entity(title)
    version = F.struct(F.substring(title, 1, 80).alias("label"), category.alias("bucket"), F.coalesce("date_issued", F.concat(year.cast("string"), F.lit("-01-01"))).alias("date"))
    none = F.array().cast("array<string>")
    return rows.select(
        document_type(category, title).alias("type"),
        title.alias("title"),
        who["entity"].alias("entity"),
        who["subtype"].alias("subtype"),
        F.lit("Existing").alias("status"),
        year.alias("year"),
        X.ref_department(ref).alias("dept"),
        X.nonblank(ref).alias("refNo"),
        F.col("date_issued").alias("dateIssued"),
        F.coalesce("archived", F.lit(False)).alias("archived"),
        category.alias("sourceCategory"),
        none.alias("aliases"),
        who["subjects"].alias("subjects"),
        F.greatest(F.size(links), F.lit(1)).alias("attachments"),
        none.alias("maintenance"),
        F.concat(title, F.lit(".")).alias("lede"),
        F.concat(F.lit("Filed by the listing scan on "), F.substring(now, 1, 10), F.lit(".")).alias("history"),
        F.create_map().cast("map<string,array<string>>").alias("relations"),
        F.when(category.isin(VERSION_BUCKETS), F.array(version)).alias("versions"),
        F.struct(
            F.col("liferay_id"),
            F.col("detail_page"),
            links.alias("pdf_links"),
            F.coalesce("pdf_filenames", none).alias("pdf_filenames"),
            F.coalesce("file_sizes", none).alias("file_sizes"),
            F.col("source_page"),
            now.alias("first_seen"),
            now.alias("last_seen"),
            none.alias("pending_relations"),
        ).alias("_source"),
        *[c for c in ("pos",) if c in rows.columns],
    )


def base_slug(doc_type: Column, title: Column, year: Column) -> Column:
    prefixes = F.create_map(*[F.lit(x) for kv in SLUG_PREFIXES.items() for x in kv])
    return F.concat_ws("-", F.coalesce(F.element_at(prefixes, doc_type), F.lit("doc")), X.slugify(title), year.cast("string"))


def migrate(docs: DataFrame) -> DataFrame:
    """Records of the old review queue in today's form; applying it again changes nothing."""
    history = F.regexp_replace(F.regexp_replace("history", r" Classification pending\.", ""), "Auto-created by", "Auto-classified by")
    old = F.col("_source").isNotNull()
    return docs.withColumns(
        {
            "status": F.when(old & (F.col("status") == "Unclassified"), F.lit("Existing")).otherwise(F.col("status")),
            "maintenance": F.when(old, F.filter(F.coalesce("maintenance", F.array().cast("array<string>")), lambda m: ~m.isin("stub", "verify"))).otherwise(F.col("maintenance")),
            "lede": F.when(old & F.col("lede").contains("pending human review"), F.concat("title", F.lit("."))).otherwise(F.col("lede")),
            "history": F.when(old & F.col("history").contains("Classification pending"), history).otherwise(F.col("history")),
        }
    )
