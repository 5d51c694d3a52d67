"""Problem 5: references to records that do not exist.

Every change of a snapshot turns into signed *deltas*: a reference that is new counts +1 and one that is gone
-1, and so does a record's existence since the moment it was first seen.  The deltas move two states on
(:func:`apply_deltas`), one of references and one of existence.  Summed per slug they give its counts;
references whose slug has existence zero at the time of the reference are the orphans.  A first snapshot is a
change from nothing, so a full computation and a series of changes share all their steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import iso_micros, micros, month_utc
from ..session import checkpoint

#: References of one slug that one join task takes; a hotter slug is spread over several.
REFS_PER_TASK = 200_000
#: Hot slugs that are broadcast; more of them are joined by shuffle.
MOST_SPREAD = 1_000_000

_BLANKS = r"(?U)^[\s\x{85}\x{1c}-\x{1f}]+|[\s\x{85}\x{1c}-\x{1f}]+$"


def norm_slug(col: Column) -> Column:
    """Lower-cased and without white space around it; null for null and blank."""
    return F.nullif(F.lower(F.regexp_replace(col, _BLANKS, "")), F.lit(""))


def current_records(docs: DataFrame) -> DataFrame:
    """One row per slug: the docs row with the latest ``_source.last_seen``.

    Null or unreadable ``last_seen`` counts as the earliest; of equally late rows the greatest ``pos`` is
    taken (they differ in ``pos`` only).  Rows whose slug is null or blank are no record.
    """
    seen = iso_micros(F.col("_source.last_seen"))
    payload = F.struct(
        F.col("slug").alias("src_key"),
        F.col("status"),
        F.col("relations"),
        iso_micros(F.col("_source.first_seen")).alias("first_us"),
        seen.alias("last_us"),
    )
    rows = docs.select(
        norm_slug(F.col("slug")).alias("slug"),
        F.struct(F.coalesce(seen, F.lit(-(2**62))).alias("t"), F.coalesce(F.col("pos"), F.lit(-1)).alias("p")).alias("rank"),
        payload.alias("r"),
    ).filter("slug IS NOT NULL")
    return rows.groupBy("slug").agg(F.max_by("r", "rank").alias("r")).select("slug", "r.*")


def references(docs: DataFrame, provisions: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """All references: ``src_table, src_key, field, ref_slug, at_us``; null and blank targets are none."""
    records = current_records(docs) if records is None else records
    from_docs = (
        records.select("src_key", "last_us", F.explode("relations").alias("kind", "targets"))
        .select("src_key", "last_us", "kind", F.explode("targets").alias("target"))
        .select(
            F.lit("docs").alias("src_table"), "src_key", F.concat(F.lit("relations."), F.col("kind")).alias("field"),
            norm_slug(F.col("target")).alias("ref_slug"), F.col("last_us").alias("at_us"),
        )
    )
    at = micros(provisions, "built_at")
    named = F.array(
        F.struct(F.lit("doc").alias("field"), F.col("doc").alias("target")),
    )
    from_events = F.transform(
        F.coalesce(F.col("events"), F.array().cast(provisions.schema["events"].dataType)),
        lambda e: F.struct(F.lit("events.doc").alias("field"), e["doc"].alias("target")),
    )
    from_provisions = (
        provisions.select(F.col("id").alias("src_key"), at.alias("at_us"), F.explode(F.concat(named, from_events)).alias("x"))
        .select(F.lit("provisions").alias("src_table"), "src_key", F.col("x.field").alias("field"), norm_slug(F.col("x.target")).alias("ref_slug"), "at_us")
    )
    return from_docs.unionByName(from_provisions).filter("ref_slug IS NOT NULL")


#: What makes two references the same.
REFERENCE = ["src_table", "src_key", "field", "ref_slug", "at_us"]


def existence(records: DataFrame) -> DataFrame:
    """``slug, first_us`` of the records that exist: a ``Deleted`` one does not."""
    return records.filter("coalesce(status, '') <> 'Deleted'").select("slug", "first_us")


def signed(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Change deltas that lead from one snapshot to the next: ``keys..., delta``, +1 for what is new and -1 for what is gone.

    Equal rows of a snapshot count once; what both hold has no delta.  Without an old snapshot all is new.
    """
    now = new.select(*keys).distinct().withColumn("delta", F.lit(1).cast("long"))
    if old is None:
        return now
    both = now.unionByName(old.select(*keys).distinct().withColumn("delta", F.lit(-1).cast("long")))
    return both.groupBy(*keys).agg(F.sum("delta").alias("delta")).filter("delta <> 0")


def apply_deltas(changes: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The state ``keys..., delta`` moved on by one batch of changes; what sums to zero leaves it."""
    keys = [c for c in changes.columns if c != "delta"]
    rows = changes if state is None else changes.unionByName(state.select(*changes.columns))
    return rows.groupBy(*keys).agg(F.sum("delta").alias("delta")).filter("delta <> 0")


def slug_state(refs: DataFrame, records: DataFrame) -> DataFrame:
    """``slug, refs, exists, live_us`` of the referenced slugs from the states of references and records: both counts, and
    since when the slug exists.  Each is a sum or a maximum over what is there, so all can be taken back."""
    counted = refs.groupBy(F.col("ref_slug").alias("slug")).agg(F.sum("delta").alias("refs")).filter("refs > 0")
    known = records.groupBy("slug").agg(F.sum("delta").alias("exists"), F.max("first_us").alias("live_us"))
    return counted.join(known, "slug", "left").select("slug", "refs", F.coalesce("exists", F.lit(0)).alias("exists"), "live_us")


def orphan_keys(state: DataFrame) -> DataFrame:
    """The current orphan report by key: positive references and zero existence."""
    return state.filter("refs > 0 AND exists <= 0").select("slug", "refs")


def current_orphans(refs: DataFrame, records: DataFrame, per_task: int = REFS_PER_TASK) -> DataFrame:
    """Distinct orphan references ``src_table, src_key, field, ref_slug, period`` of the states of references and records."""
    state = slug_state(refs, records)
    # A hot slug's state is repeated once per share of its references, and each reference picks one share.
    shares = F.ceil(F.col("refs") / F.lit(per_task)).cast("int")
    spread = state.filter(F.col("refs") > per_task).select(F.col("slug").alias("ref_slug"), shares.alias("shares"))
    if spread.limit(MOST_SPREAD + 1).count() <= MOST_SPREAD:  # else joined by shuffle
        spread = F.broadcast(spread)
    state = state.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
    salted = refs.join(spread, "ref_slug", "left").withColumn("share", F.pmod(F.xxhash64("src_table", "src_key", "field"), F.coalesce("shares", F.lit(1))).cast("int"))
    joined = salted.join(state.withColumnRenamed("slug", "ref_slug"), ["ref_slug", "share"])
    orphan = (F.col("exists") <= 0) | (F.col("live_us") > F.col("at_us"))
    return joined.filter(orphan).select("src_table", "src_key", "field", "ref_slug", month_utc(F.col("at_us")).alias("period")).distinct()


def orphan_references(docs: DataFrame, provisions: DataFrame, per_task: int = REFS_PER_TASK) -> DataFrame:
    """Distinct orphan references ``src_table, src_key, field, ref_slug, period``.

    A reference is an orphan if its slug has no record, a ``Deleted`` record, or a record first seen after
    the reference.  A reference without a readable time is judged by existence alone and has a null
    period; a record without a readable ``first_seen`` counts as there from the start.
    """
    records = current_records(docs)
    refs = signed(None, references(docs, provisions, records), REFERENCE)
    return current_orphans(refs, signed(None, existence(records), ["slug", "first_us"]), per_task)


def orphans_after_changes(snapshots: list[tuple[DataFrame, DataFrame]], per_task: int = REFS_PER_TASK) -> DataFrame:
    """The orphan references after a series of snapshots ``(docs, provisions)``, by deltas alone: each snapshot is compared
    with the one before, the states are moved on by the signed changes, and the report is read from the states."""
    refs = records = before = None
    for docs, provisions in snapshots:
        now = current_records(docs)
        now = references(docs, provisions, now), existence(now)
        refs = checkpoint(apply_deltas(signed(before and before[0], now[0], REFERENCE), refs))
        records = checkpoint(apply_deltas(signed(before and before[1], now[1], ["slug", "first_us"]), records))
        before = now
    return current_orphans(refs, records, per_task)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Number of orphan references and of slugs they name, per table and month."""
    return orphans.groupBy("src_table", "period").agg(F.count("*").alias("orphans"), F.countDistinct("ref_slug").alias("slugs"))
