"""Keyed upsert of listing sightings into the corpus, without a table format: a new snapshot from join and union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import classify

#: Fields of ``_source`` that every sighting renews.
VOLATILE = ["pdf_links", "pdf_filenames", "file_sizes", "detail_page"]


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key by ``order`` (a partial aggregate; a key's rows are never gathered)."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("r")).select(*keys, "r.*")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("r")).select(*keys, "r.*")


def with_surrogate_ids(rows: DataFrame) -> DataFrame:
    """Rows without a source id get ``sha1:`` and the hash of category, title and reference."""
    made = F.concat(F.lit("sha1:"), F.sha1(F.concat_ws("|", F.coalesce("category", F.lit("")), F.coalesce("title", F.lit("")), F.coalesce("reference_no", F.lit("")))))
    return rows.withColumn("liferay_id", F.coalesce(F.nullif("liferay_id", F.lit("")), made))


def with_slugs(records: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Adds ``slug``: the base slug, with -2, -3 ... for further records of one base in order of ``pos``.

    ``taken`` (column ``slug``) has the slugs already in use; numbering goes on above the highest of a base.
    """
    based = records.withColumn("__base", classify.base_slug(F.col("type"), F.col("title"), F.col("year")))
    n = F.row_number().over(W.partitionBy("__base").orderBy("pos"))
    if taken is not None:
        numbered = taken.select(F.explode(F.array(
            F.struct(F.col("slug").alias("base"), F.lit(1).alias("n")),
            F.struct(F.regexp_replace("slug", r"-\d{1,6}$", "").alias("base"), F.coalesce(F.nullif(F.regexp_extract("slug", r"-(\d{1,6})$", 1), F.lit("")).cast("int"), F.lit(0)).alias("n")),
        )).alias("x")).select("x.*").filter("n > 0")
        used = numbered.groupBy("base").agg(F.max("n").alias("__used"), F.max((F.col("n") == 1).cast("int")).alias("__plain"))
        based = based.join(used, based["__base"] == used["base"], "left").drop("base")
        n = n + F.when(F.col("__plain") == 1, F.col("__used")).otherwise(F.lit(0))
    out = based.withColumn("__n", n)
    return out.withColumn("slug", F.when(F.col("__n") == 1, F.col("__base")).otherwise(F.concat_ws("-", "__base", F.col("__n").cast("string")))).drop("__base", "__n", "__used", "__plain")


def upsert(corpus: DataFrame, sightings: DataFrame, now: str, as_of_year: int) -> tuple[DataFrame, DataFrame]:
    """The new corpus and the records that are new in it.

    A sighting whose id the corpus knows renews ``last_seen`` and the volatile fields only; others become
    records with a slug.  Several sightings of one id count once, the last by ``pos``; for a new id the first
    is classified.  ``sightings`` are listing rows with ``pos`` (order of arrival).
    """
    rows = with_surrogate_ids(sightings)
    known = corpus.select(F.col("_source.liferay_id").alias("liferay_id")).filter("liferay_id IS NOT NULL").distinct()
    fresh = rows.join(known, "liferay_id", "left_anti")
    last = latest_by(rows.select("liferay_id", "pos", *VOLATILE), ["liferay_id"], [F.col("pos")]).select(
        F.col("liferay_id").alias("__id"), F.struct(*VOLATILE).alias("__new")
    )
    moved = corpus.join(last, corpus["_source.liferay_id"] == last["__id"], "left")
    source = F.col("_source")
    for field in VOLATILE:
        source = source.withField(field, F.col(f"__new.{field}"))
    source = source.withField("last_seen", F.lit(now))
    kept = moved.withColumn("_source", F.when(F.col("__id").isNotNull(), source).otherwise(F.col("_source"))).drop("__id", "__new")
    # The first sighting of a new id is classified; what later ones renew is renewed below.
    once = first_by(fresh, ["liferay_id"], [F.col("pos")])
    made = classify.to_records(once, F.lit(now), as_of_year).join(last, F.col("_source.liferay_id") == last["__id"])
    renewed = F.col("_source")
    for field in VOLATILE:
        renewed = renewed.withField(field, F.col(f"__new.{field}"))
    made = with_slugs(made.withColumn("_source", renewed).drop("__id", "__new"), corpus.select("slug"))
    top = corpus.agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("__top"))
    placed = made.join(F.broadcast(top)).withColumn("pos", (F.col("pos") + F.col("__top") + 1).cast("bigint")).drop("__top")  # a single row
    return kept.unionByName(placed.select(*kept.columns)), placed


def merge_columns(target: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Update ``columns`` of matching rows of ``target`` (unique ``key`` in ``changes``); other rows stay."""
    new = changes.select(F.col(key).alias("__k"), F.struct(*columns).alias("__new"))
    joined = target.join(new, target[key] == new["__k"], "left")
    return joined.withColumns({c: F.when(F.col("__k").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) for c in columns}).select(*target.columns)


def replace_rows(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Upsert whole rows: those of ``changes`` in place of the target's rows of the same key."""
    return target.join(changes.select(key).distinct(), key, "left_anti").unionByName(changes.select(*target.columns))


def pending(docs: DataFrame, stored: DataFrame, refresh: bool = False) -> DataFrame:
    """Documents with links that still have no stored text hash (all with links if ``refresh``), in corpus order."""
    linked = docs.filter(F.size(F.coalesce("_source.pdf_links", F.array().cast("array<string>"))) > 0)
    if refresh:
        return linked
    done = stored.filter("content_sha1 IS NOT NULL").select("slug").distinct()
    return linked.join(done, "slug", "left_anti")
