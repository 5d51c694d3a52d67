"""Relations between documents mined from their titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# What titles say about other documents.
WITHDRAWS = r"(?iU)withdrawal\s+of\s+circular\s+no\.?\s*([A-Z0-9/&\.\- ]+?)(?:\s+dated\b|,|$)"
AMENDS = r"(?iU)\(\s*(?:first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth|\d+(?:st|nd|rd|th))\s+amendment\s*\)"
MODIFIES = r"(?iU)modificat\w*\s+(?:to|in|of)\s+(?:the\s+)?(.+?)(?:\s+dated\b|$)"
INVERSE = {"withdraws": "withdrawnBy", "amends": "amendedBy", "modifies": "modifiedBy"}

#: Length of the pieces by which titles that may hold each other are brought together.
PIECE = 12


def containing_pairs(wanted: DataFrame, titles: DataFrame) -> DataFrame:
    """``src, dst, n``: pairs where one bare title holds the other (``wanted``: src, text; ``titles``: dst, bare).

    Instead of comparing all with all, one piece of ``PIECE`` characters of the shorter string is looked up among
    all pieces of the longer: an equi join.  It is the shorter's rarest piece by the counts of the longer's, so openings
    that many titles share join nothing.  Titles shorter than that (at most 36 letters and digits to the
    power of their length, and in practice a handful) are looked up by all pieces of their own length.
    """

    def pieces(df: DataFrame, key: str, text: str, sizes: DataFrame) -> DataFrame:
        n = F.length(text)
        spread = df.join(F.broadcast(sizes)).filter(n >= F.col("size"))  # sizes: at most PIECE rows
        return spread.select(key, text, "size", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), n - F.col("size") + 1), lambda i: F.substr(F.col(text), i, F.col("size"))))).alias("piece"))

    def heads(df: DataFrame, key: str, text: str, among: DataFrame) -> DataFrame:
        size = F.least(F.length(text), F.lit(PIECE))
        own = df.select(key, text, size.alias("size"), F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(F.col(text), i, size)))).alias("piece"))
        counts = among.groupBy("size", "piece").agg(F.count("*").alias("n"))
        ranked = own.join(counts, ["size", "piece"], "left").groupBy(key, text, "size").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("r"))
        return ranked.filter("r.n > 0").select(key, text, "size", "r.piece")  # one that stands nowhere is held nowhere

    def sizes_of(df: DataFrame, text: str) -> DataFrame:
        return df.filter(f"length({text}) > 0").select(F.least(F.length(text), F.lit(PIECE)).alias("size")).distinct()

    titles, wanted = titles.filter("bare <> ''"), wanted.filter("text <> ''")
    of_wanted, of_titles = pieces(wanted, "src", "text", sizes_of(titles, "bare")), pieces(titles, "dst", "bare", sizes_of(wanted, "text"))
    inside = heads(titles, "dst", "bare", of_wanted).join(of_wanted, ["size", "piece"]).filter(F.col("text").contains(F.col("bare")))
    around = heads(wanted, "src", "text", of_titles).join(of_titles, ["size", "piece"]).filter(F.col("bare").contains(F.col("text")))
    both = inside.select("src", "dst", F.length("bare").alias("n")).union(around.select("src", "dst", F.length("bare").alias("n")))
    return both.distinct()


def _best(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The longest partner of each source, the first in corpus order on ties."""
    placed = pairs.filter("src <> dst").join(docs.select(F.col("slug").alias("dst"), "pos"), "dst")
    return placed.groupBy("src").agg(F.max_by("dst", F.struct("n", (-F.col("pos")).alias("p"))).alias("dst"))


def mine(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges ``src, kind, dst`` and what stayed open, ``slug, pending``; ``docs`` has unique slugs and ``pos``.

    Withdrawal looks the reference number up (of equal numbers the last document counts); amendment and
    modification look for titles that hold the stripped title or are held by it and take the longest.
    An amendment whose own stripped title is empty takes the longest title of all that is no amendment.
    """
    d = docs.select("slug", "pos", "refNo", F.coalesce("title", F.lit("")).alias("title"))
    bare = d.select(F.col("slug").alias("dst"), X.bare_title(F.col("title")).alias("bare"), F.col("title").rlike(AMENDS).alias("amending"))

    said = d.select("slug", F.nullif(F.regexp_extract("title", WITHDRAWS, 1), F.lit("")).alias("ref")).filter("ref IS NOT NULL")
    by_ref = d.filter("coalesce(refNo, '') <> ''").groupBy(X.compact_ref(F.col("refNo")).alias("key")).agg(F.max_by("slug", "pos").alias("dst"))
    found = said.withColumn("key", X.compact_ref(F.col("ref"))).join(by_ref, "key", "left")
    hit = F.col("dst").isNotNull() & (F.col("dst") != F.col("slug"))
    withdraws = found.filter(hit).select(F.col("slug").alias("src"), F.lit("withdraws").alias("kind"), "dst")
    open_withdrawals = found.filter(F.coalesce(~hit, F.lit(True))).select("slug", F.concat(F.lit("withdraws:"), X.strip(F.col("ref"))).alias("pending"))

    amending = d.filter(F.col("title").rlike(AMENDS))
    base = amending.select(F.col("slug").alias("src"), F.regexp_replace(X.bare_title(F.regexp_replace("title", AMENDS, "")), r"(19|20)\d{2}$", "").alias("text"))
    principals = bare.filter("NOT amending").select("dst", "bare")
    longest = _best(base.filter("text = ''").select("src").join(
        F.broadcast(d.join(principals.filter("bare <> ''"), d["slug"] == F.col("dst")).agg(F.max_by("dst", F.struct(F.length("bare"), -F.col("pos"))).alias("dst"), F.max(F.length("bare")).alias("n")))  # one row
    ).filter("dst IS NOT NULL"), docs)
    amends = _best(containing_pairs(base, principals), docs).union(longest)
    amends = amends.select("src", F.lit("amends").alias("kind"), "dst")
    open_amends = amending.join(amends.select(F.col("src").alias("slug")), "slug", "left_anti").select("slug", F.lit("amends:?").alias("pending"))

    modifying = d.filter(~F.col("title").rlike(AMENDS)).select("slug", F.nullif(F.regexp_extract("title", MODIFIES, 1), F.lit("")).alias("said")).filter("said IS NOT NULL")
    fragment = modifying.select(F.col("slug").alias("src"), X.bare_title(F.col("said")).alias("text"))
    held = _best(containing_pairs(fragment, bare.select("dst", "bare")), docs)
    # Every fragment holds an empty bare title; that counts only where no other title is found.
    blank = d.filter(X.bare_title(F.col("title")) == "").agg(F.min_by("slug", "pos").alias("dst")).filter("dst IS NOT NULL")  # one row
    rest = fragment.filter("text <> ''").join(held.select("src"), "src", "left_anti").select("src").join(F.broadcast(blank))
    modifies = held.select("src", "dst").union(rest).select("src", F.lit("modifies").alias("kind"), "dst")
    open_modifies = modifying.join(modifies.select(F.col("src").alias("slug")), "slug", "left_anti").select("slug", F.concat(F.lit("modifies:"), F.substring("said", 1, 60)).alias("pending"))
    return withdraws.union(amends).union(modifies), open_withdrawals.union(open_amends).union(open_modifies).distinct()


def relation_maps(edges: DataFrame) -> DataFrame:
    """``slug, relations`` with both directions of each edge, targets in order."""
    inverse = F.create_map(*[F.lit(x) for kv in INVERSE.items() for x in kv])
    both = edges.select(F.col("src").alias("slug"), "kind", F.col("dst").alias("to")).union(edges.select(F.col("dst").alias("slug"), F.element_at(inverse, F.col("kind")).alias("kind"), F.col("src").alias("to")))
    lists = both.groupBy("slug", "kind").agg(F.array_sort(F.collect_set("to")).alias("to"))
    return lists.groupBy("slug").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "to")))).alias("relations"))


# States that a withdrawal does not change, and the one it gives.
NOT_IN_FORCE, WITHDRAWN = ["Repealed", "Superseded", "Lapsed"], "Withdrawn"


def written_back(docs: DataFrame, edges: DataFrame, pending: DataFrame) -> DataFrame:
    """``docs`` with what :func:`mine` found: ``relations`` and ``_source.pending_relations`` extended, ``status`` of what is withdrawn.

    A relation that a document has already is not added again, nor is its inverse then; inverse targets follow in order
    of their documents' ``pos``.  A list in a document is as long as the document has relations.
    """
    held = docs.select(F.col("slug").alias("src"), F.col("pos").alias("at"), "relations")
    have = F.coalesce(F.try_element_at("relations", F.col("kind")), F.array().cast("array<string>"))
    fresh = edges.join(held, "src").filter(~F.array_contains(have, F.col("dst"))).select("src", "kind", "dst", "at")
    inverse = F.create_map(*[F.lit(x) for kv in INVERSE.items() for x in kv])
    both = fresh.select(F.col("src").alias("slug"), "kind", F.col("dst").alias("to"), "at").union(fresh.select("dst", F.element_at(inverse, F.col("kind")), "src", "at"))
    lists = both.groupBy("slug", "kind").agg(F.array_sort(F.collect_set(F.struct("at", "to"))).alias("to"))
    added = lists.groupBy("slug").agg(F.map_from_entries(F.collect_list(F.struct("kind", F.transform("to", lambda x: x["to"]).alias("to")))).alias("__added"))
    opened = pending.groupBy("slug").agg(F.array_sort(F.collect_set("pending")).alias("__open"))
    gone = edges.filter("kind = 'withdraws'").select(F.col("dst").alias("slug"), F.lit(True).alias("__gone")).distinct()
    none = F.array().cast("array<string>")
    empty = F.create_map().cast("map<string,array<string>>")
    merged = F.map_zip_with(F.coalesce("relations", empty), F.coalesce("__added", empty), lambda _, a, b: F.concat(F.coalesce(a, none), F.array_except(F.coalesce(b, none), F.coalesce(a, none))))
    waiting = F.coalesce("_source.pending_relations", none)
    out = docs.join(added, "slug", "left").join(opened, "slug", "left").join(gone, "slug", "left").withColumns({
        "relations": merged, "_source": F.col("_source").withField("pending_relations", F.concat(waiting, F.array_except(F.coalesce("__open", none), waiting))),
        "status": F.when(F.col("__gone") & ~F.coalesce(F.col("status").isin(NOT_IN_FORCE), F.lit(False)), F.lit(WITHDRAWN)).otherwise(F.col("status")),
    })
    return out.select(*docs.columns)
