"""Problem 3: near-duplicate records by adaptive multi-match prefixes.

A record is the set of its runs of three consecutive tokens (shingles).  All shingles have one global
order, rare ones first.  Two sets with Jaccard similarity of at least t share at least l of the first
|x| - ceil(t |x|) + l shingles of each, for every l.  Each record picks its own l: a longer prefix costs more
postings, but then l of them must be shared before the pair is looked at, which the estimated number of
candidates pays for or not.  A pair must share min(l of both).

Postings meet in buckets (see ``_postings``).  There a pair must also pass two bounds that no similar pair
fails: the sizes' ratio, and the distance of 256-bit parity signatures, which is never above the number of
shingles that the two sets do not share.  Surviving pairs are verified on the whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from ._arrays import batches, mix, ranges, span_hashes, utf8
from ._blocks import pairs_within
from ._postings import Once, Packer, Pairs, bucket_number, cell_of, count_rows, count_table, meet, restrict, shares, table_bits

U = np.uint64
THRESHOLD = 0.7
SHINGLE = 3
LEAST_TOKENS = 40
#: Bytes of text to a shingle, about; sizes the table of hashed shingle counts (2**22 cells at most).
BYTES_PER_SHINGLE = 8
#: Longest l a record may choose; cost of verifying a candidate against that of reading a posting; the
#: share of candidates that one more required match leaves over.
MOST_MATCHES, VERIFY_COST, DECAY = 6, 30.0, 0.25
DOC = np.dtype([("k", "<i8"), ("n", "<i4"), ("l", "<i4"), ("sig", "<u8", 4)])


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, w: int, least: int, distinct: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the shingles of each row (of those with ``least`` tokens or more), sorted if ``distinct``.

    Tokens are maximal runs of bytes other than space, tab and newline, which UTF-8 uses for nothing else.
    """
    inside = (raw != 32) & (raw != 9) & (raw != 10)
    step = np.zeros(len(raw) + 1, bool)
    step[offsets] = True  # a token ends where its row ends
    before = np.concatenate([[False], inside[:-1]]) & ~step[:-1]
    start = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) & ~step[1:]
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    token = span_hashes(raw, start, end)
    if len(token) < w:
        return np.empty(0, np.int64), np.empty(0, U)
    shingle = np.zeros(len(token) - w + 1, U)
    for i in range(w):
        shingle += token[i : len(token) - w + 1 + i] * U(pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64))
    shingle = mix(shingle)
    enough = np.bincount(row, minlength=len(offsets)) >= max(least, w)
    ok = (row[: len(shingle)] == row[w - 1 :]) & enough[row[: len(shingle)]]
    row, shingle = row[: len(shingle)][ok], shingle[ok]
    if distinct and len(row):
        order = np.lexsort((shingle, row))
        row, shingle = row[order], shingle[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])])
        row, shingle = row[new], shingle[new]
    return row, shingle


def _threshold(t: float) -> tuple[int, int]:
    f = Fraction(str(t))
    return f.numerator, f.denominator


def prefixes(row: np.ndarray, shingle: np.ndarray, counts: np.ndarray, t: float) -> tuple[np.ndarray, ...]:
    """Rows that have shingles, their sizes, chosen l and signatures; and the postings (index of row, shingle, count)."""
    num, den = _threshold(t)
    seen = counts[cell_of(shingle, len(counts).bit_length() - 1)]
    order = np.lexsort((shingle, seen, row))
    row, shingle, seen = row[order], shingle[order], seen[order]
    rows, begin, size = np.unique(row, return_index=True, return_counts=True)
    need = -(-size * num // den)  # overlap that any similar partner has
    single = size - need + 1
    cost = np.concatenate([[0], np.cumsum(seen.astype(np.float64))])
    best, chosen = np.full(len(rows), np.inf), np.ones(len(rows), np.int64)
    for l in range(1, MOST_MATCHES + 1):
        reach = np.minimum(single + l - 1, size)
        visits = cost[begin + reach] - cost[begin]
        total = visits + VERIFY_COST * visits * DECAY ** (l - 1)
        better = (total < best) & (l <= need)
        best[better], chosen[better] = total[better], l
    length = np.minimum(single + chosen - 1, size)
    index = np.repeat(np.arange(len(rows)), length)
    at = np.repeat(begin, length) + ranges(length)
    # Parity signature: bit j is the parity of the number of shingles that hash to j.
    bit = (shingle & U(255)).astype(np.int64)
    parity = np.bincount(np.repeat(np.arange(len(rows)), size) * 256 + bit, minlength=256 * len(rows)).reshape(len(rows), 256) & 1
    sig = np.packbits(parity.astype(np.uint8), axis=1).view("<u8")
    return rows, size, chosen, sig, index, shingle[at], seen[at]


def shingle_counts(rows: DataFrame, w: int, least: int, bits: int) -> np.ndarray:
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, once = np.zeros(1 << bits, np.int64), Once()
        for batch in map(once.fresh, batches(it, "text")):
            _, shingle = shingle_sets(*utf8(batch.column("text")), w, least, distinct=False)
            total += np.bincount(cell_of(shingle, bits), minlength=1 << bits)
        yield count_rows(total, TaskContext.get().partitionId())

    return count_table(rows.mapInArrow(count, "slice int, part int, counts binary"), bits)


def candidates(rows: DataFrame, w: int = SHINGLE, least: int = LEAST_TOKENS, t: float = THRESHOLD) -> DataFrame:
    """Pairs of text keys ``ka < kb`` that share as many prefix shingles as they must and pass the bounds.

    The counts only give the shingles their order (rare ones first) and tell which may swamp a bucket: any
    table gives the same pairs.
    """
    num, den = _threshold(t)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    counts = shingle_counts(rows, w, least, table_bits(size / BYTES_PER_SHINGLE))
    spark = rows.sparkSession
    buckets = bucket_number(counts.sum() * (1 - num / den + 0.05), int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = spark.sparkContext.broadcast((np.minimum(counts, 2**31 - 1).astype(np.int32), shares(counts).astype(np.int32)))  # 2**22 numbers each at most

    def post(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, once = Packer(buckets), Once()
        counts, dealt = table.value
        for batch in map(once.fresh, batches(it, "text")):
            row, shingle = shingle_sets(*utf8(batch.column("text")), w, least)
            if not len(row):
                continue
            rows_, size, chosen, sig, index, token, _ = prefixes(row, shingle, counts, t)
            docs = np.empty(len(rows_), DOC)
            docs["k"] = batch.column("k").to_numpy(zero_copy_only=False)[rows_]
            docs["n"], docs["l"], docs["sig"] = size, chosen, sig
            yield from packer.add(docs, token, index, dealt[cell_of(token, len(dealt).bit_length() - 1)])
        yield from packer.flush()

    def pair(docs: np.ndarray, token: np.ndarray, doc: np.ndarray, pos: None, pairs: Pairs) -> list[np.ndarray]:
        n = docs["n"].astype(np.int64)
        keys, found = [], []
        for i, j in pairs:
            a, b = doc[i], doc[j]
            keep = np.minimum(n[a], n[b]) * den >= np.maximum(n[a], n[b]) * num
            a, b = a[keep], b[keep]
            apart = np.bitwise_count(docs["sig"][a] ^ docs["sig"][b]).sum(axis=1, dtype=np.int64)
            # |a ^ b| <= (1 - t) / (1 + t) * (|a| + |b|) for every similar pair
            keep = apart * (den + num) <= (n[a] + n[b]) * (den - num)
            a, b = a[keep], b[keep]
            key, share = np.unique(np.minimum(a, b) << 32 | np.maximum(a, b), return_counts=True)
            keys.append(key)
            found.append(share)
        key, where = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_inverse=True)
        share = np.bincount(where, np.concatenate(found), minlength=len(key)).astype(np.int64) if len(key) else np.empty(0, np.int64)
        a, b = key >> 32, key & 0xFFFFFFFF
        must = np.minimum(docs["l"][a], docs["l"][b])
        ka, kb = docs["k"][a], docs["k"][b]
        return [np.minimum(ka, kb), np.maximum(ka, kb), share, must.astype(np.int64)]

    met = meet(rows.mapInArrow(post, Packer.SCHEMA), buckets, DOC, pair, [(c, pa.int64()) for c in ("ka", "kb", "shared", "must")])
    return met.groupBy("ka", "kb").agg(F.sum("shared").alias("shared"), F.max("must").alias("must")).filter("shared >= must").select("ka", "kb")


def similar_texts(rows: DataFrame, w: int = SHINGLE, least: int = LEAST_TOKENS, t: float = THRESHOLD) -> DataFrame:
    """Verified pairs of different texts ``ka, kb, overlap, union`` from rows ``k`` (key of the text), ``text``."""
    num, den = _threshold(t)
    pairs = checkpoint(candidates(rows, w, least, t))
    wanted = checkpoint(pairs.select(F.col("ka").alias("k")).union(pairs.select("kb")).distinct())
    n = wanted.count()
    texts = restrict(rows, wanted, "k", n).dropDuplicates(["k"])

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, "text"):
            row, shingle = shingle_sets(*utf8(batch.column("text")), w, least)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(shingle.view(np.int64)))], ["k", "s"])

    shingles = texts.mapInArrow(sets, "k long, s array<long>")
    both = pairs.join(shingles.select(F.col("k").alias("ka"), F.col("s").alias("sa")), "ka").join(shingles.select(F.col("k").alias("kb"), F.col("s").alias("sb")), "kb")
    overlap = F.size(F.array_intersect("sa", "sb"))
    sized = both.select("ka", "kb", overlap.alias("overlap"), (F.size("sa") + F.size("sb") - overlap).alias("union"))
    return sized.filter(F.col("overlap") * den >= F.col("union") * num)


def _rows(df: DataFrame, text: str, least: int, w: int) -> DataFrame:
    # A text of m tokens has 2 m - 1 bytes or more.
    return df.select(F.xxhash64(text).alias("k"), df[text].alias("text")).filter(F.octet_length("text") >= 2 * max(least, w) - 1)


def members(df: DataFrame, id: str, text: str, least: int = LEAST_TOKENS) -> DataFrame:
    """``k, id``: the records of each text that has ``least`` tokens or more."""
    # Counted without a list of the tokens: the places where a token begins.
    enough = F.regexp_count(text, F.lit(r"[^ \t\n]+")) >= least
    return df.filter(df[id].isNotNull() & (F.octet_length(text) >= 2 * least - 1) & enough).select(F.xxhash64(text).alias("k"), df[id].alias("id")).distinct()


def similar_pairs(df: DataFrame, id: str = "id", text: str = "content", w: int = SHINGLE, least: int = LEAST_TOKENS, t: float = THRESHOLD) -> DataFrame:
    """All pairs of records ``id_a < id_b`` with similarity of at least ``t``, copies of one text included.

    A record's texts are those of all its rows; rows repeated with one id count once.  Null ids, null
    texts and texts with fewer than ``least`` tokens (or ``w``) are in no pair.
    """
    texts = similar_texts(_rows(df, text, least, w), w, least, t)
    of = checkpoint(members(df, id, text, max(least, w)))
    left, right = of.select(F.col("k").alias("ka"), F.col("id").alias("x")), of.select(F.col("k").alias("kb"), F.col("id").alias("y"))
    across = texts.select("ka", "kb").join(left, "ka").join(right, "kb").filter("x <> y")
    inside = pairs_within(of, ["k"], "id").select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
    return across.select("x", "y").unionByName(inside).select(F.least("x", "y").alias(f"{id}_a"), F.greatest("x", "y").alias(f"{id}_b")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``k, root``: the least key of each connected component, by alternating large-star and small-star steps.

    Each round is two aggregations over the edges and one checkpoint; the rounds needed grow with the
    logarithm of a component's size.  Nothing but the test for change reaches the driver.
    """
    edges = checkpoint(edges.select(F.greatest("ka", "kb").alias("u"), F.least("ka", "kb").alias("v")).filter("u <> v").distinct())
    mark = None
    for _ in range(most_rounds):
        # Large star: every greater neighbour of u is tied to the least of u and its neighbours.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: u and its smaller neighbours are tied to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = checkpoint(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("k"), "root").union(edges.select(F.col("v").alias("k"), F.col("v").alias("root"))).distinct()


def near_duplicate_groups(df: DataFrame, id: str = "id", text: str = "content", attachment: str = "attachment", w: int = SHINGLE, least: int = LEAST_TOKENS, t: float = THRESHOLD) -> DataFrame:
    """One row per record that is nearly the same as another: ``id, group_id, links, records, attachments``.

    ``group_id`` is the least id of the connected group, ``links`` the number of other *texts* this
    record's text is similar to, ``records`` and ``attachments`` the group's numbers of records and of
    distinct attachments (a null attachment counts as one).  Copies of one text are in one group.
    """
    texts = checkpoint(similar_texts(_rows(df, text, least, w), w, least, t).select("ka", "kb"))
    roots = components(texts)
    links = texts.select(F.col("ka").alias("k")).union(texts.select("kb")).groupBy("k").agg(F.count("*").alias("links"))
    enough = F.regexp_count(text, F.lit(r"[^ \t\n]+")) >= max(least, w)
    of = df.filter(df[id].isNotNull() & enough).select(F.xxhash64(text).alias("k"), df[id].alias("id"), F.coalesce(df[attachment].cast("string"), F.lit("\u0000")).alias("att")).distinct()
    tied = of.join(roots, "k", "left").join(links, "k", "left").select("id", "att", F.coalesce("root", "k").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    groups = tied.groupBy("root").agg(F.min("id").alias("group_id"), F.countDistinct("id").alias("records"), F.countDistinct("att").alias("attachments")).filter("records > 1")
    return tied.groupBy("id", "root").agg(F.max("links").alias("links")).join(groups, "root").select("id", "group_id", "links", "records", "attachments")
