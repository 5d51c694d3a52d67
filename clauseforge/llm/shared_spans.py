"""Problem 2: long exact spans shared between records, by seed and extend.

Seeds are winnowed anchors: of every 101 consecutive runs of 100 code points the one with the least hash is
kept, so two texts with 200 code points in common keep at least one anchor at the same place of the
common run.  Texts are joined on their anchors in buckets (see ``_postings``); each meeting is extended
both ways on the texts themselves, and maximal repeats of the asked length are kept.

Where text repeats itself (dot leaders, rules, a passage over and over) an anchor stands at many places, and
two such texts would meet at the product of them.  Anchors of one hash that follow each other closely are
one *run*; where a run, or more than four places of one anchor in a text, meets another text, the pair
gets one place that stands for all, and its texts are compared by the set of all their runs of 200: the
same common parts, in time linear in the two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint
from ._arrays import GAP, batches, code_points, gram_hashes
from ._blocks import pairs_within
from ._postings import Once, Packer, Pairs, bucket_number, cell_of, count_rows, count_table, meet, restrict, shares

U = np.uint64
SPAN = 200
#: Size of the table of hashed anchor counts (2**16 whole numbers), which finds anchors that may swamp a bucket.
BITS = 16
#: Places of one anchor in one text that are joined one by one.
PLACES = 4
#: Code points of one text scanned at once; longer texts are scanned in overlapping parts.
PART = 1 << 19
DOC = np.dtype([("k", "<i8")])


def grams(span: int) -> tuple[int, int]:
    """Length of an anchor, and how many in a row one is chosen from."""
    gram = (span + 1) // 2
    return gram, span - gram + 1


def anchors(texts: list[str | None], span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position (code points) and hash of the anchors of each text of ``span`` code points or more."""
    found: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, str]] = []
    size = 0
    for n, t in enumerate(texts):
        if t is not None and len(t) >= span:
            for a in range(0, len(t) - span + 1, PART):
                held.append((n, a, t[a : a + PART + span - 1]))
                size += len(held[-1][2])
                if size >= PART:
                    found.append(_anchors(held, span))
                    held, size = [], 0
    if held:
        found.append(_anchors(held, span))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U)
    row, pos, h = (np.concatenate(x) for x in zip(*found))
    if len(row) and (np.diff(row) == 0).any():  # parts of a long text overlap
        _, first = np.unique(np.stack([row, pos]), axis=1, return_index=True)
        row, pos, h = row[first], pos[first], h[first]
    return row, pos, h


def _anchors(parts: list[tuple[int, int, str]], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gram, window = grams(span)
    cp = code_points(GAP.join(p for _, _, p in parts))
    size = np.fromiter((len(p) for _, _, p in parts), np.int64, len(parts))
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    hashes = gram_hashes(cp, gram)
    # Least hash of each window; of equal ones the last, so that a common run gives the same choice.
    at = np.arange(len(hashes))
    low = (hashes & ~U(0x3FFFFFFF)) | (U(0x3FFFFFFF) - at.astype(U))
    width = 1
    while width * 2 <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = window - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    # Windows that lie inside one part.
    inside = np.zeros(len(low) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, begin + size - span + 1, -1)
    chosen = np.unique(U(0x3FFFFFFF) - (low[np.cumsum(inside[:-1]) > 0] & U(0x3FFFFFFF))).astype(np.int64)
    part = np.searchsorted(begin, chosen, side="right") - 1
    row, shift = np.array([n for n, _, _ in parts]), np.array([a for _, a, _ in parts])
    return row[part], chosen - begin[part] + shift[part], hashes[chosen]


def runs_joined(row: np.ndarray, pos: np.ndarray, h: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors with every close run of one hash as a single entry, marked by a negative position (``-1 - first``)."""
    near = np.zeros(len(row) + 1, bool)
    near[1:-1] = (row[1:] == row[:-1]) & (h[1:] == h[:-1]) & (pos[1:] - pos[:-1] <= grams(span)[0] // 2)
    first, run = ~near[:-1], near[1:]
    return row[first], np.where(run, -1 - pos, pos)[first], h[first]


def meetings(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """``ka < kb, pa, pb``: places where two different texts (rows ``k``, ``text``) hold the same anchor, one per alignment
    and bucket; a place of -1 stands for all places of the pair."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, once = np.zeros(1 << BITS, np.int64), Once()
        for batch in map(once.fresh, batches(it, "text", PART)):
            row, pos, h = runs_joined(*anchors(batch.column("text").to_pylist(), span), span)
            k = batch.column("k").to_numpy(zero_copy_only=False)
            total += np.bincount(cell_of(h, BITS), minlength=1 << BITS)
            if len(h):
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                cells = [-1, 0, h.tobytes(), k[row].tobytes(), pos.astype(np.int32).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, kinds)], ["slice", "part", "counts", "k", "pos"])
        c = count_rows(total, TaskContext.get().partitionId())
        empty = pa.array([b""] * c.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([*c.columns, empty, empty], ["slice", "part", "counts", "k", "pos"])

    kept = checkpoint(rows.mapInArrow(cut, "slice int, part int, counts binary, k binary, pos binary"))
    counts = count_table(kept.filter("slice >= 0").select("slice", "part", "counts"), BITS)
    spark = rows.sparkSession
    buckets = bucket_number(counts.sum(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = spark.sparkContext.broadcast(shares(counts).astype(np.int32))  # 2**BITS numbers

    gram, _ = grams(span)

    def post(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets)
        for batch in it:
            for h, k, pos in zip(*(batch.column(c) for c in ("counts", "k", "pos"))):
                h, k, pos = (np.frombuffer(x.as_buffer(), t) for x, t in ((h, U), (k, np.int64), (pos, np.int32)))
                keys, doc = np.unique(k, return_inverse=True)
                docs = np.empty(len(keys), DOC)
                docs["k"] = keys
                yield from packer.add(docs, h, doc, dealt.value[cell_of(h, BITS)], pos=pos)
        yield from packer.flush()

    packed = kept.filter("slice < 0").select("counts", "k", "pos").mapInArrow(post, Packer.SCHEMA)
    return meet(packed, buckets, DOC, lambda *x: _places(*x, gram), [(c, pa.int64()) for c in ("ka", "kb", "pa", "pb")], placed=True)


def _places(docs: np.ndarray, token: np.ndarray, doc: np.ndarray, pos: np.ndarray, pairs: Pairs, gram: int) -> list[np.ndarray]:
    # Postings of one token and document stand together.  All but the first of more than PLACES are left out, the
    # first then stands for all of them, as a run does.
    new = np.concatenate([[True], (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])]) if len(token) else np.empty(0, bool)
    cut = np.flatnonzero(new)
    size = np.diff(np.append(cut, len(token)))
    run = np.logical_or.reduceat(pos < 0, cut) if len(cut) else np.empty(0, bool)
    many = np.repeat(run | (size > PLACES), size)
    kept = ~many | new
    found = []
    for i, j in pairs:
        keep = (doc[i] != doc[j]) & kept[i] & kept[j]
        i, j = i[keep], j[keep]
        swap = docs["k"][doc[i]] > docs["k"][doc[j]]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        all_ = many[i] | many[j]
        at = np.where(all_, -1, pos[i])
        found.append(_one_per_alignment(np.stack([doc[i], doc[j], np.where(all_, 0, pos[i].astype(np.int64) - pos[j]), at], axis=1), gram))
    block = _one_per_alignment(np.concatenate(found), gram) if found else np.empty((0, 4), np.int64)
    a, b, diagonal, at = block.T
    return [docs["k"][a], docs["k"][b], at, np.where(at < 0, -1, at - diagonal)]


def _one_per_alignment(block: np.ndarray, gram: int) -> np.ndarray:
    order = np.lexsort((block[:, 3], block[:, 2], block[:, 1], block[:, 0]))
    block = block[order]
    near = np.zeros(len(block), bool)
    # Anchors of one alignment that touch or overlap lie in the same repeat: extension from the first reaches them.
    near[1:] = (block[1:, :3] == block[:-1, :3]).all(axis=1) & ((block[1:, 3] < 0) == (block[:-1, 3] < 0)) & (block[1:, 3] - block[:-1, 3] <= gram)
    return block[~near]


def common_length(a: str, i: int, b: str, j: int, step: int) -> int:
    """How far ``a`` from ``i`` and ``b`` from ``j`` agree going right (step 1), or left of them (step -1)."""
    most = min(len(a) - i, len(b) - j) if step > 0 else min(i, j)
    done, width = 0, 64
    while done < most:
        n = min(width, most - done)
        x, y = (a[i + done : i + done + n], b[j + done : j + done + n]) if step > 0 else (a[i - done - n : i - done], b[j - done - n : j - done])
        if x == y:
            done += n
            width *= 2
        elif n == 1:
            break
        else:
            width = max(1, n // 2)
            most = done + n if width else most
    return done


def repeats(a: str, b: str, places: list[tuple[int, int]], span: int) -> list[tuple[int, int, int]]:
    """Maximal common runs ``(start in a, start in b, length)`` of ``span`` or more through the given places."""
    out = set()
    for i, j in places:
        left, right = common_length(a, i, b, j, -1), common_length(a, i, b, j, 1)
        if left + right >= span:
            out.add((i - left, j - left, left + right))
    return sorted(out)


def whole_common(a: str, b: str, span: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The parts ``(start, end)`` of each text that lie in common runs of ``span`` or more, from the set of all such runs."""
    x, y = gram_hashes(code_points(a), span), gram_hashes(code_points(b), span)
    in_x, in_y = np.flatnonzero(np.isin(x, y)), np.flatnonzero(np.isin(y, x))
    if not len(in_x):
        return [], []
    i = int(in_x[0])
    j = int(np.flatnonzero(y == x[i])[0])
    if a[i : i + span] != b[j : j + span]:  # hashes of different runs
        return [], []
    return joined([(int(p), int(p) + span) for p in in_x]), joined([(int(p), int(p) + span) for p in in_y])


def joined(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted parts with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(parts):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def shared_parts(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """``ka, kb, sa, sb array<struct<s, e>>``: of each pair of different texts the parts that lie in common maximal repeats."""
    places = checkpoint(meetings(rows, span))
    wanted = checkpoint(places.select(F.col("ka").alias("k")).union(places.select("kb")).distinct())
    texts = restrict(rows, wanted, "k", wanted.count()).dropDuplicates(["k"])
    # A pair has at most PLACES squared places for an anchor of its texts, so the list is linear in the shorter one.
    pairs = places.groupBy("ka", "kb").agg(F.min("pa").alias("least"), F.collect_set(F.struct("pa", "pb")).alias("places"))
    both = pairs.join(texts.select(F.col("k").alias("ka"), F.col("text").alias("ta")), "ka").join(texts.select(F.col("k").alias("kb"), F.col("text").alias("tb")), "kb")

    def extend(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ka, kb, sa, sb = [], [], [], []
            for x, y, least, p, a, b in zip(*(batch.column(c).to_pylist() for c in ("ka", "kb", "least", "places", "ta", "tb"))):
                if least < 0:
                    left, right = whole_common(a, b, span)
                else:
                    found = repeats(a, b, [(q["pa"], q["pb"]) for q in p], span)
                    left, right = joined([(i, i + n) for i, _, n in found]), joined([(j, j + n) for _, j, n in found])
                if left:
                    ka.append(x)
                    kb.append(y)
                    sa.append([{"s": s, "e": e} for s, e in left])
                    sb.append([{"s": s, "e": e} for s, e in right])
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(ka, pa.int64()), pa.array(kb, pa.int64()), pa.array(sa, kind), pa.array(sb, kind)], ["ka", "kb", "sa", "sb"])

    part = "array<struct<s:long,e:long>>"
    return both.select("ka", "kb", "least", "places", "ta", "tb").mapInArrow(extend, f"ka long, kb long, sa {part}, sb {part}")


def _rows(df: DataFrame, text: str, span: int) -> DataFrame:
    return df.select(F.xxhash64(text).alias("k"), df[text].alias("text")).filter(F.length("text") >= span)


def _members(df: DataFrame, id: str, text: str, span: int) -> DataFrame:
    return df.filter(df[id].isNotNull() & (F.length(text) >= span)).select(F.xxhash64(text).alias("k"), df[id].alias("id"), F.length(text).alias("n")).distinct()


def sharing_pairs(df: DataFrame, id: str = "id", text: str = "content", span: int = SPAN) -> DataFrame:
    """Pairs of records ``id_a < id_b`` with a common run of ``span`` code points, copies of one text included.

    Rows repeated with one id count once; null ids, null and shorter texts are in no pair.
    """
    found = shared_parts(_rows(df, text, span), span).select("ka", "kb")
    of = checkpoint(_members(df, id, text, span).select("k", "id"))
    across = found.join(of.select(F.col("k").alias("ka"), F.col("id").alias("x")), "ka").join(of.select(F.col("k").alias("kb"), F.col("id").alias("y")), "kb").filter("x <> y")
    inside = pairs_within(of, ["k"], "id").select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
    return across.select("x", "y").unionByName(inside).select(F.least("x", "y").alias(f"{id}_a"), F.greatest("x", "y").alias(f"{id}_b")).distinct()


def shared_per_record(df: DataFrame, id: str = "id", text: str = "content", span: int = SPAN) -> DataFrame:
    """One row per record with a shared run: ``id, n_chars, shared_chars, shared_share, class_id, copies, links``.

    ``shared_chars`` counts the code points that lie in a run of ``span`` or more found in another
    record.  Records with equal ``class_id`` hold the same text (a text held by two records is shared as
    a whole): it is the least id among them, ``copies`` is their number and ``links`` that of the other classes it
    shares runs with, which :func:`sharing_classes` lists.
    """
    pairs = checkpoint(shared_parts(_rows(df, text, span), span))
    of = checkpoint(_members(df, id, text, span))
    sides = pairs.select(F.col("ka").alias("k"), F.col("sa").alias("parts")).union(pairs.select("kb", "sb"))
    # Union of the parts of one text, swept in order of their starts.
    swept = sides.select("k", F.explode("parts").alias("r")).select("k", "r.*").distinct()
    order = W.partitionBy("k").orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1)
    covered = swept.withColumn("reach", F.coalesce(F.max("e").over(order), F.lit(0))).groupBy("k").agg(F.sum(F.greatest(F.lit(0), F.col("e") - F.greatest("s", "reach"))).alias("covered"))
    links = sides.groupBy("k").agg(F.count("*").alias("links"))
    copies = of.groupBy("k").agg(F.count("*").alias("copies"), F.min("id").alias("class_id"))
    out = of.join(copies, "k").join(covered, "k", "left").join(links, "k", "left").filter("copies > 1 OR covered > 0")
    shared = F.when(F.col("copies") > 1, F.col("n").cast("long")).otherwise(F.col("covered"))
    return out.select("id", F.col("n").cast("long").alias("n_chars"), shared.alias("shared_chars"), (shared / F.col("n")).alias("shared_share"), "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))


def sharing_classes(df: DataFrame, id: str = "id", text: str = "content", span: int = SPAN) -> DataFrame:
    """``class_a < class_b, shared_a, shared_b``: pairs of different texts with a common run, by the least id that holds each,
    and how much of each lies in such runs."""

    def total(parts: str) -> Column:
        return F.aggregate(F.transform(parts, lambda p: p["e"] - p["s"]), F.lit(0).cast("long"), lambda a, x: a + x)

    names = checkpoint(_members(df, id, text, span).groupBy("k").agg(F.min("id").alias("name")))
    pairs = shared_parts(_rows(df, text, span), span).select("ka", "kb", F.struct(total("sa").alias("n")).alias("a"), F.struct(total("sb").alias("n")).alias("b"))
    named = pairs.join(names.withColumnsRenamed({"k": "ka", "name": "na"}), "ka").join(names.withColumnsRenamed({"k": "kb", "name": "nb"}), "kb")
    # Two texts of one id (deliveries that differ) are no pair of records.
    ends = named.filter("na <> nb").select(F.array_sort(F.array(F.struct("na", "a.n"), F.struct(F.col("nb").alias("na"), "b.n"))).alias("e"))
    return ends.select(F.col("e")[0]["na"].alias("class_a"), F.col("e")[1]["na"].alias("class_b"), F.col("e")[0]["n"].alias("shared_a"), F.col("e")[1]["n"].alias("shared_b"))
