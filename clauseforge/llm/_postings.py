"""Postings (token, document) shuffled as packed arrays, with hot tokens met block by block.

One Spark row per posting would cost more than the posting itself.  Instead each task packs the postings
that go to one bucket into a few binary columns; a bucket is a share of the tokens small enough for one
task, and one shuffle partition.  In its bucket the exact number of a token's documents is known: tokens
of up to ``BLOCK_DOCS`` documents are paired there and then, the postings of others go on to a second
round, in which they alone are cut into blocks of documents and every two blocks meet in a group of their
own.  So no posting of a cold token is ever copied, however large the corpus.

A token that would swamp even its bucket is dealt out over many buckets by document and always goes on to
the second round, where its number is summed exactly.  Which tokens these may be is read from a table of
hashed counts of fixed size; a cold token that shares such a cell is counted in the second round and
paired there in one block, uncopied as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrays import mix, pairs_in_runs, ranges

U = np.uint64
#: Documents of one token that are paired in one group (two such blocks meet at most).
BLOCK_DOCS = 2_000
#: Postings of one bucket, on average: at most, and at least where there are fewer buckets than shuffle partitions.
BUCKET_POSTINGS, LEAST_POSTINGS = 1_000_000, 50_000
#: Postings of one token that a bucket takes besides its share; cells of more are dealt out.
SWAMPED = 500_000
#: Postings a task keeps before it packs them.
FLUSH = 1_000_000
SLICE = 1 << 16
#: Tasks' tables summed at once in the first of two steps.
PARTS = 64

Pairs = Iterator[tuple[np.ndarray, np.ndarray]]


def cell_of(token: np.ndarray, bits: int) -> np.ndarray:
    return (token >> U(64 - bits)).astype(np.int64)


def table_bits(things: float, least: int = 12, most: int = 22) -> int:
    """Size of a count table (a power of two) for so many things: a cell for 16 to 32 of them, 2**22 cells at most."""
    return int(min(most, max(least, np.log2(max(1.0, things / 16)))))


def count_rows(counts: np.ndarray, part: int) -> pa.RecordBatch:
    """A task's counts by cell, as one row per slice of the table."""
    slices = counts.astype(np.int32).reshape(-1, min(SLICE, len(counts)))
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(slices)), pa.int32()), pa.array([part % PARTS] * len(slices), pa.int32()), pa.array([s.tobytes() for s in slices], pa.binary())],
        ["slice", "part", "counts"],
    )


def count_table(rows: DataFrame, bits: int) -> np.ndarray:
    """Sum the tasks' tables (``slice int, part int, counts binary``), in two steps; 2**bits whole numbers reach the driver."""

    def add(kind: type, group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_buffer(), kind) for x in group.column("counts")], axis=0, dtype=np.int64)
        return pa.table({"slice": group.column("slice")[:1], "part": group.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "slice int, part int, counts binary"
    once = rows.groupBy("slice", "part").applyInArrow(lambda g: add(np.int32, g), schema)
    twice = once.groupBy("slice").applyInArrow(lambda g: add(np.int64, g), schema)
    out = np.zeros(1 << bits, np.int64)
    size = min(SLICE, len(out))
    for r in twice.select("slice", "counts").collect():
        out[r["slice"] * size : (r["slice"] + 1) * size] = np.frombuffer(bytes(r["counts"]), np.int64)
    return out


def shares(counts: np.ndarray, swamped: int | None = None) -> np.ndarray:
    """Buckets over which the tokens of each cell are dealt out: 1, or more where one of them may swamp a bucket.

    What the middle cell holds is a sum of many cold tokens and no sign of a hot one, so it is taken off.
    """
    swamped = swamped or SWAMPED
    over = counts - int(np.median(counts))
    return np.where(over > swamped, -(-over // swamped), 1)


def bucket_number(postings: float, partitions: int) -> int:
    return max(1, -(-int(postings) // BUCKET_POSTINGS), min(int(postings) // LEAST_POSTINGS, partitions))


class Packer:
    """Collects postings of a task and yields them packed by bucket.

    ``docs`` is a structured array (one entry per document of the batch, field ``k`` its key).  Postings whose
    ``group`` is wanted whole later on (``wide``) keep 64 bits of it, others 32, with the bucket as the rest.
    """

    SCHEMA = "bucket int, wide boolean, docs binary, token binary, doc binary, side binary, pos binary"
    NAMES = ["bucket", "wide", "docs", "token", "doc", "side", "pos"]

    def __init__(self, buckets: int):
        self.buckets, self.held, self.size, self.doc_base = buckets, [], 0, 0

    def add(self, docs: np.ndarray, token: np.ndarray, doc: np.ndarray, shares: np.ndarray | None = None, side: np.ndarray | None = None, pos: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        wide = shares > 1 if shares is not None else np.zeros(len(token), bool)
        home = token % U(self.buckets)
        if wide.any():
            own = mix(docs["k"].view(U)[doc[wide]]) % shares[wide].astype(U)
            home[wide] = mix(token[wide] + own * U(0x9E3779B97F4A7C15)) % U(self.buckets)
        self.held.append((docs, token, doc + self.doc_base, home.astype(np.int64) * 2 + wide, side, pos))
        self.doc_base += len(docs)
        self.size += len(token)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            self.held, self.doc_base = [], 0
            return
        docs, token, doc, home, side, pos = (np.concatenate([h[i] for h in self.held]) if self.held[0][i] is not None else None for i in range(6))
        self.held, self.size, self.doc_base = [], 0, 0
        order = np.lexsort((doc, home))
        homes, begin = np.unique(home[order], return_index=True)  # only buckets that are there
        end = np.append(begin[1:], len(order))
        rows: list[list] = []
        for h, a, b in zip(homes.tolist(), begin.tolist(), end.tolist()):
            at = order[a:b]
            here = doc[at]
            new = np.concatenate([[True], here[1:] != here[:-1]])
            name = token[at] if h & 1 else (token[at] >> U(32)).astype(np.uint32)
            rows.append([h >> 1, bool(h & 1), docs[here[new]].tobytes(), name.tobytes(), (np.cumsum(new) - 1).astype(np.uint32).tobytes(), side[at].tobytes() if side is not None else b"", pos[at].astype(np.int32).tobytes() if pos is not None else b""])
            if len(rows) == 256:
                yield self._batch(rows)
                rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[list]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.bool_()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], self.NAMES)


def unpack(rows: list[pa.RecordBatch], doc_type: np.dtype, sided: bool, placed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None, np.ndarray]:
    """Distinct documents of a bucket and its distinct postings sorted by token: docs, token, doc, side, pos, and whether they were dealt out."""
    parts: list[tuple] = []
    base = 0
    for batch in rows:
        for bucket, wide, d, t, x, s, p in zip(*(batch.column(c) for c in Packer.NAMES)):
            docs = np.frombuffer(d.as_buffer(), doc_type)
            if wide.as_py():
                token = np.frombuffer(t.as_buffer(), U)
            else:
                token = np.frombuffer(t.as_buffer(), np.uint32).astype(U) << U(32) | U(bucket.as_py())
            doc = np.frombuffer(x.as_buffer(), np.uint32).astype(np.int64) + base
            parts.append((docs, token, doc, np.frombuffer(s.as_buffer(), np.uint8) if sided else None, np.frombuffer(p.as_buffer(), np.int32) if placed else None, np.full(len(token), wide.as_py())))
            base += len(docs)
    docs, token, doc, side, pos, wide = (np.concatenate([p[i] for p in parts]) if parts[0][i] is not None else None for i in range(6))
    _, first, index = np.unique(docs["k"], return_index=True, return_inverse=True)  # exact copies are one document
    docs, doc = docs[first], index[doc]
    keys = [k for k in (pos, side, doc, token, wide) if k is not None]
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    order = order[new]
    return docs, token[order], doc[order], *(x[order] if x is not None else None for x in (side, pos)), wide[order]


def meet(packed: DataFrame, buckets: int, doc_type: np.dtype, pair: Callable, columns: list[tuple[str, pa.DataType]], placed: bool = False, block: int | None = None) -> DataFrame:
    """Pairs of documents that share a token: the rows that ``pair`` makes, from ``Packer`` rows.

    ``pair(docs, token, doc, pos, pairs)`` gets a bucket's documents, its postings sorted by token and an
    iterator of index pairs of postings with one token, and returns arrays for ``columns``.  Each two
    postings of one token come together exactly once.
    """
    from ..session import checkpoint

    block = block or BLOCK_DOCS
    kinds = dict(columns)
    names = [*kinds, "group", "docs"]
    ddl = ", ".join(f"{c} {'long' if pa.types.is_int64(k) else k}" for c, k in columns) + ", group long, docs binary"
    entry = np.dtype([("doc", doc_type), ("pos", "<i4")]) if placed else np.dtype([("doc", doc_type)])

    def batch(n: int, arrays: dict[str, pa.Array]) -> pa.RecordBatch:
        kind = [*kinds.values(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([arrays[c] if c in arrays else pa.nulls(n, k) for c, k in zip(names, kind)], names)

    def made(found: list[np.ndarray]) -> pa.RecordBatch:
        return batch(len(found[0]), {c: pa.array(x, kinds[c]) for c, x in zip(kinds, found)})

    def first(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in it if b.num_rows]  # the bucket of this partition: about BUCKET_POSTINGS, and SWAMPED of a token besides
        if not rows:
            return
        docs, token, doc, _, pos, wide = unpack(rows, doc_type, False, placed)
        cut = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (wide[1:] != wide[:-1])]))
        size = np.diff(np.append(cut, len(token)))
        hot = np.repeat((size > block) | wide[cut], size)
        cold = np.flatnonzero(~hot)
        found = pair(docs, token[cold], doc[cold], pos[cold] if placed else None, pairs_in_runs(token[cold]))
        yield made(found)
        for a, n in zip(cut[hot[cut]].tolist(), size[hot[cut]].tolist()):
            for lo in range(a, a + n, block):
                at = slice(lo, min(a + n, lo + block))
                held = np.empty(at.stop - at.start, entry)
                held["doc"] = docs[doc[at]]
                if placed:
                    held["pos"] = pos[at]
                yield batch(1, {"group": pa.array([token[a].astype(np.int64)]), "docs": pa.array([held.tobytes()], pa.binary())})

    met = checkpoint(packed.repartitionById(buckets, "bucket").mapInArrow(first, ddl))
    out = met.filter("group IS NULL").select(*kinds)
    hot = met.filter("group IS NOT NULL").select("group", "docs")
    totals = checkpoint(hot.groupBy("group").agg(F.sum(F.expr(f"octet_length(docs) div {entry.itemsize}")).alias("n")))
    work = totals.agg(F.count("*").alias("groups"), F.sum(F.col("n") * F.ceil(F.col("n") / F.lit(block))).alias("postings")).first()
    if not work["groups"]:
        return out
    again = bucket_number(work["postings"], 1 << 30)

    def spread_out(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(again)
        for b in it:
            for group, data, n in zip(*(b.column(c) for c in ("group", "docs", "n"))):
                held = np.frombuffer(data.as_buffer(), entry)
                docs = np.ascontiguousarray(held["doc"])
                token = np.full(len(held), np.int64(group.as_py())).view(U)
                at, part, side = spread(token, docs["k"].view(U), np.full(len(held), n.as_py()), block)
                yield from packer.add(docs, mix(part), at, side=side, pos=held["pos"][at] if placed else None)
        yield from packer.flush()

    def second(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in it if b.num_rows]
        if not rows:
            return
        docs, token, doc, side, pos, _ = unpack(rows, doc_type, True, placed)

        def apart() -> Pairs:
            for i, j in pairs_in_runs(token):
                keep = (side[i] == 0) & (side[j] == 0) | (side[i] + side[j] == 3)
                yield i[keep], j[keep]

        yield made(pair(docs, token, doc, pos, apart()))

    # Totals are one row per hot token, of which there is at most one for ``block`` postings (or a dealt-out cell's).
    known = F.broadcast(totals) if work["groups"] <= 1_000_000 else totals  # 16 MB
    packed = hot.join(known, "group").select("group", "docs", "n").mapInArrow(spread_out, Packer.SCHEMA)
    return out.unionByName(packed.repartitionById(again, "bucket").mapInArrow(second, ddl).select(*kinds))


def spread(token: np.ndarray, doc_key: np.ndarray, seen: np.ndarray, block: int = BLOCK_DOCS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the posting, group token and side of each posting after cutting hot tokens into blocks.

    Side 0: the group pairs all its documents; 1 and 2: only documents of different sides are paired.
    """
    blocks = np.maximum(1, -(-seen // block))
    index = np.repeat(np.arange(len(token)), blocks)
    n, other = blocks[index], ranges(blocks)
    own = (mix(doc_key ^ U(0xA5A5A5A5A5A5A5A5))[index] % n.astype(U)).astype(np.int64)
    lo, hi = np.minimum(own, other), np.maximum(own, other)
    group = token[index]
    many = n > 1
    group[many] = mix(group[many] + lo[many].astype(U) * U(0x9E3779B97F4A7C15) + hi[many].astype(U) * U(0xC2B2AE3D27D4EB4F) + U(1))
    side = np.where(lo == hi, 0, np.where(own == lo, 1, 2)).astype(np.uint8)
    return index, group, side


class Once:
    """Which texts of a task are new to it, by key: copies need no postings of their own.

    A group of copies then costs one document per task however large it is.  The memory is emptied when it
    is full, which only lets a copy through again.
    """

    def __init__(self, most: int = 1_000_000):
        self.most, self.seen = most, set()

    def fresh(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for k in batch.column("k").to_pylist():
            keep.append(k not in self.seen)
            self.seen.add(k)
        if len(self.seen) > self.most:
            self.seen = set()
        return batch if all(keep) else batch.filter(pa.array(keep, pa.bool_()))


def restrict(rows: DataFrame, keys: DataFrame, key: str, n: int, most: int = 2_000_000) -> DataFrame:
    """Rows whose ``key`` is among the ``n`` distinct ``keys``: by broadcast up to ``most`` keys (32 MB), else by shuffle."""
    return rows.join(F.broadcast(keys) if n <= most else keys, key, "left_semi")
