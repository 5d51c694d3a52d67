"""Problem 1: splitting oversized items at natural boundaries, by agglomerative merging.

An item starts as atomic segments: its sentences and lines; where one alone is too long its clauses, then
its words, then forced cuts that keep a letter and its marks together.  The boundaries between adjacent
segments wait in a heap, weakest first (forced, word, clause, sentence, line, paragraph), and the two sides
of a boundary are merged while their combined size plus the overlap fits the limit.  What is left are the
cuts.  Each piece but the first begins with the end of the piece before, from a natural boundary; before a
segment that fits the limit only without the full overlap, the overlap shrinks.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1800, 200
FORCED, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH = range(6)
_BREAK = regex.compile(
    r"(?P<p>\n[^\S\n]*(?:\n\s*)+)|(?P<l>\s*\n\s*)|(?P<s>(?<=[.!?।॥][\"'”’)\]]*)(?<!\b(?:Rs|No|Nos|Dr|Mr|Mrs|Ms|St|vs|cf|i\.e|e\.g)\.)\s+)|(?P<c>(?<=[,;:–—])\s+)|(?P<w>\s+)"
)
_LEVEL = {"p": PARAGRAPH, "l": LINE, "s": SENTENCE, "c": CLAUSE, "w": WORD}


def boundaries(text: str) -> list[tuple[int, int]]:
    """Position and strength of each natural boundary; white space belongs to the segment before it."""
    return [(m.end(), _LEVEL[m.lastgroup]) for m in _BREAK.finditer(text) if 0 < m.end() < len(text)]


def _forced(text: str, at: int, low: int) -> int:
    """The last place at or before ``at`` that parts no letter from its marks or joiners (``at`` if none above ``low``)."""
    p = at
    while p > low and (unicodedata.category(text[p])[0] == "M" or text[p] in "‌‍" or text[p - 1] == "‍"):
        p -= 1
    return p if p > low else at


def atoms(text: str, limit: int, most: int) -> list[tuple[int, int]]:
    """End and strength of the cut after each atomic segment (the last one's end is the text's).

    What fits the limit stays whole; what no boundary divides is cut every ``most``, to leave room for an overlap.
    """
    marks = boundaries(text)
    out: list[tuple[int, int]] = []

    def cut(begin: int, end: int, strength: int, marks: list[tuple[int, int]], level: int) -> None:
        if end - begin <= limit and level < SENTENCE:
            out.append((end, strength))
            return
        body = begin + len(text[begin:end].rstrip())
        if level < SENTENCE and begin < body <= begin + limit:  # only its white space does not fit
            out.append((body, strength))
            cut(body, end, strength, [], FORCED)
            return
        while level >= WORD:
            inner = [(p, s) for p, s in marks if s >= level]
            if inner or level <= SENTENCE:
                break
            level -= 1
        if level < WORD:
            at = begin
            while end - at > most:
                at = max(at + 1, _forced(text, at + most, at))
                out.append((at, FORCED))
            out.append((end, strength))
            return
        rest, at, k = marks, begin, 0
        for p, s in [*inner, (end, strength)]:
            own = []
            while k < len(rest) and rest[k][0] < p:
                own.append(rest[k])
                k += 1
            if k < len(rest) and rest[k][0] == p:
                k += 1
            if p - at > limit:
                cut(at, p, s, own, level - 1)
            else:
                out.append((p, s))
            at = p

    cut(0, len(text), PARAGRAPH + 1, marks, SENTENCE)
    return out


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """Pieces of ``text`` as ``(start, body start, end)``: the piece is ``text[start:end]`` and repeats up to its body start.

    The bodies follow each other without gap.  A text within the limit is one piece.
    """
    if len(text) <= limit:
        return [(0, 0, len(text))]
    overlap = min(overlap, limit - 1)
    parts = atoms(text, limit, limit - overlap)
    n = len(parts)
    end = [e for e, _ in parts]
    start = [0, *end[:-1]]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    alive, stamp = [True] * n, [0] * n  # a segment is known by its first atom; stamp tells stale boundaries
    strength = [s for _, s in parts]
    heap = [(strength[i], end[i + 1] - start[i], i, 0, 0) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        _, size, i, a, b = heapq.heappop(heap)
        j = right[i]
        if not alive[i] or j >= n or stamp[i] != a or stamp[j] != b:
            continue
        if size + (overlap if start[i] else 0) > limit:
            continue  # sizes only grow: this boundary is a cut
        end[i], strength[i], right[i] = end[j], strength[j], right[j]
        alive[j] = False
        stamp[i] += 1
        if right[i] < n:
            left[right[i]] = i
            heapq.heappush(heap, (strength[i], end[right[i]] - start[i], i, stamp[i], stamp[right[i]]))
        p = left[i]
        if p >= 0:
            heapq.heappush(heap, (strength[p], end[i] - start[p], p, stamp[p], stamp[i]))
    cuts = [(start[i], end[i]) for i in range(n) if alive[i]]
    marks = boundaries(text)
    out, k = [(0, *cuts[0])], 0
    for (a, b), (c, d) in zip(cuts, cuts[1:]):
        low = max(a, b - overlap, d - limit)
        while k < len(marks) and marks[k][0] < low:
            k += 1
        near, m = {}, k
        while m < len(marks) and marks[m][0] < b:
            near.setdefault(marks[m][1], marks[m][0])
            m += 1
        best = next((min(v for s, v in near.items() if s >= level) for level in (SENTENCE, CLAUSE, WORD) if any(s >= level for s in near)), None)
        if best is None:
            best = low
            while best < b and unicodedata.category(text[best])[0] == "M":
                best += 1
            best = low if best == b else best
        out.append((best, c, d))
    return out


def split_oversized(df: DataFrame, id: str = "id", text: str = "content", heading: str = "heading", order: str = "loaded_at", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """``id, piece, pieces, heading, content, repeated``: the pieces of each record whose text is over ``limit`` code points.

    Of several oversized rows of one id the latest by ``order`` counts (ties: the greatest text), so exact
    repeats come out once.  Null, empty and shorter texts give no pieces; a null heading stays null; a
    null id is an id of its own.  Concatenating the pieces without their ``repeated`` first code points
    gives the text.
    """
    kind = df.schema[id].dataType.simpleString()
    big = df.filter(F.length(text) > limit).select(df[id].alias("id"), F.struct(df[order].alias("o"), df[text].alias("content"), df[heading].alias("heading")).alias("r"))
    rows = big.groupBy("id").agg(F.max("r").alias("r")).select("id", "r.content", "r.heading")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            at, piece, pieces, content, repeated = [], [], [], [], []
            for n, t in enumerate(batch.column("content").to_pylist()):
                cut = split(t, limit, overlap)
                for k, (a, b, c) in enumerate(cut):
                    at.append(n)
                    piece.append(k)
                    pieces.append(len(cut))
                    content.append(t[a:c])
                    repeated.append(b - a)
            rows_ = batch.take(pa.array(at, pa.int64()))
            columns = [rows_.column("id"), pa.array(piece, pa.int32()), pa.array(pieces, pa.int32()), rows_.column("heading"), pa.array(content, pa.string()), pa.array(repeated, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "pieces", "heading", "content", "repeated"])

    out = rows.mapInArrow(run, f"id {kind}, piece int, pieces int, heading string, content string, repeated int")
    return out.withColumnRenamed("id", id)


def oversized(df: DataFrame, id: str = "id", **kw) -> DataFrame:
    """Ids of the records that the operator cuts."""
    return split_oversized(df, id, **kw).filter("piece = 0 AND pieces > 1").select(id)
