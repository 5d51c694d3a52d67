"""Problem 8: evaluation texts inside training text, by Wu-Manber multi-pattern search over words.

Every run of 13 consecutive words of an item is a pattern.  The search looks at blocks of two words: the
shift table says how far the window may move on when the block at its end stands nowhere near the end of
a pattern (12 words if it stands in no pattern at all); at shift 0 the hash table gives the patterns that
end with this block, and their words are compared one by one.  All documents of a batch move on together.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint
from ._arrays import Words, batches, ranges

RUN = 13
#: Code points of items searched for at once.  Items beyond that are searched in further passes over the documents.
ITEMS_PER_PASS = 20_000_000


class Patterns:
    """Shift and hash tables of all runs of ``run`` words of the items."""

    def __init__(self, ids: list[int], texts: list[str | None], run: int = RUN):
        w = Words(texts)
        self.run = run
        self.vocabulary, self.ids = np.unique(w.hash, return_inverse=True)
        self.size = len(self.vocabulary) + 1
        self.ids = self.ids + 1  # 0 is a word of no item
        count = np.diff(w.first)
        runs = np.maximum(count - run + 1, 0)
        start = np.repeat(w.first[:-1], runs) + ranges(runs)
        item = np.repeat(np.arange(len(texts)), runs)
        self.item_ids = np.asarray(ids, np.int64)
        # Equal runs are one pattern; owners of pattern p are owner[own[p]:own[p + 1]].
        rows = self.ids[start[:, None] + np.arange(run)] if len(start) else np.empty((0, run), np.int64)
        self.rows, which = np.unique(rows, axis=0, return_inverse=True)
        which = which.reshape(-1)
        order = np.lexsort((item, which))
        keep = order[np.concatenate([[True], (which[order][1:] != which[order][:-1]) | (item[order][1:] != item[order][:-1])])] if len(order) else order
        self.owner = item[keep]
        self.own = np.searchsorted(which[keep], np.arange(len(self.rows) + 1))
        sample = np.full(len(self.rows), 0)
        sample[which] = start
        self.words = [w.words(s, s + run) for s in sample]
        # Shift of a block: the least distance between its end and a pattern's end.
        blocks = self.rows[:, :-1] * self.size + self.rows[:, 1:] if len(self.rows) else np.empty((0, run - 1), np.int64)
        shift = np.tile(np.arange(run - 2, -1, -1), len(self.rows))
        flat = blocks.reshape(-1)
        by = np.lexsort((shift, flat))
        self.block, first = np.unique(flat[by], return_index=True)
        self.shift = shift[by][first]
        # Patterns sorted by the block at their end.
        last = blocks[:, -1] if len(self.rows) else np.empty(0, np.int64)
        self.by_suffix = np.argsort(last, kind="stable")
        self.suffix = last[self.by_suffix]

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, position of the first word, and pattern of each occurrence."""
        none = np.empty(0, np.int64)
        if not len(self.rows):
            return none, none, none
        spot = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        ids = np.where(self.vocabulary[spot] == words.hash, spot + 1, 0)
        stop = words.first[1:]
        doc = np.flatnonzero(np.diff(words.first) >= self.run)
        if not len(doc):  # only empty or short texts
            return none, none, none
        pos = words.first[doc] + self.run - 1  # last word of the window
        ends: list[np.ndarray] = []
        while len(doc):
            code = ids[pos - 1] * self.size + ids[pos]
            at = np.minimum(np.searchsorted(self.block, code), len(self.block) - 1)
            shift = np.where(self.block[at] == code, self.shift[at], self.run - 1)
            stay = shift == 0
            ends.append(pos[stay])
            pos = pos + np.where(stay, 1, shift)
            on = pos < stop[doc]
            doc, pos = doc[on], pos[on]
        end = np.sort(np.concatenate(ends))
        code = ids[end - 1] * self.size + ids[end]
        lo, hi = np.searchsorted(self.suffix, code), np.searchsorted(self.suffix, code, side="right")
        n = hi - lo
        end, pattern = np.repeat(end, n), self.by_suffix[np.repeat(lo, n) + ranges(n)]
        for back in range(self.run - 1, 1, -1):  # from the first word on; most candidates fall at once
            same = ids[end - back] == self.rows[pattern, self.run - 1 - back]
            end, pattern = end[same], pattern[same]
        begin = end - self.run + 1
        true = np.fromiter((words.words(b, b + self.run) == self.words[p] for b, p in zip(begin, pattern)), bool, len(begin))
        return words.doc[begin[true]], begin[true], pattern[true]


def _groups(items: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The items in ranges of ids of at most ``limit`` code points (or one id), each read when it is asked for."""
    rows = items.select(F.col(item).alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL").distinct()
    if (rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0) <= limit:
        yield [(r["id"], r["text"]) for r in rows.collect()]
        return
    rows = checkpoint(rows)
    firsts, held = [], limit
    # Ids and sizes pass the driver one partition at a time; only the ranges' beginnings are kept.
    for r in rows.groupBy("id").agg(F.sum(F.length("text")).alias("n")).orderBy("id").toLocalIterator():
        if held + r["n"] > limit:
            firsts.append(r["id"])
            held = 0
        held += r["n"]
    for lo, hi in zip(firsts, [*firsts[1:], None]):
        part = rows.filter(F.col("id") >= lo) if hi is None else rows.filter((F.col("id") >= lo) & (F.col("id") < hi))
        yield [(r["id"], r["text"]) for r in part.collect()]


_built: dict[tuple, Patterns] = {}


def _patterns(name: tuple, group: list[tuple[int, str]], run: int) -> Patterns:
    """The tables of a group, built once per worker and kept until another group comes."""
    if name not in _built:
        _built.clear()
        _built[name] = Patterns([i for i, _ in group], [t for _, t in group], run)
    return _built[name]


def leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", run: int = RUN, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """``key, item, n_runs, matched_words``: documents that hold ``run`` consecutive words of an item.

    ``n_runs`` counts the places where a run of the item begins, ``matched_words`` the words of the
    document inside such runs.  Items (a held-out set that does not grow) are read by the driver in
    groups of bounded size, one at a time, with one pass over the documents each, whose rows are checkpointed
    before the next group is read.  Null, empty and shorter texts match
    nothing; a null document or item id is left out; rows of one document id are taken together.
    """
    spark: SparkSession = documents.sparkSession
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key].alias("key"), documents[text].alias("text")).filter("key IS NOT NULL AND text IS NOT NULL")
    out: DataFrame | None = None
    several, last = False, None
    for group in _groups(items, item, item_text, items_per_pass):
        if last is not None:
            out = checkpoint(found) if not several else checkpoint(out.unionByName(found))
            several = True
            last.unpersist()
        shared = last = spark.sparkContext.broadcast(group)  # at most items_per_pass code points
        name = (uuid.uuid4().hex, run)

        def run_batches(it: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            patterns = _patterns(name, shared.value, run)
            for batch in batches(it, "text"):
                words = Words(batch.column("text").to_pylist())
                doc, begin, pattern = patterns.search(words)
                n = patterns.own[pattern + 1] - patterns.own[pattern]
                owner = patterns.owner[np.repeat(patterns.own[pattern], n) + ranges(n)]
                doc, begin = np.repeat(doc, n), np.repeat(begin, n)
                order = np.lexsort((begin, owner, doc))
                doc, begin, owner = doc[order], begin[order], owner[order]
                new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1])]) if len(doc) else np.empty(0, bool)
                step = np.where(new, patterns.run, np.minimum(np.diff(begin, prepend=0), patterns.run)) if len(doc) else begin
                at = np.flatnonzero(new)
                runs = np.diff(np.concatenate([at, [len(doc)]])) if len(at) else at
                covered = np.add.reduceat(step, at) if len(at) else at
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(doc[at])), pa.array(patterns.item_ids[owner[at]]), pa.array(runs, pa.int64()), pa.array(covered, pa.int64())],
                    ["key", "item", "n_runs", "matched_words"],
                )

        found = rows.mapInArrow(run_batches, f"key {kind}, item long, n_runs long, matched_words long")
    out = out.unionByName(found) if several else found
    merged = out.groupBy("key", "item").agg(F.sum("n_runs").alias("n_runs"), F.sum("matched_words").alias("matched_words"))
    return merged.withColumnsRenamed({"key": key, "item": item}) if key != item else merged


def leaked_pairs(documents: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """Distinct ``doc_id, item_id``."""
    return leaks(documents, items, **kw).select("doc_id", "item_id")
