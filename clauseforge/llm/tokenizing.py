"""Problem 7: encoding of the whole corpus with a public byte-level BPE vocabulary.

Texts are cut into words by the vocabulary's pattern; the words an Arrow batch brings that the worker has
not met yet are encoded together: their symbols lie in one flat array, and each round looks all adjacent
pairs up by binary search over the sorted pair keys, then merges every word's lowest-ranked pairs from
left to right.  Words with nothing left to merge leave the array.  Null and empty texts give an empty list.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._arrays import batches, ranges

VOCABULARY = os.environ.get("CLAUSEFORGE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
#: Fixed value: the pattern by which byte-level BPE vocabularies of this family cut a text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words a worker remembers the ids of; a full memory is emptied, which costs time only.
REMEMBERED = 400_000


def printable_bytes() -> dict[str, int]:
    """The characters by which the vocabulary file writes bytes: itself if printable, else 256 + n in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        into = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.into = keys[order], order.astype(np.int64), into[order]
        self.byte_id = np.zeros(256, np.int64)
        for ch, b in printable_bytes().items():
            self.byte_id[b] = vocab[ch]
        self.split = regex.compile(pattern).findall
        self.slot: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)  # ids of all remembered words end to end
        self.at = np.zeros(1, np.int64)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words`` end to end, and how many each has."""
        raw = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        sym = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), size)
        done_sym: list[np.ndarray] = []
        done_word: list[np.ndarray] = []
        none = np.int64(1) << 40
        while len(sym):
            key = (sym[:-1] << 32) | sym[1:]
            spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[spot] == key) & (word[:-1] == word[1:])
            rank = np.full(len(sym), none)
            rank[:-1][hit] = self.rank[spot[hit]]
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            length = np.diff(np.concatenate([begin, [len(sym)]]))
            best = np.repeat(np.minimum.reduceat(rank, begin), length)
            open_ = best < none
            if not open_.all():  # words with nothing left to merge leave
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                if not open_.any():
                    break
                spot = np.concatenate([spot, [0]])[open_]
                sym, word, rank, best = sym[open_], word[open_], rank[open_], best[open_]
            chosen = rank == best
            # Of overlapping pairs (a run such as "aaaa") every second one counts, from the left.
            run = np.flatnonzero(chosen & ~np.concatenate([[False], chosen[:-1]]))
            where = np.flatnonzero(chosen)
            first = run[np.searchsorted(run, where, side="right") - 1]
            where = where[(where - first) % 2 == 0]
            sym[where] = self.into[spot[where]]
            keep = np.ones(len(sym), bool)
            keep[where + 1] = False
            sym, word = sym[keep], word[keep]
        sym, word = np.concatenate([*done_sym, sym[:0]]), np.concatenate([*done_word, word[:0]])
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.int32), np.bincount(word, minlength=len(raw))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` end to end, and the number of ids of each."""
        if len(self.slot) > REMEMBERED:
            self.slot, self.ids, self.at = {}, np.empty(0, np.int32), np.zeros(1, np.int64)
        slot, split = self.slot, self.split
        flat: list[str] = []
        count = np.zeros(len(texts), np.int64)
        for n, t in enumerate(texts):
            if t:
                words = split(t)
                count[n] = len(words)
                flat += words
        known = len(slot)
        index = np.fromiter((slot.setdefault(w, len(slot)) for w in flat), np.int64, len(flat))
        if len(slot) > known:
            fresh = list(slot)[known:]
            ids, sizes = self.merge(fresh)
            self.ids = np.concatenate([self.ids, ids])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        sizes = self.at[index + 1] - self.at[index]
        out = self.ids[np.repeat(self.at[index], sizes) + ranges(sizes)]
        per_word = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(count)
        return out, per_word[ends] - per_word[ends - count]


_encoders: dict[tuple[str, str], Encoder] = {}


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``key, ids``: one row for each row of ``df`` (repeated rows stay repeated), no special tokens.

    Special tokens' strings inside a text are ordinary text.  Null and empty texts give an empty list; a
    null key stays null.  Further columns of ``df`` are not read.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get((path, pattern)) or _encoders.setdefault((path, pattern), Encoder(path, pattern))
        for batch in batches(it, "text"):
            ids, sizes = encoder.encode(batch.column("text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], ["key", "ids"])

    rows = df.select(df[key].alias("key"), df[text].alias("text"))
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)
