"""Vectorised building blocks shared by the text operators (numpy over whole Arrow batches)."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

U = np.uint64
#: Odd multiplier of the polynomial hashes modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C55
INVERSE = pow(BASE, -1, 1 << 64)
#: Separator between texts in one code-point array: a lone surrogate, which no valid text holds.
GAP = "\ud800"
#: Code points (or bytes) handled at once; bounds a worker's memory whatever the batch holds.
BLOCK = 1 << 20

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64 (kept for the next call)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK + 4096)
        out = np.empty(size, U)
        out[0] = 1
        done = 1
        step = base
        while done < size:  # doubling: the known part times base**done
            take = min(done, size - done)
            np.multiply(out[:take], U(pow(base, done, 1 << 64)), out=out[done : done + take])
            done += take
        have = _powers[base] = out
        del step
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on every input bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``symbols[start:end]`` for many spans, independent of where a span stands."""
    n = len(symbols)
    prefix = np.empty(n + 1, U)
    prefix[0] = 0
    np.cumsum((symbols.astype(U) + U(1)) * powers(BASE, n), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * powers(INVERSE, n + 1)[starts]
    return mix(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` symbols, by its first position."""
    n = len(symbols)
    if n < k:
        return np.empty(0, U)
    prefix = np.empty(n + 1, U)
    prefix[0] = 0
    np.cumsum((symbols.astype(U) + U(1)) * powers(BASE, n), out=prefix[1:])
    return mix((prefix[k:] - prefix[:-k]) * powers(INVERSE, n)[: n - k + 1])


def batches(it: Iterator[pa.RecordBatch], text: str, block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches whose ``text`` column holds about ``block`` bytes (one row at least)."""
    for batch in it:
        if batch.num_rows == 0:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(cut, cut[at] + block, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the offsets of its rows (null: empty)."""
    col = column.fill_null("") if column.null_count else column
    col = col.cast(pa.large_string())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(off) and off[-1] > off[0] else np.empty(0, np.uint8)
    return raw, off - off[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_word_class: np.ndarray | None = None


def word_class() -> np.ndarray:
    """For each code point whether it is a letter, mark or digit (Unicode categories L, M, N)."""
    global _word_class
    if _word_class is None:
        _word_class = np.fromiter((unicodedata.category(chr(c))[0] in "LMN" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _word_class


class Words:
    """The words of many texts: maximal runs of letters, marks and digits of the lower-cased text.

    ``doc``, ``start``, ``end`` and ``hash`` are per word; ``first`` has the index of each text's first
    word (one more entry than texts).  ``text`` is the lower-cased whole, so a word can be read back.
    """

    def __init__(self, texts: list[str | None]):
        self.text = (GAP.join(t or "" for t in texts)).lower()
        cp = code_points(self.text)
        inside = word_class()[cp] if len(cp) else np.empty(0, bool)
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        gaps = np.flatnonzero(cp == 0xD800)
        self.doc = np.searchsorted(gaps, self.start)
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.hash = span_hashes(cp, self.start, self.end)

    def words(self, a: int, b: int) -> list[str]:
        return [self.text[s:e] for s, e in zip(self.start[a:b], self.end[a:b])]


def ranges(lengths: np.ndarray) -> np.ndarray:
    """``0..n-1`` for each length, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def pairs_in_runs(key: np.ndarray, block: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs ``i < j`` of equal ``key`` in a sorted array, in blocks of bounded size."""
    n = len(key)
    if n < 2:
        return
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    end = np.concatenate([begin[1:], [n]])
    last = np.repeat(end, end - begin)  # end of each element's run
    later = last - np.arange(n) - 1  # partners after each element
    total = np.cumsum(later)
    at = 0
    while at < n:
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + block, side="right")))
        for lo in range(0, int(later[at]) if to == at + 1 else 1, block):  # one element with more than a block of partners
            if to == at + 1:
                j = np.arange(at + 1 + lo, at + 1 + min(int(later[at]), lo + block))
                i = np.full(len(j), at)
            else:
                i = np.repeat(np.arange(at, to), later[at:to])
                j = i + 1 + ranges(later[at:to])
            if len(i):
                yield i, j
        at = to
