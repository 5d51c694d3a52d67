"""Problem 4: visually identical text in different characters, brought to one form.

First compatibility forms that differ in width only (and ligatures, one-character numerals) are resolved,
accents composed one way, ignorable characters deleted and all spaces made one.  Then every letter that has
the shape of a Latin one stands for its *skeleton*.  Texts that look the same have the same skeleton.  A
token whose skeleton holds a letter found in Cyrillic or Greek only is a lattice of spellings: each
position may be any letter of that shape, in Latin or in a script the token has such a letter of.  Viterbi
picks the spelling with the best character bigrams, learned from all texts, within one script; changing
scripts inside a token costs extra.  The choice depends on the skeleton alone, so equal skeletons stay equal.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from ._arrays import GAP, batches, code_points
from ._blocks import pairs_within
from ._postings import count_rows, count_table

# Letters in the shape of Latin ones, each above the Latin letter it looks like.
CYRILLIC = "АВСЕНІЈКМОРЅТХҮԚԜѴаԁеһіјорԛѕсѵԝху"
CYR_LATIN = "ABCEHIJKMOPSTXYQWVadehijopqscvwxy"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿονϲϳ"
GRK_LATIN = "ABEZHIKMNOPTYXCJovcj"
SHAPE = dict(zip(CYRILLIC + GREEK, CYR_LATIN + GRK_LATIN))
LATIN, CYR, GRK = 0, 1, 2
#: Characters a worker's table knows letters by: Latin, Cyrillic and Greek letters, at most this many.
ALPHABET = 1024
SWITCH = 12.0


def _visible_format(c: str) -> bool:
    """Format characters that are drawn (number signs and the like)."""
    return 0x600 <= ord(c) <= 0x605 or ord(c) in (0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD)


def _ignorable(c: str) -> bool:
    o, kind = ord(c), unicodedata.category(c)
    if kind == "Cf":
        return not _visible_format(c)
    if kind == "Cc":
        return c not in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85"
    return o in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0x180B <= o <= 0x180F or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF


def _plain(c: str) -> str | None:
    """What ``c`` becomes by itself, or None if it stays.  Raised digits, fractions and the like stay."""
    if _ignorable(c):
        return ""
    if unicodedata.category(c) == "Zs":
        return " " if c != " " else None
    tag = unicodedata.decomposition(c).partition(" ")[0]
    if tag in ("<wide>", "<narrow>", "<noBreak>"):
        return "".join(_plain(x) if _plain(x) is not None else x for x in unicodedata.normalize("NFKC", c))
    name = unicodedata.name(c, "")
    if tag == "<compat>" and ("LIGATURE" in name or "ROMAN NUMERAL" in name or "DIGRAPH" in name):
        return unicodedata.normalize("NFKC", c)
    return None


def _tables() -> tuple[dict[int, str], re.Pattern]:
    table = {ord(c): s for c, s in SHAPE.items()}
    for o in range(sys.maxunicode + 1):
        if not 0xD800 <= o <= 0xDFFF and (p := _plain(chr(o))) is not None:
            table[o] = p
    # Accented Greek and Cyrillic letters have a look-alike below their accent.
    runs, last = [], None
    for o in sorted({*table, *range(0x370, 0x400), *range(0x400, 0x530), *range(0x1F00, 0x2000)}):
        if last is not None and o == last[1] + 1:
            last[1] = o
        else:
            last = [o, o]
            runs.append(last)
    return table, re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in runs) + "]")


_cache: dict[str, object] = {}


def tables() -> tuple[dict[int, str], re.Pattern]:
    if "tables" not in _cache:
        _cache["tables"] = _tables()
    return _cache["tables"]


def skeleton(text: str) -> str:
    """The text with every character replaced by the plainest one of its look."""
    table, special = tables()
    if special.search(text):
        # Marks come off first, so that an accented look-alike letter is replaced as well.
        text = unicodedata.normalize("NFD", text).translate(table)
    elif text.isascii():
        return text
    return unicodedata.normalize("NFC", text)


def script_of(o: int) -> int | None:
    c = chr(o)
    if not c.isalpha():
        return None
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return LATIN
    if 0x400 <= o < 0x530:
        return CYR
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return GRK
    return None


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Index of each letter of the three scripts (0: none), and the script by index."""
    have = [o for o in range(0x2000) if script_of(o) is not None][: ALPHABET * 4]
    index = np.zeros(sys.maxunicode + 1, np.int16)
    index[have] = np.arange(1, len(have) + 1)
    return index, np.array([-1] + [script_of(o) for o in have])


_ANCHOR = regex.compile(r"[\p{Cyrillic}\p{Greek}]")
_TOKEN = regex.compile(r"[\p{Latin}\p{Cyrillic}\p{Greek}\p{M}]+")


class Model:
    """Character bigrams of the three scripts: log scores from counts over all texts."""

    BITS = 18  # table of 2**18 hashed bigrams; three alphabets have some 10**5 that occur

    def __init__(self, counts: np.ndarray | None = None):
        self.counts = counts
        self.seen: dict[str, str] = {}
        self.total = float(counts.sum()) if counts is not None else 0.0

    @staticmethod
    def cell(a, b):  # noqa: ANN001, ANN205 - whole numbers or arrays of them
        return (a * 40503 ^ b * 9973 ^ (b >> 5)) & ((1 << Model.BITS) - 1)

    def score(self, a: str, b: str) -> float:
        n = float(self.counts[self.cell(ord(a) if a else 1, ord(b))]) if self.counts is not None else 0.0
        return math.log((n + 0.1) / (self.total + 1e5))

    def spell(self, token: str) -> str:
        """The best spelling of a skeleton token (NFC); tokens without a letter of a foreign script stay."""
        if token in self.seen:
            return self.seen[token]
        plain = unicodedata.normalize("NFD", token)
        scripts = {LATIN} | {s for c in plain if (s := script_of(ord(c))) is not None}
        states: list[list[tuple[str, int]]] = []
        for c in plain:
            own = script_of(ord(c))
            options = [(c, own if own is not None else -1)]
            if own == LATIN:
                options += [(x, CYR) for x, y in zip(CYRILLIC, CYR_LATIN) if y == c and CYR in scripts]
                options += [(x, GRK) for x, y in zip(GREEK, GRK_LATIN) if y == c and GRK in scripts]
            states.append(options)
        best: list[tuple[float, str, str, int]] = [(0.0, "", "", -1)]  # score, spelling, last letter, last script
        for options in states:
            step = []
            for c, s in options:
                if s == -1:  # a mark belongs to the letter before it
                    step += [(v, w + c, last, k) for v, w, last, k in best]
                    continue
                step.append(max((v + self.score(last, c) - (SWITCH if k not in (-1, s) else 0.0), w + c, c, s) for v, w, last, k in best))
            best = step
        out = unicodedata.normalize("NFC", max(best)[1])
        if len(self.seen) > 200_000:
            self.seen.clear()
        self.seen[token] = out
        return out

    def canonical(self, text: str) -> str:
        text = skeleton(text)
        if text.isascii() or not _ANCHOR.search(text):
            return text
        return _TOKEN.sub(lambda m: self.spell(m[0]) if _ANCHOR.search(m[0]) else m[0], text)


def learn(df: DataFrame, text: str = "content") -> Model:
    """Bigram counts of letters of one script over all rows (null texts have none)."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, script = _letters()
        total = np.zeros(1 << Model.BITS, np.int64)
        for batch in batches(it, "text"):
            cp = code_points(GAP.join(t or "" for t in batch.column("text").to_pylist())).astype(np.int64)
            s = script[index[cp]]
            same = (s[1:] == s[:-1]) & (s[1:] >= 0)
            first = np.concatenate([s[:1] >= 0, (s[1:] >= 0) & (s[:-1] < 0)])
            cells = np.concatenate([Model.cell(cp[:-1][same], cp[1:][same]), Model.cell(1, cp[first])])
            total += np.bincount(cells, minlength=len(total))
        yield count_rows(total, TaskContext.get().partitionId())

    rows = df.select(df[text].alias("text")).filter("text IS NOT NULL")
    return Model(count_table(rows.mapInArrow(count, "slice int, part int, counts binary"), Model.BITS))


def canonical_texts(df: DataFrame, id: str = "id", text: str = "content") -> DataFrame:
    """``id, content`` in the one form, for each row of ``df``; null and empty texts stay as they are."""
    kind = df.schema[id].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(learn(df, text))  # a table of fixed size

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches(it, "text"):
            out = [t if t is None else model.canonical(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], ["id", "content"])

    return df.select(df[id].alias("id"), df[text].alias("text")).mapInArrow(run, f"id {kind}, content string").withColumnsRenamed({"id": id, "content": text})


def _digests(df: DataFrame, id: str, text: str) -> DataFrame:
    """``id, stored, same``: 128-bit digests of the stored and of the one form; texts with nothing to see are left out."""
    kind = df.schema[id].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(learn(df, text))

    def digest(t: str) -> bytes:
        return hashlib.blake2b(t.encode("utf-8"), digest_size=16).digest()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches(it, "text"):
            at, stored, same = [], [], []
            for n, t in enumerate(batch.column("text").to_pylist()):
                form = model.canonical(t)
                if form and not form.isspace():
                    at.append(n)
                    stored.append(digest(t))
                    same.append(stored[-1] if form == t else digest(form))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), pa.array(stored, pa.binary()), pa.array(same, pa.binary())], ["id", "stored", "same"])

    rows = df.select(df[id].alias("id"), df[text].alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, f"id {kind}, stored binary, same binary")


def lookalike_pairs(df: DataFrame, id: str = "id", text: str = "content") -> DataFrame:
    """Pairs of records ``id_a < id_b`` whose texts differ as stored and have one form.

    Null ids, null texts and texts with nothing visible are in no pair; repeated rows count once.
    """
    rows = checkpoint(_digests(df, id, text).distinct())
    mixed = rows.groupBy("same").agg(F.min("stored").alias("lo"), F.max("stored").alias("hi")).filter("lo <> hi").select("same")
    pairs = pairs_within(rows.join(mixed, "same").select("same", "id", "stored"), ["same"], "id", where="a.stored <> b.stored")
    return pairs.select(F.col("a.id").alias(f"{id}_a"), F.col("b.id").alias(f"{id}_b")).distinct()
