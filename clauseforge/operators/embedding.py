"""Embeddings of chunks behind a language gate, with the model passed in, and nearest neighbours by cosine."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from .chunking import HINDI_GATE

# Dimension and batch size of the encoder.
DIMENSION, BATCH = 384, 64
#: texts -> unit vectors, one row each
Encoder = Callable[[list[str]], np.ndarray]


def hashing_encoder(dimension: int = DIMENSION) -> Encoder:
    """A deterministic stand-in for a model: hashed words, unit length (zero for texts without words)."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension), np.float32)
        for row, text in zip(out, texts):
            for word in re.findall(r"\w+", text.lower()):
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                row[h % dimension] += 1.0 if h >> 63 else -1.0
            n = np.linalg.norm(row)
            if n:
                row /= n
        return out

    return encode


def embed(chunks: DataFrame, make_encoder: Callable[[], Encoder] = hashing_encoder, text: str = "content") -> DataFrame:
    """Adds ``embedding array<float>``: null where the text is null or too much of it is Devanagari.

    The gate is a JVM expression in front of the Python step, which sees gated texts as null; the encoder
    is made once per task and called with batches of 64.
    """
    allowed = F.col(text).isNotNull() & (X.devanagari_share(F.col(text)) < HINDI_GATE)
    rows = chunks.withColumn("__text", F.when(allowed, F.col(text)))
    schema = T.StructType([*chunks.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        for batch in it:
            texts = batch.column("__text").to_pylist()
            at = [i for i, t in enumerate(texts) if t is not None]
            vectors: list = [None] * len(texts)
            for k in range(0, len(at), BATCH):
                part = at[k : k + BATCH]
                for i, v in zip(part, encode([texts[i] for i in part])):
                    vectors[i] = np.asarray(v, np.float32)
            kept = batch.select([n for n in batch.schema.names if n != "__text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(vectors, pa.list_(pa.float32()))], [*kept.schema.names, "embedding"])

    return rows.mapInArrow(run, schema)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", block: int = 1024) -> DataFrame:
    """``query, neighbour, score, rank``: the ``k`` nearest other rows of each query by cosine (exact, ties by key).

    Queries are packed into matrices of ``block`` rows; every partition of ``vectors`` is compared with each
    matrix by one product and keeps its own best k, so what is shuffled is k rows per query and partition.
    Query blocks are read one at a time by the driver; where there are several, a block's neighbours are checkpointed
    and its broadcast is dropped before the next is read.  Null vectors have no neighbours.
    """
    from ..session import checkpoint

    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<float>").alias("v")).filter("key IS NOT NULL AND v IS NOT NULL")
    asked = queries.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<float>").alias("v")).filter("key IS NOT NULL AND v IS NOT NULL").distinct()
    n = asked.count()
    parts = max(1, -(-n // block))
    asked = checkpoint(asked.withColumn("__part", F.pmod(F.xxhash64("key"), F.lit(parts)))) if parts > 1 else asked.withColumn("__part", F.lit(0))
    out: DataFrame | None = None
    for part in range(parts):
        held = asked.filter(F.col("__part") == part).select("key", "v").collect()  # about ``block`` vectors
        if not held:
            continue
        ids = np.array([r["key"] for r in held])
        matrix = np.array([r["v"] for r in held], np.float64)
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-30)
        shared = spark.sparkContext.broadcast((ids, matrix))

        def near(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, matrix = shared.value
            best_k, best_s = np.empty((len(ids), 0), np.int64), np.empty((len(ids), 0))
            for batch in it:
                if not batch.num_rows:
                    continue
                keys = batch.column("key").to_numpy()
                v = np.array(batch.column("v").to_pylist(), np.float64)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-30)
                score = np.round(matrix @ v.T, 9)
                score[ids[:, None] == keys[None, :]] = -np.inf
                all_k, all_s = np.concatenate([best_k, np.broadcast_to(keys, score.shape)], axis=1), np.concatenate([best_s, score], axis=1)
                order = np.lexsort((all_k, -all_s), axis=1)[:, :k]
                best_k, best_s = np.take_along_axis(all_k, order, 1), np.take_along_axis(all_s, order, 1)
            ok = np.isfinite(best_s)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, ok.sum(axis=1))), pa.array(best_k[ok]), pa.array(best_s[ok])], ["query", "neighbour", "score"])

        found = rows.mapInArrow(near, "query long, neighbour long, score double")
        if parts > 1:
            found = checkpoint(found)
            shared.unpersist()
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query long, neighbour long, score double, rank int")
    from pyspark.sql import Window as W

    order = W.partitionBy("query").orderBy(F.desc("score"), "neighbour")
    return out.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
