"""Problem 9: repetition inside a single document, with host-level rules.

Each document is measured on its own (words, repeated sequences of six words, repeated lines and
sentences); each measure is held against a rule.  The failures are counted per host (the documents' source),
the hosts' failure rates are shrunk by a beta prior fitted to all hosts, and the verdict on the host is
joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from ._arrays import Words, batches, mix, powers

SEQUENCE = 6
LEAST_WORDS = 30
MOST_REPEATED = 0.4
#: Rules on the share of characters in repeated sentences and paragraphs.
MOST_IN_SENTENCES = 0.3
MOST_IN_PARAGRAPHS = 0.3
#: A host is bad if its shrunk failure rate is at least this.
BAD_HOST = 0.1
_U = np.uint64
_SENTENCE = regex.compile(r"[^.!?।\n]+[.!?।]*")

SCHEMA = "key {key}, n_words long, repeated_words long, repeated_share double, sentence_share double, paragraph_share double"


def repeated_words(words: Words, n_docs: int, n: int = SEQUENCE) -> np.ndarray:
    """Per document the number of words that stand in a sequence of ``n`` words found there twice or more."""
    total = len(words.hash)
    if total < n:
        return np.zeros(n_docs, np.int64)
    gram = np.zeros(total - n + 1, _U)
    for i, p in enumerate(powers(0xC2B2AE3D27D4EB4F, n)):
        gram += words.hash[i : total - n + 1 + i] * p
    whole = words.doc[: total - n + 1] == words.doc[n - 1 :]
    at = np.flatnonzero(whole)
    doc = words.doc[at]
    # Equal sequences of one document lie side by side after the sort; the document is part of the key.
    key = mix(mix(gram[at]) + doc.astype(_U) * _U(0x9E3779B97F4A7C15))
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = at[order[twice]]
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + n, -1)
    return np.bincount(words.doc[np.cumsum(change[:-1]) > 0], minlength=n_docs)


def _share(parts: list[str]) -> float:
    """Share of the characters that stand in parts occurring twice or more."""
    if len(parts) < 2 or len(set(parts)) == len(parts):
        return 0.0
    seen: dict[str, int] = {}
    for p in parts:
        seen[p] = seen.get(p, 0) + 1
    return sum(len(p) for p in parts if seen[p] > 1) / max(1, sum(map(len, parts)))


def measure(df: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), n: int = SEQUENCE) -> DataFrame:
    """Measures of each row; null, empty and wordless texts have 0 words and shares of 0."""
    kind = df.schema[key].dataType.simpleString()
    kept = [(c, df.schema[c].dataType.simpleString()) for c in carry]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, "text"):
            texts = batch.column("text").to_pylist()
            words = Words(texts)
            count = np.diff(words.first)
            repeated = repeated_words(words, len(texts), n)
            sentences = [_share([s.strip() for s in _SENTENCE.findall(t) if s.strip()]) if t else 0.0 for t in texts]
            paragraphs = [_share([p.strip() for p in t.split("\n") if p.strip()]) if t else 0.0 for t in texts]
            columns = [batch.column("key"), pa.array(count), pa.array(repeated), pa.array(repeated / np.maximum(count, 1)), pa.array(sentences), pa.array(paragraphs)]
            columns += [batch.column(f"c{i}") for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "repeated_words", "repeated_share", "sentence_share", "paragraph_share", *(f"c{i}" for i in range(len(kept)))])

    schema = SCHEMA.format(key=kind) + "".join(f", c{i} {t}" for i, (_, t) in enumerate(kept))
    rows = df.select(df[key].alias("key"), df[text].alias("text"), *(df[c].alias(f"c{i}") for i, (c, _) in enumerate(kept)))
    out = rows.mapInArrow(run, schema).withColumnRenamed("key", key)
    for i, (c, _) in enumerate(kept):
        out = out.withColumnRenamed(f"c{i}", c)
    return out


def with_rules(measures: DataFrame, least_words: int = LEAST_WORDS, most: float = MOST_REPEATED) -> DataFrame:
    """Adds the rules' failures.  The share of repeated words is compared as whole numbers, so 0.4 is exact."""
    parts = 1000
    long_enough = F.col("n_words") >= least_words
    return measures.withColumns(
        {
            "fails_sequences": long_enough & (F.col("repeated_words") * parts >= F.col("n_words") * round(most * parts)),
            "fails_sentences": long_enough & (F.col("sentence_share") >= MOST_IN_SENTENCES),
            "fails_paragraphs": long_enough & (F.col("paragraph_share") >= MOST_IN_PARAGRAPHS),
        }
    ).withColumn("fails", F.col("fails_sequences") | F.col("fails_sentences") | F.col("fails_paragraphs"))


def host_verdicts(ruled: DataFrame, host: str, bad: float = BAD_HOST) -> DataFrame:
    """``host, host_docs, host_fails, host_rate, host_bad``: failure rates shrunk by an empirical beta prior.

    The prior's two parameters come from the mean and variance of the hosts' raw rates (method of
    moments over all hosts, each weighing as many documents as it has); with fewer than two hosts or no
    variance the prior is the overall rate with the weight of one document.  Counts are partial
    aggregates, so a host with a third of the rows costs one row per task.
    """
    per_host = ruled.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_docs"), F.sum(F.col("fails").cast("long")).alias("host_fails"))
    rate = F.col("host_fails") / F.col("host_docs")
    moments = per_host.agg(
        F.sum("host_docs").alias("n"),
        F.sum("host_fails").alias("k"),
        F.count("*").alias("hosts"),
        (F.sum(F.col("host_docs") * rate * rate) / F.sum("host_docs")).alias("m2"),
    )
    mean = F.col("k") / F.col("n")
    between = F.col("m2") - mean * mean - mean * (1 - mean) * F.col("hosts") / F.col("n")  # less the binomial noise
    weight = F.when((F.col("hosts") > 1) & (between > 0), F.greatest(F.lit(1.0), mean * (1 - mean) / between - 1)).otherwise(F.lit(1.0))
    prior = moments.select(mean.alias("m"), weight.alias("w"))
    shrunk = (F.col("host_fails") + F.col("m") * F.col("w")) / (F.col("host_docs") + F.col("w"))
    joined = per_host.join(F.broadcast(prior))  # the prior is a single row
    return joined.select("host", "host_docs", "host_fails", shrunk.alias("host_rate"), (shrunk >= bad).alias("host_bad"))


def document_repetition(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", least_words: int = LEAST_WORDS, most: float = MOST_REPEATED, bad: float = BAD_HOST) -> DataFrame:
    """One row per row of ``df``: measures, rule failures and the verdict on its host (null hosts form one host).

    The measures (numbers only) are checkpointed, so texts are read and measured once.  The join is on the
    host; the verdicts are one row per host and the rows of a hot host are split by adaptive execution,
    as the measures side may be.  Repeated rows are measured like any other.
    """
    ruled = checkpoint(with_rules(measure(df, key, text, (host,)), least_words, most))
    verdicts = host_verdicts(ruled, host, bad)
    return ruled.join(verdicts, ruled[host].eqNullSafe(verdicts["host"])).drop("host")


def repetitive_documents(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Ids of the documents whose six-word sequences repeat beyond the rule."""
    return document_repetition(df, key, text, host).filter("fails_sequences").select(key).distinct()
