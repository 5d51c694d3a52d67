"""Which document of the corpus a title names."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import checkpoint
from . import classify

THRESHOLD = 0.7
YEAR = re.compile(r"(?:19|20)[0-9]{2}\Z")
#: Wanted titles and titles of the corpus that one task compares with each other, and blocks of wanted ones if there are enough.
ASKED_PER_BLOCK, TITLES_PER_BLOCK, BLOCKS = 100_000, 250_000, 12


def stripped_title(title: Column) -> Column:
    """An amendment's own title without what says that it amends."""
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"(?iU)\((?:first|second|third|fourth|fifth|sixth|\d+(?:st|nd|rd|th))?\s*amendment\)?", "")
    return F.regexp_replace(t, r"(?iU)\bamendments?\b", "")


def _best_of_block(block: pa.Table) -> pa.Table:
    """The two best titles of the block for each wanted one in it that shares a word: equal scores in order of ``pos``.

    Scores are those of ``functions.text.title_score``, worked out from the places of each word, all titles at a time.
    """
    asked, titles = block.filter(block.column("asked")), block.filter(pc.invert(block.column("asked"))).sort_by([("pos", "ascending")])
    both = pa.concat_arrays([x for t in (titles, asked) for x in t.column("tokens").chunks])
    coded = both.flatten().dictionary_encode()
    word, sizes = coded.indices.to_numpy(zero_copy_only=False), pc.list_value_length(both).to_numpy(zero_copy_only=False)
    ends, n = np.cumsum(sizes), titles.num_rows
    size, held = sizes[:n], ends[n - 1] if n else 0
    of = np.repeat(np.arange(n), size)[np.argsort(word[:held], kind="stable")]  # the titles of each word, word by word
    till = np.cumsum(np.bincount(word[:held], minlength=len(coded.dictionary)))
    places = np.split(of, till[:-1]) if len(till) else []
    year = np.array([bool(YEAR.match(w)) for w in coded.dictionary.to_pylist()], bool)
    who, which, how = [], [], []
    for i, (end, k) in enumerate(zip(ends[n:], sizes[n:])):
        mine = word[end - k : end]
        counts = np.bincount(np.concatenate([places[t] for t in mine]), minlength=n) if k else np.zeros(n, int)
        met = np.flatnonzero(counts)
        common, have = counts[met], size[met]
        score = common / (have + (k - common))
        whole = (common == k) | (common == have)
        score[whole] = np.maximum(score[whole], 0.99)
        if len(years := mine[year[mine]]):
            same = np.zeros(n, bool)
            same[np.concatenate([places[t] for t in years])] = True
            score[~same[met]] *= 0.5
        for _ in range(min(2, len(met))):
            best = int(score.argmax())
            who.append(i)
            which.append(met[best])
            how.append(score[best])
            score[best] = -1
    of_asked, of_title = pa.array(who, pa.int64()), pa.array(which, pa.int64())
    found = titles.take(of_title)
    return pa.table({"wt": asked.column("tokens").take(of_asked).cast(pa.list_(pa.string())), "cand": found.column("cand"), "pos": found.column("pos"), "score": pa.array(how, pa.float64())})


def resolve(wanted: DataFrame, corpus: DataFrame, key: list[str]) -> DataFrame:
    """``key..., slug, score``: the best-scoring document for each wanted title (slug null below the threshold).

    ``wanted`` has the unique key columns, ``title`` and ``self`` (a slug to leave out, or null); ``corpus`` has unique
    ``slug``, and ``pos, title``; equal scores go to the first in corpus order.  A score depends on the sets of words
    alone, so each set is compared once, on either side; of the documents of one set the first two stand for all (one of
    them may be ``self``).  Sets are compared block by block, in arrays: no pair of titles is ever a row.
    """
    w = wanted.select(*key, "self", X.title_tokens(F.col("title")).alias("wt"))
    c = corpus.select(F.col("slug").alias("cand"), F.col("pos").cast("long").alias("pos"), X.title_tokens(F.col("title")).alias("tokens"))
    place = F.row_number().over(W.partitionBy("tokens").orderBy(F.asc_nulls_last("pos"), "cand"))
    have = c.filter(F.size("tokens") > 0).withColumn("n", place).filter("n <= 2").select(F.lit(False).alias("asked"), "tokens", "cand", "pos")
    ask = w.filter(F.size("wt") > 0).select(F.lit(True).alias("asked"), F.col("wt").alias("tokens")).distinct()
    sides = checkpoint(have.unionByName(ask, allowMissingColumns=True))
    n = {r.asked: r["count"] for r in sides.groupBy("asked").count().collect()}  # two rows
    rows = -(-n.get(True, 1) // ASKED_PER_BLOCK), -(-n.get(False, 1) // TITLES_PER_BLOCK)
    across, down = max(rows[0], min(BLOCKS, -(-n.get(True, 1) // 1000))), rows[1]
    # A wanted set has a column of its own and stands in all rows of blocks, a title the other way round.
    own = F.pmod(F.xxhash64("tokens"), F.when(F.col("asked"), F.lit(across)).otherwise(F.lit(down)))
    other = F.explode(F.when(F.col("asked"), F.sequence(F.lit(0), F.lit(down - 1))).otherwise(F.sequence(F.lit(0), F.lit(across - 1))))
    dealt = sides.select("*", own.cast("int").alias("own"), other.alias("other"))
    block = F.when(F.col("asked"), F.col("other") * across + F.col("own")).otherwise(F.col("own") * across + F.col("other"))
    best = dealt.select(block.alias("block"), "asked", "tokens", "cand", "pos").groupBy("block").applyInArrow(_best_of_block, "wt array<string>, cand string, pos bigint, score double")
    good = F.col("cand").isNotNull() & (F.col("self").isNull() | (F.col("cand") != F.col("self")))
    rank = F.when(good, F.struct("score", (-F.col("pos")).alias("p")))
    found = w.join(best.hint("merge"), "wt", "left").groupBy(*key).agg(F.max_by(F.struct("cand", "score"), rank).alias("b"))
    named = F.when(F.col("b.score") >= THRESHOLD, F.col("b.cand"))
    return found.select(*key, named.alias("slug"), F.coalesce("b.score", F.lit(0.0)).alias("score"))


def resolve_principals(parsed: DataFrame, corpus: DataFrame) -> DataFrame:
    """``doc_id, principal, slug, score`` for amendments ``doc_id, principal`` (the title they name, or null).

    The named title is looked up in the whole corpus; where that finds nothing, the amendment's own
    stripped title among documents that are no amendments.  A title that leads to the amendment itself is
    unresolved.
    """
    docs = corpus.select("slug", "pos", "title", "type")
    named = resolve(parsed.filter("principal IS NOT NULL").select("doc_id", F.col("principal").alias("title"), F.lit(None).cast("string").alias("self")), docs, ["doc_id"])
    first = parsed.select("doc_id", "principal").join(named, "doc_id", "left")
    rest = first.filter("slug IS NULL").select("doc_id").join(docs.select(F.col("slug").alias("doc_id"), "title"), "doc_id")
    own = resolve(rest.select("doc_id", stripped_title(F.col("title")).alias("title"), F.col("doc_id").alias("self")), docs.filter(~classify.is_amendment(F.col("type"), F.col("title"))), ["doc_id"])
    both = first.join(own.select("doc_id", F.col("slug").alias("own"), F.col("score").alias("own_score")), "doc_id", "left")
    slug = F.coalesce("slug", "own")
    score = F.when(F.col("slug").isNull(), F.coalesce("own_score", F.lit(0.0))).otherwise(F.col("score"))
    return both.select("doc_id", "principal", F.when(slug != F.col("doc_id"), slug).alias("slug"), score.alias("score"))


def text_variants(wanted: DataFrame, corpus: DataFrame, texts: DataFrame) -> DataFrame:
    """``slug, variant``: for principals without text the first document that has one and whose title holds all their words."""
    return first_variants(holding_titles(wanted, corpus, texts))


def first_variants(held: DataFrame) -> DataFrame:
    return held.groupBy("slug").agg(F.min_by("variant", "pos").alias("variant"))


def holding_titles(wanted: DataFrame, corpus: DataFrame, texts: DataFrame) -> DataFrame:
    """``slug, variant, pos``: all documents with a text and a title that holds all words of the wanted one's.

    ``wanted`` has ``slug`` and ``amendment`` (left out as well).  All words must be shared, so the rarest
    word of the wanted title alone finds the candidates.  The joins are by sorting: a title is many times the bytes that
    its compressed column has in a file, and by those bytes the planner would broadcast millions of titles.
    """
    docs = corpus.select(F.col("slug"), "pos", "title", "type")
    with_text = docs.filter(~classify.is_amendment(F.col("type"), F.col("title"))).join(texts.filter("coalesce(text, '') <> ''").select("slug").distinct().hint("merge"), "slug", "left_semi")
    have = with_text.select(F.col("slug").alias("variant"), "pos", X.title_tokens(F.col("title")).alias("ct"))
    words = have.select(F.explode("ct").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    want = wanted.join(docs.select("slug", "title").hint("merge"), "slug").select("slug", "amendment", X.title_tokens(F.col("title")).alias("wt")).filter(F.size("wt") > 0)
    rarest = (
        want.select("slug", "amendment", "wt", F.explode("wt").alias("token"))
        .join(words.hint("merge"), "token", "left")
        .groupBy("slug", "amendment", "wt")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("token"))
    )
    return rarest.join(have.select("variant", "pos", "ct", F.explode("ct").alias("token")).hint("merge"), "token").filter(
        (F.size(F.array_except("wt", "ct")) == 0) & (F.col("variant") != F.col("slug")) & (F.col("variant") != F.col("amendment"))
    ).select("slug", "variant", "pos")
