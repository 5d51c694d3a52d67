"""Pairing the rows of a group without ever holding a whole hot group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one group that one task pairs with each other.
ROWS_PER_BLOCK = 2_000


def pairs_within(rows: DataFrame, key: list[str], row: str, per_block: int = ROWS_PER_BLOCK, where: str | None = None) -> DataFrame:
    """Each unordered pair of rows of one ``key``, once: columns ``a`` and ``b`` hold structs of the other columns.

    ``row`` tells the rows of a group apart and orders the pair.  A group of n rows is cut into
    ceil(n / per_block) blocks by a hash of ``row``; every two blocks meet in a task of their own, so the
    work of a hot group is spread and no task sees more than two blocks of it.
    """
    rest = [c for c in rows.columns if c not in key]
    sizes = rows.groupBy(*key).agg(F.count("*").alias("__n")).filter("__n > 1")
    spread = rows.join(sizes, key).withColumn("__blocks", F.ceil(F.col("__n") / F.lit(per_block)).cast("int"))
    spread = spread.withColumn("__own", F.pmod(F.xxhash64(row), F.col("__blocks")).cast("int"))
    spread = spread.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    spread = spread.select(
        *key,
        F.least("__own", "__other").alias("__lo"),
        F.greatest("__own", "__other").alias("__hi"),
        F.col("__own"),
        F.struct(*rest).alias("__row"),
    )
    left, right = spread.alias("l"), spread.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in [*key, "__lo", "__hi"]]
    # In a block pair (lo, hi) rows of different blocks meet; in (lo, lo) rows of the same block.
    meet = (F.col("l.__lo") == F.col("l.__hi")) | (F.col("l.__own") != F.col("r.__own"))
    joined = left.join(right, [*same, meet, F.col(f"l.__row.{row}") < F.col(f"r.__row.{row}")])
    out = joined.select(*[F.col(f"l.{c}").alias(c) for c in key], F.col("l.__row").alias("a"), F.col("r.__row").alias("b"))
    return out.filter(where) if where else out
