"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.session import cut_lineage, small_table

SALTS = 16
SHARES = 16


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join where ``big`` may repeat a key any number of times and ``small`` has it rarely:
    the rows of a key are dealt over ``salts`` partitions and ``small`` is repeated there."""
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    dealt = big.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = small.withColumn("__salt", F.explode(F.array(*map(F.lit, range(salts)))))
    return dealt.join(copies, [*on, "__salt"], how).drop("__salt")


def key_shares(big: DataFrame, on: Sequence[str], shares: int, counts: str | None = None) -> DataFrame:
    """``(name, shares)`` of the keys that hold more than one ``shares``-th of the rows; fewer
    than ``shares`` keys can. The share of a key is its rows over that bound. ``counts`` names
    a column with the rows each row of ``big`` stands for, if they are already counted."""
    weight = F.lit(1) if counts is None else F.col(counts)
    sizes = big.groupBy(F.xxhash64(*on).alias("name")).agg(F.sum(weight).cast("double").alias("n"))
    sizes = cut_lineage(sizes)
    least = (sizes.agg(F.sum("n")).first()[0] or 0.0) / shares
    heavy = sizes.filter(F.col("n") > least).select("name", F.ceil(F.col("n") / max(least, 1.0)).cast("int").alias("shares"))
    return small_table(big.sparkSession, [tuple(r) for r in heavy.collect()], "name bigint, shares int")


def counted_join(big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Column, how: str = "inner", counted: DataFrame | None = None, counts: str | None = None) -> DataFrame:
    """As ``salted_join``, with as many shares per key as its rows ask for: none for most keys,
    whose row of ``small`` travels once, and for a heavy key one share for each
    ``1 / (SHARES * shuffle partitions)`` of the rows. One pass over ``big`` counts the keys,
    or ``counted`` holds them with their rows in ``counts``. Both sides need the same key types."""
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    kinds = [[side.schema[c].dataType for c in on] for side in (big, small)]
    if kinds[0] != kinds[1]:
        raise TypeError(f"key types differ: {kinds}")
    parts = SHARES * int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = key_shares(big if counted is None else counted, on, parts, counts).toDF("__name", "__shares")
    known = lambda side: side.withColumn("__name", F.xxhash64(*on)).join(heavy, "__name", "left")
    share = F.pmod(F.xxhash64(spread_by), F.coalesce("__shares", F.lit(1)))
    dealt = known(big).withColumn("__salt", share.cast("int")).drop("__name", "__shares")
    copies = known(small).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__shares", F.lit(1)) - 1))).drop("__name", "__shares")
    return dealt.join(copies, [*on, "__salt"], how).drop("__salt")


def paired(left: DataFrame, right: DataFrame, on: Sequence[str]):
    """Cogroup of two tables on ``on``, dealt over all shuffle partitions. Work on pairs of
    blocks is large where its rows are few, so partitions must not be joined for their size."""
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    renamed = right.select(*[F.col(c).alias(f"__of_{c}") for c in on], *[c for c in right.columns if c not in on])
    return left.repartition(parts, *on).groupBy(*on).cogroup(renamed.repartition(parts, *[f"__of_{c}" for c in on]).groupBy(*[f"__of_{c}" for c in on]))
