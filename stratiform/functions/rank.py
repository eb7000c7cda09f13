"""Row numbers that do not need a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratiform.session import cut_lineage


def ranked(df: DataFrame, order: Sequence[str], group: str | None = None, out: str = "rank") -> DataFrame:
    """1-based position of each row in ``order``, within ``group`` if given.

    Rows are range-partitioned by group and order, so one heavy group spreads over
    many tasks; each task numbers its own stretch and adds the rows before it, which
    come from one count per stretch. ``order`` must end in a unique column.
    """
    keys: list[str] = [group] if group else []
    placed = df.repartitionByRange(*[F.col(c) for c in [*keys, *order]]).withColumn("__part", F.spark_partition_id())
    placed = cut_lineage(placed)
    stretch = ["__part", *keys]
    counts = placed.groupBy(*stretch).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part") if not keys else Window.partitionBy(*keys).orderBy("__part")
    offsets = counts.select(
        *stretch,
        F.coalesce(F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
    )
    local: Column = F.row_number().over(Window.partitionBy(*stretch).orderBy(*order))
    return (
        placed.withColumn("__local", local)
        .join(offsets, stretch)
        .withColumn(out, F.col("__before") + F.col("__local"))
        .drop("__part", "__local", "__before")
    )
