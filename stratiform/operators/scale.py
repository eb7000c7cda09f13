"""Z-scores with population deviation; a column without spread is divided by 1."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.session import small_table


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column: two numbers a column, kept on the driver."""

    cols: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]

    def table(self, spark) -> DataFrame:
        return small_table(spark, list(zip(self.cols, self.mean, self.std)), "`column` string, mean double, std double")


def scaler_fit(df: DataFrame, cols: Sequence[str]) -> Scaler:
    row = df.agg(
        *[
            F.struct(F.avg(F.col(c).cast("double")).alias("m"), F.stddev_pop(F.col(c).cast("double")).alias("s")).alias(c)
            for c in cols
        ]
    ).first()
    return Scaler(tuple(cols), tuple(row[c]["m"] or 0.0 for c in cols), tuple(row[c]["s"] or 1.0 for c in cols))


def scaler_apply(df: DataFrame, stats: Scaler) -> DataFrame:
    """Scale the fitted columns in place; other columns pass through."""
    scaled = {c: ((F.col(c) - m) / s).alias(c) for c, m, s in zip(stats.cols, stats.mean, stats.std)}
    return df.select(*[scaled.get(c, F.col(c)) for c in df.columns])


def scaler_invert(df: DataFrame, stats: Scaler) -> DataFrame:
    """Back to original units, for rows or for centroids."""
    raw = {c: (F.col(c) * s + m).alias(c) for c, m, s in zip(stats.cols, stats.mean, stats.std)}
    return df.select(*[raw.get(c, F.col(c)) for c in df.columns])
