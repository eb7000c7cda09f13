"""Missing values, validation rules, fences and table comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions.expr import missing
from stratiform.functions.quantile import quantile_values


def _any_null(df: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(or_, (missing(df, c) for c in cols))


def _long(one_row: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    return one_row.unpivot([], list(names), "column", value)


def drop_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Remove rows holding a known bad literal; NULL rows stay."""
    return df.filter(F.coalesce(~F.col(col).isin(*values), F.lit(True)))


def drop_null_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing value; with ``null_rows`` they make up the whole table."""
    return df.filter(~_any_null(df, cols or df.columns))


def null_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Only the rows with a missing value somewhere."""
    return df.filter(_any_null(df, cols or df.columns))


def fences(df: DataFrame, cols: Sequence[str], lo: float, hi: float) -> dict[str, tuple]:
    """Lower and upper quantile of each column."""
    q = quantile_values(df, cols, [lo, hi])
    return {c: (q[c][0], q[c][1]) for c in cols}


def outside_condition(bounds: Mapping[str, tuple]) -> Column:
    """True when any column lies beyond its fence; NULL is never outside."""
    conds = [
        F.coalesce((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)), F.lit(False))
        for c, (lo, hi) in bounds.items()
        if lo is not None
    ]
    return reduce(or_, conds) if conds else F.lit(False)


def quantile_fence(df: DataFrame, cols: Sequence[str], lo: float, hi: float) -> tuple[DataFrame, DataFrame]:
    """Rows inside all fences, and rows outside any. The fences enter the filter as
    constants, so both halves are narrow scans without a join."""
    cond = outside_condition(fences(df, cols, lo, hi))
    return df.filter(~cond), df.filter(cond)


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: share of missing values in percent, two decimals."""
    one = df.agg(*[F.round(F.avg(missing(df, c).cast("int")) * 100, 2).alias(c) for c in df.columns])
    return _long(one, df.columns, "pct_null")


def zero_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: share equal to zero in percent; NULL counts as not zero."""
    one = df.agg(
        *[F.round(F.avg(F.coalesce((F.col(c) == 0).cast("int"), F.lit(0))) * 100, 2).alias(c) for c in cols]
    )
    return _long(one, cols, "pct_zero")


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing cells in total, sum of the column percentages, and row count."""
    cells = reduce(lambda a, b: a + b, (missing(df, c).cast("bigint") for c in df.columns))
    return df.agg(F.sum(cells).alias("missing_cells"), F.count(F.lit(1)).alias("n_rows")).select(
        "missing_cells",
        F.round(F.try_divide(F.col("missing_cells"), F.col("n_rows")) * 100, 2).alias("sum_pct"),
        "n_rows",
    )


def dropna_impact(df: DataFrame) -> DataFrame:
    """Rows before and after dropping rows with a NULL, rows lost, and the share lost."""
    return df.agg(
        F.count(F.lit(1)).alias("before"), F.count_if(~_any_null(df, df.columns)).alias("after")
    ).select(
        "before",
        "after",
        (F.col("before") - F.col("after")).alias("lost"),
        F.round(F.try_divide(F.col("before") - F.col("after"), F.col("before")) * 100, 2).alias("lost_pct"),
    )


def rule_max(col: str, limit) -> Column:
    """Violated when ``col`` exceeds ``limit``."""
    return F.coalesce(F.col(col) > F.lit(limit), F.lit(False))


def rule_in_set(col: str, values: Sequence) -> Column:
    """Violated when ``col`` is outside the set; NULL is a violation."""
    return ~F.coalesce(F.col(col).isin(*values), F.lit(False))


def rule_min_gap(later: str, earlier: str, gap: int) -> Column:
    """Violated when ``later`` comes before ``earlier + gap``."""
    return F.when(F.col(later) < F.col(earlier) + gap, True).otherwise(False)


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule ``(rule, violations, passed)``; every rule is counted in one scan."""
    one = df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])
    return one.unpivot([], list(rules), "rule", "violations").withColumn("passed", F.col("violations") == 0)


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """How many rows share their key with another row (every copy counts)."""
    return (
        df.groupBy(key)
        .count()
        .agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("duplicate_rows"))
    )


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """Are two tables equal as bags of rows? Schema check plus rows only on one side.

    Both sides are reduced to distinct rows with a signed count before the only
    shuffle, so heavy repetition of one row costs nothing.
    """
    same_schema = [(f.name, f.dataType) for f in a.schema.fields] == [
        (f.name, f.dataType) for f in b.schema.fields
    ]
    if sorted(a.columns) != sorted(b.columns):
        counts = a.agg(F.count(F.lit(1)).alias("only_left")).withColumn("k", F.lit(1))
        other = b.agg(F.count(F.lit(1)).alias("only_right")).withColumn("k", F.lit(1))
        out = counts.join(other, "k").drop("k")
    else:
        sides = a.withColumn("__side", F.lit(1)).unionByName(b.withColumn("__side", F.lit(-1)))
        out = (
            sides.groupBy(*a.columns)
            .agg(F.sum("__side").alias("__d"))
            .agg(
                F.coalesce(F.sum(F.greatest(F.col("__d"), F.lit(0))), F.lit(0)).alias("only_left"),
                F.coalesce(F.sum(F.greatest(-F.col("__d"), F.lit(0))), F.lit(0)).alias("only_right"),
            )
        )
    return out.select(
        F.lit(same_schema).alias("same_schema"),
        "only_left",
        "only_right",
        (F.lit(same_schema) & (F.col("only_left") == 0) & (F.col("only_right") == 0)).alias("equal"),
    )
