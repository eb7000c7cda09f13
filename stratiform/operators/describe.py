"""Descriptive statistics: summaries, shares, histograms, densities, correlations.

Every operator is one scan with partial aggregation, or two when the second needs
the range found by the first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratiform.functions.expr import bin_label, percent_label
from stratiform.functions.quantile import quantile_values
from stratiform.functions.skew import salted_join
from stratiform.operators.columns import melt
from stratiform.session import small_table


def _rows(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return small_table(df.sparkSession, rows, schema)


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(column, p, value)``; exact, linear interpolation."""
    q = quantile_values(df, cols, probs)
    return _rows(df, [(c, float(p), v) for c in cols for p, v in zip(probs, q[c])], "`column` string, p double, value double")


_NUMERIC_SCHEMA = (
    "`column` string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
)


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of numeric columns."""
    row = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(F.col(c).cast("double")).alias("lo"),
                F.max(F.col(c).cast("double")).alias("hi"),
            ).alias(c)
            for c in cols
        ]
    ).first()
    q = quantile_values(df, cols, [0.25, 0.5, 0.75])
    rows = [(c, row[c]["n"], row[c]["mean"], row[c]["std"], row[c]["lo"], *q[c], row[c]["hi"]) for c in cols]
    return _rows(df, rows, _NUMERIC_SCHEMA)


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value (ties: lowest) and its frequency, of any
    type by its text. A column of NULLs is a row with count 0."""
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "v")
    per_value = long.groupBy("column", "v").agg(F.count("v").alias("n"))
    return per_value.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("v").alias("n_distinct"),
        F.min_by("v", F.when(F.col("v").isNotNull(), F.struct(-F.col("n"), F.col("v")))).alias("top"),
        F.max(F.when(F.col("n") > 0, F.col("n"))).alias("freq"),
    )


def describe_all(df: DataFrame) -> DataFrame:
    """Every column in one table; measures that do not apply to a type are NULL."""
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    rest = [c for c in df.columns if c not in nums]
    if not nums:
        return describe_text(df, rest)
    parts = describe_numeric(df, nums)
    return parts.unionByName(describe_text(df, rest), allowMissingColumns=True) if rest else parts


def group_count(df: DataFrame, by: str, col: str) -> DataFrame:
    """Non-null values of ``col`` per group."""
    return df.groupBy(by).agg(F.count(col).alias("n"))


def category_share(df: DataFrame, col: str, label: bool = False) -> DataFrame:
    """Rows per category and share of all rows in percent; optional chart label.

    The total is taken over the counted categories, not over the rows again.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).first()["total"] or 0
    out = counts.withColumn("pct", F.try_divide(F.col("n") * F.lit(100.0), F.lit(total)))
    return out.withColumn("label", percent_label(F.col("n"), F.lit(total))) if label else out


def sum_by_measure(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return melt(df, [], cols).groupBy("variable").agg(F.sum("value").alias("total"))


def positive_count_by_measure(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return melt(df, [], cols).filter(F.col("value") > 0).groupBy("variable").agg(F.count("value").alias("n"))


def reversal_counts(df: DataFrame, cols: Sequence[str], total_name: str = "total") -> DataFrame:
    """Negative values per column, and a grand-total row; one scan without a shuffle of rows."""
    one = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in cols])
    one = one.withColumn(total_name, sum((F.col(c) for c in cols), F.lit(0)).cast("bigint"))
    return one.unpivot([], [*cols, total_name], "variable", "n")


def reversal_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The reversed policies themselves: one row per customer and negative column."""
    return df.select("*", F.explode(F.array(*[F.when(F.col(c) < 0, F.lit(c)) for c in cols])).alias("variable")).filter(
        F.col("variable").isNotNull()
    )


def sum_by_bin(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums per bin; bins without rows stay, with zero sums."""
    bins = _rows(df, [(i, n) for i, n in enumerate(labels)], "position int, bin string")
    sums = (
        df.select(bin_label(F.col(col), edges, labels).alias("bin"), *measures)
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    return bins.join(sums, "bin", "left").select(
        "position", "bin", *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in measures]
    )


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, col: str, col_values: Sequence[str]) -> DataFrame:
    """Counts of ``row`` by the given values of ``col``; combinations without rows are NULL."""
    return df.groupBy(row).pivot(col, list(col_values)).count()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Values by frequency, highest first, ties by value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (
        df.select([F.col(c).cast("string").alias(c) for c in cols])
        .unpivot([], list(cols), "variable", "value")
        .distinct()
    )


def kde(df: DataFrame, col: str, grid: Sequence[float], by: str | None = None, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on a fixed grid, per category.

    One average per grid point in a single aggregate: rows are never multiplied by
    the grid. Scott's rule sets the bandwidth from the count and sample deviation of
    the category unless one is given. A category with one row or no spread has no
    density and gives no rows. A category may hold most of the rows: its bandwidth is
    looked up under a salt, and the averages are formed before anything is shuffled.
    """
    x = F.col(col).cast("double")
    keys = [by] if by else []
    data = df.filter(F.col(col).isNotNull()).select(*keys, x.alias("x"))
    if bandwidth is None:
        width = (F.stddev_samp("x") * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("h")
        if by:
            data = salted_join(data, data.groupBy(by).agg(width), [by], F.col("x"))
        else:
            data = data.withColumn("h", F.lit(data.agg(width).first()["h"]))
    else:
        data = data.withColumn("h", F.lit(float(bandwidth)))
    data = data.filter(F.col("h") > 0)
    scale = math.sqrt(2 * math.pi)

    def point(g: float) -> Column:
        z = (F.lit(float(g)) - F.col("x")) / F.col("h")
        return F.avg(F.exp(F.lit(-0.5) * z * z) / (F.col("h") * F.lit(scale)))

    one = data.groupBy(*keys).agg(F.array(*[point(g) for g in grid]).alias("d"))
    return one.select(*keys, F.posexplode("d").alias("position", "density")).withColumn(
        "x", F.element_at(F.array(*[F.lit(float(g)) for g in grid]), F.col("position") + 1)
    )


def _range(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    row = df.agg(
        *[F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in cols]
    ).first()
    out = {}
    for c in cols:
        lo, hi = row[c]["lo"], row[c]["hi"]
        if lo is not None and lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        out[c] = (lo, hi)
    return out


def _bin_of(c: Column, lo: float, width: float, bins: int) -> Column:
    return F.least(F.floor((c.cast("double") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed, empty bins kept."""
    ranges = {c: r for c, r in _range(df, cols).items() if r[0] is not None}
    used = list(ranges)
    tags = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column"), _bin_of(F.col(c), lo, (hi - lo) / bins, bins).alias("bin")))
        for c, (lo, hi) in ranges.items()
    ]
    counts = (
        df.select(F.explode(F.array(*tags)).alias("t"))
        .filter(F.col("t").isNotNull())
        .groupBy("t.column", "t.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = _rows(
        df,
        [(c, b, ranges[c][0] + b * ((ranges[c][1] - ranges[c][0]) / bins)) for c in used for b in range(bins)],
        "`column` string, bin int, lo double",
    )
    return frame.join(counts, ["column", "bin"], "left").select(
        "column", "bin", "lo", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def _pearson(a: str, b: str) -> Column:
    """Pearson r over the rows where both are present; NULL when either has no spread."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def joint_histogram(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Two-dimensional bin counts and the Pearson r of the pair; occupied cells only."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranges = _range(both, [x, y])
    if ranges[x][0] is None:
        return _rows(df, [], "x_bin int, y_bin int, n bigint, r double")
    r = both.agg(_pearson(x, y).alias("r")).first()["r"]
    cells = [
        _bin_of(F.col(c), ranges[c][0], (ranges[c][1] - ranges[c][0]) / bins, bins).alias(n)
        for c, n in ((x, "x_bin"), (y, "y_bin"))
    ]
    return both.select(*cells).groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n")).withColumn("r", F.lit(r).cast("double"))


def box_stats(df: DataFrame, cols: Sequence[str], lo: float, hi: float) -> DataFrame:
    """Whiskers at two quantiles, quartiles, and the rows beyond the whiskers, per column."""
    q = quantile_values(df, cols, [lo, 0.25, 0.5, 0.75, hi])
    used = [c for c in cols if q[c][0] is not None]
    row = df.agg(*[F.count_if((F.col(c) < q[c][0]) | (F.col(c) > q[c][4])).alias(c) for c in used]).first() if used else {}
    return _rows(
        df,
        [(c, *q[c], row[c] if c in used else 0) for c in cols],
        "`column` string, whisker_lo double, q1 double, median double, q3 double, whisker_hi double, n_outside bigint",
    )


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form ``(a, b, r)``, pairwise complete.

    One scan finds the columns without NULL, whose deviations serve every pair they are
    in; only pairs with gaps carry their own. A second scan takes all pairs at once.
    """
    first = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.struct(F.count(c).alias("n"), F.stddev_pop(F.col(c).cast("double")).alias("s")).alias(f"c{i}") for i, c in enumerate(cols)]
    ).first()
    dev = [first[f"c{i}"]["s"] if first[f"c{i}"]["n"] == first["rows"] else None for i in range(len(cols))]
    r: dict[tuple[int, int], float | None] = {}
    wanted = []
    for i, j in combinations_with_replacement(range(len(cols)), 2):
        if dev[i] is None or dev[j] is None:
            wanted.append(_pearson(cols[i], cols[j]).alias(f"{i}_{j}"))
        elif dev[i] * dev[j] == 0:
            r[(i, j)] = None
        elif i == j:
            r[(i, j)] = 1.0
        else:
            cov = F.covar_pop(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double"))
            wanted.append((cov / F.lit(dev[i] * dev[j])).alias(f"{i}_{j}"))
    if wanted:
        row = df.agg(*wanted).first()
        r.update({tuple(map(int, name.split("_"))): row[name] for name in row.asDict()})
    rows = [(cols[i], cols[j], r[(min(i, j), max(i, j))]) for i in range(len(cols)) for j in range(len(cols))]
    return _rows(df, rows, "a string, b string, r double")


def correlation_lower(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strict lower triangle of the matrix: ``a`` comes after ``b`` in the column order."""
    order = {c: i for i, c in enumerate(cols)}
    place = lambda name: F.element_at(F.create_map(*[F.lit(v) for kv in order.items() for v in kv]), F.col(name))
    return correlation(df, cols).filter(place("a") > place("b"))


def cumulative(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Running total in rank order, for tables whose size is the number of columns."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))
