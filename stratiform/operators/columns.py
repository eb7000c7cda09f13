"""Projections, joins, stacking and other relational operators on columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.expr import bin_label, count_if_across, recoded, split_parts, total_of


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    return df.toDF(*names)


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def split_column(df: DataFrame, col: str, sep: str, names: Sequence[str]) -> DataFrame:
    """Add one column per part of ``col`` split on a literal separator."""
    return df.select("*", *split_parts(col, sep, names))


def cast_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes NULL."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def recode(df: DataFrame, col: str, mapping: Mapping) -> DataFrame:
    """Replace values by dictionary; unmapped values become NULL."""
    return df.withColumn(col, recoded(F.col(col), mapping))


def fill_null(df: DataFrame, cols: Sequence[str], value) -> DataFrame:
    return df.fillna(value, subset=list(cols))


def count_across(df: DataFrame, cols: Sequence[str], pred: Callable[[Column], Column], out: str) -> DataFrame:
    """Per row: how many of ``cols`` satisfy ``pred``."""
    return df.withColumn(out, count_if_across(cols, pred))


def share_across(df: DataFrame, cols: Sequence[str], num_pred, den_pred, out: str) -> DataFrame:
    """Per row: columns meeting ``num_pred`` over columns meeting ``den_pred``; 0/0 is NULL."""
    return df.withColumn(out, F.try_divide(count_if_across(cols, num_pred), count_if_across(cols, den_pred)))


def tenure(df: DataFrame, year_col: str, as_of_year: int, out: str = "cust_tenure") -> DataFrame:
    """Years between the start year and a stated year (never the clock: results must repeat)."""
    return df.withColumn(out, F.lit(as_of_year) - F.col(year_col))


def row_total(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Row-wise sum; NULL if any part is NULL."""
    return df.withColumn(out, total_of(cols))


def paid_amount(rate: str = "claims_rate", total: str = "total_premiums") -> Column:
    return F.col(rate) * F.col(total)


def acquisition_cost(
    total: str = "total_premiums",
    paid: str = "amt_paidby_comp",
    years: str = "cust_tenure",
    value: str = "customer_monetary_value",
) -> Column:
    return (F.col(total) - F.col(paid)) * F.col(years) - F.col(value)


def wage_ratio(total: str = "total_premiums", salary: str = "gross_monthly_salary") -> Column:
    return F.try_divide(F.col(total), F.col(salary) * 12)


def value_features(df: DataFrame, premiums: Sequence[str], as_of_year: int) -> DataFrame:
    """All derived value columns, written as stacked projections Catalyst folds into one."""
    out = count_across(df, premiums, lambda c: c > 0, "active_premiums")
    out = share_across(out, premiums, lambda c: c < 0, lambda c: c != 0, "cancelled_premiums_pct")
    out = tenure(out, "policy_creation_year", as_of_year)
    out = row_total(out, premiums, "total_premiums")
    out = out.withColumn("amt_paidby_comp", paid_amount())
    out = out.withColumn("cust_acq_cost", acquisition_cost())
    return out.withColumn("premium_wage_ratio", wage_ratio())


def shares_of_total(df: DataFrame, cols: Sequence[str], total: str) -> DataFrame:
    """Add ``<col>_pct`` = col / total for each column; a zero total gives NULL."""
    return df.select("*", *[F.try_divide(F.col(c), F.col(total)).alias(f"{c}_pct") for c in cols])


def columns_by_type(df: DataFrame, key: str) -> tuple[list[str], list[str]]:
    """Names of the categorical and of the numeric columns, the key left out."""
    cat, num = [], []
    for f in df.schema.fields:
        if f.name == key:
            continue
        if isinstance(f.dataType, T.StringType):
            cat.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
    return cat, num


def split_by_type(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The categorical half and the numeric half, each with the key."""
    cat, num = columns_by_type(df, key)
    return df.select(key, *cat), df.select(key, *num)


def feature_view(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    return df.select(key, *cols)


def melt(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable", value: str = "value"
) -> DataFrame:
    """Wide to long. Only the named columns are read from the source."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), var, value
    )


def model_features(df: DataFrame, key: str, premiums: Sequence[str]) -> DataFrame:
    """The nine unscaled model columns: value measures plus premium shares."""
    keep = ["customer_monetary_value", "claims_rate", "cancelled_premiums_pct", "premium_wage_ratio"]
    return df.select(
        key, *keep, *[F.try_divide(F.col(c), F.col("total_premiums")).alias(f"{c}_pct") for c in premiums]
    )


def cut(
    df: DataFrame,
    col: str,
    edges: Sequence[float],
    labels: Sequence[str],
    out: str,
    missing: str | None = None,
) -> DataFrame:
    """Right-closed labelled bins; outside every bin is NULL or the ``missing`` text."""
    return df.withColumn(out, bin_label(F.col(col), edges, labels, missing))


def left_join(a: DataFrame, b: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Left equi-join on the key; other columns both sides share get suffixes."""
    shared = [c for c in a.columns if c in b.columns and c != key]
    left = a.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = b.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return left.join(right, key, "left")


def attach(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Put the columns of ``other`` beside ``df`` by row identity."""
    return df.join(other, key, "left")


def attach_labels(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Add the ``label`` column of a ``(key, label)`` table."""
    return df.join(labels.select(key, "label"), key, "inner")


def bottom_k(df: DataFrame, col: str, k: int, key: str) -> DataFrame:
    """The ``k`` rows with the lowest non-null value, ties by key."""
    return df.filter(F.col(col).isNotNull()).orderBy(F.col(col).asc(), F.col(key).asc()).limit(k)


def stack(*dfs: DataFrame) -> DataFrame:
    """Stack by column name; a column one side lacks is NULL there."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
