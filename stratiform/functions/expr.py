"""Row-level expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_PRIME = 2_147_483_647
HASH_FACTOR = 1_103_515_245


def missing(df: DataFrame, col: str) -> Column:
    """NULL, or NaN in a floating column: both are missing everywhere in this package."""
    c = F.col(col)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)) else c.isNull()


def without_nan(df: DataFrame) -> DataFrame:
    """The same table with NULL for NaN in its floating columns."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating}) if floating else df


def count_if_across(cols: Sequence[str], pred: Callable[[Column], Column]) -> Column:
    """How many of ``cols`` satisfy ``pred`` in this row (NULL satisfies nothing)."""
    return reduce(add, (F.when(pred(F.col(c)), 1).otherwise(0) for c in cols))


def total_of(cols: Sequence[str]) -> Column:
    """Row total; NULL when any part is NULL."""
    return reduce(add, (F.col(c) for c in cols))


def split_parts(col: str, sep: str, names: Sequence[str]) -> list[Column]:
    """One column per part of ``col`` split on the literal ``sep``; missing parts are NULL."""
    parts = F.split(F.col(col), re.escape(sep))
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]


def recoded(col: Column, mapping: Mapping) -> Column:
    """Dictionary lookup as a CASE expression; values outside the mapping become NULL."""
    out = None
    for k, v in mapping.items():
        cond = col == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    if out is None:
        return F.lit(None)
    return out


def bin_label(col: Column, edges: Sequence[float], labels: Sequence[str], missing: str | None = None) -> Column:
    """Label of the right-closed interval; outside or NULL becomes ``missing``."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    out = None
    for lo, hi, name in zip(edges, edges[1:], labels):
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out if missing is None else F.coalesce(out, F.lit(missing))


def key_hash(key: Column, seed: int = 1) -> Column:
    """Multiplicative hash of an integer key on [0, 2^31 - 2]; plain arithmetic, so
    any SQL engine gives the same number."""
    k = F.pmod(key.cast("bigint") + F.lit(seed), F.lit(HASH_PRIME))
    return F.pmod(k * F.lit(HASH_FACTOR), F.lit(HASH_PRIME))


def sq_dist(cols: Sequence[str], point: Sequence[float]) -> Column:
    """Squared distance between a row and a fixed point."""
    return reduce(add, ((F.col(c) - F.lit(float(p))) * (F.col(c) - F.lit(float(p))) for c, p in zip(cols, point)))


def percent_label(count: Column, total: Column) -> Column:
    """Chart text such as ``12.5%`` over ``(1,234)``; the count is truncated from the share."""
    pct = F.try_divide(count * F.lit(100.0), total)
    absolute = F.floor(pct / F.lit(100.0) * total)
    return F.format_string("%.1f%%\n(%,d)", pct, absolute.cast("bigint"))
