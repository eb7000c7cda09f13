"""Exact quantiles that never put a whole column into one task.

``F.percentile`` keeps every distinct value of a column in one aggregation buffer.
That is the shorter plan while the row count is known to be small; beyond ``SMALL_ROWS`` the
values are located by narrowing brackets: every pass counts the rows per bucket of
the brackets still open (partial counts per task, a few hundred rows shuffled) and
keeps the bucket holding the wanted rank, until that bucket holds one distinct
value or few enough rows to list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 100_000
LIST_ROWS = 100_000
BUCKETS = 512


def _column_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    """Non-null count, minimum and maximum of every column, in one scan."""
    row = df.agg(
        *[
            F.struct(F.count(c).alias("n"), F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
            for c in cols
        ]
    ).first()
    return {c: (row[c]["n"], row[c]["lo"], row[c]["hi"]) for c in cols}


def _by_percentile(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    row = df.agg(*[F.percentile(c, F.array(*map(F.lit, probs))).alias(c) for c in cols]).first()
    return {c: (list(row[c]) if row[c] is not None else [None] * len(probs)) for c in cols}


def _order_statistics(
    df: DataFrame, wanted: dict[str, set[int]], bounds: dict[str, tuple[int, float, float]], small_rows: int
) -> dict[tuple[str, int], float]:
    """Value at each 0-based rank of each column, by bracket narrowing."""
    found: dict[tuple[str, int], float] = {}
    # (column, rank) -> (low end, high end, rows below the bracket, rows inside it)
    open_: dict[tuple[str, int], tuple[float, float, int, int]] = {}
    for c, ranks in wanted.items():
        n, lo, hi = bounds[c]
        for r in ranks:
            open_[(c, r)] = (lo, hi, 0, n)
    while open_:
        for target, (lo, hi, _, _) in list(open_.items()):
            if lo == hi:
                found[target] = lo
                del open_[target]
        if not open_:
            break
        brackets = sorted({(c, lo, hi, below, inside) for (c, _), (lo, hi, below, inside) in open_.items()})
        tags = []
        for i, (c, lo, hi, _, inside) in enumerate(brackets):
            x = F.col(c).cast("double")
            if inside <= min(small_rows, LIST_ROWS) // len(brackets):
                part = x
            else:
                width = hi / BUCKETS - lo / BUCKETS
                part = F.least(F.floor((x - lo) / width), F.lit(BUCKETS - 1)).cast("double") if width > 0 else x
            tags.append(F.when((x >= lo) & (x <= hi), F.struct(F.lit(i).alias("b"), part.alias("p"), x.alias("x"))))
        hit = F.filter(F.array(*tags), lambda t: t.isNotNull())
        cells = (
            df.select(F.explode(hit).alias("t"))
            .groupBy("t.b", "t.p")
            .agg(F.count(F.lit(1)).alias("n"), F.min("t.x").alias("lo"), F.max("t.x").alias("hi"))
            .collect()
        )
        by_bracket: dict[int, list] = {}
        for cell in cells:
            by_bracket.setdefault(cell["b"], []).append(cell)
        index = {b[:3]: i for i, b in enumerate(brackets)}
        for target, (lo, hi, below, _) in list(open_.items()):
            seen = below
            for cell in sorted(by_bracket[index[(target[0], lo, hi)]], key=lambda t: t["lo"]):
                if target[1] < seen + cell["n"]:
                    open_[target] = (cell["lo"], cell["hi"], seen, cell["n"])
                    break
                seen += cell["n"]
    return found


def quantile_values(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], small_rows: int | None = None
) -> dict[str, list]:
    """Linear-interpolation quantiles of each column, NULL ignored; all columns together."""
    small_rows = SMALL_ROWS if small_rows is None else small_rows
    bounds = _column_bounds(df, cols)
    if all(b[0] <= small_rows for b in bounds.values()):
        return _by_percentile(df, cols, probs)
    wanted: dict[str, set[int]] = {}
    for c, (n, _, _) in bounds.items():
        if n:
            wanted[c] = {f((n - 1) * p) for p in probs for f in (math.floor, math.ceil)}
    at = _order_statistics(df, wanted, bounds, small_rows)
    out = {}
    for c, (n, _, _) in bounds.items():
        vals = []
        for p in probs:
            if not n:
                vals.append(None)
                continue
            h = (n - 1) * p
            a, b = at[(c, math.floor(h))], at[(c, math.ceil(h))]
            # The same arithmetic as F.percentile, so both routes give the same digits.
            vals.append(a if a == b else (math.ceil(h) - h) * a + (h - math.floor(h)) * b)
        out[c] = vals
    return out
