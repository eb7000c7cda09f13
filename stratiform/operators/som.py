"""Self-organising map trained in batches.

The map (a few hundred prototypes) travels with the task; each epoch is one scan that
returns a sum and a count per prototype.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators.centers import Centers, _sums, assign_nearest, kmeans, n_parts, spread


def hex_grid(rows: int, cols: int) -> np.ndarray:
    """Unit positions on a hexagonal lattice: odd rows shifted by half a step."""
    return np.array([[c + 0.5 * (r % 2), r * math.sqrt(3) / 2] for r in range(rows) for c in range(cols)])


def neighbourhood(grid: np.ndarray, radius: float) -> np.ndarray:
    """Gaussian weight between every two units of the map."""
    d2 = ((grid[:, None, :] - grid[None, :, :]) ** 2).sum(axis=2)
    return np.exp(-d2 / (2.0 * radius * radius))


def radius_plan(rows: int, cols: int, rough: int, fine: int) -> list[float]:
    """Radius per epoch for a random start: a wide falling phase, then a narrow one."""
    size = max(rows, cols)
    rough_in = max(1.0, math.ceil(size / 3.0))
    fine_in = max(1.0, math.ceil(size / 12.0))
    return [
        *np.linspace(rough_in, max(1.0, rough_in / 6.0), rough).tolist(),
        *np.linspace(fine_in, max(1.0, fine_in / 25.0), fine).tolist(),
    ]


def som_epoch(df: DataFrame, codebook: Centers, grid: np.ndarray, radius: float, tasks: int) -> tuple[Centers, float]:
    """One batch update; also the summed squared distance to the old prototypes."""
    n, s, cost = _sums(df, codebook.cols, {0: codebook.points}, tasks)[0]
    h = neighbourhood(grid, radius)
    mass = h @ n
    points = np.where(mass[:, None] > 0, (h @ s) / np.where(mass > 0, mass, 1.0)[:, None], codebook.points)
    return Centers(codebook.cols, codebook.ids, points), cost


def som_fit(
    df: DataFrame,
    key: str,
    cols: Sequence[str],
    rows: int = 20,
    columns: int = 20,
    rough: int = 30,
    fine: int = 50,
    seed: int = 0,
    start: Centers | None = None,
    radii: Sequence[float] | None = None,
) -> tuple[Centers, list[float]]:
    """Codebook after all epochs, and the quantisation cost seen at each epoch. The random
    start draws prototypes uniformly within the range of each column."""
    data = spread(df.select(key, *cols), key).persist()
    try:
        if start is None:
            lo_hi = data.agg(*[F.min(c) for c in cols], *[F.max(c) for c in cols]).first()
            lo, hi = np.array(lo_hi[: len(cols)], dtype=float), np.array(lo_hi[len(cols) :], dtype=float)
            start = Centers.of(cols, lo + np.random.default_rng(seed).random((rows * columns, len(cols))) * (hi - lo))
        tasks = n_parts(data)
        grid, book, costs = hex_grid(rows, columns), start, []
        for radius in radii if radii is not None else radius_plan(rows, columns, rough, fine):
            book, cost = som_epoch(data, book, grid, radius, tasks)
            costs.append(cost)
    finally:
        data.unpersist()
    return book, costs


def som_assign(df: DataFrame, codebook: Centers) -> DataFrame:
    """Best-matching unit per row."""
    return assign_nearest(df, codebook, "unit", "sq_dist")


def som_hits(assigned: DataFrame, rows: int, columns: int) -> DataFrame:
    """``(unit, grid_row, grid_col, hits)``; units without rows stay with zero."""
    counts = assigned.groupBy("unit").agg(F.count(F.lit(1)).alias("hits"))
    units = assigned.sparkSession.range(rows * columns).select(F.col("id").cast("int").alias("unit"))
    return units.join(counts, "unit", "left").select(
        "unit",
        F.floor(F.col("unit") / columns).cast("int").alias("grid_row"),
        F.pmod(F.col("unit"), F.lit(columns)).alias("grid_col"),
        F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"),
    )


def som_segments(df: DataFrame, codebook: Centers, k: int, key: str, n_init: int = 30, seed: int = 0) -> DataFrame:
    """``(key, unit, label)``: the codebook is clustered and rows take their unit's label."""
    spark = df.sparkSession
    book = codebook.table(spark, "unit")
    centers, _ = kmeans(book, "unit", codebook.cols, k, n_init, seed)
    units = assign_nearest(book, centers).select("unit", "label")
    return som_assign(df, codebook).select(key, "unit").join(units, "unit").select(key, "unit", "label")
