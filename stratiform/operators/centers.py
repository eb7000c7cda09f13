"""Nearest-center kernels and k-means.

Rows stay where they are: tasks hold the (few) centers, and what is shuffled is one
partial sum per task and center. Restarts and different k are trained side by side,
so thirty starts of eight values of k cost as many scans as the slowest one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.expr import HASH_PRIME, key_hash
from stratiform.operators.pca import pca_project
from stratiform.session import small_table

INLINE_TERMS = 400
SEEDS_PER_CENTER = 20
SEED_ROUNDS = 4
DIRECT_ROWS = 100_000
PART_ROWS = 250_000
_CHUNK_CELLS = 1 << 18  # 2 MB of distances at a time: bounded memory, and it stays in the cache
_MANY = 16


@dataclass(frozen=True)
class Centers:
    """A bounded table of points: ids in ascending order, one row of ``points`` each."""

    cols: tuple[str, ...]
    ids: tuple[int, ...]
    points: np.ndarray

    @staticmethod
    def of(cols: Sequence[str], points: np.ndarray) -> Centers:
        return Centers(tuple(cols), tuple(range(len(points))), np.asarray(points, dtype=float))

    def table(self, spark: SparkSession, id_col: str = "label") -> DataFrame:
        schema = f"`{id_col}` int, " + ", ".join(f"`{c}` double" for c in self.cols)
        return small_table(spark, [(int(i), *map(float, p)) for i, p in zip(self.ids, self.points)], schema)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances, summed column by column as SQL would."""
    d = np.zeros((len(x), len(points)))
    for j in range(points.shape[1]):
        d += (x[:, j, None] - points[None, :, j]) ** 2
    return d


def within(x: np.ndarray, points: np.ndarray, reach: float) -> np.ndarray:
    """``distances(x, points) <= reach * reach``, by one product; pairs too close to the bound for
    its rounding are measured column by column."""
    out = np.zeros((len(x), len(points)), dtype=bool)
    own, theirs = (x * x).sum(axis=1), (points * points).sum(axis=1)
    limit = reach * reach
    slack = 1e-12 * (own.max(initial=0.0) + theirs.max(initial=0.0) + limit)
    back = -2.0 * points.T
    for part in _chunks(len(x), len(points)):
        d = x[part] @ back
        d += theirs
        d += own[part, None] - limit
        np.less_equal(d, 0.0, out=out[part])
        i, j = np.nonzero(~(np.abs(d, out=d) > slack))
        if len(i):
            at, apart = i + part.start, np.zeros(len(i))
            for c in range(x.shape[1]):
                apart += (x[at, c] - points[j, c]) ** 2
            out[at, j] = apart <= limit
    return out


def _chunks(n: int, width: int) -> Iterator[slice]:
    step = max(1, _CHUNK_CELLS // max(1, width))
    for i in range(0, n, step):
        yield slice(i, i + step)


def assign_nearest(df: DataFrame, centers: Centers, label: str = "label", dist: str = "sq_dist") -> DataFrame:
    """Add the id of the nearest center (ties: lowest id) and the squared distance.

    Few centers become one generated expression; many are compared in Arrow batches.
    """
    cols, points, ids = list(centers.cols), centers.points, centers.ids
    if points.size <= INLINE_TERMS:
        options = [
            F.struct(
                reduce(
                    add,
                    ((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(cols, p)),
                ).alias("d"),
                F.lit(int(i)).alias("i"),
            )
            for i, p in zip(ids, points)
        ]
        best = options[0] if len(options) == 1 else F.least(*options)
        return df.select("*", best.alias("__b")).select(*df.columns, F.col("__b.i").alias(label), F.col("__b.d").alias(dist))

    id_array = np.array(ids, dtype=np.int32)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            at, away = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
            for part in _chunks(len(x), len(points)):
                d = distances(x[part], points)
                at[part] = d.argmin(axis=1)
                away[part] = d.min(axis=1)
            pdf[label], pdf[dist] = id_array[at], away
            yield pdf

    schema = T.StructType(
        df.schema.fields + [T.StructField(label, T.IntegerType()), T.StructField(dist, T.DoubleType())]
    )
    return df.mapInPandas(nearest, schema)


def update_centers(assigned: DataFrame, cols: Sequence[str], label: str = "label", weight: str | None = None) -> DataFrame:
    """Mean of the members of each center, weighted if asked; one small shuffle by label."""
    if weight is None:
        aggs = [F.avg(c).alias(c) for c in cols]
        return assigned.groupBy(label).agg(*aggs, F.count(F.lit(1)).alias("n"))
    aggs = [F.try_divide(F.sum(F.col(c) * F.col(weight)), F.sum(weight)).alias(c) for c in cols]
    return assigned.groupBy(label).agg(*aggs, F.sum(weight).alias("n"))


def lloyd_rounds(df: DataFrame, start: Centers, rounds: int) -> Centers:
    """A fixed number of assign-and-update rounds from given start points; a center
    that loses all members stays where it is."""
    now = start
    for _ in range(rounds):
        rows = update_centers(assign_nearest(df, now), list(now.cols)).collect()
        moved = {r["label"]: [r[c] for c in now.cols] for r in rows}
        points = np.array([moved.get(i, list(p)) for i, p in zip(now.ids, now.points)], dtype=float)
        now = Centers(now.cols, now.ids, points)
    return now


def seed_points(df: DataFrame, cols: Sequence[str], key: str, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates for start points drawn from all rows, and how many rows each stands for.

    Each round scans the rows once and draws ``SEEDS_PER_CENTER * k`` of them without
    replacement, with probability proportional to the squared distance to what was drawn
    before (the first round: any row). So a small far group is found whatever the number of
    rows. The draw is by key hash: a row's place in the order of ``-log(u) / distance**2``.
    """
    cols, each = list(cols), SEEDS_PER_CENTER * k
    drawn = np.zeros((0, len(cols)))
    for round_ in range(SEED_ROUNDS):
        known = drawn

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                x, u = pdf[cols].to_numpy(dtype=float), pdf["__u"].to_numpy()
                near = np.ones(len(x))
                if len(known):
                    for part in _chunks(len(x), len(known)):
                        near[part] = distances(x[part], known).min(axis=1)
                with np.errstate(divide="ignore"):
                    pdf["__e"] = np.where(near > 0, -np.log(u) / near, np.inf)
                yield pdf[["__e", "__u", *cols]]

        u = (key_hash(F.col(key), seed + 7919 * round_) + 1) / (HASH_PRIME + 1)
        rows = df.select(u.alias("__u"), *cols).mapInPandas(place, "__e double, __u double, " + ", ".join(f"`{c}` double" for c in cols))
        best = rows.filter("__e < double('infinity')").orderBy("__e", "__u", *cols).limit(each).select(*cols)
        more = best.toPandas().to_numpy(dtype=float)
        if not len(more):
            break
        drawn = np.unique(np.concatenate([drawn, more]), axis=0)
    if not len(drawn):
        return drawn, np.zeros(0)
    weight, _, _ = _sums(df, cols, {0: drawn}, n_parts(df))[0]
    return drawn, weight


def plus_plus(sample: np.ndarray, k: int, rng: np.random.Generator, weight: np.ndarray | None = None) -> np.ndarray:
    """Start points drawn with probability proportional to the squared distance to
    the points already drawn, times the weight."""
    weight = np.ones(len(sample)) if weight is None else weight
    first = rng.choice(len(sample), p=weight / weight.sum())
    chosen, nearest = [sample[first]], ((sample - sample[first]) ** 2).sum(axis=1)
    while len(chosen) < k:
        share = nearest * weight
        total = share.sum()
        pick = rng.choice(len(sample), p=share / total) if total > 0 else rng.integers(len(sample))
        chosen.append(sample[pick])
        nearest = np.minimum(nearest, ((sample - sample[pick]) ** 2).sum(axis=1))
    return np.array(chosen)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows evenly by key: one part per core at least, and more once a part would
    exceed ``PART_ROWS``. Every later scan of the cached rows keeps all cores busy, and
    tables derived from it join on the key without another shuffle."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PART_ROWS))
    return df.repartition(parts, key)


def n_parts(df: DataFrame) -> int:
    """Tasks a scan of ``df`` takes; asked once before a loop."""
    return df.rdd.getNumPartitions()


def add_up(parts: DataFrame, keys: Sequence[str], values: Sequence[str], most_rows: int) -> pd.DataFrame:
    """Total of per-task partial sums. At most ``DIRECT_ROWS`` rows in all come straight
    to the driver; beyond that the tasks add them up first."""
    if most_rows <= DIRECT_ROWS:
        return parts.toPandas().groupby(list(keys), as_index=False)[list(values)].sum()
    return parts.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values]).toPandas()


def _member_sums(xt: np.ndarray, terms: np.ndarray, back: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Members, cost and coordinate sums per center of the rows in the columns of ``xt``.
    ``terms`` holds ones, squared lengths and coordinates; ``back`` is the centers times -2 and
    ``norm`` their squared lengths. Ties go to the lowest center."""
    k, own = len(back), terms[1]
    if k > _MANY:
        d = xt.T @ back.T
        d += norm
        at = d.argmin(axis=1)
        cost = np.maximum(d[np.arange(len(d)), at] + own, 0.0)
        return np.stack([np.bincount(at, v, k) for v in (terms[0], cost, *terms[2:])], axis=1)
    d = back @ xt
    d += norm[:, None]
    low = d.min(axis=0)
    member = d == low
    if np.count_nonzero(member) != len(low):
        member = d.argmin(axis=0) == np.arange(k)[:, None]
    member = member.astype(float)
    out = member @ terms.T
    out[:, 1] = member @ np.maximum(low + own, 0.0)
    return out


def _sums(df: DataFrame, cols: Sequence[str], runs: dict[int, np.ndarray], tasks: int) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One scan for all runs: members, coordinate sums and cost per run and center."""
    cols = list(cols)
    names = [f"s{j}" for j in range(len(cols))]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = {r: np.zeros((len(c), 2 + len(cols))) for r, c in runs.items()}
        held = {r: (-2.0 * c, (c * c).sum(axis=1)) for r, c in runs.items()}
        for pdf in batches:
            x_all = pdf.to_numpy(dtype=float)
            for part in _chunks(len(x_all), max(len(c) for c in runs.values())):
                xt = np.ascontiguousarray(x_all[part].T)
                terms = np.vstack([np.ones(xt.shape[1]), (xt * xt).sum(axis=0), xt])
                for r, (back, norm) in held.items():
                    acc[r] += _member_sums(xt, terms, back, norm)
        rows = [
            (r, i, int(total[i, 0]), *map(float, total[i, 1:]))
            for r, total in acc.items()
            for i in range(len(total))
            if total[i, 0] > 0
        ]
        yield pd.DataFrame(rows, columns=["run", "center", "n", "cost", *names])

    schema = "run int, center int, n bigint, cost double, " + ", ".join(f"{s} double" for s in names)
    parts = df.select(*cols).mapInPandas(partial, schema)
    total = add_up(parts, ["run", "center"], ["n", "cost", *names], tasks * sum(len(c) for c in runs.values()))
    out = {r: (np.zeros(len(c)), np.zeros((len(c), len(cols))), 0.0) for r, c in runs.items()}
    for run, rows in total.groupby("run"):
        n, s, _ = out[run]
        n[rows["center"]] = rows["n"]
        s[rows["center"]] = rows[names]
        out[run] = (n, s, float(rows["cost"].sum()))
    return out


def train_runs(
    df: DataFrame, cols: Sequence[str], starts: Sequence[np.ndarray], max_iter: int = 300, tol: float = 1e-4
) -> list[tuple[np.ndarray, float]]:
    """Lloyd rounds for many start sets at once; ``(centers, cost)`` per start set.

    A run leaves the scan when its centers move less than ``tol`` times the mean
    column variance; one last scan prices every run at its final centers.
    """
    var = df.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
    tasks = n_parts(df)
    limit = tol * float(np.mean([v or 0.0 for v in var]))
    centers = {i: np.array(s, dtype=float) for i, s in enumerate(starts)}
    live = dict(centers)
    for _ in range(max_iter):
        if not live:
            break
        sums = _sums(df, cols, live, tasks)
        for run in list(live):
            n, s, _ = sums[run]
            new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], live[run])
            moved = float(((new - live[run]) ** 2).sum())
            centers[run] = live[run] = new
            if moved <= limit:
                del live[run]
    final = _sums(df, cols, centers, tasks)
    return [(centers[i], final[i][2]) for i in range(len(starts))]


def _ordered(points: np.ndarray) -> np.ndarray:
    """Centers in coordinate order, so equal solutions get equal labels."""
    return points[np.lexsort(points.T[::-1])]


def kmeans_many(
    df: DataFrame, key: str, cols: Sequence[str], ks: Sequence[int], n_init: int = 30, seed: int = 0, max_iter: int = 300,
    starts: Mapping[int, Sequence[np.ndarray]] | None = None, tol: float = 1e-4,
) -> dict[int, tuple[Centers, float]]:
    """Best of ``n_init`` starts for every ``k``, all trained in the same scans. ``starts``
    gives the start points of each k instead of drawing them."""
    data = spread(df.select(key, *cols), key).persist()
    try:
        if starts is None:
            sample, weight = seed_points(data, cols, key, max(ks), seed)
            rng = np.random.default_rng(seed)
            plan = [(k, plus_plus(sample, k, rng, weight)) for k in ks for _ in range(n_init if k > 1 else 1)]
        else:
            plan = [(k, s) for k in ks for s in starts[k]]
        fitted = train_runs(data, cols, [s for _, s in plan], max_iter, tol)
    finally:
        data.unpersist()
    best: dict[int, tuple[Centers, float]] = {}
    for (k, _), (points, cost) in zip(plan, fitted):
        if k not in best or cost < best[k][1]:
            best[k] = (Centers.of(cols, _ordered(points)), cost)
    return best


def kmeans(df: DataFrame, key: str, cols: Sequence[str], k: int, n_init: int = 30, seed: int = 0, **how) -> tuple[Centers, float]:
    """Centers and cost (sum of squared distances) of the best of ``n_init`` starts; ``how``
    as in ``kmeans_many``."""
    return kmeans_many(df, key, cols, [k], n_init, seed, **how)[k]


def elbow(df: DataFrame, key: str, cols: Sequence[str], k_max: int, n_init: int = 30, seed: int = 0, **how) -> DataFrame:
    """``(k, sse)`` for k = 1 .. k_max inclusive. k = 1 is the total sum of squares, in
    closed form; the rest share their scans."""
    one = df.agg(*[(F.var_pop(c) * F.count(c)).alias(c) for c in cols]).first()
    rows = [(1, float(sum(one)))]
    if k_max > 1:
        fits = kmeans_many(df, key, cols, range(2, k_max + 1), n_init, seed, **how)
        rows += [(k, fits[k][1]) for k in sorted(fits)]
    return small_table(df.sparkSession, rows, "k int, sse double")


def compare_init(df: DataFrame, cols: Sequence[str], methods: Sequence[str], k: int, seed: int = 0, max_iter: int = 100) -> DataFrame:
    """``(method, label, <center columns>, size, cost)`` for the start methods Spark ML offers."""
    vec = VectorAssembler(inputCols=list(cols), outputCol="features").transform(df.select(*cols)).select("features").persist()
    rows = []
    try:
        for m in methods:
            model = KMeans(k=k, initMode=m, maxIter=max_iter, seed=seed).fit(vec)
            sizes = model.summary.clusterSizes
            for i, c in enumerate(model.clusterCenters()):
                rows.append((m, i, *map(float, c), int(sizes[i]), float(model.summary.trainingCost)))
    finally:
        vec.unpersist()
    schema = "method string, label int, " + ", ".join(f"{c} double" for c in cols) + ", size bigint, cost double"
    return small_table(df.sparkSession, rows, schema)


def compare_init_labels(df: DataFrame, key: str, cols: Sequence[str], methods: Sequence[str], k: int, seed: int = 0, max_iter: int = 100) -> DataFrame:
    """``(method, key, label)``: the labels behind ``compare_init``, every row once for each
    start method."""
    found = compare_init(df, cols, methods, k, seed, max_iter).collect()
    out = None
    for m in methods:
        mine = sorted((r for r in found if r["method"] == m), key=lambda r: r["label"])
        centers = Centers(tuple(cols), tuple(r["label"] for r in mine), np.array([[r[c] for c in cols] for r in mine]))
        part = assign_nearest(df.select(key, *cols), centers).select(F.lit(m).alias("method"), key, "label")
        out = part if out is None else out.unionByName(part)
    return out


def pca_kmeans(
    df: DataFrame, key: str, cols: Sequence[str], n: int, k: int, n_init: int = 30, seed: int = 0, start_keys: Sequence[int] | None = None, **how
) -> tuple[DataFrame, Centers]:
    """k-means on the first ``n`` components: ``(key, label)`` and the component centers.
    Score the labels on the original columns, not on the components. ``start_keys`` names
    ``k`` rows to start from."""
    projected, names = pca_project(df, cols, n, key), [f"PC{i + 1}" for i in range(n)]
    if start_keys is not None:
        rows = projected.filter(F.col(key).isin(*start_keys)).orderBy(key).select(*names).toPandas()
        how = {**how, "starts": {k: [rows.to_numpy(dtype=float)]}}
    centers, _ = kmeans(projected, key, names, k, n_init, seed, **how)
    return assign_nearest(projected, centers).select(key, "label"), centers
