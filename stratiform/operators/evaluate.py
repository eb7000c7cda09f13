"""Silhouettes and classification metrics."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.expr import key_hash
from stratiform.functions.rank import ranked as ranked_rows
from stratiform.functions.skew import salted_join
from stratiform.operators.centers import Centers, assign_nearest, distances, kmeans_many, train_runs
from stratiform.operators.columns import attach_labels
from stratiform.operators.silhouette_cells import MAX_CELLS, mean_silhouettes
from stratiform.session import cut_lineage, small_table

BLOCK_ROWS = 1024
CHUNK_ROWS = 256
NEAR = 1e-6
GROUP_ROWS = 1_000_000
SIZE_ROWS = 20_000
SCORE_CELLS = 4_000_000


def _coded(side: pd.DataFrame, label_cols: Sequence[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The labels of each labeling, and one column per labeling with the place of each row's
    label among the labels of all labelings."""
    found = [np.unique(side[c].to_numpy(), return_inverse=True) for c in label_cols]
    start = np.cumsum([0, *[len(v) for v, _ in found]])
    return [v for v, _ in found], np.stack([code + at for (_, code), at in zip(found, start)], axis=1)


def _hot(codes: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(codes), width))
    out[np.arange(len(codes))[:, None], codes] = 1.0
    return out


def _summed(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, widths: Sequence[int], same: bool, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed distances from each row of ``x`` to the labels ``b`` of ``y``, and back to the
    labels ``a`` unless both sides are the ``same``.

    Products give the distances of a block that stays in the processor's cache. They lose digits
    where two rows are near for their distance from the middle, so those are measured column by
    column. Rows go by their distance from the middle, so that few are near by that measure.
    """
    fit = np.isfinite(x).all(axis=1)
    middle = x[fit].mean(axis=0) if fit.any() else np.zeros(x.shape[1])
    x, y = x - middle, y - middle
    nx, ny = (x * x).sum(axis=1), (y * y).sum(axis=1)
    go, back = np.argsort(nx, kind="stable"), np.argsort(ny, kind="stable")
    x, y, nx, ny, a, b = x[go], y[back], nx[go], ny[back], a[go], b[back]
    wide = np.hstack([x, nx[:, None], np.ones((len(x), 1))])
    to_b, to_a = np.zeros((len(x), widths[1])), np.zeros((len(y), widths[0]))
    for q in range(0, len(y), block_rows):
        some = slice(q, q + block_rows)
        turned = np.vstack([-2.0 * y[some].T, np.ones((1, len(y[some]))), ny[None, some]])
        hot_b, most = _hot(b[some], widths[1]), np.fmax.reduce(ny[some])
        for p in range(0, len(x), CHUNK_ROWS):
            part = slice(p, p + CHUNK_ROWS)
            dist = wide[part] @ turned
            near = dist < NEAR * (np.fmax.reduce(nx[part]) + most)
            if near.any():
                i, j = np.nonzero(near)
                gap = np.zeros(len(i))
                for c in range(x.shape[1]):
                    gap += (x[p + i, c] - y[q + j, c]) ** 2
                dist[i, j] = gap
            np.sqrt(dist, out=dist)
            to_b[part] += dist @ hot_b
            if not same:
                to_a[some] += dist.T @ _hot(a[part], widths[0])
    out_b, out_a = np.empty_like(to_b), np.empty_like(to_a)
    out_b[go], out_a[back] = to_b, to_a
    return out_b, out_a


def _label_sums(members: DataFrame, key: str, cols: Sequence[str], label_cols: Sequence[str], block_rows: int) -> DataFrame:
    """``(key, method, own, other, s)``: summed distance from each row to each label.

    Rows are dealt by key hash into groups, whatever their labels; a task gets two groups,
    measures their distances ``block_rows`` at a time and returns one sum per row
    and label, for both directions and every labelling at once. No pair of rows leaves a
    task. The work is quadratic in the rows because the definition is; what is shuffled
    is rows times groups, and the number of groups follows the tasks, not the rows.
    """
    cols, label_cols = list(cols), list(label_cols)
    n = members.count()
    spark = members.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    blocks = max(1, min(math.ceil(n / block_rows), max(math.ceil(math.sqrt(2 * tasks)), math.ceil(n / GROUP_ROWS))))
    block = F.pmod(key_hash(F.col(key), 7), F.lit(blocks)).cast("int")
    i, j = F.least("__b", "__o"), F.greatest("__b", "__o")
    dealt = (
        members.withColumn("__b", block)
        .withColumn("__o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("__pair", F.expr("int(greatest(__b, __o) * (greatest(__b, __o) + 1L) div 2)") + i)
        .withColumn("__left", F.col("__b") == i)
        .drop("__o")
    )

    def told(q: pd.DataFrame, others: list[np.ndarray], sums: np.ndarray) -> list[pd.DataFrame]:
        at, parts = 0, []
        for m, values in enumerate(others):
            for other in values:
                parts.append(pd.DataFrame({key: q[key].to_numpy(), "method": m, "own": q[label_cols[m]].to_numpy(), "other": other, "s": sums[:, at]}))
                at += 1
        return parts

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [pdf for pdf in batches if len(pdf)]
        if not held:
            return
        pdf = pd.concat(held)
        del held
        a, b = pdf[pdf["__left"]], pdf[~pdf["__left"]]
        if not len(a):
            return
        same = bool((a["__b"].iloc[0] * (a["__b"].iloc[0] + 3)) // 2 == a["__pair"].iloc[0])
        if same:
            b = a
        others, codes = zip(*[_coded(side, label_cols) for side in (a, b)])
        x, y = a[cols].to_numpy(dtype=float), b[cols].to_numpy(dtype=float)
        to_b, to_a = _summed(x, y, codes[0], codes[1], [sum(map(len, o)) for o in others], same, block_rows)
        yield from told(a, others[1], to_b)
        if not same:
            yield from told(b, others[0], to_a)

    schema = T.StructType(
        [
            members.schema[key],
            T.StructField("method", T.IntegerType()),
            T.StructField("own", T.IntegerType()),
            T.StructField("other", T.IntegerType()),
            T.StructField("s", T.DoubleType()),
        ]
    )
    # One pair to each partition: neither joined for their few rows nor two in one by their hash.
    parts = dealt.repartitionById(blocks * (blocks + 1) // 2, "__pair").mapInPandas(pair, schema)
    # Spread by key once: both aggregations below then stay in their partition.
    return parts.repartition(F.col(key)).groupBy(key, "method", "own", "other").agg(F.sum("s").alias("s"))


def _samples(members: DataFrame, key: str, cols: Sequence[str], label_cols: Sequence[str], block_rows: int) -> DataFrame:
    """``(key, method, label, silhouette)`` for every labelling column."""
    sums = _label_sums(members, key, cols, label_cols, block_rows)
    sizes = members.select(
        F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(c).alias("other")) for m, c in enumerate(label_cols)])).alias("t")
    ).groupBy("t.method", "t.other").agg(F.count(F.lit(1)).alias("n"))
    own = F.col("own") == F.col("other")
    # Sizes are one row per label and method: few enough, they travel as a table of known
    # size; else they are looked up under a salt, as one label may hold most rows.
    head = sizes.limit(SIZE_ROWS + 1).collect()
    if len(head) <= SIZE_ROWS:
        with_size = sums.join(small_table(members.sparkSession, [tuple(r) for r in head], "method int, other int, n bigint"), ["method", "other"])
    else:
        with_size = salted_join(sums, sizes, ["method", "other"], F.col(key))
    per_row = (
        with_size
        .groupBy(key, "method", "own")
        .agg(
            F.max(F.when(own, F.try_divide(F.col("s"), F.col("n") - 1))).alias("a"),
            F.max(F.when(own, F.col("n"))).alias("n_own"),
            F.min(F.when(~own, F.col("s") / F.col("n"))).alias("b"),
        )
    )
    value = F.when(F.col("n_own") == 1, F.when(F.col("b").isNotNull(), 0.0)).otherwise(
        F.coalesce(
            F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")),
            F.when(F.col("b").isNotNull(), 0.0),
        )
    )
    return per_row.select(key, "method", F.col("own").alias("label"), value.alias("silhouette"))


def _int_label(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("int"))


def silhouette_samples(
    df: DataFrame, labels: DataFrame, key: str, cols: Sequence[str], ranked: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Exact Euclidean silhouette per row; a one-member cluster scores 0; with a single
    cluster there is no score (NULL). ``ranked`` adds the position inside the cluster,
    lowest first."""
    members = _int_label(attach_labels(df.select(key, *cols), labels, key), "label")
    out = _samples(members, key, cols, ["label"], block_rows).drop("method")
    return ranked_rows(out, ["silhouette", key], "label", "position") if ranked else out


def silhouette_score(df: DataFrame, labels: DataFrame, key: str, cols: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean of the row silhouettes."""
    return silhouette_samples(df, labels, key, cols, block_rows=block_rows).agg(F.avg("silhouette").alias("silhouette"))


def chunked(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for i in range(0, len(pdf), rows):
            yield pdf.iloc[i : i + rows]


def silhouette_bounds(df: DataFrame, labels: DataFrame, key: str, cols: Sequence[str], cells: int = 128, seed: int = 0) -> DataFrame:
    """Proven lower and upper bound of the mean silhouette in time linear in the rows.

    Each label is summarised by at most ``cells`` cells (count, mean, mean squared
    spread). For a cell of n rows the mean distance from a point lies between the
    distance to the cell mean and the root of squared distance plus spread, so every
    row's silhouette is bracketed by one scan against the cells. More cells, tighter
    bracket; this is the way to score tables too large for the exact form.
    """
    cols = list(cols)
    members = _int_label(attach_labels(df.select(key, *cols), labels, key), "label").persist()
    try:
        codebook, _ = kmeans_many(members, key, cols, [max(2, cells)], n_init=1, seed=seed, max_iter=5)[max(2, cells)]
        celled = assign_nearest(members, codebook, "cell", "away")
        rows = (
            celled.groupBy("label", "cell")
            .agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n"), *[F.var_pop(c).alias(f"v_{c}") for c in cols])
            .collect()
        )
        label_ids = sorted({r["label"] for r in rows})
        slot = {v: i for i, v in enumerate(label_ids)}
        points = np.array([[r[c] for c in cols] for r in rows], dtype=float)
        count = np.array([r["n"] for r in rows], dtype=float)
        spread = np.array([sum(r[f"v_{c}"] for c in cols) for r in rows], dtype=float)
        share = np.zeros((len(rows), len(label_ids)))
        share[np.arange(len(rows)), [slot[r["label"]] for r in rows]] = count
        size = share.sum(axis=0)

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in chunked(batches, max(1, SCORE_CELLS // len(points))):
                d2 = distances(pdf[cols].to_numpy(dtype=float), points)
                own = pdf["label"].map(slot).to_numpy()
                at = np.arange(len(pdf))
                n_own = size[own]
                lo, hi = np.sqrt(d2) @ share, np.sqrt(d2 + spread) @ share
                with np.errstate(divide="ignore", invalid="ignore"):
                    a_lo, a_hi = lo[at, own] / (n_own - 1), hi[at, own] / (n_own - 1)
                    lo, hi = lo / size, hi / size
                    lo[at, own] = hi[at, own] = np.inf
                    b_lo, b_hi = lo.min(axis=1), hi.min(axis=1)
                    low = (b_lo - a_hi) / np.maximum(b_lo, a_hi)
                    high = (b_hi - a_lo) / np.maximum(b_hi, a_lo)
                low, high = (np.where(n_own == 1, 0.0, np.nan_to_num(v)) for v in (low, high))
                yield pd.DataFrame({"low": low, "high": high, "n": 1})

        bounds = members.mapInPandas(score, "low double, high double, n bigint")
        row = bounds.agg(F.avg("low").alias("lower"), F.avg("high").alias("upper"), F.sum("n").alias("n")).first()
    finally:
        members.unpersist()
    return small_table(df.sparkSession, [tuple(row)], "lower double, upper double, n bigint")


def silhouette_fast(df: DataFrame, labels: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Linear-time silhouette on squared distances: a different number on purpose."""
    members = attach_labels(df.select(key, *cols), labels, key)
    vec = VectorAssembler(inputCols=list(cols), outputCol="features").transform(members).select("features", "label")
    value = ClusteringEvaluator(
        predictionCol="label", featuresCol="features", metricName="silhouette", distanceMeasure="squaredEuclidean"
    ).evaluate(vec)
    return small_table(df.sparkSession, [(float(value),)], "silhouette double")


def compare_methods(
    df: DataFrame,
    labelings: Mapping[str, DataFrame],
    key: str,
    cols: Sequence[str],
    exclude_noise: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(method, n_clusters, silhouette)``, all labellings priced in the same pass over
    the distances. Noise counts as a cluster in the score unless excluded; it never
    counts in ``n_clusters``."""
    names = list(labelings)
    if exclude_noise:
        parts = [
            compare_methods(df, {m: l.filter(F.col("label") != -1)}, key, cols, block_rows=block_rows) for m, l in labelings.items()
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    members = df.select(key, *cols)
    for i, m in enumerate(names):
        members = members.join(labelings[m].select(key, F.col("label").cast("int").alias(f"__l{i}")), key)
    label_cols = [f"__l{i}" for i in range(len(names))]
    scored = _samples(members, key, cols, label_cols, block_rows)
    per_label = scored.groupBy("method", "label").agg(F.sum("silhouette").alias("s"), F.count(F.lit(1)).alias("n"))
    out = per_label.groupBy("method").agg(
        F.count_if(F.col("label") != -1).alias("n_clusters"), F.try_divide(F.sum("s"), F.sum("n")).alias("silhouette")
    )
    return out.select(
        F.element_at(F.array(*map(F.lit, names)), F.col("method") + 1).alias("method"), "n_clusters", "silhouette"
    )


def compare_within(
    df: DataFrame,
    labelings: Mapping[str, DataFrame],
    key: str,
    cols: Sequence[str],
    tol: float,
    exclude_noise: bool = False,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """``(method, n_clusters, silhouette, lower, upper)``: as ``compare_methods``, but each mean
    is only bracketed, by bounds at most ``tol`` apart; ``silhouette`` is their middle.

    Scans against summaries of cells shared by all labelings, so the work is linear in the rows
    for a given number of cells; where ``max_cells`` do not suffice, the exact form is taken and
    both bounds are its value. A row without a label in one labeling counts in the others.
    """
    names = list(labelings)
    members = df.select(key, *[F.col(c).cast("double").alias(c) for c in cols])
    label_cols = [f"__l{i}" for i in range(len(names))]
    for m, c in zip(names, label_cols):
        members = members.join(labelings[m].select(key, F.col("label").cast("int").alias(c)), key, "left")
    if exclude_noise:
        members = members.withColumns({c: F.when(F.col(c) != -1, F.col(c)) for c in label_cols})
    scored = mean_silhouettes(cut_lineage(members), cols, label_cols, tol, max_cells)
    if scored is None:
        exact = compare_methods(df, labelings, key, cols, exclude_noise)
        return exact.select("*", F.col("silhouette").alias("lower"), F.col("silhouette").alias("upper"))
    rows = [(names[m], n, None if low is None else (low + high) / 2, low, high) for m, n, low, high in scored]
    return small_table(df.sparkSession, rows, "method string, n_clusters bigint, silhouette double, lower double, upper double")


def silhouette_by_k(
    df: DataFrame, key: str, cols: Sequence[str], k_min: int, k_max: int, n_init: int = 30, seed: int = 0, within: float | None = None, **how
) -> DataFrame:
    """``(k, silhouette)`` for every k in the range, both ends included; exact, or with ``within``
    the middle of bounds that are at most so far apart. ``how`` as in ``kmeans_many``."""
    fits = kmeans_many(df, key, cols, range(k_min, k_max + 1), n_init, seed, **how)
    base = df.select(key, *cols)
    labelings = {str(k): assign_nearest(base, c).select(key, "label") for k, (c, _) in fits.items()}
    scored = compare_methods(df, labelings, key, cols) if within is None else compare_within(df, labelings, key, cols, within)
    return scored.select(F.col("method").cast("int").alias("k"), "silhouette")


def confusion_matrix(pred: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """Rows: actual, one column ``p<label>`` per predicted label, zeros kept."""
    counts = pred.groupBy(F.col(actual).cast("int").alias("actual"), F.col(predicted).cast("int").alias("guess")).agg(F.count(F.lit(1)).alias("n"))
    pairs = cut_lineage(counts.filter("actual is not null and guess is not null"))
    labels = pairs.select(F.explode(F.array("actual", "guess")).alias("actual")).distinct()
    ids = sorted(r["actual"] for r in labels.collect())  # one column each, so as many as the result is wide
    wide = pairs.groupBy("actual").agg(*[F.coalesce(F.sum(F.when(F.col("guess") == i, F.col("n"))), F.lit(0)).alias(f"p{i}") for i in ids])
    return labels.join(wide, "actual", "left").select("actual", *[F.coalesce(f"p{i}", F.lit(0)).alias(f"p{i}") for i in ids])


def accuracy(pred: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    return pred.agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))


def classification_report(pred: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class, then macro and weighted
    averages and accuracy; a ratio without a denominator counts as 0. Rows are counted
    once per (actual, predicted) pair; everything else works on those counts."""
    counts = pred.groupBy(F.col(actual).cast("int").alias("a"), F.col(predicted).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"), F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).cast("bigint").alias("hit")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hit")),
            )
        ).alias("t")
    ).select("t.*")
    zero = F.lit(0.0)
    per_class = (
        sides.groupBy("c")
        .agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
        .withColumn("precision", F.coalesce(F.try_divide("hit", "guessed"), zero))
        .withColumn("recall", F.coalesce(F.try_divide("hit", "support"), zero))
        .withColumn(
            "f1",
            F.coalesce(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero),
        )
    )
    measures = ["precision", "recall", "f1"]
    total = per_class.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in measures],
        F.sum("support").alias("support"),
        F.try_divide(F.sum("hit"), F.sum("support")).alias("acc"),
    )
    averages = total.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("label"), *[F.col(f"{kind}_{m}").alias(m) for m in measures], F.col("support").alias("support")
                    )
                    for kind in ("macro", "weighted")
                ],
                F.struct(F.lit("accuracy").alias("label"), *[F.col("acc").alias(m) for m in measures], F.col("support").alias("support")),
            )
        ).alias("t")
    ).select("t.*")
    return per_class.select(F.col("c").cast("string").alias("label"), *measures, "support").unionByName(averages)
