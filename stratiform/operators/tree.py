"""Decision tree on cluster labels, and its use on the outliers.

The tree is exact: every distinct value of every column is a split candidate, and depth has no
limit. Nodes of more than ``SMALL_ROWS`` rows are split level by level in Spark. Each task counts
the classes of its rows per node, column and bucket of values; a bucket that cannot hold a split
as good as the best one between buckets is left at that. The values of the others, a small part of
the table, are folded to class counts, and each bucket scores them from its own running counts and
what came before it. A smaller node goes to one task, which grows its whole subtree. Both ways
choose the same splits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions.expr import HASH_PRIME, key_hash
from stratiform.functions.skew import salted_join
from stratiform.operators.columns import attach_labels, stack
from stratiform.session import cut_plan, small_table

SMALL_ROWS = 50_000
STRETCH_ROWS = 100_000
BUCKETS = 128
CORNER_CLASSES = 8
FEW_NODES = 10_000
SHIPPED_NODES = 1_000_000
_NODES = "path string, feature int, threshold double, n bigint, majority int, hits bigint"


def split_by_key(df: DataFrame, key: str, frac: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Reproducible split: a row's side depends on its key and the seed alone."""
    first = key_hash(F.col(key), seed) < F.lit(int(frac * HASH_PRIME))
    return df.filter(first), df.filter(~first)


@dataclass(frozen=True)
class Tree:
    """``nodes``: one row per node. Its ``path`` from the root has a 0 for each step to the left
    (value <= threshold) and a 1 for each to the right; leaves have no feature. ``n`` training
    rows, their most frequent class (the lower label of equals) and how many are of it."""

    nodes: DataFrame
    features: tuple[str, ...]

    @property
    def depth(self) -> int:
        return self.nodes.agg(F.max(F.length("path"))).first()[0]

    @property
    def size(self) -> int:
        return self.nodes.count()


def _scores(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Gini purity of splits by their class counts: the larger, the purer both sides."""
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        return (left * left).sum(axis=-1) / left.sum(axis=-1) + (right * right).sum(axis=-1) / right.sum(axis=-1)


def _middle(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    middle = (low + high) / 2
    return np.where(middle >= high, low, middle)


def _best(x: np.ndarray, hot: np.ndarray, min_leaf: int) -> tuple[int, float] | None:
    """The purest split of the rows: the lowest column, then the lowest value, of equals."""
    best, found = -np.inf, None
    sizes = np.arange(1, len(x))
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        at = np.flatnonzero((v[1:] != v[:-1]) & (sizes >= min_leaf) & (len(x) - sizes >= min_leaf))
        if len(at):
            left = np.cumsum(hot[order], axis=0)
            scores = _scores(left[at].astype(float), left[-1].astype(float))
            i = int(scores.argmax())
            if scores[i] > best:
                best, found = scores[i], (f, float(_middle(v[at[i]], v[at[i] + 1])))
    return found


def _subtree(classes: Sequence[int], min_leaf: int, max_depth: int | None):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(pdf["x"].to_numpy()), np.searchsorted(classes, pdf["y"].to_numpy())
        hot = np.eye(len(classes), dtype=np.int64)[y]
        out, todo = [], [(pdf["path"].iloc[0], np.arange(len(x)))]
        while todo:
            path, rows = todo.pop()
            counts = hot[rows].sum(axis=0)
            top = int(counts.argmax())
            split = None
            if counts[top] < len(rows) and (max_depth is None or len(path) < max_depth):
                split = _best(x[rows], hot[rows], min_leaf)
            out.append((path, *(split or (None, None)), len(rows), int(classes[top]), int(counts[top])))
            if split:
                low = x[rows, split[0]] <= split[1]
                todo += [(path + "0", rows[low]), (path + "1", rows[~low])]
        frame = pd.DataFrame(out, columns=["path", "feature", "threshold", "n", "majority", "hits"])
        return frame.astype({"feature": "Int32"})

    return grow


def _stretch(k: int, min_leaf: int):
    """The best split of each node by each column among the values of one sorted stretch."""
    c = [f"c{i}" for i in range(k)]

    def score(cells: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values(["path", "f", "v"], kind="stable").merge(known, on=["path", "f"], how="left", suffixes=("", "_"))
        keys = cells[["path", "f"]]
        inside = cells.groupby(["path", "f"], sort=False)
        left = inside[c].cumsum().to_numpy(dtype=float) + cells[[f"before_{x}" for x in c]].to_numpy(dtype=float)
        total = cells[[f"total_{x}" for x in c]].to_numpy(dtype=float)
        high = inside["v"].shift(-1).fillna(cells["next"]).to_numpy(dtype=float)
        n, whole = left.sum(axis=1), total.sum(axis=1)
        fit = ~np.isnan(high) & (n >= min_leaf) & (whole - n >= min_leaf)
        out = keys.assign(score=_scores(left, total), threshold=_middle(cells["v"].to_numpy(dtype=float), high))[fit]
        return out.sort_values("score", ascending=False, kind="stable").drop_duplicates(["path", "f"])

    return score


def _edges(rows: DataFrame, d: int, buckets: int) -> list[np.ndarray]:
    """Upper edges of at most ``buckets`` buckets of about equal row count, for each column."""
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[f], shares, max(10_000, 10 * buckets)).alias(f"e{f}") for f in range(d)]).first()
    return [np.unique(np.asarray(e if e is not None else [], dtype=float)) for e in found]


def _binned(edges: list[np.ndarray], classes: Sequence[int]):
    """Class counts and least value per node, column and bucket of one task's rows."""
    d, k, width = len(edges), len(classes), max(map(len, edges)) + 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, d)
            y = np.searchsorted(classes, batch.column("y").to_numpy())
            named = batch.column("path").dictionary_encode()
            node = named.indices.to_numpy()
            at = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1) if len(x) else np.zeros((0, d), np.int64)
            for i, path in enumerate(named.dictionary.to_pylist()):
                counts, least = held.setdefault(path, (np.zeros((d, width, k), np.int64), np.full((d, width), np.inf)))
                mine = np.flatnonzero(node == i)
                for f in range(d):
                    counts[f] += np.bincount(at[mine, f] * k + y[mine], minlength=width * k).reshape(width, k)
                    np.minimum.at(least[f], at[mine, f], x[mine, f])
        for path, (counts, least) in held.items():
            f, bucket = np.nonzero(counts.any(axis=2))
            columns = [pa.array([path] * len(f)), pa.array(f, pa.int32()), pa.array(bucket, pa.int32()), pa.array(least[f, bucket])]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(c) for c in counts[f, bucket].T]], names=["path", "f", "bucket", "least", *[f"c{i}" for i in range(k)]])

    return scan


def _most(before: np.ndarray, after: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What no split inside a bucket can exceed in purity. Purity is convex in the counts on the
    left, which lie between those before and after the bucket, so a corner of that box holds the
    most; with many classes, the larger squares over the smaller sums."""
    k = before.shape[1]
    if k <= CORNER_CLASSES:
        corners = np.array([[(c >> i) & 1 for i in range(k)] for c in range(1 << k)], dtype=bool)
        left = np.where(corners[None], after[:, None], before[:, None])
        sides = (left, total[:, None] - left)
        squares, sums = ([g(v) for v in sides] for g in (lambda v: (v * v).sum(axis=-1), lambda v: v.sum(axis=-1)))
        return sum(q / np.maximum(n, 1.0) for q, n in zip(squares, sums)).max(axis=1)
    sides = ((after, before), (total - before, total - after))
    return sum((more * more).sum(axis=-1) / np.maximum(less.sum(axis=-1), 1.0) for more, less in sides)


def _alive(edges: list[np.ndarray], k: int, min_leaf: int):
    """The buckets of a node that may hold its best split: those whose bound reaches the best
    split between two buckets. With what lies before them and the least value after them."""
    c = [f"c{i}" for i in range(k)]

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["f", "bucket"], kind="stable").reset_index(drop=True)
        inside = pdf.groupby("f", sort=False)
        counts = pdf[c].to_numpy(dtype=float)
        after = inside[c].cumsum().to_numpy(dtype=float)
        total = inside[c].transform("sum").to_numpy(dtype=float)
        following = inside["least"].shift(-1).to_numpy(dtype=float)
        n, whole = after.sum(axis=1), total.sum(axis=1)
        fit = ~np.isnan(following) & (n >= min_leaf) & (whole - n >= min_leaf)
        best = _scores(after[fit], total[fit]).max() if fit.any() else -np.inf
        some = _most(after - counts, after, total) >= best * (1 - 1e-9) if fit.any() else np.ones(len(pdf), dtype=bool)
        f, bucket = pdf["f"].to_numpy(), pdf["bucket"].to_numpy()
        low = [edges[i][j - 1] if j else np.nan for i, j in zip(f, bucket)]
        high = [edges[i][j] if j < len(edges[i]) else np.inf for i, j in zip(f, bucket)]
        out = pdf[["path", "f", "bucket"]].assign(low=pd.array(low, dtype="Float64"), high=high, next=pd.array(following, dtype="Float64"))
        for i, x in enumerate(c):
            out[f"before_{x}"], out[f"total_{x}"] = (after - counts)[:, i].astype(np.int64), total[:, i].astype(np.int64)
        return out[some]

    return keep


def _cells(rows: DataFrame, classes: Sequence[int], min_leaf: int, edges: list[np.ndarray]) -> tuple[DataFrame, DataFrame]:
    """Class counts per value of the buckets that may hold a node's best split, and those buckets.
    The other values are only counted, in the task that holds them."""
    c = [f"c{i}" for i in range(len(classes))]
    binned = rows.select("path", "x", "y").mapInArrow(_binned(edges, classes), "path string, f int, bucket int, least double, " + ", ".join(f"{x} bigint" for x in c))
    binned = binned.groupBy("path", "f", "bucket").agg(F.min("least").alias("least"), *[F.sum(x).alias(x) for x in c])
    schema = "path string, f int, bucket int, low double, high double, next double, " + ", ".join(f"before_{x} bigint, total_{x} bigint" for x in c)
    alive = cut_plan(binned.groupBy("path").applyInPandas(_alive(edges, len(classes), min_leaf), schema))
    values = rows.select("path", "y", F.posexplode("x").alias("f", "v"))
    held = values.join(alive.select("path", "f", "bucket", "low", "high"), ["path", "f"]).filter((F.col("low").isNull() | (F.col("v") > F.col("low"))) & (F.col("v") <= F.col("high")))
    cells = held.groupBy("path", "f", "bucket", "v").agg(*[F.count_if(F.col("y") == label).alias(x) for x, label in zip(c, classes)])
    return cells, alive.drop("low", "high")


def _splits(rows: DataFrame, classes: Sequence[int], min_leaf: int, edges: list[np.ndarray]) -> DataFrame:
    """``(path, feature, threshold)`` of every node of ``rows`` that can be split."""
    cells, known = _cells(rows, classes, min_leaf, edges)
    known = known.withColumns({f"of_{x}": F.col(x) for x in ("path", "f", "bucket")}).drop("bucket")
    best = cells.groupBy("path", "f", "bucket").cogroup(known.groupBy("of_path", "of_f", "of_bucket")).applyInPandas(_stretch(len(classes), min_leaf), "path string, f int, score double, threshold double")
    first = F.struct(F.col("score"), -F.col("f"), -F.col("threshold"))
    return best.groupBy("path").agg(F.max_by(F.struct(F.col("f").alias("feature"), "threshold"), first).alias("s")).select("path", "s.*")


def _with_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows beside what is known of their node. Nodes are few where each is large: then they
    travel and the rows stay."""
    head = nodes.limit(FEW_NODES + 1).collect()
    if len(head) > FEW_NODES:
        return salted_join(rows, nodes, ["path"], F.hash("x"))
    return rows.join(small_table(rows.sparkSession, [tuple(r) for r in head], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)), "path")


def fit_tree(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    min_leaf: int = 3,
    max_depth: int | None = None,
    small_rows: int = SMALL_ROWS,
    stretch_rows: int = STRETCH_ROWS,
) -> Tree:
    """Gini tree with at least ``min_leaf`` rows per leaf, split at every distinct value (half
    way to the next) until nodes are pure or cannot be split. Of equally good splits the first
    column's lowest is taken. Rows with a missing feature or label are left out. The number of
    classes is the width of what is counted; ``small_rows`` and ``stretch_rows``, the rows of a
    bucket, do not change the tree."""
    complete = train.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v))
    )
    rows = cut_plan(complete.withColumn("path", F.lit("")))
    spark, n = train.sparkSession, rows.count()
    edges = _edges(rows, len(features), max(BUCKETS, -(-n // stretch_rows))) if n > small_rows else []
    classes = sorted(r["y"] for r in rows.select("y").distinct().collect())
    done = [small_table(spark, [], _NODES)]
    level = 0
    while True:
        sizes = cut_plan(rows.groupBy("path", "y").agg(F.count(F.lit(1)).alias("m")).groupBy("path").agg(F.sum("m").alias("n"), F.max_by("y", F.struct("m", -F.col("y"))).alias("majority"), F.max("m").alias("hits")))
        large = sizes.filter(F.col("n") > small_rows)
        few = _with_nodes(rows, sizes.filter(F.col("n") <= small_rows).select("path"))
        done.append(cut_plan(few.groupBy("path").applyInPandas(_subtree(classes, min_leaf, max_depth), _NODES)))
        if not large.limit(1).count():
            break
        ahead = large.filter((F.col("hits") < F.col("n")) & F.lit(max_depth is None or level < max_depth)).select("path")
        open_rows = _with_nodes(rows, ahead)
        splits = cut_plan(_splits(open_rows, classes, min_leaf, edges))
        done.append(cut_plan(large.join(splits, "path", "left").select("path", "feature", "threshold", "n", "majority", "hits")))
        low = F.element_at("x", F.col("feature") + 1) <= F.col("threshold")
        moved = _with_nodes(rows, splits)
        rows = cut_plan(moved.select("x", "y", F.concat("path", F.when(low, "0").otherwise("1")).alias("path")))
        level += 1
    nodes = done[0]
    for part in done[1:]:
        nodes = nodes.unionByName(part)
    return Tree(cut_plan(nodes), tuple(features))


def leaves(model: Tree, df: DataFrame, shipped: int = SHIPPED_NODES) -> DataFrame:
    """``df`` with the ``leaf`` (its path) and ``prediction`` of each row; a missing value goes to
    the right. Up to ``shipped`` nodes travel to the tasks; a larger tree is walked a level at a
    time by joins."""
    x = [F.col(c).cast("double") for c in model.features]
    held = [f"__x{i}" for i in range(len(x))]
    head = model.nodes.select("path", "feature", "threshold", "majority").limit(shipped + 1).toPandas()
    if len(head) <= shipped:
        place = {p: i for i, p in enumerate(head["path"])}
        inner = head["feature"].notna().to_numpy()
        feature, threshold = head["feature"].fillna(0).to_numpy(dtype=np.int64), head["threshold"].to_numpy(dtype=float)
        down = np.array([[place[p + s] if i else place[p] for s in "01"] for p, i in zip(head["path"], inner)], np.int64).reshape(-1, 2)
        paths, majority = head["path"].to_numpy(), head["majority"].to_numpy()

        def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                values = pdf[held].to_numpy(dtype=float)
                at = np.full(len(pdf), place.get("", 0))
                while len(at) and inner[at].any():
                    right = ~(values[np.arange(len(at)), feature[at]] <= threshold[at])
                    at = down[at, right.astype(np.int64)]
                yield pdf.drop(columns=held).assign(leaf=paths[at], prediction=majority[at].astype(np.int32))

        wide = df.select(*df.columns, *[v.alias(name) for name, v in zip(held, x)])
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return wide.mapInPandas(walk, f"{fields}, leaf string, prediction int")
    at = df.withColumns({"leaf": F.lit(""), "__x": F.array(*x)})
    known = model.nodes.select(F.col("path").alias("leaf"), "feature", "threshold", "majority")
    while True:
        at = cut_plan(salted_join(at, known, ["leaf"], F.hash("__x")))
        if not at.filter(F.col("feature").isNotNull()).limit(1).count():
            return at.withColumnRenamed("majority", "prediction").select(*df.columns, "leaf", "prediction")
        low = F.coalesce(F.element_at("__x", F.col("feature") + 1) <= F.col("threshold"), F.lit(False))
        step = F.when(F.col("feature").isNull(), "").when(low, "0").otherwise("1")
        at = at.withColumn("leaf", F.concat("leaf", step)).select(*df.columns, "leaf", "__x")


def predict(model: Tree, df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Add an integer ``prediction``."""
    return leaves(model, df).drop("leaf")


def label_outliers(inside: DataFrame, labels: DataFrame, outside: DataFrame, model: Tree, key: str, features: Sequence[str]) -> DataFrame:
    """Labelled rows and predicted outliers in one table, with an ``outlier`` flag.
    Outliers with a missing feature cannot be placed and are left out."""
    known = attach_labels(inside.select(key, *features), labels, key).withColumn("outlier", F.lit(False))
    placed = predict(model, outside.select(key, *features).dropna())
    return stack(known, placed.withColumnRenamed("prediction", "label").withColumn("outlier", F.lit(True)))


def tree_leaf_profile(model: Tree, df: DataFrame, features: Sequence[str] | None = None, label: str = "label") -> DataFrame:
    """``(leaf, n, majority, purity)``: what each leaf of the tree holds of ``df``."""
    placed = leaves(model, df).select("leaf", F.col(label).cast("int").alias("l"))
    per_label = placed.groupBy("leaf", "l").agg(F.count(F.lit(1)).alias("n"))
    return per_label.groupBy("leaf").agg(
        F.sum("n").alias("n"),
        F.min_by("l", F.struct(-F.col("n"), F.col("l"))).alias("majority"),
        (F.max("n") / F.sum("n")).alias("purity"),
    )
