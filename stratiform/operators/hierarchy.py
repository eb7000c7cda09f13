"""Hierarchies: bottom-up over rows or micro-clusters, and top-down.

The bottom-up tree links all distinct rows, or fewer micro-clusters of them if asked. Each
round merges every pair that are each other's nearest neighbour, which gives the same tree as
one merge at a time for the four linkages offered. The last ``FEW`` clusters are merged one
at a time by one task.

* Ward needs no distances kept: the height of a merge follows from two centers and weights. Near
  clusters lie in one block, and a round makes the merges that no cluster of another block can
  prevent; if few are, clusters ask the blocks that may hold a nearer one. What is stored and
  checkpointed is one row per cluster.
* Complete, average and weighted linkage keep the rows, each with its cluster and its share of it:
  the largest distance or a weighted sum over rows is the distance of two clusters. Centers and
  spreads bound it from both sides. First, merges that no cluster of another block can prevent are
  made in blocks of near clusters; then clusters that have lost their nearest ask the blocks that may
  hold it, and only those that may be nearest are measured. Rows of at most ``HELD_CELLS`` numbers
  are not dealt: each task holds them and looks up its clusters. The distances of the last ``FEW``
  clusters take every pair of rows once. Distances are never stored, so disk grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions.components import connected_components
from stratiform.functions.skew import counted_join, paired, salted_join
from stratiform.operators.centers import assign_nearest, distances, kmeans_many, update_centers
from stratiform.session import cut_lineage, cut_plan, small_table

LINKAGES = ("ward", "complete", "average", "weighted")
BLOCK_ROWS = 2048
CHUNK = 256
CHUNK_CELLS = 1 << 18
PAIR_ROWS = 8192
PAIRED_BLOCKS = 12
LAST_ROWS = 65_536
FEW_ROWS = 20_000
TILE = 512
DIRECT_ROWS = 100_000
HELD_CELLS = 1 << 23  # 64 MB of coordinates may lie on the driver and in each task
NEAR = 1e-6
ASKED_TOGETHER = 256
FEW = 4096
DRAWN = 32  # rows per block that place the blocks
ASKED_ROWS = 32_768
GAIN = 0.1
MERGES = "a bigint, b bigint, h double"


def _heights(squared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Ward heights from squared center distances of clusters of sizes ``n`` and ``m``."""
    return np.sqrt(2 * n * m / (n + m) * np.maximum(squared, 0.0))


def _last_merges(ids: np.ndarray, size: np.ndarray, s: np.ndarray, linkage: str) -> list[tuple[int, int, float]]:
    """All merges of a whole matrix ``s`` (squared center distances for ward, else distances),
    lowest ``(h, a, b)`` first. ``ids`` ascend. Every row keeps its nearest; only rows that lose
    theirs are searched again."""
    ward, size, s = linkage == "ward", size.astype(float), s.copy()
    np.fill_diagonal(s, np.inf)

    def heights(p: int) -> np.ndarray:
        return _heights(s[p], size[p], size) if ward else s[p]

    least, near = np.full(len(ids), np.inf), np.zeros(len(ids), np.int64)

    def search(p: int) -> None:
        h = heights(p)
        near[p] = h.argmin()
        least[p] = h[near[p]]

    for p in range(len(ids)):
        search(p)
    live, merges = np.ones(len(ids), dtype=bool), []
    for _ in range(len(ids) - 1):
        p = int(least.argmin())
        p, q = sorted((p, int(near[p])))
        merges.append((int(ids[p]), int(ids[q]), float(least[p])))
        live[q] = False
        rest = live.copy()
        rest[p] = False
        x, y, total = s[p, rest], s[q, rest], size[p] + size[q]
        if linkage == "complete":
            new = np.maximum(x, y)
        elif linkage == "weighted":
            new = (x + y) / 2
        else:
            new = (size[p] * x + size[q] * y) / total
        if ward:
            new = new - s[p, q] * size[p] * size[q] / (total * total)
        size[p] = total
        s[q], s[:, q], least[q] = np.inf, np.inf, np.inf
        s[p, rest] = s[rest, p] = new
        h = heights(p)
        nearer = rest & ((h < least) | ((h == least) & (p < near)))
        least[nearer], near[nearer] = h[nearer], p
        for r in np.flatnonzero(rest & ((near == p) | (near == q)) & ~nearer):
            search(r)
        search(p)
    return merges


# ---- ward: centers and weights -----------------------------------------------------------


def _ward_nearest(cols: list[str]):
    """The nearest of the other block for each asking cluster; the lower id on equal heights."""

    def nearest(asked: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        other = other.sort_values("id", kind="stable")
        x, y = (side[cols].to_numpy(dtype=float) for side in (asked, other))
        n, m = asked["n"].to_numpy(dtype=float), other["n"].to_numpy(dtype=float)
        mine, theirs = asked["id"].to_numpy(), other["id"].to_numpy()
        best, height = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
        for i in range(0, len(x) if len(y) else 0, CHUNK):
            some = slice(i, i + CHUNK)
            h = _heights(distances(x[some], y), n[some, None], m[None])
            h[mine[some, None] == theirs[None]] = np.inf
            best[some] = h.argmin(axis=1)
            height[some] = h[np.arange(len(h)), best[some]]
        found = np.isfinite(height)
        return pd.DataFrame({"id": mine[found], "h": height[found], "nn": theirs[best[found]] if len(y) else best[found]})

    return nearest


def _ward_last(cols: list[str]):
    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [pdf for pdf in batches if len(pdf)]
        if held:
            rows = pd.concat(held).sort_values("id")
            x = rows[cols].to_numpy(dtype=float)
            yield pd.DataFrame(_last_merges(rows["id"].to_numpy(), rows["n"].to_numpy(), distances(x, x), "ward"), columns=["a", "b", "h"])

    return merge


@dataclass(frozen=True)
class _Layout:
    """Blocks of near clusters: ``turn`` rotates the columns, and each level halves every block
    at a value of one of them. It only decides which clusters meet, never what is merged."""

    turn: np.ndarray
    levels: tuple[tuple[np.ndarray, np.ndarray], ...]

    @staticmethod
    def of(sample: np.ndarray, depth: int, seed: int) -> _Layout:
        width = sample.shape[1]
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))[0] if seed else np.eye(width)
        z, at, levels = _turned(sample, turn), np.zeros(len(sample), np.int64), []
        for level in range(depth):
            axis, value = np.zeros(1 << level, np.int64), np.zeros(1 << level)
            for i in range(1 << level):
                here = z[at == i]
                if len(here):
                    axis[i] = here.var(axis=0).argmax()
                    value[i] = np.median(here[:, axis[i]])
            levels.append((axis, value))
            at = 2 * at + (z[np.arange(len(z)), axis[at]] > value[at])
        return _Layout(turn, tuple(levels))

    def blocks(self, x: np.ndarray) -> np.ndarray:
        z, at = _turned(x, self.turn), np.zeros(len(x), np.int64)
        for axis, value in self.levels:
            at = 2 * at + (z[np.arange(len(z)), axis[at]] > value[at])
        return at


def _turned(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """``x @ turn``, column by column: the same for a row whatever rows stand beside it."""
    z = np.zeros((len(x), turn.shape[1]))
    for j in range(len(turn)):
        z += x[:, j, None] * turn[j]
    return z


def _bounds(z: np.ndarray, n: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Least Ward height of each cluster with any that lies in one of the boxes, whose rows hold
    the lowest and highest coordinates and the least size. Clusters merged in a box stay in it."""
    d, width = np.zeros((len(z), len(boxes))), z.shape[1]
    slack = 1e-9 * max(np.abs(boxes[:, :-1]).max(initial=0.0), np.abs(z).max(initial=0.0))
    for j in range(width):
        gap = np.maximum(boxes[:, j] - z[:, j, None], z[:, j, None] - boxes[:, width + j]) - slack
        d += np.maximum(gap, 0.0) ** 2
    return _heights(d, n[:, None], boxes[:, -1]) * (1 - 1e-9)


def _box(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.concatenate([z.min(axis=0), z.max(axis=0), [n.min()]])


def _sure_merges(ids: np.ndarray, x: np.ndarray, n: np.ndarray, turn: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """Merges of clusters that are each other's nearest whatever the clusters in the ``boxes``
    are, lowest first; ``x`` and ``n`` become those of what is left. A cluster that may have a
    nearer one in a box waits, and so does one whose nearest waits. By reducibility these merges
    belong to the tree in whatever order they are made."""
    s = distances(x, x)
    np.fill_diagonal(s, np.inf)
    sure = _bounds(_turned(x, turn), n, boxes).min(axis=1, initial=np.inf)
    least, near = np.full(len(ids), np.inf), np.zeros(len(ids), np.int64)

    def search(p: int) -> None:
        h = _heights(s[p], n[p], n)
        near[p] = h.argmin()
        least[p] = h[near[p]]

    for p in range(len(ids)):
        search(p)
    live, merges = np.ones(len(ids), dtype=bool), []
    first = np.where(least < sure, least, np.inf)  # of those that do not wait
    while len(ids):
        p = int(first.argmin())
        if not np.isfinite(first[p]):
            break
        p, q = sorted((p, int(near[p])))
        if not (np.isfinite(first[p]) and np.isfinite(first[q])):
            first[p] = first[q] = np.inf
            continue
        h, total = min(least[p], least[q]), n[p] + n[q]
        merges.append((int(ids[p]), int(ids[q]), float(h)))
        live[q] = False
        rest = live.copy()
        rest[p] = False
        new = (n[p] * s[p, rest] + n[q] * s[q, rest]) / total - s[p, q] * n[p] * n[q] / (total * total)
        x[p] = (n[p] * x[p] + n[q] * x[q]) / total
        n[p] = total
        s[q], s[:, q], least[q], first[q] = np.inf, np.inf, np.inf, np.inf
        s[p, rest] = s[rest, p] = new
        search(p)
        sure[p] = _bounds(_turned(x[p : p + 1], turn), n[p : p + 1], boxes).min(initial=np.inf)
        first[p] = least[p] if least[p] < sure[p] else np.inf
        for r in np.flatnonzero(rest & np.isfinite(first) & ((near == p) | (near == q))):
            search(r)
            first[r] = least[r] if least[r] < sure[r] else np.inf
    return live, merges


def _ward_blocks(layout: _Layout, boxes: dict[int, np.ndarray], names: list[str], block_rows: int):
    """One block: the merges that are sure in it, and what is left with the nearest in the block."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable").reset_index(drop=True)
        block = int(pdf["block"].iloc[0])
        others = np.array([b for i, b in boxes.items() if i != block]).reshape(-1, 2 * len(names) + 1)
        ids, x, n = pdf["id"].to_numpy(), pdf[names].to_numpy(dtype=float), pdf["n"].to_numpy(dtype=float).copy()
        parts = -(-len(ids) // (2 * block_rows))  # a block that came out too large is cut along its widest column
        z = _turned(x, layout.turn)
        cut = [np.sort(part) for part in np.array_split(np.argsort(z[:, z.var(axis=0).argmax()], kind="stable"), parts)]
        own = np.array([_box(z[part], n[part]) for part in cut])
        live, merges = np.zeros(len(ids), dtype=bool), []
        for i, part in enumerate(cut):
            xs, ns = x[part], n[part]
            live[part], some = _sure_merges(ids[part], xs, ns, layout.turn, np.concatenate([others, np.delete(own, i, axis=0)]))
            x[part], n[part] = xs, ns
            merges += some
        left = pd.DataFrame({"id": ids[live], "n": n[live], **{c: x[live, j] for j, c in enumerate(names)}})
        found = _ward_nearest(names)(left, left)
        left = left.merge(found, on="id", how="left")
        left["nn"], left["h"] = left["nn"].fillna(0).astype(np.int64) if len(found) < len(left) else left["nn"], left["h"].fillna(np.inf)
        done = pd.DataFrame(merges, columns=["id", "nn", "h"]).astype({"id": np.int64, "nn": np.int64, "h": float})
        return pd.concat([left.assign(merged=False), done.assign(n=0.0, merged=True, **{c: 0.0 for c in names})]).assign(block=block)

    return merge


def _dealt(state: DataFrame, names: list[str], left: int, block_rows: int, seed: int) -> tuple[_Layout, DataFrame, dict[int, np.ndarray]]:
    """Clusters with their block, and the box of each block. A bounded draw places the blocks."""
    depth = max(0, int(np.ceil(np.log2(max(1, left / block_rows)))))
    drawn = state.select(*names).orderBy(F.xxhash64("id", F.lit(seed))).limit(DRAWN << depth).toPandas() if depth else pd.DataFrame(columns=names, dtype=float)
    layout = _Layout.of(drawn.to_numpy(dtype=float), depth, seed)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(block=layout.blocks(pdf[names].to_numpy(dtype=float)))

    dealt = state.select("id", "n", *names).mapInPandas(place, "id bigint, n double, " + ", ".join(f"{c} double" for c in names) + ", block int")
    sides = [f"{side}{i}" for side in ("lo", "hi") for i in range(len(names))]

    def extent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            z = _turned(pdf[names].to_numpy(dtype=float), layout.turn)
            wide = pd.DataFrame(np.hstack([z, z]), columns=sides).assign(m=pdf["n"].to_numpy(), block=pdf["block"].to_numpy())
            yield wide.groupby("block", as_index=False).agg({c: "max" if c.startswith("hi") else "min" for c in [*sides, "m"]})

    parts = dealt.mapInPandas(extent, "block int, " + ", ".join(f"{c} double" for c in [*sides, "m"]))
    extents = parts.groupBy("block").agg(*[(F.max if c.startswith("hi") else F.min)(c).alias(c) for c in [*sides, "m"]]).toPandas()
    return layout, dealt, dict(zip(map(int, extents["block"]), extents[[*sides, "m"]].to_numpy(dtype=float)))


def _looked_up(held: DataFrame, layout: _Layout, boxes: dict[int, np.ndarray], names: list[str]) -> DataFrame:
    """``held`` with the nearest cluster of all: blocks that may hold a nearer one than a cluster's
    own block does are asked. A block that many ask answers in shares."""
    order = np.array(sorted(boxes))
    walls = np.array([boxes[b] for b in order])

    def wanted(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        z, n = _turned(pdf[names].to_numpy(dtype=float), layout.turn), pdf["n"].to_numpy(dtype=float)
        h, own = pdf["h"].to_numpy(dtype=float), pdf["block"].to_numpy()
        for i in range(0, len(pdf), CHUNK):
            some = slice(i, i + CHUNK)
            row, at = np.nonzero((_bounds(z[some], n[some], walls) <= h[some, None]) & (order != own[some, None]))
            yield row + i, at

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(order), np.int64)
        for pdf in batches:
            for _, at in wanted(pdf):
                total += np.bincount(at, minlength=len(order))
        yield pd.DataFrame({"other": order, "rows": total})

    asked = held.mapInPandas(counted, "other int, rows bigint").groupBy("other").agg(F.sum("rows").alias("rows")).toPandas()
    share_of = dict(zip(asked["other"], np.maximum(1, -(-asked["rows"].to_numpy() // ASKED_ROWS))))
    shares = np.array([share_of.get(b, 1) for b in order], np.int64)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row, at in wanted(pdf):
                out = pdf[["id", "n", *names]].iloc[row]
                yield out.assign(other=order[at], share=out["id"].to_numpy() % shares[at])

    fields = "id bigint, n double, " + ", ".join(f"{c} double" for c in names)
    asking = held.mapInPandas(ask, fields + ", other int, share int")
    known = small_table(held.sparkSession, [(int(b), int(k)) for b, k in zip(order, shares)], "block int, shares int")
    answering = held.join(known, "block").select("id", "n", *names, F.col("block").alias("other"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    found = paired(asking, answering, ["other", "share"]).applyInPandas(_ward_nearest(names), "id bigint, h double, nn bigint")
    best = found.unionByName(held.select("id", "h", "nn")).groupBy("id").agg(F.min(F.struct("h", "nn")).alias("m"))
    return cut_plan(held.select("id", "n", *names).join(best, "id").select("id", "n", *names, "m.nn", "m.h"))


def _ward_rounds(micro: DataFrame, cols: Sequence[str], few: int, block_rows: int) -> DataFrame:
    """Clusters lie in blocks of near ones. A round makes all merges that are sure within a block,
    told by the boxes of the other blocks, and lays the blocks anew. Where that gains little, each
    cluster looks its nearest up in the blocks that may hold it, and mutual pairs merge."""
    names = [f"x{i}" for i in range(len(cols))]
    columns = ["id", "n", *names]
    fields = "id bigint, n double, " + ", ".join(f"{c} double" for c in names)
    state = cut_plan(micro.select(F.col("label").cast("bigint").alias("id"), F.col("n").cast("double").alias("n"), *[F.col(c).cast("double").alias(x) for c, x in zip(cols, names)]))
    merges, left, turn = [small_table(micro.sparkSession, [], MERGES)], state.count(), 0
    while left > max(1, few):
        layout, dealt, boxes = _dealt(state, names, left, block_rows, turn)
        parts = int(micro.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        work = _ward_blocks(layout, boxes, names, block_rows)
        both = cut_plan(dealt.repartition(max(parts, min(len(boxes), 4 * parts)), "block").groupBy("block").applyInPandas(work, fields + ", nn bigint, h double, merged boolean, block int"))
        sure = both.filter("merged").select(F.col("id").alias("a"), F.col("nn").alias("b"), "h")
        state, done, turn = both.filter("NOT merged").select(*columns, "nn", "h", "block"), sure.count(), turn + 1
        merges.append(sure)
        left -= done
        if done >= GAIN * (left + done) or left <= max(1, few):
            continue
        state = _looked_up(state, layout, boxes, names)
        # A pair chosen from both ends merges.
        pairs = state.groupBy(F.least("id", "nn").alias("a"), F.greatest("id", "nn").alias("b")).agg(F.count(F.lit(1)).alias("ends"), F.min("h").alias("h"))
        mutual = cut_plan(pairs.filter("ends = 2").select("a", "b", "h"))
        merges.append(mutual)
        left -= mutual.count()
        ends = mutual.select(F.explode(F.array("a", "b")).alias("id"), F.col("a").alias("new"))
        state = state.join(ends, "id", "left").groupBy(F.coalesce("new", "id").alias("id")).agg(
            *[F.when(F.count(F.lit(1)) == 1, F.min(x)).otherwise(F.sum(F.col("n") * F.col(x)) / F.sum("n")).alias(x) for x in names], F.sum("n").alias("n")
        )
        state = cut_plan(state.select(*columns))
    last = state.select(*columns).coalesce(1).mapInPandas(_ward_last(names), MERGES)
    return cut_plan(reduce(DataFrame.unionByName, merges).unionByName(last))


# ---- complete, average, weighted: rows and their clusters ---------------------------------


def _between(x: np.ndarray, mine: np.ndarray, p: np.ndarray, y: np.ndarray, theirs: np.ndarray, q: np.ndarray, complete: bool) -> np.ndarray:
    """Largest, or else weighted sum of, distances per pair of clusters. Rows are sorted by
    cluster, which starts at the places ``mine`` and ``theirs``."""
    out = np.zeros((len(mine), len(theirs)))
    step = max(1, CHUNK_CELLS // max(1, len(y)))
    for i in range(0, len(x), step):
        d = np.sqrt(distances(x[i : i + step], y))
        if not complete:
            d *= q
        if len(theirs) < len(y):
            d = (np.maximum if complete else np.add).reduceat(d, theirs, axis=1)
        if not complete:
            d *= p[i : i + step, None]
        # The clusters of these rows: the first may have begun in the rows before.
        lo, hi = np.searchsorted(mine, i, "right") - 1, np.searchsorted(mine, i + len(d))
        starts = np.maximum(mine[lo:hi] - i, 0)
        if len(starts) < len(d):
            d = (np.maximum if complete else np.add).reduceat(d, starts, axis=0)
        if complete:
            np.maximum(out[lo:hi], d, out=out[lo:hi])
        else:
            out[lo:hi] += d
    return out


def _between_many(x: np.ndarray, mine: np.ndarray, p: np.ndarray, y: np.ndarray, theirs: np.ndarray, q: np.ndarray, complete: bool) -> np.ndarray:
    """As ``_between``, for large blocks: distances are products of tiles that stay in the cache,
    and rows that are near for their distance from the middle are measured column by column."""
    out = np.zeros((len(mine), len(theirs)))
    middle = y.mean(axis=0) if len(y) else 0.0
    x, y = x - middle, y - middle
    nx, ny = (x * x).sum(axis=1), (y * y).sum(axis=1)
    wide, fold = np.hstack([x, nx[:, None], np.ones((len(x), 1))]), np.maximum if complete else np.add
    for j in range(0, len(y), TILE):
        there = slice(j, j + TILE)
        turned = np.vstack([-2.0 * y[there].T, np.ones((1, len(y[there]))), ny[None, there]])
        left, right = np.searchsorted(theirs, j, "right") - 1, np.searchsorted(theirs, j + TILE)
        to, most = np.maximum(theirs[left:right] - j, 0), ny[there].max()
        for i in range(0, len(x), TILE):
            here = slice(i, i + TILE)
            d = wide[here] @ turned
            near = d < NEAR * (nx[here].max() + most)
            if near.any():
                a, b = np.nonzero(near)
                gap = np.zeros(len(a))
                for c in range(x.shape[1]):
                    gap += (x[i + a, c] - y[j + b, c]) ** 2
                d[a, b] = gap
            if not complete:
                np.sqrt(d, out=d)
                d *= q[there]
            d = fold.reduceat(d, to, axis=1)
            if not complete:
                d *= p[here, None]
            lo, hi = np.searchsorted(mine, i, "right") - 1, np.searchsorted(mine, i + TILE)
            d = fold.reduceat(d, np.maximum(mine[lo:hi] - i, 0), axis=0)
            fold(out[lo:hi, left:right], d, out=out[lo:hi, left:right])
    return np.sqrt(out) if complete else out


def _by_cluster(pdf: pd.DataFrame, names: list[str]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """The first row of each cluster, its place, and shares and coordinates of all rows, sorted
    by cluster."""
    pdf = pdf.sort_values("id", kind="stable")
    _, starts = np.unique(pdf["id"].to_numpy(), return_index=True)
    return pdf.iloc[starts], starts, pdf["share"].to_numpy(dtype=float), pdf[names].to_numpy(dtype=float)


def _least_linked(z: np.ndarray, low: np.ndarray, boxes: np.ndarray, complete: bool) -> np.ndarray:
    """Least height of each cluster with any whose center lies in one of the boxes. The mean of
    distances is not below the distance of the centers; their largest square is not below that
    of the centers and both mean squared spreads, ``low`` and the last column. Centers of
    clusters merged in a box stay in it, and spreads only grow."""
    d, width = np.zeros((len(z), len(boxes))), z.shape[1]
    slack = 1e-9 * max(np.abs(boxes[:, :-1]).max(initial=0.0), np.abs(z).max(initial=0.0))
    for j in range(width):
        gap = np.maximum(boxes[:, j] - z[:, j, None], z[:, j, None] - boxes[:, width + j]) - slack
        d += np.maximum(gap, 0.0) ** 2
    if complete:
        d += low[:, None] + boxes[:, -1]
    return np.sqrt(d) * (1 - 1e-9)


def _sure_links(ids: np.ndarray, s: np.ndarray, n: np.ndarray, c: np.ndarray, v: np.ndarray, linkage: str, turn: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, float]]]:
    """Merges of a block, as ``_sure_merges``, from its distances ``s``, centers ``c`` and mean
    squared spreads ``v``. Also the place of the cluster each one is in now, and its factor there."""
    complete = linkage == "complete"
    np.fill_diagonal(s, np.inf)
    sure = _least_linked(_turned(c, turn), v, boxes, complete).min(axis=1, initial=np.inf)
    near = s.argmin(axis=1)
    least = s[np.arange(len(ids)), near]
    live, merges = np.ones(len(ids), dtype=bool), []
    held, factor = [[i] for i in range(len(ids))], np.ones(len(ids))
    first = np.where(least < sure, least, np.inf)  # of those that do not wait
    while len(ids):
        p = int(first.argmin())
        if not np.isfinite(first[p]):
            break
        p, q = sorted((p, int(near[p])))
        if not (np.isfinite(first[p]) and np.isfinite(first[q])):
            first[p] = first[q] = np.inf
            continue
        total = n[p] + n[q]
        merges.append((int(ids[p]), int(ids[q]), float(min(least[p], least[q]))))
        a, b = (0.5, 0.5) if linkage == "weighted" else (n[p] / total, n[q] / total)
        v[p] = a * v[p] + b * v[q] + a * b * ((c[p] - c[q]) ** 2).sum()
        c[p] = a * c[p] + b * c[q]
        factor[held[p]] *= a
        factor[held[q]] *= b
        held[p] += held[q]
        live[q], n[p] = False, total
        rest = live.copy()
        rest[p] = False
        new = np.maximum(s[p, rest], s[q, rest]) if complete else a * s[p, rest] + b * s[q, rest]
        s[q], s[:, q], least[q], first[q] = np.inf, np.inf, np.inf, np.inf
        s[p, rest] = s[rest, p] = new
        sure[p] = _least_linked(_turned(c[p : p + 1], turn), v[p : p + 1], boxes, complete).min(initial=np.inf)
        for r in [p, *np.flatnonzero(rest & np.isfinite(first) & ((near == p) | (near == q)))]:
            near[r] = s[r].argmin()
            least[r] = s[r, near[r]]
            first[r] = least[r] if least[r] < sure[r] else np.inf
    into = np.zeros(len(ids), np.int64)
    for i in np.flatnonzero(live):
        into[held[i]] = i
    return into, factor, merges


def _linked_blocks(layout: _Layout, boxes: dict[int, np.ndarray], names: list[str], linkage: str, block_rows: int, most_rows: int):
    """The rows of one block: those merges that are sure in it, and the rows in their clusters."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        out = pdf[["pid", "id", "share", "n", *names]].assign(merged=False, h=0.0)
        if block < 0:  # of a cluster too large for a block
            return out
        out = out.sort_values("id", kind="stable").reset_index(drop=True)
        heads, starts, p, x = _by_cluster(out, names)
        ids, n, rows = heads["id"].to_numpy(), heads["n"].to_numpy(dtype=float), np.diff(np.append(starts, len(out)))
        c = np.add.reduceat(p[:, None] * x, starts, axis=0)
        v = np.add.reduceat(p * ((x - np.repeat(c, rows, axis=0)) ** 2).sum(axis=1), starts)
        others = np.array([b for i, b in boxes.items() if i != block]).reshape(-1, 2 * len(names) + 1)
        # A block that came out too large is cut along its widest column.
        z = _turned(c, layout.turn)
        order = np.argsort(z[:, z.var(axis=0).argmax()], kind="stable")
        load = np.maximum(rows[order] / most_rows, 1 / block_rows)
        cut = [np.sort(part) for part in np.split(order, np.flatnonzero(np.diff((np.cumsum(load) - load) // 2)) + 1)]
        own = np.array([_box(z[part], v[part]) for part in cut])
        into, factor, size, merges = np.arange(len(ids)), np.ones(len(ids)), n.copy(), []
        for i, part in enumerate(cut):
            at = np.flatnonzero(np.repeat(np.isin(np.arange(len(ids)), part), rows))
            to = np.cumsum(rows[part]) - rows[part]
            s = _between(x[at], to, p[at], x[at], to, p[at], linkage == "complete")
            ns = n[part].copy()
            place, factor[part], some = _sure_links(ids[part], np.minimum(s, s.T), ns, c[part], v[part], linkage, layout.turn, np.concatenate([others, np.delete(own, i, axis=0)]))
            into[part], size[part] = part[place], ns[place]
            merges += some
        out["id"], out["share"], out["n"] = np.repeat(ids[into], rows), p * np.repeat(factor, rows), np.repeat(size, rows)
        done = pd.DataFrame(merges, columns=["id", "pid", "h"]).astype({"id": np.int64, "pid": np.int64, "h": float})
        return pd.concat([out, done.assign(share=0.0, n=0.0, merged=True, **{c: 0.0 for c in names})])[[*out.columns]]

    return merge


def _clusters(members: DataFrame, names: list[str], complete: bool) -> DataFrame:
    """One row per cluster: weight, rows, center, least and most mean squared spread, and, for the
    complete linkage, a radius."""
    def total(parts):
        return reduce(add, parts)

    square = total([F.col(x) * F.col(x) for x in names])
    ends = [f(x).alias(f"{name}_{x}") for x in names for name, f in (("lo", F.min), ("hi", F.max))] if complete else []
    found = members.groupBy("id").agg(
        F.first("n").alias("n"), F.count(F.lit(1)).alias("rows"), *[F.sum(F.col("share") * F.col(x)).alias(f"c_{x}") for x in names], F.sum(F.col("share") * square).alias("m2"), *ends
    )
    spread = F.col("m2") - total([F.col(f"c_{x}") * F.col(f"c_{x}") for x in names])
    away = total([F.pow(F.greatest(F.col(f"hi_{x}") - F.col(f"c_{x}"), F.col(f"c_{x}") - F.col(f"lo_{x}")), 2) for x in names]) if complete else F.lit(0.0)
    one = F.col("rows") == 1
    bound = lambda sign: F.when(one, 0.0).otherwise(F.greatest(F.lit(0.0), spread + sign * 1e-10 * F.col("m2")))
    return found.select("id", "n", "rows", *[f"c_{x}" for x in names], bound(-1).alias("low"), bound(1).alias("high"), F.sqrt(away).alias("radius"))


def _most_linked(c: np.ndarray, high: np.ndarray, radius: np.ndarray, points: np.ndarray, highs: np.ndarray, radii: np.ndarray, complete: bool) -> np.ndarray:
    """A height that no two of the clusters exceed."""
    d = distances(c, points)
    h = np.sqrt(d) + radius[:, None] + radii if complete else np.sqrt(d + high[:, None] + highs)
    return h * (1 + 1e-9) + 1e-9 * max(np.abs(c).max(initial=0.0), np.abs(points).max(initial=0.0))


def _row_layout(members: DataFrame, names: list[str], left: int, n: int, block_rows: int, most_rows: int, seed: int) -> _Layout:
    """Blocks for ``left`` clusters of ``n`` rows, placed by a bounded draw of rows."""
    depth = max(0, int(np.ceil(np.log2(max(1, left / block_rows, n / most_rows)))))
    drawn = members.select(*names).orderBy(F.xxhash64("pid", F.lit(seed))).limit(DRAWN << depth).toPandas() if depth else pd.DataFrame(columns=names, dtype=float)
    return _Layout.of(drawn.to_numpy(dtype=float), depth, seed)


def _laid(clusters: DataFrame, names: list[str], layout: _Layout, most_rows: int) -> tuple[DataFrame, dict[int, np.ndarray], bool]:
    """Clusters with their block, the box of the centers of each block, and whether there are
    clusters too large for a block: their rows are dealt into pieces, blocks with negative names
    from ``first`` on, as many as ``pieces``."""
    centers = [f"c_{x}" for x in names]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in clusters.schema)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(block=layout.blocks(pdf[centers].to_numpy(dtype=float)))

    placed = cut_plan(clusters.mapInPandas(place, f"{fields}, block bigint"))
    sides = [f"{side}{i}" for side in ("lo", "hi") for i in range(len(names))]

    def extent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[pdf["rows"] <= most_rows]
            z = _turned(pdf[centers].to_numpy(dtype=float), layout.turn)
            wide = pd.DataFrame(np.hstack([z, z]), columns=sides).assign(m=pdf["low"].to_numpy(), block=pdf["block"].to_numpy())
            yield wide.groupby("block", as_index=False).agg({c: "max" if c.startswith("hi") else "min" for c in [*sides, "m"]})

    parts = placed.select("rows", "low", "block", *centers).mapInPandas(extent, "block bigint, " + ", ".join(f"{c} double" for c in [*sides, "m"]))
    extents = parts.groupBy("block").agg(*[(F.max if c.startswith("hi") else F.min)(c).alias(c) for c in [*sides, "m"]]).toPandas()
    boxes = dict(zip(map(int, extents["block"]), extents[[*sides, "m"]].to_numpy(dtype=float)))
    large = placed.filter(F.col("rows") > most_rows).select("id", "rows", "low", *centers).toPandas().sort_values("id")
    if not len(large):
        return placed.withColumns({c: F.lit(None).cast("bigint") for c in ("first", "pieces")}), boxes, False
    pieces = (-(-large["rows"] // most_rows)).to_numpy(dtype=np.int64)
    first = np.cumsum(pieces) - pieces
    z = _turned(large[centers].to_numpy(dtype=float), layout.turn)
    for i, (at, many) in enumerate(zip(first.tolist(), pieces.tolist())):
        boxes |= {-1 - at - k: np.concatenate([z[i], z[i], [float(large["low"].iloc[i])]]) for k in range(many)}
    known = small_table(clusters.sparkSession, list(zip(large["id"].tolist(), first.tolist(), pieces.tolist())), "id bigint, first bigint, pieces bigint")
    return placed.join(known, "id", "left").withColumn("block", F.when(F.col("pieces").isNull(), F.col("block")).otherwise(-1 - F.col("first"))), boxes, True


def _row_blocks(members: DataFrame, placed: DataFrame, large: bool, some: Sequence[str]) -> DataFrame:
    """Rows with the block of their cluster, or of their piece of it, and ``some`` of its columns."""
    known = placed.select("id", "block", "first", "pieces", *some)
    if not large:
        return members.join(known, "id")
    dealt = counted_join(members, known, ["id"], F.col("pid"), counted=placed.select("id", "rows"), counts="rows")
    return dealt.withColumn("block", F.when(F.col("pieces").isNull(), F.col("block")).otherwise(-1 - F.col("first") - F.pmod(F.xxhash64("pid"), F.col("pieces"))))


def _reach(placed: DataFrame, blocks: int, names: list[str], complete: bool, some_large: bool) -> DataFrame:
    """``limit`` of each cluster that has lost its nearest: a height its nearest does not exceed,
    told by the centers and spreads of its block, or of all clusters for the few large ones."""
    centers = [f"c_{x}" for x in names]
    sized = lambda pdf: (pdf[centers].to_numpy(dtype=float), pdf["high"].to_numpy(dtype=float), pdf["radius"].to_numpy(dtype=float))
    large = placed.filter("pieces IS NOT NULL AND nn IS NULL").toPandas() if some_large else pd.DataFrame()

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = np.full(len(large), np.inf)
        for pdf in batches:
            for i in range(0, len(pdf), CHUNK):
                some = pdf.iloc[i : i + CHUNK]
                h = _most_linked(*sized(large), *sized(some), complete)
                h[large["id"].to_numpy()[:, None] == some["id"].to_numpy()] = np.inf
                least = np.minimum(least, h.min(axis=1, initial=np.inf))
        yield pd.DataFrame({"id": large["id"].astype(np.int64), "limit": least})

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        lost = pdf["nn"].isna().to_numpy()
        limit, ids = pdf["h"].to_numpy(dtype=float).copy(), pdf["id"].to_numpy()
        at, every = np.flatnonzero(lost), sized(pdf)
        for i in range(0, len(at), CHUNK):
            some = at[i : i + CHUNK]
            h = _most_linked(*[part[some] for part in every], *every, complete)
            h[ids[some][:, None] == ids] = np.inf
            limit[some] = h.min(axis=1, initial=np.inf)
        return pdf.assign(limit=limit)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = cut_plan(placed.repartition(max(parts, min(blocks, 4 * parts)), "block").groupBy("block").applyInPandas(own, fields + ", limit double"))
    if not len(large):
        return out
    known = out.mapInPandas(told, "id bigint, limit double").groupBy("id").agg(F.min("limit").alias("limit")).collect()
    known = small_table(out.sparkSession, [tuple(r) for r in known], "id bigint, known double")
    return out.join(known, "id", "left").withColumn("limit", F.coalesce("known", "limit")).drop("known")


def _linked(names: list[str], complete: bool):
    """The nearest of the other block for each asking cluster, the lower id on equal heights; of
    clusters larger than a block the part of the distance instead. Only clusters that may be
    within the limit are measured."""
    centers = [f"c_{x}" for x in names]

    def linked(asked: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool))]
        if len(asked) and len(other):
            head, at, p, x = _by_cluster(asked, names)
            heads, to, q, y = _by_cluster(other, names)
            mine, theirs, mine_cut, theirs_cut = head["id"].to_numpy(), heads["id"].to_numpy(), head["cut"].to_numpy(bool), heads["cut"].to_numpy(bool)
            c, points, limit = head[centers].to_numpy(dtype=float), heads[centers].to_numpy(dtype=float), head["limit"].to_numpy(dtype=float)
            slack = 1e-9 * max(np.abs(c).max(), np.abs(points).max())
            sizes, ends = np.diff(np.append(to, len(y))), np.append(at, len(x))
            rows = np.diff(ends)
            # Near clusters ask together, a few of them or a few of their rows.
            order = np.argsort(_Layout.of(c, max(0, len(c).bit_length() - 6), 0).blocks(c), kind="stable")
            load = (np.cumsum(rows[order]) - rows[order]) // ASKED_TOGETHER
            for some in np.split(order, np.flatnonzero(np.diff(load)) + 1):
                some = np.sort(some)
                d = distances(c[some], points)
                if complete:
                    d += head["low"].to_numpy(dtype=float)[some, None] + heads["low"].to_numpy(dtype=float)
                fits = (np.sqrt(d) * (1 - 1e-9) - slack <= limit[some, None]) & (mine[some, None] != theirs)
                near = np.flatnonzero(fits.any(axis=0))
                if not len(near):
                    continue
                at_x = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in some])
                at_y = np.flatnonzero(np.repeat(fits.any(axis=0), sizes))
                h = _between(x[at_x], np.cumsum(rows[some]) - rows[some], p[at_x], y[at_y], np.cumsum(sizes[near]) - sizes[near], q[at_y], complete)
                fits, cut = fits[:, near], mine_cut[some, None] | theirs_cut[near]
                a, b = np.nonzero(cut & fits)
                out.append((mine[some][a], h[a, b], theirs[near][b], np.ones(len(a), bool)))
                h[cut | ~fits] = np.inf
                best = h.argmin(axis=1)
                low = h[np.arange(len(some)), best]
                found = np.isfinite(low)
                out.append((mine[some][found], low[found], theirs[near][best[found]], np.zeros(int(found.sum()), bool)))
        return pd.DataFrame(dict(zip(["id", "h", "nn", "part"], map(np.concatenate, zip(*out)))))

    return linked


def _heights_found(dealt: DataFrame, layout: _Layout, boxes: dict[int, np.ndarray], names: list[str], complete: bool) -> DataFrame:
    """``(id, nn, h)``: the nearest of every cluster that has lost its. The blocks that may hold one
    within the limit are asked; a block that many rows ask answers in shares."""
    order = np.array(sorted(boxes))
    walls = np.array([boxes[b] for b in order])
    centers = [f"c_{x}" for x in names]

    def wanted(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        z, low, limit = _turned(pdf[centers].to_numpy(dtype=float), layout.turn), pdf["low"].to_numpy(dtype=float), pdf["limit"].to_numpy(dtype=float)
        for i in range(0, len(pdf), CHUNK):
            some = slice(i, i + CHUNK)
            row, at = np.nonzero(_least_linked(z[some], low[some], walls, complete) <= limit[some, None])
            yield row + i, at

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(order), np.int64)
        for pdf in batches:
            for _, at in wanted(pdf):
                total += np.bincount(at, minlength=len(order))
        yield pd.DataFrame({"other": order, "rows": total})

    lost = dealt.filter("nn IS NULL")
    asked = lost.select("low", "limit", *centers).mapInPandas(counted, "other bigint, rows bigint").groupBy("other").agg(F.sum("rows").alias("rows")).toPandas()
    share_of = dict(zip(asked["other"], -(-asked["rows"].to_numpy() // ASKED_ROWS)))
    shares = np.array([share_of.get(b, 0) for b in order], np.int64)
    held = ["id", "share", *names, *centers, "low", "cut"]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row, at in wanted(pdf):
                out = pdf[[*held, "limit"]].iloc[row]
                yield out.assign(other=order[at], part=(out["id"].to_numpy() % np.maximum(1, shares[at])).astype(np.int64))

    fields = ", ".join(f"`{f}` {dealt.schema[f].dataType.simpleString()}" for f in [*held, "limit"])
    asking = lost.select(*held, "limit").mapInPandas(ask, fields + ", other bigint, part bigint")
    known = small_table(dealt.sparkSession, [(int(b), int(k)) for b, k in zip(order, shares)], "other bigint, shares bigint")
    answering = dealt.select(*held, F.col("block").alias("other")).join(known, "other").filter("shares > 0").select("other", *held, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("part"))
    found = paired(asking, answering, ["other", "part"]).applyInPandas(_linked(names, complete), "id bigint, h double, nn bigint, part boolean")
    # Parts of a distance are put together; of whole ones only the nearest goes on.
    total = F.max("h") if complete else F.sum("h")
    found = found.groupBy("id", F.when(F.col("part"), F.col("nn")).alias("to")).agg(total.alias("total"), F.min(F.struct("h", "nn")).alias("m"))
    found = found.select("id", F.when(F.col("to").isNotNull(), F.struct(F.col("total").alias("h"), F.col("to").alias("nn"))).otherwise(F.col("m")).alias("m"))
    return found.groupBy("id").agg(F.min("m").alias("m")).select("id", "m.nn", "m.h")


def _all_heights(members: DataFrame, names: list[str], complete: bool, n: int, block_rows: int) -> DataFrame:
    """``(a, b, h)`` of all pairs of clusters, ``a`` below ``b``. Clusters are dealt whole into blocks
    of about ``block_rows`` rows, those too large for that row by row; a task measures two blocks."""
    blocks = -(-n // block_rows)
    sizes = members.groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    large = [(r["id"],) for r in sizes.filter(F.col("rows") > max(1, block_rows // 16)).collect()]
    known = small_table(members.sparkSession, large, "id bigint").withColumn("cut", F.lit(True))
    by = F.when(F.col("cut"), F.col("pid")).otherwise(F.col("id"))
    dealt = members.join(known, "id", "left").withColumn("block", F.pmod(F.xxhash64(by), F.lit(blocks)).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = pairs.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other"), "left": F.col("block") <= F.col("other")})
    between = _between if n <= FEW_ROWS else _between_many

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [pdf for pdf in batches if len(pdf)]
        if not held:
            return
        pdf = pd.concat(held)
        same = bool(pdf["i"].iloc[0] == pdf["j"].iloc[0])
        left, right = pdf[pdf["left"]], pdf if same else pdf[~pdf["left"]]
        if not len(left) or not len(right):
            return
        (head, at, p, x), (heads, to, q, y) = _by_cluster(left, names), _by_cluster(right, names)
        mine, theirs = head["id"].to_numpy(), heads["id"].to_numpy()
        h = between(x, at, p, y, to, q, complete)
        for k in range(0, len(mine), CHUNK):
            a, b = np.nonzero((mine[k : k + CHUNK, None] < theirs) if same else (mine[k : k + CHUNK, None] != theirs))
            ends = np.stack([mine[k + a], theirs[b]])
            yield pd.DataFrame({"a": ends.min(axis=0), "b": ends.max(axis=0), "h": h[k + a, b]})

    parts = pairs.select("id", "share", *names, "i", "j", "left", F.expr("int(j * (j + 1L) div 2 + i)").alias("pair")).repartitionById(blocks * (blocks + 1) // 2, "pair")
    found = parts.mapInPandas(measured, MERGES)
    if not len(large):
        return found
    return found.groupBy("a", "b").agg((F.max("h") if complete else F.sum("h")).alias("h"))


@dataclass
class _Held:
    """Rows of a bounded table, sorted by cluster, and what is known of each cluster."""

    ids: np.ndarray
    starts: np.ndarray
    n: np.ndarray
    share: np.ndarray
    x: np.ndarray

    def __post_init__(self) -> None:
        self.rows = np.diff(np.append(self.starts, len(self.x)))
        self.c = np.add.reduceat(self.share[:, None] * self.x, self.starts, axis=0)
        away = ((self.x - np.repeat(self.c, self.rows, axis=0)) ** 2).sum(axis=1)
        self.spread = np.add.reduceat(self.share * away, self.starts)
        self.radius = np.sqrt(np.maximum.reduceat(away, self.starts))

    def nearest(self, p: int, d: np.ndarray, slack: float, complete: bool) -> tuple[int, float]:
        """Place and height of the nearest of cluster ``p``, whose center is ``d`` from the others. They
        are measured in the order of their least possible height, until none can be nearer."""
        least = (np.sqrt(d * d + self.spread[p] + self.spread) if complete else d) * (1 - 1e-9) - slack
        most = (d + self.radius[p] + self.radius if complete else np.sqrt(d * d + self.spread[p] + self.spread)) * (1 + 1e-9) + slack
        least[p] = most[p] = np.inf
        some = np.flatnonzero(least <= most.min())
        some = some[np.argsort(least[some], kind="stable")]
        best, at, taken, own = np.inf, -1, 0, slice(self.starts[p], self.starts[p] + self.rows[p])
        while taken < len(some) and least[some[taken]] <= best:
            part = np.sort(some[taken : max(4, 2 * taken)])
            taken += len(part)
            sizes = self.rows[part]
            to = np.cumsum(sizes) - sizes
            rows = np.arange(sizes.sum()) + np.repeat(self.starts[part] - to, sizes)
            h = _between(self.x[own], np.zeros(1, np.int64), self.share[own], self.x[rows], to, self.share[rows], complete)[0]
            i = int(h.argmin())
            if (h[i], part[i]) < (best, at):
                best, at = float(h[i]), int(part[i])
        return at, best

    def merged(self, a: np.ndarray, b: np.ndarray, halves: bool) -> tuple[_Held, np.ndarray]:
        """The clusters after ``b`` went into ``a``, and the place of each cluster among them, -1 if it merged."""
        total, factor, into = self.n[a] + self.n[b], np.ones(len(self.ids)), np.arange(len(self.ids))
        factor[a], factor[b] = (0.5, 0.5) if halves else (self.n[a] / total, self.n[b] / total)
        n, live = self.n.copy(), np.ones(len(self.ids), dtype=bool)
        n[a], into[b], live[b] = total, a, False
        place = np.cumsum(live) - 1
        cluster = np.repeat(place[into], self.rows)
        order = np.argsort(cluster, kind="stable")
        held = _Held(self.ids[live], np.searchsorted(cluster[order], np.arange(live.sum())), n[live], (self.share * np.repeat(factor, self.rows))[order], self.x[order])
        place[a] = place[b] = -1
        return held, place


def _held_rounds(members: DataFrame, names: list[str], linkage: str, few: int) -> tuple[DataFrame, DataFrame]:
    """Merges, and the rows in the ``few`` clusters that are left, of a table that the driver and each
    task can hold: tasks look up the nearest of their clusters, the rows stay where they are."""
    spark, complete = members.sparkSession, linkage == "complete"
    rows = members.toPandas().sort_values(["id", "pid"])
    heads, starts, share, x = _by_cluster(rows, names)
    held = _Held(heads["id"].to_numpy(), starts, heads["n"].to_numpy(dtype=float), share, x)
    near, height = np.full(len(starts), -1), np.full(len(starts), np.inf)
    merges, fresh, tasks = [], True, 4 * spark.sparkContext.defaultParallelism

    while len(held.ids) > max(1, few):
        lost = np.flatnonzero(near < 0)
        lost = lost[np.argsort(-held.rows[lost], kind="stable")]
        told = spark.sparkContext.broadcast(held)

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            now = told.value
            square, slack = (now.c * now.c).sum(axis=1), 1e-6 * np.abs(now.c).max()
            step = max(1, CHUNK_CELLS // len(now.ids))
            for pdf in batches:
                at, found = pdf["p"].to_numpy(), []
                for i in range(0, len(at), step):
                    some = at[i : i + step]
                    # Rounding of the product is far within the slack.
                    d = np.sqrt(np.maximum(square[some, None] + square - 2.0 * (now.c[some] @ now.c.T), 0.0))
                    found += [now.nearest(int(p), row, slack, complete) for p, row in zip(some, d)]
                yield pd.DataFrame({"p": at, "nn": [f[0] for f in found], "h": [f[1] for f in found]}).astype({"nn": np.int64, "h": float})

        asked = spark.createDataFrame(pa.table({"p": lost, "task": (np.arange(len(lost)) % tasks).astype(np.int32)}))
        got = asked.repartitionById(tasks, "task").select("p").mapInPandas(look, "p bigint, nn bigint, h double").toPandas()
        told.destroy()
        near[got["p"]], height[got["p"]] = got["nn"], got["h"]
        a = np.flatnonzero((near[near] == np.arange(len(near))) & (np.arange(len(near)) < near))
        if not len(a) and not fresh:  # equal heights told apart by clusters that are gone: look all up again
            near[:], fresh = -1, True
            continue
        if not len(a):  # a ring of heights equal but for rounding: its lowest pair
            p = int(height.argmin())
            near[near[p]], a = p, np.array([min(p, near[p])])
        fresh, b = False, near[a]
        merges += zip(held.ids[a].tolist(), held.ids[b].tolist(), np.minimum(height[a], height[b]).tolist())
        held, place = held.merged(a, b, linkage == "weighted")
        kept = np.flatnonzero((place >= 0) & (place[near] >= 0))
        now, of = np.full(len(held.ids), -1), np.full(len(held.ids), np.inf)
        now[place[kept]], of[place[kept]] = place[near[kept]], height[kept]
        near, height = now, of
    table = {"pid": np.arange(len(held.x)), "id": np.repeat(held.ids, held.rows), "share": held.share, "n": np.repeat(held.n, held.rows), **{c: held.x[:, j].copy() for j, c in enumerate(names)}}
    return small_table(spark, merges, MERGES), spark.createDataFrame(pa.table(table))


def _linkage_rounds(micro: DataFrame, cols: Sequence[str], linkage: str, few: int, block_rows: int) -> DataFrame:
    """Average and weighted distances of two clusters are sums over their rows of the distance
    times both shares, where a row's share of its cluster is its weight over the cluster's, or one
    half to the power of the merges it went through. The complete distance is the largest."""
    complete, names = linkage == "complete", [f"x{i}" for i in range(len(cols))]
    spark, held = micro.sparkSession, ["pid", "id", "share", "n", *[f"x{i}" for i in range(len(cols))]]
    known = micro.select(F.col("label").cast("bigint").alias("pid"), F.col("n").cast("double").alias("n"), *[F.col(c).cast("double").alias(x) for c, x in zip(cols, names)])
    members = cut_plan(known.select("pid", F.col("pid").alias("id"), F.lit(1.0).alias("share"), "n", *names))
    n = members.count()
    merges, left, turn, parts = [small_table(spark, [], MERGES)], n, 0, int(spark.conf.get("spark.sql.shuffle.partitions"))
    most_rows = PAIR_ROWS * block_rows // BLOCK_ROWS
    centers = [f"c_{x}" for x in names]
    # As in ward: merges that are sure in a block, as long as that gains.
    small = n * len(names) <= HELD_CELLS
    gained = not small or n > DIRECT_ROWS
    while left > max(1, few) and gained:
        layout = _row_layout(members, names, left, n, block_rows, most_rows, turn)
        placed, boxes, large = _laid(_clusters(members, names, complete), names, layout, most_rows)
        dealt = _row_blocks(members, placed, large, []).select(*held, "block")
        work = _linked_blocks(layout, boxes, names, linkage, block_rows, most_rows)
        fields = ", ".join(f"`{f}` {members.schema[f].dataType.simpleString()}" for f in held)
        both = cut_plan(dealt.repartition(max(parts, min(len(boxes), 4 * parts)), "block").groupBy("block").applyInPandas(work, fields + ", merged boolean, h double"))
        sure = both.filter("merged").select(F.col("id").alias("a"), F.col("pid").alias("b"), "h")
        done, turn = sure.count(), turn + 1
        members, merges, gained = both.filter("NOT merged").select(*held), [*merges, sure], done >= GAIN * left
        left -= done
    if small and left > max(1, few):
        done, members = _held_rounds(members, names, linkage, few)
        merges, left = [*merges, done], max(1, few)
    near, fresh = small_table(spark, [], "id bigint, nn bigint, h double"), True
    layout = _row_layout(members, names, left, n, block_rows, most_rows, 0) if left > max(1, few) else None
    while left > max(1, few):
        # A cluster keeps its nearest while that one lives.
        placed, boxes, large = _laid(_clusters(members, names, complete).join(near, "id", "left"), names, layout, most_rows)
        state = _reach(placed, len(boxes), names, complete, large)
        some = [*centers, "low", "limit", "nn"]
        dealt = cut_plan(_row_blocks(members, state.select("id", "rows", "block", "first", "pieces", *some), large, some).select(*held, "block", *some, F.col("pieces").isNotNull().alias("cut")))
        found = _heights_found(dealt, layout, boxes, names, complete).toDF("id", "nn_found", "h_found")
        state = cut_plan(state.select("id", "n", "nn", "h").join(found, "id", "left").select("id", "n", F.coalesce("nn", "nn_found").alias("nn"), F.coalesce("h", "h_found").alias("h")))
        pairs = state.groupBy(F.least("id", "nn").alias("a"), F.greatest("id", "nn").alias("b")).agg(F.count(F.lit(1)).alias("ends"), F.min("h").alias("h"), F.sum("n").alias("total"), F.collect_list(F.struct("id", "n")).alias("both"))
        told = lambda mutual: cut_plan(mutual.select(F.col("a").alias("new"), "total", "h", F.inline("both")))
        moved = told(pairs.filter("ends = 2"))
        done = moved.count() // 2
        members = dealt.select(*held)
        if not done and not fresh:  # equal heights told apart by clusters that are gone: look all up again
            near, fresh = near.limit(0), True
            continue
        if not done:  # a ring of heights equal but for rounding: its lowest pair
            lowest = pairs.orderBy("h", "a", "b").limit(1).select("a", "b", "h")
            ends = lowest.select("a", "h", F.explode(F.array("a", "b")).alias("id")).join(state.select("id", "n"), "id")
            moved, done = told(ends.groupBy("a").agg(F.min("h").alias("h"), F.sum("n").alias("total"), F.collect_list(F.struct("id", "n")).alias("both"))), 1
        fresh = False
        merges, left = [*merges, moved.filter("id != new").select(F.col("new").alias("a"), F.col("id").alias("b"), "h")], left - done
        factor = F.lit(0.5) if linkage == "weighted" else F.col("n") / F.col("total")
        members = salted_join(members, moved.select("id", "new", "total", factor.alias("factor")), ["id"], F.col("pid"), "left").select(
            "pid", F.coalesce("new", "id").alias("id"), (F.col("share") * F.coalesce("factor", F.lit(1.0))).alias("share"), F.coalesce("total", "n").alias("n"), *names
        )
        gone = moved.select("id")
        near = state.select("id", "nn", "h").join(gone, "id", "left_anti").join(gone.withColumnRenamed("id", "nn"), "nn", "left_anti").select("id", "nn", "h")
    in_rounds = reduce(DataFrame.unionByName, merges)
    members = cut_plan(members)
    sizes = members.groupBy("id").agg(F.first("n").alias("n")).toPandas().sort_values("id")
    if len(sizes) < 2:
        return cut_plan(in_rounds)
    ids, size = sizes["id"].to_numpy(), sizes["n"].to_numpy(dtype=float)

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s, seen = np.zeros((len(ids), len(ids))), False
        for pdf in batches:
            seen = seen or len(pdf) > 0
            a, b = np.searchsorted(ids, pdf["a"]), np.searchsorted(ids, pdf["b"])
            s[a, b] = s[b, a] = pdf["h"]
        if seen:
            yield pd.DataFrame(_last_merges(ids, size, s, linkage), columns=["a", "b", "h"])

    every = _all_heights(members, names, complete, n, max(1, min(LAST_ROWS * block_rows // BLOCK_ROWS, -(-n // PAIRED_BLOCKS))))
    return cut_plan(in_rounds.unionByName(every.coalesce(1).mapInPandas(last, MERGES)))


def merge_rounds(micro: DataFrame, cols: Sequence[str], linkage: str, few: int = FEW, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Merges ``a`` (kept id), ``b`` (absorbed id), ``h`` (height) of a table ``(label, <cols>, n)``."""
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}")
    return _ward_rounds(micro, cols, few, block_rows) if linkage == "ward" else _linkage_rounds(micro, cols, linkage, few, block_rows)


def merge_tree(micro: DataFrame, cols: Sequence[str], linkage: str) -> list[tuple[int, int, float]]:
    """The merges of a small table as a list; ``hierarchy`` leaves them in Spark."""
    return [tuple(r) for r in merge_rounds(micro, cols, linkage).collect()]


def cut_tree(ids: Sequence[int], merges: Sequence[tuple[int, int, float]], k: int) -> dict[int, int]:
    """Label per micro-cluster after the ``len(ids) - k`` lowest merges; labels follow the
    lowest id they hold."""
    owner = {i: i for i in ids}

    def root(i: int) -> int:
        while owner[i] != i:
            i = owner[i]
        return i

    for p, q, _ in sorted(merges, key=lambda m: (m[2], m[0], m[1]))[: max(0, len(ids) - k)]:
        a, b = sorted((root(p), root(q)))
        owner[b] = a
    roots = sorted({root(i) for i in ids})
    return {i: roots.index(root(i)) for i in ids}


def _cuts(points: DataFrame, merges: DataFrame, k_list: Sequence[int]) -> DataFrame:
    """``(label, label_k<k> ...)`` of each cluster. Only the highest merges, fewer than the
    largest k, and the groups they join come to the driver."""
    top = merges.orderBy(F.desc("h"), F.desc("a"), F.desc("b")).limit(max(k_list) - 1)
    high = small_table(points.sparkSession, [tuple(r) for r in top.collect()], MERGES)
    parts = connected_components(points.select(F.col("label").cast("bigint").alias("node")), merges.join(high, "b", "left_anti").select("a", "b"), cut_plan)
    of = lambda x: parts.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))
    last = [tuple(r) for r in high.join(of("a"), "a").join(of("b"), "b").select("of_a", "of_b", "h").collect()]
    ids = sorted(r["component"] for r in parts.select("component").distinct().collect())
    cuts = {k: cut_tree(ids, last, k) for k in k_list}
    schema = "component bigint, " + ", ".join(f"label_k{k} int" for k in k_list)
    named = small_table(points.sparkSession, [(i, *[cuts[k][i] for k in k_list]) for i in ids], schema)
    return parts.join(named, "component").select(F.col("node").alias("label"), *[f"label_k{k}" for k in k_list])


def hierarchy(
    df: DataFrame, key: str, cols: Sequence[str], linkage: str, k_list: Sequence[int], micro: int | None, seed: int = 0
) -> DataFrame:
    """``(key, label_k<k> ...)``: every row labelled by one column per requested cut of one
    tree. ``micro`` None, or not below the number of distinct rows, links the rows
    themselves, copies as one weighted point: exact, and quadratic in the distinct rows.
    Fewer link that many micro-clusters, trained on all rows until they stay, by their
    centers; rows of one are never separated."""
    cols = list(cols)
    rows = df.select(key, *cols)
    points = cut_lineage(rows.groupBy(*cols).agg(F.min(key).cast("bigint").alias("label"), F.count(F.lit(1)).alias("n")))
    named = [f"label_k{k}" for k in k_list]
    if micro is None or points.count() <= micro:
        cuts = _cuts(points, merge_rounds(points, cols, linkage), k_list)
        return salted_join(rows, points.join(cuts, "label").select(*cols, *named), cols, F.col(key)).select(key, *named)
    centers, _ = kmeans_many(df, key, cols, [micro], n_init=1, seed=seed, max_iter=10_000, tol=1e-9)[micro]
    assigned = cut_lineage(assign_nearest(rows, centers))
    table = cut_lineage(update_centers(assigned, cols))
    cuts = _cuts(table, merge_rounds(table, cols, linkage), k_list)
    return salted_join(assigned.select(key, "label"), cuts, ["label"], F.col(key)).select(key, *named)
