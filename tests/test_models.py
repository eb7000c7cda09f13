"""Model operators against brute force on small fixtures, and their invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.functions.components import connected_components
from stratiform.operators import bisecting as bi
from stratiform.operators import centers as ce
from stratiform.operators import density as de
from stratiform.operators import evaluate as ev
from stratiform.operators import hierarchy as hi
from stratiform.operators import kmodes as km
from stratiform.operators import mixture as mi
from stratiform.operators import pca, profile, som, tree

COLS = ["c0", "c1", "c2"]


def table(spark, x, cols=None):
    cols = cols or [f"c{j}" for j in range(x.shape[1])]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k bigint, " + ", ".join(f"{c} double" for c in cols))


def labels_of(df):
    return np.array([r.label for r in sorted(df.select("k", "label").collect())])


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(5)
    return np.vstack([rng.normal(m, 0.4, size=(n, 3)) for m, n in (((0, 0, 0), 150), ((4, 4, 0), 60), ((0, 5, 5), 40))]).round(6)


def brute_silhouette(x, lab):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = np.zeros(len(x))
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == o].mean() for o in set(lab) if o != lab[i])
        out[i] = (b - a) / max(a, b)
    return out


def brute_dbscan(x, eps, least):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    lab, n = np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and lab[i] == -1:
            stack, lab[i] = [i], n
            while stack:
                for t in np.where(near[stack.pop()] & core)[0]:
                    if lab[t] == -1:
                        lab[t] = n
                        stack.append(t)
            n += 1
    out = lab.copy()
    for i in np.where(~core)[0]:
        reach = [lab[j] for j in np.where(near[i] & core)[0]]
        out[i] = min(reach) if reach else -1
    return out


def test_nearest_center_routes_agree(spark, blobs, monkeypatch):
    df = table(spark, blobs)
    centers = ce.Centers.of(COLS, blobs[:6])
    want = ((blobs[:, None] - blobs[None, :6]) ** 2).sum(-1).argmin(1)
    assert (labels_of(ce.assign_nearest(df, centers)) == want).all()
    monkeypatch.setattr(ce, "INLINE_TERMS", 0)
    assert (labels_of(ce.assign_nearest(df, centers)) == want).all()


def test_kmeans_finds_blobs_and_elbow_falls(spark, blobs):
    df = table(spark, blobs)
    centers, cost = ce.kmeans(df, "k", COLS, 3, n_init=5)
    sizes = sorted(r.n for r in profile.label_counts(ce.assign_nearest(df, centers)).collect())
    assert sizes == [40, 60, 150]
    own = ((blobs[:, None] - centers.points[None]) ** 2).sum(-1).min(1).sum()
    assert cost == pytest.approx(own)
    sse = [r.sse for r in ce.elbow(df, "k", COLS, 4, n_init=5).orderBy("k").collect()]
    assert sse[0] == pytest.approx(((blobs - blobs.mean(0)) ** 2).sum())
    assert all(a >= b for a, b in zip(sse, sse[1:])) and sse[2] == pytest.approx(cost)
    assert {(r.method, r.label) for r in ce.compare_init(df, COLS, ["random", "k-means||"], 3).collect()} == {
        (m, i) for m in ("random", "k-means||") for i in range(3)
    }


@pytest.mark.parametrize("block_rows", [1000, 60])
def test_exact_silhouette(spark, blobs, block_rows):
    lab = np.arange(len(blobs)) % 3
    lab[7] = 9
    df = table(spark, blobs)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(lab)], "k bigint, label int")
    got = {r.k: r.silhouette for r in ev.silhouette_samples(df, labels, "k", COLS, block_rows=block_rows).collect()}
    want = brute_silhouette(blobs, lab)
    assert np.allclose([got[i] for i in range(len(blobs))], want)
    assert got[7] == 0.0
    row = ev.silhouette_bounds(df, labels, "k", COLS, cells=40).first()
    assert row.lower <= want.mean() <= row.upper and row.n == len(blobs)
    board = {r.method: r for r in ev.compare_methods(df, {"x": labels, "y": labels.withColumn("label", F.lit(-1) + F.col("label") % 2)}, "k", COLS, block_rows=block_rows).collect()}
    assert board["x"].silhouette == pytest.approx(want.mean()) and board["x"].n_clusters == 4
    assert board["y"].n_clusters == 1


def test_silhouette_pairs_of_groups_fill_all_tasks(spark):
    # Few rows make small partitions, which must not be joined: their work is quadratic.
    rng = np.random.default_rng(8)
    points = np.vstack([rng.normal(size=(300, 3)) * 1e-4 + 1e5, rng.normal(size=(5, 3))])
    points[5] = points[4]
    lab = np.arange(len(points)) % 3
    members = table(spark, points).join(spark.createDataFrame([(i, int(v)) for i, v in enumerate(lab)], "k bigint, label int"), "k")
    sums = ev._label_sums(members, "k", COLS, ["label"], 60)
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    got = {(r.k, r.other): r.s for r in sums.collect()}
    want = {(i, int(v)): d[i, lab == v].sum() for i in range(len(points)) for v in range(3)}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], rel=1e-9) for x in want)
    assert "REPARTITION_BY_NUM" in sums._jdf.queryExecution().toString()


@pytest.mark.parametrize("tol", [0.3, 0.05, 1e-6])
def test_silhouettes_to_a_tolerance(spark, blobs, tol):
    points = np.concatenate([blobs, blobs[:20]])  # copies share a summary
    df = table(spark, points)
    coded = {"thirds": np.arange(len(points)) % 3, "near": np.argmin(((points[:, None, :] - points[None, [0, 50, 100], :]) ** 2).sum(axis=2), axis=1), "noise": np.arange(len(points)) % 4 - 1}
    coded["thirds"][7] = 9  # a cluster of one row
    labelings = {m: spark.createDataFrame([(i, int(v)) for i, v in enumerate(lab)], "k bigint, label int") for m, lab in coded.items()}
    labelings["one"] = df.select("k", F.lit(0).alias("label"))
    got = {r.method: r for r in ev.compare_within(df, labelings, "k", COLS, tol).collect()}
    for m, lab in coded.items():
        want = brute_silhouette(points, lab).mean()
        assert got[m].lower - 1e-9 <= want <= got[m].upper + 1e-9 and got[m].upper - got[m].lower <= tol
        assert got[m].n_clusters == len(set(lab.tolist()) - {-1})
    assert got["one"].silhouette is None and got["one"].n_clusters == 1
    few = ev.compare_within(df, {"near": labelings["near"]}, "k", COLS, tol, max_cells=2).first()
    assert few.lower == few.upper == pytest.approx(brute_silhouette(points, coded["near"]).mean())  # the exact form
    kept = {r.method: r for r in ev.compare_within(df, {m: labelings[m] for m in ("noise", "thirds")}, "k", COLS, tol, exclude_noise=True).collect()}
    inside = coded["noise"] >= 0
    assert kept["noise"].lower - 1e-9 <= brute_silhouette(points[inside], coded["noise"][inside]).mean() <= kept["noise"].upper + 1e-9
    assert kept["thirds"].n_clusters == 4
    none = ev.compare_within(df.limit(0), {"near": labelings["near"]}, "k", COLS, tol).first()
    assert none.silhouette is None and none.n_clusters == 0


def test_single_cluster_has_no_score(spark, blobs):
    df = table(spark, blobs)
    assert ev.silhouette_score(df, df.select("k", F.lit(0).alias("label")), "k", COLS).first()[0] is None


@pytest.mark.parametrize("dims,eps,least", [(2, 0.3, 6), (5, 1.1, 8)])
def test_dbscan_matches_brute_force(spark, dims, eps, least):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(360, dims))
    x[:120] = 0.25  # a third of the rows are copies of one point
    x[120:160] = rng.normal(size=(40, dims)) * 0.05 + 1
    x = x.round(6)
    df = table(spark, x)
    want = brute_dbscan(x, eps, least)
    cols = [f"c{j}" for j in range(dims)]
    for direct in (None, 0):
        assert (labels_of(de.dbscan(df, "k", cols, eps, least, direct_pairs=direct)) == want).all()


def test_dbscan_compares_cells_of_different_clusters_only(spark, monkeypatch):
    """Two crowded squares and a few lone rows: once cells sharing a face are linked, only pairs
    of cells that are still apart are looked at."""
    rng = np.random.default_rng(11)
    x = np.vstack([rng.uniform(size=(900, 2)), rng.uniform(size=(900, 2)) + [1.15, 0], rng.uniform(size=(30, 2)) * 3 + [0, 1.4]]).round(6)
    asked, touching = [], de._touching

    def counted(requests, *rest):
        asked.append(requests.count())
        return touching(requests, *rest)

    monkeypatch.setattr(de, "_touching", counted)
    for direct in (None, 0):
        asked.clear()
        assert (labels_of(de.dbscan(table(spark, x), "k", ["c0", "c1"], 0.2, 6, direct_pairs=direct)) == brute_dbscan(x, 0.2, 6)).all()
        side = 0.2 / np.sqrt(2)
        cells = {tuple(c) for c in np.floor(x[:1800] / side).astype(int)}
        shared = sum(((a, b + 1) in cells) + ((a + 1, b) in cells) for a, b in cells)
        assert len(asked) == 2 and sum(asked) < 2 * shared


def test_dbscan_all_noise(spark):
    x = np.arange(20.0)[:, None] * 10 @ np.ones((1, 2))
    df = table(spark, x)
    labels = de.dbscan(df, "k", ["c0", "c1"], 1.0, 3)
    assert set(labels_of(labels)) == {-1}
    assert profile.n_clusters(labels).first()[0] == 0
    assert profile.cluster_profile(df, labels, "k", ["c0", "c1"]).count() == 0


def test_pairs_within_splits_crowded_cells(spark, blobs, monkeypatch):
    x = np.hstack([blobs, blobs[:, ::-1] * 0.5, np.random.default_rng(2).normal(size=(len(blobs), 2)) * 2]).round(6)
    cols = [f"c{j}" for j in range(8)]
    df = table(spark, x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = {(i, j) for i, j in zip(*np.where(d <= 1.2)) if i < j}
    for limit in (4_000_000, 50):
        monkeypatch.setattr(de, "CROWDED", limit)
        got = [(r.key_a, r.key_b) for r in de.pairs_within(df, "k", cols, 1.2).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components_of_a_long_chain(spark):
    nodes = spark.createDataFrame([(f"{i:03d}",) for i in range(120)], "node string")
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(119) if i != 60], "a string, b string")
    got = {r.node: r.component for r in connected_components(nodes, edges).collect()}
    assert set(got.values()) == {"000", "061"} and got["060"] == "000" and got["119"] == "061"


def test_mean_shift_routes_agree(spark, blobs):
    df = table(spark, blobs)
    few = sorted(tuple(np.round(r, 6)) for r in map(tuple, de.mean_shift_seeds(df, "k", COLS, 1.5).collect()))
    many = sorted(tuple(np.round(r, 6)) for r in map(tuple, de.mean_shift_seeds(df, "k", COLS, 1.5, few=0).collect()))
    assert np.allclose(few, many, atol=1e-5)
    labels, centers = de.mean_shift(df, "k", COLS, 1.5)
    assert len(centers.points) == 3
    assert [r.n for r in profile.label_counts(labels).orderBy("label").collect()] == [150, 60, 40]


def test_bandwidth_counts_the_row_itself(spark, blobs):
    df = table(spark, blobs)
    d = np.sort(np.sqrt(((blobs[:, None] - blobs[None]) ** 2).sum(-1)), axis=1)
    k = int(len(blobs) * 0.1)
    got = de.estimate_bandwidth(df, "k", COLS, 0.1, 1000).first()
    assert got.bandwidth == pytest.approx(d[:, k - 1].mean()) and got.n == len(blobs)


def greedy_tree(points, size, linkage):
    """One merge at a time, by definition of each linkage; heights in order."""
    groups = {i: ([i], {i: 1.0}) for i in range(len(points))}
    base = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))

    def dist(a, b):
        (ma, ua), (mb, ub) = groups[a], groups[b]
        sub = base[np.ix_(ma, mb)]
        wa, wb = size[ma], size[mb]
        if linkage == "complete":
            return sub.max()
        if linkage == "average":
            return (sub * wa[:, None] * wb[None]).sum() / (wa.sum() * wb.sum())
        if linkage == "weighted":
            return sum(ua[i] * ub[j] * base[i, j] for i in ma for j in mb)
        ca, cb = np.average(points[ma], axis=0, weights=wa), np.average(points[mb], axis=0, weights=wb)
        return np.sqrt(2 * wa.sum() * wb.sum() / (wa.sum() + wb.sum()) * ((ca - cb) ** 2).sum())

    heights = []
    while len(groups) > 1:
        h, a, b = min((dist(a, b), a, b) for a in groups for b in groups if a < b)
        heights.append(h)
        (ma, ua), (mb, ub) = groups.pop(a), groups.pop(b)
        groups[a] = (ma + mb, {**{i: v / 2 for i, v in ua.items()}, **{i: v / 2 for i, v in ub.items()}})
    return sorted(heights)


@pytest.mark.parametrize("linkage", hi.LINKAGES)
def test_reciprocal_merges_equal_greedy_merges(spark, linkage):
    rng = np.random.default_rng(11)
    points, size = rng.normal(size=(14, 2)), rng.integers(1, 9, 14).astype(float)
    micro = spark.createDataFrame([(i, *map(float, p), int(n)) for i, (p, n) in enumerate(zip(points, size))], "label int, c0 double, c1 double, n bigint")
    merges = hi.merge_tree(micro, ["c0", "c1"], linkage)
    assert sorted(h for _, _, h in merges) == pytest.approx(greedy_tree(points, size, linkage))
    for k in (1, 3, 14):
        assert len(set(hi.cut_tree(range(14), merges, k).values())) == k


def test_hierarchies_label_every_row(spark, blobs):
    df = table(spark, blobs)
    out = hi.hierarchy(df, "k", COLS, "ward", [3, 4], micro=20)
    assert out.count() == len(blobs)
    assert sorted(r.n for r in out.groupBy("label_k3").agg(F.count("*").alias("n")).collect()) == [40, 60, 150]
    # Top-down splits the largest cluster first, so it need not find the same three groups.
    sizes = [r.n for r in profile.label_counts(bi.bisecting(df, "k", COLS, 3)).collect()]
    assert len(sizes) == 3 and sum(sizes) == len(blobs)


def test_bisecting_equals_one_split_after_another(spark, blobs):
    """Side by side in shared scans as split by split: fixed starts, then the same order."""

    def halves(rows):
        points = blobs[rows[:2]]
        for _ in range(3):
            near = ((blobs[rows][:, None] - points) ** 2).sum(axis=2).argmin(axis=1)
            points = np.array([blobs[rows][near == i].mean(axis=0) for i in (0, 1)])
        d = ((blobs[rows][:, None] - points) ** 2).sum(axis=2)
        near = d.argmin(axis=1)
        return [(rows[near == i], d[near == i].min(axis=1).sum()) for i in (0, 1)]

    leaves = [(np.arange(len(blobs)), np.inf)]
    while len(leaves) < 6:
        at = max(range(len(leaves)), key=lambda i: leaves[i][1])
        leaves[at : at + 1] = halves(leaves[at][0])
    want = np.zeros(len(blobs), int)
    for i, (rows, _) in enumerate(leaves):
        want[rows] = i
    got = labels_of(bi.bisecting(table(spark, blobs), "k", COLS, 6, max_iter=3, tol=0.0, lowest_keys=True))
    assert (got == want).all()


def test_bisecting_finds_groups_and_stops_at_copies(spark, blobs):
    df = table(spark, blobs)
    got = labels_of(bi.bisecting(df, "k", COLS, 3))
    assert all(len(set(got[a:b])) == 1 for a, b in ((0, 150), (150, 210), (210, 250))) and set(got) == {0, 1, 2}
    same = table(spark, np.repeat([[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]], 30, axis=0))
    assert sorted(r.n for r in profile.label_counts(bi.bisecting(same, "k", COLS, 5)).collect()) == [30, 30]
    assert bi.bisecting(df.limit(0), "k", COLS, 3).count() == 0
    assert set(labels_of(bi.bisecting(df, "k", COLS, 1))) == {0}


@pytest.mark.parametrize("linkage", hi.LINKAGES)
def test_hierarchy_of_300_rows_equals_exact_linkage(spark, monkeypatch, linkage):
    """Nothing is summarised when micro allows every distinct row, by rounds as in one task."""
    r = np.random.default_rng(5)
    points = r.normal(size=(300, 2)) * [1.0, 3.0]
    rows = np.concatenate([points, points[:20]])  # 20 copies
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(rows)], "k bigint, c0 double, c1 double")
    size = np.where(np.arange(300) < 20, 2.0, 1.0)
    near = {i: {i} for i in range(300)}
    d = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    d = d if linkage == "ward" else np.sqrt(d)
    weight = size.copy()
    while len(near) > 5:
        ids = sorted(near)
        w = weight[ids]
        h = d[np.ix_(ids, ids)] * (2 * np.outer(w, w) / (w[:, None] + w[None]) if linkage == "ward" else 1)
        np.fill_diagonal(h, np.inf)
        p, q = sorted(ids[x] for x in divmod(int(h.argmin()), len(ids)))
        a, b = weight[p], weight[q]
        new = {"complete": np.maximum(d[p], d[q]), "weighted": (d[p] + d[q]) / 2}.get(linkage, (a * d[p] + b * d[q]) / (a + b))
        new = new - (a * b / (a + b) ** 2 * d[p, q] if linkage == "ward" else 0)
        d[p], d[:, p], weight[p] = new, new, a + b
        near[p] |= near.pop(q)
    want = {frozenset(m | {300 + i for i in m if i < 20}) for m in near.values()}
    for micro, few in ((300, hi.FEW), (None, 40)):
        monkeypatch.setattr(hi.merge_rounds, "__defaults__", (few, 64))
        out = hi.hierarchy(df, "k", ["c0", "c1"], linkage, [5], micro=micro).collect()
        got = {}
        for row in out:
            got.setdefault(row.label_k5, set()).add(row.k)
        assert set(map(frozenset, got.values())) == want


def test_ward_merges_inside_blocks_equal_one_task(spark, monkeypatch):
    """Groups far from each other need no look-up until they are few, and rows that lie anywhere
    look up in some rounds only. Merges are those of the whole matrix, blocks too large included."""
    rng, looks, look = np.random.default_rng(8), [], hi._looked_up
    monkeypatch.setattr(hi, "_looked_up", lambda held, *rest: (looks.append(held.count()), look(held, *rest))[1])
    groups = np.vstack([rng.normal(size=(50, 3)) * 0.1 + m * 100.0 for m in rng.normal(size=(8, 3))])
    for x, few, rows, asked in ((groups, 8, 64, 80), (rng.uniform(size=(400, 3)), 20, 32, 1500), (np.vstack([groups[:60], groups[:200] * 1e-3]), 1, 8, 1500)):
        looks.clear()
        n = rng.integers(1, 4, size=len(x)).astype(float)
        micro = spark.createDataFrame([(i, *map(float, p), int(w)) for i, (p, w) in enumerate(zip(x, n))], "label bigint, c0 double, c1 double, c2 double, n bigint")
        got = sorted(tuple(r) for r in hi.merge_rounds(micro, COLS, "ward", few, rows).collect())
        want = sorted(hi._last_merges(np.arange(len(x)), n, ce.distances(x, x), "ward"))
        assert [m[:2] for m in got] == [m[:2] for m in want] and np.allclose([m[2] for m in got], [m[2] for m in want], rtol=1e-6, atol=1e-9)
        assert sum(looks) <= asked


def test_kmodes_small(spark):
    rows = [("a", "x")] * 5 + [("a", "y")] * 2 + [("b", "z")] * 3 + [(None, "z")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k bigint, p string, q string")
    modes, cost = km.kmodes(df, "k", ["p", "q"], 2)
    assert modes == [("a", "x"), ("b", "z")] and cost == 3
    costs = [r.cost for r in km.kmodes_elbow(df, "k", ["p", "q"], 3).orderBy("k").collect()]
    assert costs[1] == cost and costs[0] >= costs[1] >= costs[2]


def test_mixture_recovers_blobs(spark, blobs):
    df = table(spark, blobs)
    mix, ll = mi.gmm(df, "k", COLS, 3, n_init=3)
    assert sorted(np.round(mix.weights * len(blobs))) == pytest.approx([40, 60, 150], abs=1)
    scored = mi.gmm_score(df, mix, "k")
    rows = scored.collect()
    assert np.mean([r.log_density for r in rows]) == pytest.approx(ll, abs=5e-3)
    assert all(r.p0 + r.p1 + r.p2 == pytest.approx(1.0) for r in rows)
    assert sorted(r.n for r in profile.label_counts(scored).collect()) == [40, 60, 150]


def test_som_improves_and_keeps_empty_units(spark, blobs):
    df = table(spark, blobs)
    book, costs = som.som_fit(df, "k", COLS, 5, 6, rough=6, fine=6)
    assert costs[-1] < costs[0]
    hits = som.som_hits(som.som_assign(df, book), 5, 6).collect()
    assert len(hits) == 30 and sum(h.hits for h in hits) == len(blobs)
    seg = som.som_segments(df, book, 3, "k", n_init=5)
    assert seg.count() == len(blobs) and seg.select("label").distinct().count() == 3
    plan = som.radius_plan(20, 20, 30, 50)
    assert len(plan) == 80 and plan[0] == 7.0 and plan[30] == 2.0 and plan[-1] == 1.0


def test_components_of_pca(spark, blobs):
    df = table(spark, blobs)
    out = np.array([tuple(r)[1:] for r in pca.pca_project(df, COLS, 2, "k").orderBy("k").collect()])
    values = np.linalg.eigvalsh(np.cov(blobs.T))[::-1]
    assert out.mean(0) == pytest.approx([0, 0], abs=1e-9)
    assert out.var(0, ddof=1) == pytest.approx(values[:2])
    assert abs(np.corrcoef(out.T)[0, 1]) < 1e-9
    table_ = pca.pca_variance(df, COLS).orderBy("pc").collect()
    assert table_[-1].cumulative_pct == 100.0
    loads = pca.pca_loadings(df, COLS).collect()
    for pc in ("PC1", "PC2", "PC3"):
        v = [r.loading for r in loads if r.pc == pc]
        assert max(v, key=abs) > 0 and sum(a * a for a in v) == pytest.approx(1.0)


def test_tree_flow(spark, blobs):
    df = table(spark, blobs)
    centers, _ = ce.kmeans(df, "k", COLS, 3, n_init=5)
    labelled = ce.assign_nearest(df, centers).drop("sq_dist")
    train, test = tree.split_by_key(labelled, "k", 0.7, 1)
    model = tree.fit_tree(train, COLS)
    pred = tree.predict(model, test)
    share, n = ev.accuracy(pred).first()[0], pred.count()
    hits = sum(row[f"p{row['actual']}"] for row in ev.confusion_matrix(pred).collect())
    told = ev.classification_report(pred).filter("label = 'accuracy'").first()
    assert share == pytest.approx(hits / n) == told["precision"] and told["support"] == n and train.count() + n == len(blobs) and share > 0.95
    leaves = tree.tree_leaf_profile(model, train).collect()
    assert sum(r.n for r in leaves) == train.count() and min(r.n for r in leaves) >= 3
    outside = spark.createDataFrame([(900, 9.0, 9.0, 9.0), (901, None, 0.0, 0.0)], "k bigint, c0 double, c1 double, c2 double")
    whole = tree.label_outliers(df, labelled, outside, model, "k", COLS)
    assert whole.count() == len(blobs) + 1 and whole.filter("outlier").count() == 1


def brute_tree(x, y, min_leaf, path="", out=None):
    """Every column, every distinct value, recursively."""
    out = {} if out is None else out
    values, counts = np.unique(y, return_counts=True)
    best = None
    for f in range(x.shape[1]) if len(values) > 1 else ():
        v = np.unique(x[:, f])
        for low, high in zip(v, v[1:]):
            sides = y[x[:, f] <= low], y[x[:, f] > low]
            if min(map(len, sides)) >= min_leaf:
                score = sum((np.unique(s, return_counts=True)[1] ** 2).sum() / len(s) for s in sides)
                if best is None or score > best[0]:
                    best = (score, f, (low + high) / 2)
    out[path] = (None if best is None else best[1], None if best is None else pytest.approx(best[2]), len(y), values[counts.argmax()], counts.max())
    if best:
        left = x[:, best[1]] <= best[2]
        brute_tree(x[left], y[left], min_leaf, path + "0", out)
        brute_tree(x[~left], y[~left], min_leaf, path + "1", out)
    return out


@pytest.mark.parametrize("small_rows", [1000, 25])
def test_tree_equals_brute_force(spark, small_rows):
    """300 rows of three noisy columns, one of them mostly one value, grown in one task and level by level."""
    r = np.random.default_rng(6)
    x = np.stack([r.normal(size=300).round(1), np.where(r.random(300) < 0.4, 0.0, r.integers(-9, 9, 300)), r.integers(0, 3, 300)], 1)
    y = (x[:, 0] > 0.2).astype(int) + 2 * (x[:, 1] > 3) + (r.random(300) < 0.1)
    want = brute_tree(x, y, 3)
    df = spark.createDataFrame([(i, *map(float, row), int(v)) for i, (row, v) in enumerate(zip(x, y))] + [(300, None, 1.0, 1.0, 0), (301, 1.0, 1.0, 1.0, None)], "k bigint, c0 double, c1 double, c2 double, label int")
    model = tree.fit_tree(df, COLS, small_rows=small_rows, stretch_rows=40)
    got = {n.path: (n.feature, n.threshold, n.n, n.majority, n.hits) for n in model.nodes.collect()}
    assert got == want and model.depth == max(map(len, want)) and model.size == len(want)
    if small_rows < 300:
        return
    rows = {row.k: (row.leaf, row.prediction) for row in tree.leaves(model, df).collect()}
    assert all(want[leaf][0] is None and want[leaf][3] == p for leaf, p in rows.values()) and len(rows) == 302
    assert {row.k: (row.leaf, row.prediction) for row in tree.leaves(model, df, shipped=0).collect()} == rows
    assert tree.fit_tree(df.limit(0), COLS).size == 0


@pytest.mark.parametrize("corner_classes", [8, 0])
def test_tree_scores_few_values_of_a_level(spark, monkeypatch, corner_classes):
    """Only buckets that may hold the best split are scored by value; the tree stays exact."""
    r = np.random.default_rng(9)
    x = np.stack([r.normal(size=2000), np.where(r.random(2000) < 0.4, -0.0, r.normal(size=2000)), r.integers(0, 3, 2000)], 1)
    x[0, 0], x[1, 0] = -np.inf, np.inf
    y = (x[:, 0] > 0.2).astype(int) + 2 * (x[:, 1] > 0.5) + (r.random(2000) < 0.05)
    df = spark.createDataFrame([(*map(float, row), int(v)) for row, v in zip(x, y)], "c0 double, c1 double, c2 double, label int")
    monkeypatch.setattr(tree, "CORNER_CLASSES", corner_classes)
    monkeypatch.setattr(tree, "BUCKETS", 40)
    model = tree.fit_tree(df, COLS, small_rows=300)
    assert {n.path: (n.feature, n.threshold, n.n, n.majority, n.hits) for n in model.nodes.collect()} == brute_tree(x, y, 3)
    rows = df.select(F.lit("").alias("path"), F.array(*COLS).alias("x"), F.col("label").alias("y"))
    cells, _ = tree._cells(rows, sorted(set(y.tolist())), 3, tree._edges(rows, 3, 40))
    assert 0 < cells.count() < 0.1 * sum(len(np.unique(x[:, f])) for f in range(3))


def test_report_with_a_class_never_predicted(spark):
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    rep = {r.label: r for r in ev.classification_report(pred).collect()}
    assert rep["2"].precision == 0.0 and rep["2"].recall == 0.0 and rep["2"].f1 == 0.0 and rep["2"].support == 1
    assert rep["1"].precision == pytest.approx(1 / 3) and rep["accuracy"].f1 == 0.5
    assert rep["macro avg"].recall == pytest.approx((0.5 + 1 + 0) / 3)
    assert [tuple(r) for r in ev.confusion_matrix(pred).orderBy("actual").collect()] == [(0, 1, 1, 0), (1, 0, 1, 0), (2, 0, 1, 0)]


def test_silhouette_by_k_within(spark, blobs):
    df = table(spark, blobs)
    exact, near = ({r.k: r.silhouette for r in ev.silhouette_by_k(df, "k", COLS, 2, 3, n_init=2, within=w).collect()} for w in (None, 0.02))
    assert set(near) == set(exact) == {2, 3} and all(abs(near[k] - exact[k]) <= 0.01 + 1e-9 for k in exact)


@pytest.mark.parametrize("k", [1, 3, 16, 40, 400])
def test_member_sums_hold_few_distances_and_match_brute_force(k):
    rng = np.random.default_rng(k)
    x, c = rng.integers(-3, 4, (700, 3)).astype(float), rng.integers(-3, 4, (k, 3)).astype(float)
    xt = np.ascontiguousarray(x.T)
    got = ce._member_sums(xt, np.vstack([np.ones(700), (xt * xt).sum(axis=0), xt]), -2.0 * c, (c * c).sum(axis=1))
    d = ce.distances(x, c)
    at = d.argmin(axis=1)
    want = np.zeros((k, 5))
    np.add.at(want, at, np.column_stack([np.ones(700), d.min(axis=1), x]))
    assert np.allclose(got, want)
    # A batch of 10,000 rows against 400 prototypes once took 32 MB for each array of distances.
    assert max(s.stop - s.start for s in ce._chunks(10_000, 400)) * 400 * 8 <= 4 << 20


@pytest.mark.parametrize("linkage", ["complete", "average", "weighted"])
def test_linkage_rounds_store_rows_not_distances(spark, tmp_path, linkage):
    rng = np.random.default_rng(5)
    n = 400
    x, w = rng.normal(size=(n, 3)), rng.integers(1, 4, n).astype(float)
    df = spark.createDataFrame([(i, *map(float, x[i]), float(w[i])) for i in range(n)], "label bigint, a double, b double, c double, n double")
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        got = sorted(map(tuple, hi.merge_rounds(df, ["a", "b", "c"], linkage, few=250, block_rows=60).collect()), key=lambda m: (m[2], m[0]))
    finally:
        if before is not None:
            spark.sparkContext._jsc.sc().setCheckpointDir(before.rsplit("/", 1)[0])
    want = sorted(hi._last_merges(np.arange(n), w, np.sqrt(ce.distances(x, x)), linkage), key=lambda m: (m[2], m[0]))
    assert [m[:2] for m in got] == [m[:2] for m in want] and np.allclose([m[2] for m in got], [m[2] for m in want])
    # The matrix of distances, once stored round by round, has this many bytes.
    assert sum(p.stat().st_size for p in tmp_path.rglob("*") if p.is_file()) < 8 * n * n


def test_rows_within_reach_by_product_equal_measured_ones():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(700, 9)), rng.normal(size=(600, 9))
    y[:40] = x[:40]
    y[40:80] = x[40:80] + np.eye(9)[0] * 0.9  # on the border
    for shift in (0.0, 1e4):
        a, b = x + shift, y + shift
        assert (ce.within(a, b, 0.9) == (ce.distances(a, b) <= 0.9 * 0.9)).all()
    grid = np.round(rng.normal(size=(300, 2)), 1)
    assert (ce.within(grid, grid, 0.5) == (ce.distances(grid, grid) <= 0.25)).all()
    assert ce.within(x[:0], y, 0.9).shape == (0, 600) and ce.within(x, y[:0], 0.9).shape == (700, 0)


def test_seeds_count_runs_inside_their_radius_as_a_whole(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(1500, 3)) * 0.05, rng.normal(size=(1500, 3)) * 2])
    seeds = np.array([[0.0, 0.0, 0.0], [1.0, 0.5, -0.5], [50.0, 50.0, 50.0]])
    points = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    n, mean = de._scan_round(points, ["a", "b", "c"], seeds, 0.8, 8)
    inside = ce.distances(x, seeds) <= 0.8 * 0.8
    assert n.tolist() == inside.sum(axis=0).tolist() and n[0] > 1500 and n[2] == 0
    for i in (0, 1):
        assert np.allclose(mean[i], x[inside[:, i]].mean(axis=0))


def test_moments_of_many_runs_equal_one_by_one(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3))
    points = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    mixes = [mi.Mixture(("a", "b", "c"), np.array([0.3, 0.7]), rng.normal(size=(2, 3)), np.stack([np.eye(3) * v for v in (0.5, 2.0)])) for _ in range(3)]
    runs = {i: ("soft", m.means, *m.whitening()) for i, m in enumerate(mixes)}
    found = mi._moments(points, ["a", "b", "c"], runs, 2, 8)
    terms = np.hstack([np.ones((400, 1)), x, (x[:, :, None] * x[:, None, :]).reshape(400, 9)])
    for i, (_, means, inv, const) in runs.items():
        lj = np.stack([const[j] - 0.5 * (((x - means[j]) @ inv[j].T) ** 2).sum(axis=1) for j in range(2)], axis=1)
        norm = np.log(np.exp(lj).sum(axis=1, keepdims=True))
        assert np.allclose(found[i][0], np.exp(lj - norm).T @ terms)
        assert np.isclose(found[i][1], norm.sum())


@pytest.mark.parametrize("linkage", ["complete", "average", "weighted"])
def test_linkage_held_or_dealt_equals_one_task(spark, monkeypatch, linkage):
    """Rows held by each task, and rows dealt into blocks with clusters too large for one."""
    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(size=(70, 2)) * 0.2 + [m, 0.0] for m in (0.0, 30.0)] + [rng.uniform(-20, 50, size=(20, 2))])
    w = rng.integers(1, 4, len(x)).astype(float)
    df = spark.createDataFrame([(i, *map(float, p), float(n)) for i, (p, n) in enumerate(zip(x, w))], "label bigint, c0 double, c1 double, n double")
    want = sorted(hi._last_merges(np.arange(len(x)), w, np.sqrt(ce.distances(x, x)), linkage), key=lambda m: (m[2], m[0]))
    for cells, few, rows in ((hi.HELD_CELLS, 8, 64), (0, 20, 8)):
        monkeypatch.setattr(hi, "HELD_CELLS", cells)
        got = sorted(map(tuple, hi.merge_rounds(df, ["c0", "c1"], linkage, few, rows).collect()), key=lambda m: (m[2], m[0]))
        assert [m[:2] for m in got] == [m[:2] for m in want] and np.allclose([m[2] for m in got], [m[2] for m in want])


@pytest.mark.parametrize("linkage", ["complete", "average"])
def test_nearest_cluster_measures_few_rows(monkeypatch, linkage):
    rng = np.random.default_rng(13)
    x, cells, between = rng.normal(size=(3000, 4)), [], hi._between
    monkeypatch.setattr(hi, "_between", lambda a, m, p, b, *rest: (cells.append(len(a) * len(b)), between(a, m, p, b, *rest))[1])
    x = x[np.argsort(x[:, 0].round() * 1000 + x[:, 1].round(1) * 10)]
    starts = np.arange(0, 3000, 3)
    share = np.full(3000, 1 / 3)
    held, complete = hi._Held(np.arange(1000), starts, np.full(1000, 3.0), share, x), linkage == "complete"
    whole = between(x, starts, share, x, starts, share, complete)
    np.fill_diagonal(whole, np.inf)
    d = np.sqrt(ce.distances(held.c, held.c))
    got = [held.nearest(p, d[p], 1e-9, complete) for p in range(1000)]
    assert [g[0] for g in got] == whole.argmin(axis=1).tolist() and np.allclose([g[1] for g in got], whole.min(axis=1))
    assert sum(cells) < 0.2 * 3000 * 3000
    fast = hi._between_many(x, starts, share, x, starts, share, complete)
    np.fill_diagonal(fast, np.inf)
    assert np.allclose(fast, whole)
