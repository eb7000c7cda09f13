"""Check SQL for the modelling queries. Iterations are unrolled into numbered CTEs."""

from __future__ import annotations

from collections.abc import Sequence

from stratiform.functions.expr import HASH_FACTOR, HASH_PRIME
from stratiform.sources.mart import KEY


def sq(a: str, b: str, cols: Sequence[str]) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


def first_rows(name: str, frame: str, cols: Sequence[str], n: int, id_col: str = "label") -> str:
    """Start points: the rows with the lowest keys, numbered from 0."""
    return (
        f"{name} AS (SELECT CAST(row_number() OVER (ORDER BY {KEY}) - 1 AS INTEGER) AS {id_col}, {', '.join(cols)} "
        f"FROM {frame} ORDER BY {KEY} LIMIT {n})"
    )


def nearest(name: str, frame: str, centers: str, cols: Sequence[str], id_col: str = "label") -> str:
    return (
        f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT x.*, c.{id_col}, {sq('x', 'c', cols)} AS sq_dist, row_number() OVER "
        f"(PARTITION BY x.{KEY} ORDER BY {sq('x', 'c', cols)}, c.{id_col}) AS rn FROM {frame} x CROSS JOIN {centers} c) WHERE rn = 1)"
    )


def lloyd(frame: str, cols: Sequence[str], k: int, rounds: int) -> str:
    """``c0`` start, ``a<i>`` assignment to ``c<i>``, ``c<i+1>`` the means of ``a<i>``."""
    parts = [first_rows("c0", frame, cols, k)]
    for i in range(rounds):
        parts.append(nearest(f"a{i}", frame, f"c{i}", cols))
        parts.append(f"c{i + 1} AS (SELECT label, {', '.join(f'avg({c}) AS {c}' for c in cols)} FROM a{i} GROUP BY label)")
    parts.append(nearest(f"a{rounds}", frame, f"c{rounds}", cols))
    return ",\n".join(parts)


def som(frame: str, cols: Sequence[str], rows: int, columns: int, radii: Sequence[float]) -> str:
    parts = [
        first_rows("b0", frame, cols, rows * columns, "unit"),
        f"grid AS (SELECT CAST(i AS INTEGER) AS unit, (i % {columns}) + 0.5 * ((i // {columns}) % 2) AS gx, (i // {columns}) * sqrt(3) / 2 AS gy FROM range({rows * columns}) t(i))",
    ]
    for e, radius in enumerate(radii):
        parts.append(nearest(f"u{e}", frame, f"b{e}", cols, "unit"))
        parts.append(f"s{e} AS (SELECT unit, count(*) AS n, {', '.join(f'sum({c}) AS {c}' for c in cols)} FROM u{e} GROUP BY unit)")
        parts.append(
            f"w{e} AS (SELECT g.unit, s.n, exp(-((g.gx - o.gx) * (g.gx - o.gx) + (g.gy - o.gy) * (g.gy - o.gy)) / (2.0 * {radius} * {radius})) AS h, "
            f"{', '.join('s.' + c for c in cols)} FROM grid g CROSS JOIN s{e} s JOIN grid o ON o.unit = s.unit)"
        )
        parts.append(f"b{e + 1} AS (SELECT unit, {', '.join(f'sum(h * {c}) / sum(h * n) AS {c}' for c in cols)} FROM w{e} GROUP BY unit)")
    return ",\n".join(parts)


def kmodes(cols: Sequence[str], k: int, rounds: int, tag: str = "") -> str:
    """Density seeds and assign-and-update rounds over distinct tuples ``tup``; the last
    mode table is ``m<tag>_<rounds>`` and the last assignment ``t<tag>_<rounds>``."""
    differ = lambda a, b: " + ".join(f"CASE WHEN {a}.{c} = {b}.{c} THEN 0 ELSE 1 END" for c in cols)
    parts = []
    for i in range(k):
        score = "t.dens" if i == 0 else "least(" + ", ".join(f"({differ('t', f'k{tag}_{j}')}) * t.dens" for j in range(i)) + ")"
        joins = " ".join(f"CROSS JOIN k{tag}_{j}" for j in range(i))
        parts.append(f"k{tag}_{i} AS (SELECT {i} AS label, {', '.join('t.' + c for c in cols)} FROM dens t {joins} ORDER BY {score} DESC, t.first_key LIMIT 1)")
    parts.append(f"m{tag}_0 AS (" + " UNION ALL ".join(f"SELECT * FROM k{tag}_{i}" for i in range(k)) + ")")
    for r_ in range(rounds + 1):
        parts.append(
            f"t{tag}_{r_} AS (SELECT * EXCLUDE (rn) FROM (SELECT t.*, m.label, {differ('t', 'm')} AS d, row_number() OVER "
            f"(PARTITION BY t.first_key ORDER BY {differ('t', 'm')}, m.label) AS rn FROM tup t CROSS JOIN m{tag}_{r_} m) WHERE rn = 1)"
        )
        if r_ == rounds:
            break
        votes = [
            f"(SELECT label, {c} FROM (SELECT label, {c}, row_number() OVER (PARTITION BY label ORDER BY sum(w) DESC, {c}) AS rn FROM t{tag}_{r_} GROUP BY label, {c}) WHERE rn = 1) v{i}"
            for i, c in enumerate(cols)
        ]
        joined = votes[0] + "".join(f" JOIN {v} USING (label)" for v in votes[1:])
        parts.append(f"m{tag}_{r_ + 1} AS (SELECT label, {', '.join(cols)} FROM {joined})")
    return ",\n".join(parts)


def tuples(frame: str, cols: Sequence[str]) -> str:
    freq = " ".join(f"JOIN (SELECT {c}, sum(w) AS f{i} FROM tup GROUP BY {c}) q{i} USING ({c})" for i, c in enumerate(cols))
    return (
        f"tup AS (SELECT {', '.join(cols)}, count(*) AS w, min({KEY}) AS first_key FROM {frame} GROUP BY ALL),\n"
        f"dens AS (SELECT tup.*, {' + '.join(f'f{i}' for i in range(len(cols)))} AS dens FROM tup {freq})"
    )


def dbscan(frame: str, cols: Sequence[str], eps: float, min_samples: int) -> str:
    return (
        f"pr AS (SELECT x.{KEY} AS a, y.{KEY} AS b FROM {frame} x JOIN {frame} y ON {sq('x', 'y', cols)} <= {eps} * {eps}),\n"
        f"core AS (SELECT a AS id FROM pr GROUP BY a HAVING count(*) >= {min_samples}),\n"
        "link AS (SELECT pr.a, pr.b FROM pr JOIN core p ON p.id = pr.a JOIN core q ON q.id = pr.b),\n"
        "reach(root, id) AS (SELECT id, id FROM core UNION SELECT r.root, l.b FROM reach r JOIN link l ON l.a = r.id WHERE l.b > r.root),\n"
        "comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),\n"
        "num AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS label FROM (SELECT DISTINCT root FROM comp)),\n"
        "clab AS (SELECT id, label FROM comp JOIN num USING (root)),\n"
        "blab AS (SELECT pr.a AS id, min(label) AS label FROM pr JOIN clab ON clab.id = pr.b WHERE pr.a NOT IN (SELECT id FROM core) GROUP BY pr.a),\n"
        f"labelled AS (SELECT x.{KEY}, CAST(coalesce(c.label, b.label, -1) AS INTEGER) AS label FROM {frame} x LEFT JOIN clab c ON c.id = x.{KEY} LEFT JOIN blab b ON b.id = x.{KEY})"
    )


def hashed(key: str, seed: int) -> str:
    return f"((({key} + {seed}) % {HASH_PRIME}) * {HASH_FACTOR}) % {HASH_PRIME}"


def silhouette(members: str, cols: Sequence[str], tag: str = "", key: str = KEY, squared: bool = False, dist: str | None = None) -> str:
    """``sil<tag>(key, label, silhouette)`` from a table with key, columns and label."""
    d = dist or sq("x", "y", cols)
    if not squared:
        d = f"sqrt({d})"
    return (
        f"pd{tag} AS (SELECT x.{key}, x.label AS own, y.label AS other, sum({d}) AS s, count(*) AS n FROM {members} x CROSS JOIN {members} y GROUP BY 1, 2, 3),\n"
        f"ab{tag} AS (SELECT {key}, own, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, max(CASE WHEN own = other THEN n END) AS n_own, "
        f"min(CASE WHEN own <> other THEN s / n END) AS b FROM pd{tag} GROUP BY 1, 2),\n"
        f"sil{tag} AS (SELECT {key}, own AS label, CASE WHEN n_own = 1 THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab{tag})"
    )


def tree(frame: str, cols: Sequence[str], classes: int, min_leaf: int, levels: int) -> str:
    """``t<i>`` the rows with their node ``path`` after i splits, ``s<i>`` the split of each node,
    ``nodes`` all nodes: gini purity, the first column's lowest value of equals."""
    total, low = [f"t{c}" for c in range(classes)], [f"l{c}" for c in range(classes)]
    square = lambda side: " + ".join(f"({x}) * ({x})" for x in side)
    rest = [f"t{c} - l{c}" for c in range(classes)]
    parts = [f"t0 AS (SELECT *, '' AS path FROM {frame})"]
    for i in range(levels):
        long = " UNION ALL ".join(f"SELECT path, {f} AS f, {x} AS v, label FROM t{i}" for f, x in enumerate(cols))
        parts.append(f"v{i} AS (SELECT path, f, v, {', '.join(f'CAST(count(*) FILTER (WHERE label = {c}) AS DOUBLE) AS c{c}' for c in range(classes))} FROM ({long}) GROUP BY path, f, v)")
        sums = ", ".join(f"sum(c{c}) OVER (PARTITION BY path, f ORDER BY v) AS l{c}, sum(c{c}) OVER (PARTITION BY path, f) AS t{c}" for c in range(classes))
        parts.append(f"w{i} AS (SELECT path, f, v, lead(v) OVER (PARTITION BY path, f ORDER BY v) AS nxt, {sums} FROM v{i})")
        n, m = " + ".join(low), " + ".join(f"({x})" for x in rest)
        score = f"({square(low)}) / ({n}) + ({square(rest)}) / ({m})"
        parts.append(
            f"s{i} AS (SELECT path, f, (v + nxt) / 2 AS thr FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY {score} DESC, f, v) AS rn FROM w{i} "
            f"WHERE nxt IS NOT NULL AND {n} >= {min_leaf} AND {m} >= {min_leaf} AND greatest({', '.join(total)}) < {' + '.join(total)}) WHERE rn = 1)"
        )
        value = "CASE s.f " + " ".join(f"WHEN {f} THEN t.{x}" for f, x in enumerate(cols)) + " END"
        parts.append(f"t{i + 1} AS (SELECT t.* EXCLUDE (path), t.path || CASE WHEN {value} <= s.thr THEN '0' ELSE '1' END AS path FROM t{i} t JOIN s{i} s USING (path))")
    every = " UNION ALL ".join(f"SELECT path, label FROM t{i}" for i in range(levels + 1))
    splits = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(levels))
    parts.append(f"per AS (SELECT path, label, count(*) AS m FROM ({every}) GROUP BY path, label)")
    parts.append(
        "nodes AS (SELECT p.path, CAST(s.f AS INTEGER) AS feature, s.thr AS threshold, p.n, p.majority, p.hits FROM (SELECT path, CAST(sum(m) AS BIGINT) AS n, arg_max(label, m * 1000 - label) AS majority, max(m) AS hits "
        f"FROM per GROUP BY path) p LEFT JOIN ({splits}) s USING (path))"
    )
    leaf = " UNION ALL ".join([f"SELECT * FROM t{levels}"] + [f"SELECT t.* FROM t{i} t ANTI JOIN s{i} s USING (path)" for i in range(levels)])
    parts.append(f"placed AS ({leaf})")
    return ",\n".join(parts)


def walk(frame: str, cols: Sequence[str], levels: int) -> str:
    """``<frame>_leaf``: the rows of ``frame`` with the ``path`` of their leaf in ``tree``."""
    parts, at = [], f"(SELECT *, '' AS path FROM {frame})"
    for i in range(levels):
        value = "CASE s.f " + " ".join(f"WHEN {f} THEN t.{x}" for f, x in enumerate(cols)) + " END"
        name = f"{frame}_leaf" if i == levels - 1 else f"{frame}_{i}"
        parts.append(f"{name} AS (SELECT t.* EXCLUDE (path), t.path || CASE WHEN s.f IS NULL THEN '' WHEN {value} <= s.thr THEN '0' ELSE '1' END AS path FROM {at} t LEFT JOIN s{i} s USING (path))")
        at = name
    return ",\n".join(parts)


def linkage(table: str, cols: Sequence[str], name: str, merges: int) -> str:
    """``p<i>`` the i-th merge ``(a, b, h)`` of the clusters ``(label, <cols>, n)``: one at a time,
    lowest ``(h, a, b)`` first, by the update formula of the linkage."""
    start = sq("x", "y", cols) if name == "ward" else f"sqrt({sq('x', 'y', cols)})"
    parts = [f"d0 AS (SELECT x.label AS a, y.label AS b, CAST(x.n AS DOUBLE) AS na, CAST(y.n AS DOUBLE) AS nb, {start} AS s FROM {table} x JOIN {table} y ON x.label < y.label)"]
    for i in range(merges):
        h = "sqrt(2 * na * nb / (na + nb) * s)" if name == "ward" else "s"
        parts.append(f"p{i} AS (SELECT a, b, {h} AS h, na, nb, s FROM d{i} ORDER BY 3, 1, 2 LIMIT 1)")
        # Every pair, with the merged cluster under its first name.
        parts.append(
            f"q{i} AS (SELECT least(a, b) AS a, greatest(a, b) AS b, CASE WHEN a < b THEN na ELSE nb END AS na, CASE WHEN a < b THEN nb ELSE na END AS nb, s, w FROM ("
            f"SELECT CASE WHEN d.a = p.b THEN p.a ELSE d.a END AS a, CASE WHEN d.b = p.b THEN p.a ELSE d.b END AS b, "
            f"CASE WHEN d.a IN (p.a, p.b) THEN p.na + p.nb ELSE d.na END AS na, CASE WHEN d.b IN (p.a, p.b) THEN p.na + p.nb ELSE d.nb END AS nb, "
            f"d.s, CASE WHEN d.a IN (p.a, p.b) THEN d.na WHEN d.b IN (p.a, p.b) THEN d.nb ELSE 1 END AS w FROM d{i} d CROSS JOIN p{i} p WHERE NOT (d.a = p.a AND d.b = p.b)))"
        )
        new = {"complete": "max(s)", "weighted": "avg(s)"}.get(name, "sum(w * s) / sum(w)")
        if name == "ward":
            new = f"{new} - CASE WHEN count(*) = 2 THEN (SELECT s * na * nb / ((na + nb) * (na + nb)) FROM p{i}) ELSE 0 END"
        parts.append(f"d{i + 1} AS (SELECT a, b, max(na) AS na, max(nb) AS nb, {new} AS s FROM q{i} GROUP BY a, b)")
    return ",\n".join(parts)
