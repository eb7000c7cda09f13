"""The Jaccard join against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
from stratiform.llm import jaccard

SF = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets_of(rows):
    out = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        out.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    return out


def brute(rows):
    sets = sets_of(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 85 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return Counter((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def invented(seed, families, members, length):
    """Families of texts a few words apart, texts around the threshold, shared passages."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5)))
    passage = [word() for _ in range(20)]
    rows, doc = [], 0
    for _ in range(families):
        base = [word() for _ in range(r.randint(1, length))]
        for _ in range(r.randint(1, members)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = word()
            if r.random() < 0.3:
                copy = copy + passage
            if r.random() < 0.2:
                copy = [w.upper() for w in copy]
            doc += r.randint(1, 3)
            rows.append((doc, " ".join(copy)))
    rows += [(doc + 1, None), (doc + 2, " \n"), (doc + 3, "two words"), (doc + 4, "Two WORDS"), (None, rows[0][1]), (doc + 5, rows[0][1])]
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "y") for d, t in rows], "doc_id long, text string, class int, region string").repartition(3)


@pytest.mark.parametrize("seed,families,members,length", [(1, 40, 6, 120), (2, 6, 60, 90)])
def test_equals_brute_force(spark, monkeypatch, seed, families, members, length):
    monkeypatch.setattr(jaccard, "CELL", 8)
    rows = invented(seed, families, members, length)
    assert Counter(map(tuple, jaccard.jaccard_components(frame(spark, rows)).collect())) == brute(rows)


def test_empty_table_and_repeated_rows(spark):
    assert jaccard.jaccard_components(frame(spark, []).limit(0)).count() == 0
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f"), (3, "other words are in this text")]
    assert Counter(map(tuple, jaccard.jaccard_components(frame(spark, rows)).collect())) == brute(rows)


def test_cells_lose_no_near_pair():
    r = np.random.default_rng(5)
    hist = r.integers(0, 6, (600, jaccard.HIST)).astype(np.uint8)
    hist[300:] = np.maximum(0, hist[:300].astype(int) + (r.random((300, jaccard.HIST)) < 0.05)).astype(np.uint8)
    space = jaccard.Region(hist.sum(axis=1), hist, 85)
    cells = space.cells(np.arange(600))
    together = {(min(a, b), max(a, b)) for c in cells for a in c for b in c if a != b}
    a, b = np.triu_indices(600, 1)
    near = space.near(a, b)
    assert near.sum() > 200 and all((x, y) in together for x, y in zip(a[near], b[near]))


@pytest.mark.parametrize("cut", [1, 2, 3, 50])
def test_regions_over_batches(cut):
    """Rows of shared regions, and their hubs, do not depend on where batches end."""
    r = random.Random(cut)
    rows = sorted((r.randrange(12), r.randrange(6), r.randrange(8, 12)) for _ in range(50))
    sizes = {c: n for _, c, n in rows}
    rows = [(g, c, sizes[c]) for g, c, _ in rows]

    def batches(rows):
        for i in range(0, len(rows), cut):
            g, c, n = zip(*rows[i : i + cut])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(n, pa.int32()), pa.array(g, pa.int64())], names=["class", "n", "region"])
            yield pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.int64())], names=["class", "n", "region"])

    members = {}
    for g, c, n in rows:
        members.setdefault(g, {})[c] = n
    want = [(g, c, n) for g, m in sorted(members.items()) if len(m) > 1 for c, n in sorted(m.items())]
    got = [(x["region"], x["class"], x["n"]) for b in jaccard._held()(batches(rows)) for x in b.to_pylist()]
    assert got == want
    pairs = [(x["a"], x["b"]) for b in jaccard._hubs(85)(batches(got)) for x in b.to_pylist()]
    assert pairs == [(min(m), c) for g, m in sorted(members.items()) for c, n in sorted(m.items()) if c != min(m) and 100 * min(n, m[min(m)]) >= 85 * max(n, m[min(m)])]


def test_a_group_of_copies_costs_one_pair_each(spark, monkeypatch):
    """Copies of one text with a word changed meet their original, not each other."""
    made = []
    scan = jaccard._near

    def told(percent):
        inner = scan(percent)
        seen = spark.sparkContext.accumulator(0)
        made.append(seen)

        def run(batches):
            def tell(batch):
                seen.add(batch.num_rows)
                return batch

            yield from inner(map(tell, batches))

        return run

    monkeypatch.setattr(jaccard, "_near", told)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))] + [(i, " ".join(base[:i] + [f"x{i}", f"y{i}"] + base[i + 2 :])) for i in range(1, 140)]
    assert Counter(map(tuple, jaccard.jaccard_components(frame(spark, rows)).collect())) == brute(rows)
    assert sum(x.value for x in made) <= 2 * len(rows)


def test_registered_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert Counter(map(tuple, entry_points.queries()["op3_jaccard_regions"](spark, SF).collect())) == brute(rows)
