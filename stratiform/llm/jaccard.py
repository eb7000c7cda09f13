"""Exact Jaccard join of shingle sets in a metric space.

Two texts link when the Jaccard distance of their sets of word shingles is at most
``1 - PERCENT / 100``. That distance is a metric, and so is the weighted Jaccard distance of
two histograms of the sets over ``HIST`` hash buckets, which is never larger.

1. Equal sets are one class from here on.
2. Home regions. Every shingle is a pivot; in a global order of shingles (frequent ones
   last) the nearest pivot of a set is its first shingle. Sets within the distance differ
   in so few shingles that they share one among the first of each, so a set is replicated
   into the regions of as many pivots as the triangle inequality leaves open: a window of
   ``n - ceil(percent n / 100) + 1`` shingles.
3. Regions join recursively. A large region picks classes as pivots, every member goes to
   the Voronoi cell of the nearest one and, as the boundary windows demand, to each cell
   whose pivot is at most twice the threshold farther away. A cell that is small is joined
   pair by pair, and so is a region that is small from the start. All this uses sizes and
   histogram distances, so it may only let too much pass.
4. What passes is compared exactly, shingle by shingle, on the texts. First each member meets
   one hub only: of the members that share most regions with others, the one it shares most
   regions with. Of an original and its edited copies the original is that hub, so a group
   costs one pair for each member. Then near pairs of classes that are still apart are compared.

Scale: what is frequent comes from counts of all texts, kept for shingles of at least one
text in ``COMMON``, so the list that travels is bounded by that share and not by the corpus.
Copies are folded before regions form. Regions are read as sorted streams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions.components import connected_components
from stratiform.llm.text import LOWER, Hasher, mix, slices, windows, word_bounds
from stratiform.llm.tokens import plain
from stratiform.session import cut_lineage

PERCENT = 85
WORDS = 4
HIST = 256
FULL = 255
COMMON = 2000
SMALL = 16
CELL = 64
PIVOTS = 16
FLUSH = 1 << 22
LOOKUP_ROWS = 500_000
SHARE_TEXTS = 1000
NO_ID = 2**63 - 1

_HASH = Hasher(303)


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """``(values, bounds)``: the distinct shingles of each text as sorted 64-bit hashes. A text
    with fewer words has its whole sequence as one; without words it has none."""
    lower = LOWER[flat]
    starts, ends, counts = word_bounds(lower, offsets)
    word = _HASH.of(lower, starts, ends)
    first = np.cumsum(counts) - counts
    room = np.maximum(0, counts - words + 1)
    text = np.repeat(np.arange(len(counts)), room)
    place = np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room)
    value = windows(word, words)[first[text] + place] if len(text) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        whole = np.array([windows(word[first[t] : first[t] + counts[t]], int(counts[t]), seed=77 + int(counts[t]))[0] for t in short], np.uint64)
        value, text = np.concatenate([value, whole]), np.concatenate([text, short])
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(len(counts) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_names(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit name for each set, the same for equal sets."""
    return mix(_sums(mix(values ^ np.uint64(0x5851F42D4C957F2D)), bounds) ^ np.diff(bounds).astype(np.uint64)).view(np.int64)


def _common(words: int, share: int):
    """``(shingle, texts)`` of shingles that many different sets of a task hold, and one row
    with the number of sets (shingle NULL)."""

    def count(held):
        names, values, bounds = [], [], [0]
        for n, v, b in held:
            names.append(n)
            values.append(v)
            bounds.append(np.diff(b))
        name, value, size = np.concatenate(names), np.concatenate(values), np.concatenate(bounds[1:])
        _, lead = np.unique(name, return_index=True)
        once = np.zeros(len(name), bool)
        once[lead] = True
        distinct, texts = np.unique(value[np.repeat(once, size)], return_counts=True)
        many = texts >= max(2, len(lead) // (2 * share))
        return pa.RecordBatch.from_arrays([pa.array([None, *distinct[many].view(np.int64).tolist()], pa.int64()), pa.array([len(lead), *texts[many].tolist()], pa.int64())], names=["shingle", "texts"])

    def scan(batches):
        held, amount = [], 0
        for batch in batches:
            for _, _, flat, offsets in slices(batch):
                values, bounds = shingle_sets(flat, offsets, words)
                held.append((set_names(values, bounds), values, bounds))
                amount += len(values)
                if amount > FLUSH:
                    yield count(held)
                    held, amount = [], 0
        if held:
            yield count(held)

    return scan


def _features(words: int, percent: int, common):
    """``doc_id, class, n, window, hist`` of every text; class is NULL for the empty set. Of the
    copies that a task meets, the first alone brings its window."""

    def scan(batches):
        frequent, met = common.value, set()
        for batch in batches:
            for row, n, flat, offsets in slices(batch):
                values, bounds = shingle_sets(flat, offsets, words)
                size = np.diff(bounds)
                text = np.repeat(np.arange(n), size)
                late = np.zeros(len(values), np.int64)
                if len(frequent):
                    late = (frequent[np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)] == values).astype(np.int64)
                order = np.argsort(2 * text + late, kind="stable")
                rank = np.arange(len(values)) - np.repeat(bounds[:-1], size)
                names = set_names(values, bounds)
                first = np.array([x not in met and not met.add(x) for x in names.tolist()], bool)
                wide = np.where(first & (size > 0), size - -(-percent * size // 100) + 1, 0)
                taken = values[order][rank < np.repeat(wide, size)]
                spot = text * HIST + (values % np.uint64(HIST)).astype(np.int64)
                hist = np.minimum(np.bincount(spot, minlength=n * HIST), FULL).astype(np.uint8).reshape(n, HIST)
                ends = np.concatenate([[0], np.cumsum(wide)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, n),
                        pa.array(names, mask=size == 0),
                        pa.array(size.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(taken.view(np.int64))),
                        pa.array([h.tobytes() for h in hist], pa.binary()),
                    ],
                    names=["doc_id", "class", "n", "window", "hist"],
                )

    return scan


def _runs(batches, columns: list[str]):
    """Columns as arrays, such that no run of equal ``region`` is split."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        region = batch.column("region").to_numpy()
        if rest and region[0] == region[-1] == rest[-1].column("region")[-1].as_py():
            rest.append(batch)
            continue
        change = np.flatnonzero(region[1:] != region[:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if rest or cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)]).select(columns).combine_chunks()
        rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest).select(columns).combine_chunks()


def _held():
    """The rows, each once, of regions with at least two classes; one row is kept back between batches."""

    def scan(batches):
        kept, joined = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if kept is None else [kept, batch]).combine_chunks()
            region, name = (table.column(c).to_numpy() for c in ("region", "class"))
            fresh = np.ones(len(region), bool)
            fresh[1:] = (region[1:] != region[:-1]) | (name[1:] != name[:-1])
            table, region = table.filter(pa.array(fresh)), region[fresh]
            same = region[1:] == region[:-1]
            together = np.concatenate([[joined], same]) | np.concatenate([same, [False]])
            yield from table.slice(0, len(region) - 1).filter(pa.array(together[:-1])).to_batches()
            joined, kept = bool(together[-1]), table.slice(len(region) - 1).combine_chunks().to_batches()[0]
        if joined:
            yield kept

    return scan


def _hubs(percent: int):
    """``(a, b)``: the first row of each region with each other one of a fitting size."""

    def scan(batches):
        at, hub, most = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            region, name, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("region", "class", "n"))
            head = np.concatenate([[region[0] != at], region[1:] != region[:-1]])
            lead = np.cumsum(head)
            first, size = np.concatenate([[hub], name[head]])[lead], np.concatenate([[most], n[head]]).astype(np.int64)[lead]
            fits = (first != name) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
            yield pa.RecordBatch.from_arrays([pa.array(first[fits]), pa.array(name[fits])], names=["a", "b"])
            at, hub, most = region[-1], first[-1], size[-1]

    return scan


def _shared(percent: int):
    """What the regions with at least two labels hold, as pairs ``(a, b)``. Small regions: all
    pairs of fitting sizes and different labels. Crowded ones: their smallest class with each
    other member; so regions of the same texts, which have the same smallest class, become one."""

    def scan(batches):
        for table in _runs(batches, ["region", "class", "n", "label"]):
            region, name, n, label = (table.column(c).to_numpy() for c in ("region", "class", "n", "label"))
            if not len(region):
                continue
            n = n.astype(np.int64)
            head = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
            size = np.diff(np.append(head, len(region)))
            mixed = np.repeat(np.minimum.reduceat(label, head) != np.maximum.reduceat(label, head), size)
            small = np.repeat(size <= SMALL, size)
            for step in range(1, min(SMALL, len(region))):
                a = np.flatnonzero(mixed[:-step] & small[:-step] & (region[step:] == region[:-step]) & (label[step:] != label[:-step]))
                b = a + step
                fits = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
                if fits.any():
                    yield _pairs(name[a[fits]], name[b[fits]], False)
            lead = np.repeat(name[head], size)
            member = mixed & ~small & (lead != name)
            if member.any():
                yield _pairs(lead[member], name[member], True)

    return scan


def _pairs(a: np.ndarray, b: np.ndarray, crowded: bool) -> pa.RecordBatch:
    pair = np.unique(np.stack([a, b]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1]), pa.array(np.full(pair.shape[1], crowded))], names=["a", "b", "crowded"])


def _histograms(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HIST)


def _near(percent: int):
    """The pairs whose histograms leave the threshold within reach."""

    def scan(batches):
        for batch in batches:
            a, b = (_histograms(batch.column(c)) for c in ("hist_a", "hist_b"))
            n = np.concatenate([batch.column(c).to_numpy() for c in ("n_a", "n_b")])
            at = np.arange(batch.num_rows)
            keep = Region(n, np.concatenate([a, b]), percent).near(at, at + len(at))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return scan


class Region:
    """Members of one region: classes, sizes, groups, histograms."""

    def __init__(self, n: np.ndarray, hist: np.ndarray, percent: int):
        self.n, self.hist, self.percent = n.astype(np.int64), hist, percent
        self.eps = 1 - percent / 100
        # Counts that are cut off are no metric: no cells then, all pairs are looked at.
        self.full = bool((hist == FULL).any())

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the histograms of the pairs leave the threshold within reach; whole numbers.
        A bucket that is full on both sides may hold any number, so such pairs pass."""
        out = np.zeros(len(a), bool)
        for at in range(0, len(a), 1 << 14):
            i, j = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
            least = np.minimum(self.hist[i], self.hist[j])
            both = least.sum(axis=1, dtype=np.int64)
            out[at : at + (1 << 14)] = (100 * both >= self.percent * (self.n[i] + self.n[j] - both)) | (least == FULL).any(axis=1)
        return out

    def distance(self, members: np.ndarray, pivot: int) -> np.ndarray:
        both = np.minimum(self.hist[members], self.hist[pivot]).sum(axis=1, dtype=np.int64)
        return 1 - both / (self.n[members] + self.n[pivot] - both)

    def cells(self, members: np.ndarray) -> list[np.ndarray]:
        """Voronoi cells with their windows, down to small ones."""
        todo, done = [members], []
        while todo:
            cell = todo.pop()
            if len(cell) <= CELL or self.full:
                done.append(cell)
                continue
            pivots = cell[:: -(-len(cell) // PIVOTS)]
            apart = np.stack([self.distance(cell, p) for p in pivots])
            reach = apart <= apart.min(axis=0) + 2 * self.eps + 1e-9
            parts = [cell[r] for r in reach if r.any()]
            # Cells that overlap so much that splitting does not pay are joined as they are.
            if sum(len(p) for p in parts) > len(cell) * len(parts) // 2 or max(map(len, parts)) > 0.9 * len(cell):
                done.append(cell)
            else:
                todo += parts
        return done


def _near_pairs(percent: int):
    """Near pairs ``(a, b)`` of different groups in crowded regions, cell by cell."""

    def scan(batches):
        for table in _runs(batches, ["region", "class", "n", "hist", "label"]):
            if not table.num_rows:
                continue
            region, name, n, label = (table.column(c).to_numpy() for c in ("region", "class", "n", "label"))
            hist = _histograms(table.column("hist"))
            head = np.append(np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]])), len(region))
            found = [np.zeros((2, 0), np.int64)]
            for low, high in zip(head[:-1], head[1:]):
                space, group, names = Region(n[low:high], hist[low:high], percent), label[low:high], name[low:high]
                for cell in space.cells(np.arange(high - low)):
                    for i in range(0, len(cell), CELL):
                        block = cell[i : i + CELL]
                        a, b = np.repeat(block, len(cell)), np.tile(cell, len(block))
                        apart = (a < b) & (group[a] != group[b])
                        a, b = a[apart], b[apart]
                        keep = space.near(a, b)
                        found.append(np.stack([names[a[keep]], names[b[keep]]]))
            pair = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair.min(axis=0)), pa.array(pair.max(axis=0))], names=["a", "b"])

    return scan


def _linked(words: int, percent: int):
    """The pairs whose texts' sets are within the distance. Rows come sorted by ``target``, the
    text of the target itself (``pivot``) before the others; a text whose set is not the
    class it was fetched for (a row that repeats a doc_id) is passed over."""

    def scan(batches):
        last, mine = None, None
        for batch in batches:
            targets, pivots, names = (batch.column(c).to_pylist() for c in ("target", "pivot", "class"))
            for row, n, flat, offsets in slices(batch):
                values, bounds = shingle_sets(flat, offsets, words)
                found = set_names(values, bounds).tolist()
                a, b = [], []
                for i in range(n):
                    target, name = targets[row + i], names[row + i]
                    if found[i] != name:
                        continue
                    own = values[bounds[i] : bounds[i + 1]]
                    if pivots[row + i]:
                        last, mine = target, own.copy()
                    elif last == target:
                        both = len(np.intersect1d(mine, own, assume_unique=True))
                        if 100 * both >= percent * (len(mine) + len(own) - both):
                            a.append(target)
                            b.append(name)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return scan


def jaccard_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest doc_id that chains of links reach. Letters A to Z count
    as lower case. NULL texts and texts without words have the empty set, which links with
    nothing, not even a copy. A NULL doc_id is never the smallest of others. Rows that repeat
    a text are linked, whatever their ids. Other columns are ignored; an empty table gives
    no row. Sets are compared by 64-bit hashes of their shingles.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = plain(docs, id_col, text_col)
    counted = cut_lineage(rows.mapInArrow(_common(words, COMMON), "shingle long, texts long").groupBy("shingle").agg(F.sum("texts").alias("texts")))
    total = counted.filter("shingle is null").agg(F.sum("texts")).head()[0] or 0
    frequent = [r.shingle for r in counted.filter((F.col("texts") >= max(4, total // COMMON)) & F.col("shingle").isNotNull()).select("shingle").collect()]
    common = spark.sparkContext.broadcast(np.sort(np.array(frequent, np.int64).view(np.uint64)))

    known = cut_lineage(rows.mapInArrow(_features(words, percent, common), "doc_id long, class long, n long, window array<long>, hist binary"))
    classes = cut_lineage(known.filter("class is not null").groupBy("class").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("lead"), F.first("n").alias("n"), F.first("hist").alias("hist")))
    placed = known.select("class", F.col("n").cast("int").alias("n"), F.explode("window").alias("region"))
    held = placed.repartition(tasks, "region").sortWithinPartitions("region", "class").mapInArrow(_held(), "class long, n int, region long")
    places = cut_lineage(held.groupBy("class").agg(F.first("n").alias("n"), F.collect_list("region").alias("regions")))

    def by_region(df, order, *cols):
        dealt = df.select("class", "n", *cols, F.explode("regions").alias("region")).repartition(tasks, "region")
        return dealt.sortWithinPartitions("region", *order, "class")

    def with_hist(pairs, side):
        return pairs.join(classes.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("hist").alias(f"hist_{side}")), side)

    def near(pairs):
        return with_hist(with_hist(pairs.select("a", "b"), "a"), "b").mapInArrow(_near(percent), "a long, b long")

    def of_crowded(shared, labels):
        """Near pairs of the crowded regions that hold several groups."""
        crowded = shared.filter("crowded").select(F.col("a").alias("region"), F.explode(F.array("a", "b")).alias("class")).distinct()
        rows = crowded.join(labels, "class", "left").select("region", "class", F.coalesce("component", "class").alias("label"))
        mixed = rows.groupBy("region").agg((F.min("label") != F.max("label")).alias("mixed")).filter("mixed").select("region")
        full = rows.join(mixed, "region").join(classes.select("class", "n", "hist"), "class")
        return full.repartition(tasks, "region").sortWithinPartitions("region", "class").mapInArrow(_near_pairs(percent), "a long, b long")

    def verified(pairs):
        """The links among the pairs. Each text travels to the texts it is compared with: the
        one of ``a`` to all shares of its group, those of ``b`` to one share each."""
        pairs = cut_lineage(pairs)
        shares = pairs.groupBy("a").agg((F.count(F.lit(1)) / SHARE_TEXTS).cast("int").alias("more"))
        to_b = pairs.join(shares, "a").select(F.col("b").alias("class"), F.col("a").alias("target"), F.lit(False).alias("pivot"), F.pmod(F.xxhash64("b"), F.col("more") + 1).cast("int").alias("share"))
        to_a = shares.select(F.col("a").alias("class"), F.col("a").alias("target"), F.lit(True).alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("more"))).alias("share"))
        wanted = cut_lineage(to_a.unionByName(to_b).join(classes.select("class", "lead"), "class"))
        # Few enough, they go to the texts; else both sides are shuffled.
        side = F.broadcast(wanted) if wanted.count() <= LOOKUP_ROWS else wanted
        own = rows.join(side, F.coalesce(F.col("doc_id"), F.lit(NO_ID)) == F.col("lead")).select("target", "share", "pivot", "class", "text")
        dealt = own.repartition(tasks, "target", "share").sortWithinPartitions("target", "share", F.desc("pivot"))
        return cut_lineage(dealt.mapInArrow(_linked(words, percent), "a long, b long"))

    def joined(links):
        nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return connected_components(nodes, links).withColumnRenamed("node", "class")

    # Who holds most regions leads them; a class meets the one that leads most of its regions.
    led = by_region(places.withColumn("held", F.size("regions")), [F.desc("held")], "held").mapInArrow(_hubs(percent), "a long, b long")
    links = verified(near(cut_lineage(led.groupBy("b").agg(F.mode("a", True).alias("a")))))
    labels = joined(links)
    labelled = places.join(labels, "class", "left").withColumn("label", F.coalesce("component", "class"))
    shared = cut_lineage(by_region(labelled, [], "label").mapInArrow(_shared(percent), "a long, b long, crowded boolean").distinct())
    more = verified(near(shared.filter("not crowded")).union(of_crowded(shared, labels)).distinct())
    if not more.isEmpty():
        labels = joined(links.union(more))
    named = known.select("doc_id", "class", "n").join(labels, "class", "left").withColumn("group", F.coalesce("component", "class"))
    smallest = named.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    return named.join(smallest, "group", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """The rows whose doc_id is the smallest of their component, in all columns. Rows that
    repeat a kept doc_id stay too; a component of NULL doc_ids only stays as it is. Texts
    link by the caller's threshold and shingle length, not by those of op3."""
    kept = jaccard_components(docs, percent, words).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")), "left_semi")
