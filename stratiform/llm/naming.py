"""Exact dedup by deterministic block naming.

Every text is cut into blocks of equal size. Sorting the blocks of all texts gives each
distinct block an integer name; then neighbouring names are joined to pairs, the pairs
are named the same way, and so on until one name is left of each text. Names come from
comparing contents, never from hashes, so two texts share the last name exactly when
they are equal.

Scale: a level is one range-partitioned sort of its rows. Rows of equal content are told
apart by their document, so a block that a third of all rows share is spread over many
tasks; a name then is the rank within the task plus the number of distinct keys before
it. Two rows per task (its first and last key) reach the driver. Each level halves the
rows, and a text leaves as soon as one name is left of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.text import binary_column, slices
from stratiform.session import cut_lineage, small_table

BLOCK_BYTES = 512
_ROW = "doc_id long, digest long, size int, place int"


def _cut(block: int):
    def cut(batches):
        for batch in batches:
            for row, n, flat, offsets in slices(batch):
                lengths = np.diff(offsets)
                counts = np.maximum(1, -(-lengths // block))
                doc = np.repeat(np.arange(n), counts)
                place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = offsets[:-1][doc] + place * block
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row + doc)),
                        batch.column("digest").take(pa.array(row + doc)),
                        pa.array(counts[doc].astype(np.int32)),
                        pa.array(place.astype(np.int32)),
                        binary_column(flat, np.append(starts, len(flat))),
                    ],
                    names=["doc_id", "digest", "size", "place", "a"],
                )

    return cut


def _ranks(keys: list[str]):
    """Dense rank of the keys within the sorted task, and one closing row with the task's
    number of distinct keys, its first and its last key."""

    def changes(columns, last):
        import pyarrow.compute as pc

        n = len(columns[0])
        new = np.zeros(n, bool)
        for i, c in enumerate(columns):
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] |= last is not None and c[0].as_py() != last[i]
        return new

    def rank(batches):
        task, count, first, last = TaskContext.get().partitionId(), 0, None, None
        blank = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            blank = blank or [c.type for c in columns]
            local = count + np.cumsum(changes(columns, last))
            first = first if first is not None else [c[0].as_py() for c in columns]
            last, count = [c[-1].as_py() for c in columns], int(local[-1])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "digest", "size", "place")), pa.array(np.full(n, task, np.int32)), pa.array(local.astype(np.int64)), pa.array(np.zeros(n, bool)), *(pa.nulls(n, t) for t in blank for _ in (0, 1))],
                names=["doc_id", "digest", "size", "place", "task", "local", "closing", *(f"{e}_{k}" for k in keys for e in ("first", "last"))],
            )
        if first is not None:
            ends = [pa.array([x], type=t) for f, l, t in zip(first, last, blank) for x in (f, l)]
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([task], pa.int32()), pa.array([count + 1], pa.int64()), pa.array([True]), *ends],
                names=["doc_id", "digest", "size", "place", "task", "local", "closing", *(f"{e}_{k}" for k in keys for e in ("first", "last"))],
            )

    return rank


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with their keys replaced by ``name``, equal for equal keys only."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)
    order = [*keys, "doc_id", "digest", "place"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = [f"{e}_{k}" for k in keys for e in ("first", "last")]
    schema = f"{_ROW}, task int, local long, closing boolean, " + ", ".join(f"{e}_{k} {kind[k]}" for k in keys for e in ("first", "last"))
    sorted_rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    ranked = cut_lineage(sorted_rows.mapInArrow(_ranks(keys), schema))
    base, at, before = [], 0, None
    for r in sorted(ranked.filter("closing").select("task", "local", *ends).collect(), key=lambda r: r.task):
        at -= before is not None and before == [r[f"first_{k}"] for k in keys]
        base.append((r.task, at))
        at, before = at + r.local, [r[f"last_{k}"] for k in keys]
    bases = small_table(spark, base, "task int, base long")
    return ranked.filter("not closing").join(bases, "task").select("doc_id", "digest", "size", "place", (F.col("local") + F.col("base")).alias("name"))


def block_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, digest, level, name)``: two texts are equal exactly when level and name are.

    NULL counts as the empty text. ``digest`` (a 64-bit hash of the text) only tells apart
    rows that repeat a doc_id with another text; rows that repeat both yield one row. An
    empty table yields no row; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
        .mapInArrow(_cut(block_bytes), f"{_ROW}, a binary")
    )
    names, level, done = _named(rows, ["a"]), 0, None
    while True:
        names = cut_lineage(names) if level else names
        ready = names.filter("size = 1").select("doc_id", "digest", F.lit(level).alias("level"), "name")
        done = ready if done is None else done.unionByName(ready)
        rest = names.filter("size > 1")
        if rest.isEmpty():
            return done.distinct()
        even = F.col("place") % 2 == 0
        pairs = rest.groupBy("doc_id", "digest", F.expr("cast((size + 1) div 2 as int)").alias("size"), F.expr("cast(place div 2 as int)").alias("place")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")
        )
        names, level = _named(pairs, ["a", "b"]), level + 1


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest doc_id stays; rows whose doc_id and text are
    both repeated share one decision, and each counts in ``group_size``. A NULL doc_id is
    smaller than any other. The lookup of a group by its name may meet a hot name (a text
    that a third of all rows share): its rows are a few numbers wide, and the join is a
    plain one whose skewed partitions Spark splits at run time.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), F.sha2(text, 256).alias("text_sha256"))
    ids = block_identities(docs, id_col, text_col, block_bytes).withColumnRenamed("doc_id", "id")
    named = cut_lineage(
        rows.join(ids.withColumnRenamed("digest", "d"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d"))).select("doc_id", "text_sha256", "level", "name")
    )
    groups = named.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["level", "name"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns; rows repeating doc_id and text leave one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = exact_groups(docs).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    kept = cut_lineage(kept.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("copies").alias("__copies")))
    stay = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.sha2(text, 256) == F.col("__sha")))
    once = stay.filter("__copies = 1").select(*docs.columns)
    return once.unionByName(stay.filter("__copies > 1").dropDuplicates(["__id", "__sha"]).select(*docs.columns))


ORACLE = """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""

__all__ = ["BLOCK_BYTES", "ORACLE", "block_identities", "drop_copies", "exact_groups"]
