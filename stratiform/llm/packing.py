"""Packing by concatenation: one endless stream of ids, cut every ``length`` ids.

Two passes of prefix sums. The first tokenizes each text once and notes, within its task,
how many ids stand before it; the totals of the tasks, one number each, are summed up on
the driver and give every task its global start. The second pass cuts each document at
the multiples of ``length``. A document that runs over such a boundary has one record
on either side of it. Nothing is sorted or shuffled: the order is that of the scan.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.text import binary_column
from stratiform.llm.tokens import encoded, plain, tokenizer
from stratiform.session import cut_lineage, small_table

SEQUENCE = 2048
END_ID = 1


def _first_pass(path: str, end_id: int):
    def number(batches):
        task, before = TaskContext.get().partitionId(), 0
        for doc_ids, ids, offsets in encoded(batches, path, end_id):
            width = ids.dtype.itemsize
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.full(len(doc_ids), task, np.int32)), pa.array(before + offsets[:-1]), pa.array(np.diff(offsets)), binary_column(ids.view(np.uint8), offsets * width)],
                names=["doc_id", "task", "before", "doc_tokens", "ids"],
            )
            before += int(offsets[-1])

    return number


def _second_pass(path: str, length: int):
    def cut(batches):
        kind = tokenizer(path).dtype
        for batch in batches:
            if not batch.num_rows:
                continue
            begin = batch.column("begin").to_numpy()
            size = batch.column("doc_tokens").to_numpy()
            count = np.where(size > 0, (begin + size - 1) // length - begin // length + 1, 0)
            doc = np.repeat(np.arange(len(begin)), count)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            sequence = begin[doc] // length + nth
            low = np.maximum(begin[doc], sequence * length)
            high = np.minimum(begin[doc] + size[doc], (sequence + 1) * length)
            rows = batch.column("ids")
            for lo in range(0, len(doc), 2000):  # the widened ids of so many pieces at a time
                part = slice(lo, lo + 2000)
                pieces = [
                    np.frombuffer(rows[int(d)].as_buffer(), kind)[a:b].astype("<u4").tobytes()
                    for d, a, b in zip(doc[part], (low - begin[doc])[part], (high - begin[doc])[part])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(doc[part])),
                        pa.array((low - begin[doc])[part]),
                        pa.array((high - low)[part]),
                        pa.array(size[doc[part]]),
                        pa.array(sequence[part]),
                        pa.array((low - sequence * length)[part]),
                        pa.array(pieces, pa.binary()),
                    ],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return cut


def concatenate_and_cut(docs: DataFrame, path: str, length: int = SEQUENCE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    ``ids`` are little-endian unsigned 32-bit numbers. All sequences but the last hold
    ``length`` ids, so nothing is padded but that one. A NULL or empty text is its end id
    alone; repeated rows are packed once each; a NULL doc_id is carried along; other
    columns are ignored; an empty table gives no row.
    """
    first = cut_lineage(plain(docs, id_col, text_col).mapInArrow(_first_pass(path, end_id), "doc_id long, task int, before long, doc_tokens long, ids binary"))
    totals = sorted((r.task, r.total) for r in first.groupBy("task").agg(F.sum("doc_tokens").alias("total")).collect())
    starts = [0, *accumulate(t for _, t in totals)]
    bases = small_table(docs.sparkSession, [(task, at) for (task, _), at in zip(totals, starts)], "task int, base long")
    placed = first.join(bases, "task").select("doc_id", (F.col("base") + F.col("before")).alias("begin"), "doc_tokens", "ids")
    return placed.mapInArrow(_second_pass(path, length), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
