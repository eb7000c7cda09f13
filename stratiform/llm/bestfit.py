"""Training rows of token ids by best-fit-decreasing packing.

Texts are tokenized where they are read. A window of ``window_ids`` ids at a time is packed:
texts longer than a row are split into whole rows and a rest, pieces are taken longest
first, and each goes to the open row with the least room that still holds it. A segment
tree over the possible amounts of room finds that row. Windows are independent, so a
task's memory is one window, nothing is shuffled, and a lost task is simply run again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stratiform.llm.text import binary_column
from stratiform.llm.tokens import encoded, plain

SEQUENCE = 2048
END_ID = 1
PAD_ID = 0
WINDOW_IDS = 1 << 21

ROWS = (
    "shard int, row long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, doc_starts array<long>"
)


class Room:
    """How many open rows have each amount of room left, as a segment tree."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.count[node] += by
            node >>= 1

    def least(self, need: int) -> int:
        """The smallest amount of room >= need that some row has, or -1."""
        count, node = self.count, self.size + need
        if count[node]:
            return need
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return -1


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of piece numbers; longest first, earlier first among equals."""
    room, by_room, rows = Room(capacity), {}, []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        found = room.least(need)
        if found < 0:
            at, found = len(rows), capacity
            rows.append([])
        else:
            at = by_room[found].pop()
            room.add(found, -1)
        rows[at].append(piece)
        left = found - need
        if left:
            by_room.setdefault(left, []).append(at)
            room.add(left, 1)
    return rows


def _packed(doc_ids, ids, offsets, capacity, shard, first_row, pad_id):
    """The packed rows of one window."""
    size = np.diff(offsets)
    count = -(-size // capacity)
    doc = np.repeat(np.arange(len(size)), count)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * capacity
    length = np.minimum(capacity, size[doc] - start)
    rows = best_fit(length, capacity)
    order = np.array([p for r in rows for p in r], np.int64)
    per_row = np.array([len(r) for r in rows], np.int64)
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    matrix = np.full((len(rows), capacity), pad_id, "<u4")
    positions = np.zeros((len(rows), capacity), "<u4")
    cumulative = np.zeros(len(order) + len(rows), np.int32)
    used = np.zeros(len(rows), np.int32)
    at = 0
    for r, pieces in enumerate(rows):
        fill = 0
        at += 1
        for p in pieces:
            n, begin = int(length[p]), int(offsets[doc[p]] + start[p])
            matrix[r, fill : fill + n] = ids[begin : begin + n]
            positions[r, fill : fill + n] = np.arange(n)
            fill += n
            cumulative[at] = fill
            at += 1
        used[r] = fill
    width = np.arange(len(rows) + 1, dtype=np.int64) * capacity * 4
    lists = pa.array(bounds.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(rows), shard, np.int32)),
            pa.array(first_row + np.arange(len(rows), dtype=np.int64)),
            pa.array(used),
            binary_column(matrix.view(np.uint8).ravel(), width),
            binary_column(positions.view(np.uint8).ravel(), width),
            pa.ListArray.from_arrays(pa.array((bounds + np.arange(len(bounds))).astype(np.int32)), pa.array(cumulative)),
            pa.ListArray.from_arrays(lists, doc_ids.take(pa.array(doc[order]))),
            pa.ListArray.from_arrays(lists, pa.array(start[order])),
        ],
        names=["shard", "row", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "doc_starts"],
    )


def packed_rows(
    docs: DataFrame, path: str, length: int = SEQUENCE, end_id: int = END_ID, pad_id: int = PAD_ID,
    window_ids: int = WINDOW_IDS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per training row: its shard (the reading task) and number there, the id and
    position matrices' row (little-endian unsigned 32-bit, padded), the cumulative segment
    lengths, and for each segment its document and where in it the segment starts.

    Positions start again at 0 in every segment; padding has position 0. Every id of every
    text, and the end id after it, lies in exactly one segment. NULL or empty texts are
    their end id; repeated rows are packed once each; other columns are ignored; an empty
    table gives no row.
    """

    def pack(batches):
        shard, row, held, amount = TaskContext.get().partitionId(), 0, [], 0

        def release():
            sizes = np.concatenate([np.diff(o) for _, _, o in held])
            docs_, all_ids = pa.concat_arrays([d for d, _, _ in held]), np.concatenate([i for _, i, _ in held])
            return _packed(docs_, all_ids, np.concatenate([[0], np.cumsum(sizes)]), length, shard, row, pad_id)

        for doc_ids, ids, offsets in encoded(batches, path, end_id):
            held.append((doc_ids, ids, offsets))
            amount += len(ids)
            if amount >= window_ids:
                out = release()
                row, held, amount = row + out.num_rows, [], 0
                yield out
        if held:
            yield release()

    return plain(docs, id_col, text_col).mapInArrow(pack, ROWS)


def write_packed(rows: DataFrame, path: str) -> None:
    """The packed rows as Parquet files, one set of columns per matrix."""
    rows.write.mode("error").option("compression", "zstd").parquet(path)
