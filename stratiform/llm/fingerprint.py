"""Document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs, its lines. Each is hashed to a wide vector, and the
fingerprint is the sum of these vectors: ``LANES`` numbers modulo 2**32 that decide
equality, and ``BITS`` counts modulo 2**16 that measure likeness, for which a long line
counts as several, cut after its sentences. Sums do not depend on order, and a paragraph
is added or taken away by adding or subtracting its vector, without the rest of the text.

Likeness: paragraph vectors have independent random signs in ``BITS`` places, so the
squared length of a sum estimates the size of the multiset, and that of a difference the
number of paragraphs by which two texts differ. ``1 - differing / all`` is clipped to
the range 0 to 1.
"""

from __future__ import annotations

import math
import re
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.text import slices
from stratiform.llm.tokens import plain

LANES = 16
BITS = 512
LONG_LINE = 160
STEP = 1 << 14

_SENTENCE = re.compile(rb"(?<=[.!?]) +")


def paragraphs(text: bytes) -> list[bytes]:
    """The lines, empty ones included."""
    return text.split(b"\n")


def pieces(text: bytes) -> list[bytes]:
    """What likeness counts: lines that are not empty, long ones cut after their sentences."""
    out = []
    for line in paragraphs(text):
        if len(line) > LONG_LINE:
            out += _SENTENCE.split(line)
        elif line:
            out.append(line)
    return out


def _digests(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([blake2b(p).digest() for p in parts]), np.uint8).reshape(-1, 64)


def _summed(parts: list[list[bytes]], width: int, spread) -> np.ndarray:
    """For each text the sum of ``spread(digests)`` over its parts, about ``STEP`` parts at a time."""
    sizes = np.array([len(p) for p in parts], np.int64)
    out = np.zeros((len(parts), width), np.int64)
    ends, row = np.cumsum(sizes), 0
    while row < len(parts):
        last = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + STEP, "right")))
        full = np.flatnonzero(sizes[row:last])
        if len(full):
            begin = (np.cumsum(sizes[row:last]) - sizes[row:last])[full]
            out[row + full] = spread(_digests([p for ps in parts[row:last] for p in ps]), begin, sizes[row:last][full])
        row = last
    return out


def _lanes(digests, begin, sizes):
    return np.add.reduceat(digests.view("<u4"), begin, axis=0, dtype=np.uint32)


def _signs(digests, begin, sizes):
    return 2 * np.add.reduceat(np.unpackbits(digests, axis=1), begin, axis=0, dtype=np.int32) - sizes[:, None]


def vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(equality lanes uint32, likeness counts int32)`` for each text. An empty text is one
    empty line: its lanes are that line's, its counts zero."""
    lanes = _summed([paragraphs(t) for t in texts], LANES, _lanes).astype(np.uint32)
    return lanes, _summed([pieces(t) for t in texts], BITS, _signs).astype(np.int32)


def changed(fingerprint: tuple[np.ndarray, np.ndarray], line: bytes, times: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint after inserting (``times`` > 0) or deleting (< 0) a line anywhere."""
    lanes = fingerprint[0] + np.uint32(times % 2**32) * _digests([line]).view("<u4")[0]
    return lanes, fingerprint[1] + times * _summed([pieces(line)], BITS, _signs)[0].astype(np.int32)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1, row by row, of two arrays of likeness counts; two empty texts are alike.

    Differences are taken modulo 2**16, as the counts are stored."""
    wrap = lambda x: ((x + 2**15) % 2**16 - 2**15).astype(np.float64)
    apart = (wrap(a - b) ** 2).sum(axis=1)
    whole = (wrap(a) ** 2).sum(axis=1) + (wrap(b) ** 2).sum(axis=1)
    return np.where(whole > 0, np.clip(1 - apart / np.maximum(whole, 1), 0, 1), 1.0)


def text_of(lanes: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in np.ascontiguousarray(lanes.astype("<u4"))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, lanes, counts``: the hex text of the equality lanes, and both
    vectors as little-endian bytes. NULL counts as the empty text; one row per input row;
    other columns are ignored."""

    def compute(batches):
        for batch in batches:
            for row, n, flat, offsets in slices(batch):
                raw = flat.tobytes()
                lanes, counts = vectors([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, n),
                        pa.array(text_of(lanes)),
                        pa.array([x.tobytes() for x in lanes.astype("<u4")], pa.binary()),
                        pa.array([x.tobytes() for x in (counts % 2**16).astype("<u2")], pa.binary()),
                    ],
                    names=["doc_id", "fingerprint", "lanes", "counts"],
                )

    return plain(docs, id_col, text_col).mapInArrow(compute, "doc_id long, fingerprint string, lanes binary, counts binary")


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_check(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints beside those of edited texts, one row per input row: ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one with the next smaller doc_id (NULL is the smallest; rows
    that repeat a doc_id follow each other by the hash of their texts); after the last one
    comes the first. A table of one row is its own next. NULL counts as the empty text.

    Rows go to contiguous ranges of doc_id, found from quantiles, and are sorted there, so
    the next row is the one read next. Only the first row of a range is also sent to the
    range before it.
    """
    spark = docs.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = F.lit(-(2**63))
    rows = plain(docs, id_col, text_col)
    key = F.coalesce(F.col("doc_id"), low)
    cuts = rows.select(key.alias("k")).agg(F.percentile_approx("k", [i / wanted for i in range(1, wanted)] or [0.5], 10000)).head()[0] or []
    edges = sorted(set(cuts), reverse=True)
    # Range 0 holds the largest ids; a row's range is the number of edges above its id.
    # They are counted in two steps, among every so-manieth edge and within one stretch.
    part = F.lit(0)
    if edges:
        stride = math.isqrt(len(edges))
        above = lambda some: F.size(F.filter(some, lambda e: e > key))
        coarse = above(F.lit(edges[::stride]).cast("array<long>"))
        stretch = F.slice(F.lit(edges).cast("array<long>"), F.greatest((coarse - 1) * stride + 1, F.lit(1)), F.lit(stride))
        part = F.when(coarse == 0, 0).otherwise((coarse - 1) * stride + above(stretch))
    placed = rows.withColumns({"range": part.cast("int"), "key": key})
    # The largest id of each range, read from the id column alone.
    heads = sorted((r.range, r.top) for r in placed.groupBy("range").agg(F.max("key").alias("top")).collect())
    before = {at: heads[i - 1][0] for i, (at, _) in enumerate(heads)}  # the range before each, round the end
    sent = F.array(F.struct(F.col("range").alias("to"), F.lit(False).alias("visitor")))
    if heads:
        top = F.create_map(*[F.lit(x) for at, t in heads for x in (at, t)])
        to = F.create_map(*[F.lit(x) for at, b in before.items() for x in (at, b)])
        visitor = F.struct(F.element_at(to, F.col("range")).cast("int").alias("to"), F.lit(True).alias("visitor"))
        sent = F.when(F.col("key") == F.element_at(top, F.col("range")), F.array(F.struct(F.col("range").alias("to"), F.lit(False).alias("visitor")), visitor)).otherwise(sent)
    dealt = placed.withColumn("sent", F.explode(sent)).select("sent.to", "sent.visitor", "doc_id", "key", F.xxhash64("text").alias("hash"), "text")
    order = ["to", "visitor", F.desc("key"), "hash"]
    ranges = max(1, len(heads))
    ordered = dealt.repartitionById(ranges, "to").sortWithinPartitions(*order)

    def compare(batches):
        def rows_of():
            for batch in batches:
                columns = [batch.column(c) for c in ("to", "visitor", "doc_id", "text")]
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*(c.slice(at, 256).to_pylist() for c in columns))

        def finish(held, following):
            texts = [t for _, t in held] + [following]
            lanes, counts = vectors([t.encode() for t in texts])
            edited = [_edited(a, b).encode() for a, b in zip(texts, texts[1:])]
            edited_lanes, edited_counts = vectors(edited)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([d for d, _ in held], pa.int64()),
                    pa.array([len(t) for _, t in held], pa.int64()),
                    pa.array([sha256(e).hexdigest() for e in edited]),
                    pa.array(text_of(lanes[:-1])),
                    pa.array(text_of(edited_lanes)),
                    pa.array(likeness(edited_counts, counts[:-1])),
                    pa.array(likeness(counts[1:], counts[:-1])),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        current, held, amount, closed = None, [], 0, True
        for to, visitor, doc_id, text in rows_of():
            if to != current:
                current, held, amount, closed = to, [], 0, False
            if visitor:
                if not closed:
                    yield finish(held, text)
                held, closed = [], True
                continue
            if held and amount > 1 << 21:
                yield finish(held, text)
                held, amount = [], 0
            held.append((doc_id, text))
            amount += len(text)

    return ordered.mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )

