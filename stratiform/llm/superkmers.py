"""Repeated windows of any corpus, found by super-k-mer partitioning.

A window is ``width`` consecutive units (words or bytes) of one text. Its minimiser is the
short gram inside it with the smallest hash, so windows of equal content have equal
minimisers. Consecutive windows with the same minimiser form one super-k-mer.

1. Scan: the minimisers of all super-k-mers, without text. Those met twice in a slice of
   the scan are known to repeat; the others meet at their hash. A window whose minimiser
   occurs once in the corpus cannot repeat, so it goes no further.
2. The texts that have repeated minimisers are cut again; each super-k-mer of a repeated
   minimiser travels as one packed string to the bucket of its minimiser. Equal strings of
   one task travel once, with the list of their places. Strings of a bucket are compressed
   together.
3. In its bucket, the windows of all strings are sorted and compared exactly.
4. What repeats comes back as ranges of units for each document, beside its text. Both
   joins with the texts use the same exchange.

A minimiser that a third of all texts share sends one string for each task, not for each
text. A bucket is judged in parts of whole minimisers with at most ``PART_BYTES`` of text,
since judging takes about a hundred bytes for each of them.

Documents are known by doc_id and a hash of the text. Rows that repeat both are copies of
each other; a NULL doc_id is a document as any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.text import Hasher, binary_column, gather, mix, sliding_min, slices, windows, word_bounds

NO_ID = -(2**63)
BUCKETS_PER_TASK = 4
FLUSH_BYTES = 12 << 20
PART_BYTES = 2 << 20
_HIGH = np.uint64(0xFFFFFFFF00000000)
_HASH = Hasher(101)


@dataclass(frozen=True)
class Unit:
    """What windows are made of: ``width`` words or bytes, minimisers of ``gram`` of them."""

    words: bool
    width: int
    gram: int
    slice_bytes: int


class Slice:
    """Some texts, cut into units, with their super-k-mers."""

    def __init__(self, unit: Unit, flat: np.ndarray, offsets: np.ndarray):
        self.unit = unit
        if unit.words:
            self.starts, ends, counts = word_bounds(flat, offsets)
            self.bounds = np.concatenate([[0], np.cumsum(counts)])
            # The words of all texts, each followed by one blank.
            padded = np.append(flat, np.uint8(32))
            self.flat, self.at = gather(padded, self.starts, ends - self.starts + 1)
            self.flat[self.at[1:] - 1] = 32
            values = _HASH.of(flat, self.starts, ends)
            grams = windows(values, unit.gram)
        else:
            self.flat, self.bounds, self.at = flat, offsets, None
            grams = _HASH.grams(flat, unit.gram)
        keys = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_min(keys, unit.width - unit.gram + 1)
        room = np.maximum(0, np.diff(self.bounds) - unit.width + 1)
        doc = np.repeat(np.arange(len(room)), room)
        start = self.bounds[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room)
        place = (least[start] & ~_HIGH).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        self.doc, self.first = doc[head], start[head]
        self.count = np.diff(np.append(head, len(start)))
        self.anchor = grams[place[head]]

    def strings(self, pick: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The bytes of the chosen super-k-mers, and their first units within their texts."""
        low, high = self.first[pick], self.first[pick] + self.count[pick] + self.unit.width - 1
        local = low - self.bounds[self.doc[pick]]
        if self.at is not None:
            low, high = self.at[low], self.at[high]
        raw = self.flat.tobytes()
        return [raw[a:b] for a, b in zip(low.tolist(), high.tolist())], local


def _minimisers(unit: Unit):
    """``(deal, kind, anchor, doc_id)``: kind 0 asks whether the anchor repeats elsewhere, kind
    1 tells others that it does, kind 2 is known to repeat and only passes through."""

    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for row, n, flat, offsets in slices(batch, limit=unit.slice_bytes):
                part = Slice(unit, flat, offsets)
                anchor = part.anchor.view(np.int64)
                distinct, inverse, count = np.unique(anchor, return_inverse=True, return_counts=True)
                again = count[inverse] > 1
                doc = ids[row + part.doc]
                known = np.stack(np.divmod(np.unique(part.doc[again] * len(distinct) + inverse[again]), max(1, len(distinct))))
                tell = distinct[count > 1]
                pieces = [
                    (anchor[~again], 0, doc[~again], anchor[~again]),
                    (tell, 1, np.full(len(tell), NO_ID), tell),
                    (distinct[known[1]], 2, ids[row + known[0]], (distinct[known[1]].view(np.uint64) + np.arange(known.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)),
                ]
                for a, kind, d, deal in pieces:
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(deal), pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(d)], names=["deal", "kind", "anchor", "doc_id"])

    return scan


def _repeated(batches):
    """``(doc_id, anchor)`` of anchors that occur again; rows come sorted by passing, anchor."""
    held = None  # the last row of kind 0 or 1: anchor, doc_id, kind, known to repeat
    schema = ["doc_id", "anchor"]

    def rows(docs, anchors):
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(anchors, pa.int64())], names=schema)

    for batch in batches:
        kind, anchor, doc = (batch.column(c).to_numpy() for c in ("kind", "anchor", "doc_id"))
        passing = kind == 2
        if passing.any():
            yield rows(doc[passing], anchor[passing])
        anchor, doc, kind = anchor[~passing], doc[~passing], kind[~passing]
        if not len(anchor):
            continue
        same = np.zeros(len(anchor) + 1, bool)
        same[1:-1] = anchor[1:] == anchor[:-1]
        if held is not None:
            same[0] = held[0] == anchor[0]
            if held[2] == 0 and (held[3] or same[0]):
                yield rows([held[1]], [held[0]])
        known = same[:-1] | same[1:]
        out = known & (kind == 0)
        held = (anchor[-1], doc[-1], kind[-1], bool(known[-1]))
        out[-1] = False
        if out.any():
            yield rows(doc[out], anchor[out])
    if held is not None and held[2] == 0 and held[3]:
        yield rows([held[1]], [held[0]])


def _pack(unit: Unit, buckets: int):
    """Blobs of packed super-k-mers for each bucket, from texts beside their repeated anchors."""
    import zstandard

    def emit(held):
        anchor, count, doc, digest, local = (np.concatenate([h[k] for h in held]) for k in range(1, 6))
        text = [s for h in held for s in h[0]]
        # Equal strings once, wherever they occur.
        places: dict[bytes, int] = {}
        name = np.array([places.setdefault(s, len(places)) for s in text], np.int64)
        bucket = (anchor % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((name, anchor, bucket))
        heads = np.flatnonzero(np.concatenate([[True], name[order][1:] != name[order][:-1]]))
        times = np.diff(np.append(heads, len(order)))
        lead = order[heads]
        edges = np.flatnonzero(np.concatenate([[True], bucket[lead][1:] != bucket[lead][:-1], [True]]))
        pack = zstandard.ZstdCompressor(level=3)
        names, blobs = [], []
        for a, b in zip(edges[:-1], edges[1:]):
            some = lead[a:b]
            at = order[heads[a] : heads[b] if b < len(heads) else len(order)]
            body = [text[i] for i in some]
            parts = [
                np.array([len(some), len(at)], "<i8"), anchor[some], np.array([len(s) for s in body], "<u4"), count[some].astype("<u4"), times[a:b].astype("<u4"),
                doc[at], digest[at], local[at].astype("<i8"),
            ]
            names.append(int(bucket[some[0]]))
            blobs.append(pack.compress(b"".join([p.tobytes() for p in parts] + body)))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def scan(batches):
        held, amount = [], 0
        for batch in batches:
            ids, digests = batch.column("doc_id").to_numpy(), batch.column("digest").to_numpy()
            lists = batch.column("anchors")
            ends = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy().view(np.uint64)
            for row, n, flat, offsets in slices(batch, limit=unit.slice_bytes):
                part = Slice(unit, flat, offsets)
                # Anchors of one text only count for that text.
                size = np.diff(ends[row : row + n + 1])
                salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
                wanted = values[ends[row] : ends[row + n]] ^ np.repeat(salt, size)
                pick = np.flatnonzero(np.isin(part.anchor ^ salt[part.doc], wanted))
                if not len(pick):
                    continue
                text, local = part.strings(pick)
                held.append((text, part.anchor[pick], part.count[pick], ids[row + part.doc[pick]], digests[row + part.doc[pick]], local))
                amount += sum(map(len, text))
                if amount > FLUSH_BYTES:
                    yield emit(held)
                    held, amount = [], 0
        if held:
            yield emit(held)

    return scan


class Strings:
    """Packed strings, the minimiser of each, and where each of them occurs."""

    def __init__(self, anchor: np.ndarray, sizes: np.ndarray, count: np.ndarray, times: np.ndarray, doc: np.ndarray, digest: np.ndarray, local: np.ndarray, text: np.ndarray):
        self.anchor, self.doc, self.digest, self.local, self.text = anchor, doc, digest, local, text
        self.sizes, self.count, self.times = sizes.astype(np.int64), count.astype(np.int64), times.astype(np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.place = np.cumsum(self.times) - self.times  # of a string's first occurrence

    @classmethod
    def unpacked(cls, blobs: list[bytes]) -> Strings:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        columns: list[list[np.ndarray]] = [[] for _ in range(8)]
        for blob in blobs:
            raw = unpack.decompress(blob)
            n, m = np.frombuffer(raw, "<i8", 2)
            at = 16
            for k, (kind, size) in enumerate([("<u8", n), ("<u4", n), ("<u4", n), ("<u4", n), ("<i8", m), ("<i8", m), ("<i8", m), ("u1", -1)]):
                columns[k].append(np.frombuffer(raw, kind, size, at))
                at += columns[k][-1].nbytes
        anchor, sizes, count, times, *places, text = (np.concatenate(c) for c in columns)
        # Equal strings of several tasks become one, with all its places.
        raw, ends = text.tobytes(), np.cumsum(sizes, dtype=np.int64)
        known: dict[bytes, int] = {}
        name = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip((ends - sizes).tolist(), ends.tolist())], np.int64)
        lead = np.zeros(len(known), np.int64)
        lead[name[::-1]] = np.arange(len(name))[::-1]
        owner = np.repeat(name, times)
        order = np.argsort(owner, kind="stable")
        body = np.frombuffer(b"".join(known), np.uint8)
        return cls(anchor[lead], sizes[lead], count[lead], np.bincount(owner, minlength=len(known)), *(p[order] for p in places), body)

    def parts(self, limit: int = PART_BYTES) -> Iterator[Strings]:
        """These strings in parts of at most ``limit`` bytes of text. Strings of one minimiser
        stay together, as only they can share a window; more bytes than that make one part."""
        if len(self.text) <= limit:
            yield self
            return
        order = np.argsort(self.anchor, kind="stable")
        ends = np.flatnonzero(np.append(self.anchor[order][1:] != self.anchor[order][:-1], True)) + 1
        total = np.concatenate([[0], np.cumsum(self.sizes[order])[ends - 1]])
        ends = np.concatenate([[0], ends])
        at = 0
        while at < len(ends) - 1:
            to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
            some = order[ends[at] : ends[to]]
            places = [gather(column, self.place[some], self.times[some])[0] for column in (self.doc, self.digest, self.local)]
            yield Strings(self.anchor[some], self.sizes[some], self.count[some], self.times[some], *places, gather(self.text, self.begin[some], self.sizes[some])[0])
            at = to

    def ranges(self, string: np.ndarray, low: np.ndarray, high: np.ndarray, occurrences: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        """One row for each given range of a string and each chosen occurrence of the string;
        ``occurrences(strings)`` gives the first of them and how many."""
        first, many = occurrences(string)
        which = np.repeat(np.arange(len(string)), many)
        at = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.doc[at]), pa.array(self.digest[at]), pa.array(self.local[at] + low[which]), pa.array(self.local[at] + high[which])],
            names=["doc_id", "digest", "low", "high"],
        )


def _buckets(judge: Callable[[Strings], Iterator[pa.RecordBatch]]):
    def scan(batches):
        current, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob")):
                if bucket != current:
                    for part in Strings.unpacked(blobs).parts() if blobs else ():
                        yield from judge(part)
                    current, blobs = bucket, []
                blobs.append(blob.as_py())
        for part in Strings.unpacked(blobs).parts() if blobs else ():
            yield from judge(part)

    return scan


def spread(flags: np.ndarray, string: np.ndarray, window: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(string, low, high)``: maximal ranges of units covered by flagged windows; windows
    come sorted by string and place."""
    at = np.flatnonzero(flags)
    s, w = string[at], window[at]
    new = np.ones(len(at), bool)
    new[1:] = (s[1:] != s[:-1]) | (w[1:] > w[:-1] + width)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1 if len(at) else head
    return s[head], w[head], w[tail] + width


def with_ranges(docs: DataFrame, unit: Unit, judge: Callable[[Strings], Iterator[pa.RecordBatch]], id_col: str, text_col: str) -> DataFrame:
    """``doc_id, digest, text, ranges``: every document with the ranges ``judge`` gives for it
    (an array of ``digest, low, high``; NULL without any). ``doc_id`` is ``NO_ID`` for NULL."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    asked = rows.select("doc_id", "text").mapInArrow(_minimisers(unit), "deal long, kind byte, anchor long, doc_id long")
    dealt = asked.repartition(tasks, "deal").sortWithinPartitions((F.col("kind") == 2), "anchor").select("kind", "anchor", "doc_id")
    again = dealt.mapInArrow(_repeated, "doc_id long, anchor long").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    buckets = tasks * BUCKETS_PER_TASK
    packed = rows.join(again, "doc_id").mapInArrow(_pack(unit, buckets), "bucket int, blob binary")
    bucketed = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    found = bucketed.mapInArrow(_buckets(judge), "doc_id long, digest long, low long, high long")
    ranges = found.groupBy("doc_id").agg(F.collect_list(F.struct("digest", "low", "high")).alias("ranges"))
    return rows.join(ranges, "doc_id", "left")


def covered(batch: pa.RecordBatch, row: int, n: int, bounds: np.ndarray) -> np.ndarray:
    """Which units of ``n`` texts lie in one of their ranges; ``bounds`` are their unit offsets."""
    lists = batch.column("ranges")
    ends = lists.offsets.to_numpy().astype(np.int64)[row : row + n + 1]
    inner = lists.values
    text = np.repeat(np.arange(n), np.diff(ends))
    digest, low, high = (inner.field(k).to_numpy()[ends[0] : ends[-1]] for k in range(3))
    mine = digest == batch.column("digest").to_numpy()[row + text]
    step = np.zeros(bounds[-1] + 1, np.int64)
    np.add.at(step, bounds[text[mine]] + low[mine], 1)
    np.add.at(step, bounds[text[mine]] + high[mine], -1)
    return np.cumsum(step[:-1]) > 0


# -- repeated runs of words ---------------------------------------------------------------

WORDS = Unit(words=True, width=35, gram=4, slice_bytes=4 << 20)


def _equal_before(text: np.ndarray, low: np.ndarray, high: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For stretches sorted by ``key``: whether each equals the one before it, byte by byte."""
    same = np.zeros(len(low), bool)
    pair = np.flatnonzero((key[1:] == key[:-1]) & (high[1:] - low[1:] == high[:-1] - low[:-1])) + 1
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    two = padded[:-1].astype(np.uint64) << np.uint64(8) | padded[1:]
    four = two[:-2] << np.uint64(16) | two[2:]
    eight = four[:-4] << np.uint64(32) | four[4:]
    size = high[pair] - low[pair]
    open_, step = pair, 0
    while len(open_):
        # The last step looks at the last eight bytes, or at what there is of them.
        rest = size - step
        done = rest <= 0
        same[open_[done]] = True
        open_, size, rest = open_[~done], size[~done], rest[~done]
        shift = (np.uint64(8) * np.maximum(0, 8 - rest).astype(np.uint64)).astype(np.uint64)
        alike = (eight[low[open_] + step] >> shift) == (eight[low[open_ - 1] + step] >> shift)
        open_, size = open_[alike], size[alike]
        step += 8
    return same


def judge_words(unit: Unit):
    """Windows of words that occur at least twice in the bucket."""

    def judge(strings: Strings):
        starts, ends, words = word_bounds(strings.text, np.append(strings.begin, len(strings.text)))
        string = np.repeat(np.arange(len(strings.count)), strings.count)
        window = np.arange(len(string)) - np.repeat(np.cumsum(strings.count) - strings.count, strings.count)
        first = (np.cumsum(words) - words)[string] + window
        key = windows(_HASH.of(strings.text, starts, ends), unit.width)[first]
        order = np.argsort(key, kind="stable")
        low, high = starts[first[order]], ends[first[order] + unit.width - 1]
        same = _equal_before(strings.text, low, high, key[order])
        if np.any((key[order][1:] == key[order][:-1]) & ~same[1:]):  # one hash, other words
            texts = np.array([strings.text[a:b].tobytes() for a, b in zip(starts[first], ends[first + unit.width - 1])], dtype=object)
            _, name = np.unique(texts, return_inverse=True)
            order = np.argsort(name, kind="stable")
            same = np.concatenate([[False], name[order][1:] == name[order][:-1]])
        group = np.cumsum(~same) - 1
        total = np.bincount(group, strings.times[string[order]])
        flags = np.zeros(len(order), bool)
        flags[order] = total[group] > 1
        if flags.any():
            yield strings.ranges(*spread(flags, string, window, unit.width), lambda s: (strings.place[s], strings.times[s]))

    return judge


def remove_repeated_words(docs: DataFrame, width: int = WORDS.width, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_text``.

    Every word in a window of ``width`` words that also starts anywhere else is removed;
    the others are joined by one blank. NULL, empty and wordless texts have no words, and
    texts shorter than a window lose none. Rows repeating doc_id and text are copies of
    each other. Other columns are ignored; an empty table gives no row.
    """
    unit = Unit(True, width, min(WORDS.gram, width), WORDS.slice_bytes)

    def finish(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for row, n, flat, offsets in slices(batch, limit=unit.slice_bytes):
                starts, ends, counts = word_bounds(flat, offsets)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                keep = ~covered(batch, row, n, bounds)
                text, at = gather(np.append(flat, np.uint8(32)), starts[keep], (ends - starts)[keep] + 1)
                text[at[1:] - 1] = 32
                kept = np.concatenate([[0], np.cumsum(keep)])[bounds]
                low, high = at[kept[:-1]], at[kept[1:]]
                text, spot = gather(text, low, np.maximum(0, high - low - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row : row + n], mask=ids[row : row + n] == NO_ID), pa.array(counts.astype(np.int64)), pa.array(counts - np.diff(kept)), binary_column(text, spot)],
                    names=["doc_id", "n_words", "n_removed", "kept_text"],
                )

    joined = with_ranges(docs, unit, judge_words(unit), id_col, text_col)
    return joined.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_text binary")
