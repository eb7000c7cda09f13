"""Suffix-array dedup: strings of ``width`` bytes that start earlier in the corpus.

Super-k-mer partitioning (``superkmers``) brings the passages that may repeat together in
buckets. There, the suffixes are sorted in two stages: only those smaller than their
successor are sorted directly; scanning the buckets of first bytes from left to right then
induces the place of every other suffix from its successor, which is smaller and so
already placed. Adjacent common prefixes of at least ``width`` bytes are the repeats.

Sorting stops at ``width`` bytes, since longer common prefixes make no difference here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratiform.llm.superkmers import NO_ID, Strings, Unit, covered, spread, with_ranges
from stratiform.llm.text import binary_column, slices

# Fixed value: a byte that no UTF-8 text holds. It ends every string.
SEPARATOR = 0xFF

BYTES = Unit(words=False, width=100, gram=24, slice_bytes=2 << 20)


def packed_keys(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts as they do."""
    two = text[:-1].astype(np.uint64) << np.uint64(8) | text[1:]
    four = two[:-2] << np.uint64(16) | two[2:]
    return four[:-4] << np.uint64(32) | four[4:]


def rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not."""
    n = len(text)
    change = np.append(text[1:] != text[:-1], True)
    at = np.where(change, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]  # the last place of the run of equal bytes
    following = np.minimum(at + 1, n - 1)
    return (at < n - 1) & (text[at] < text[following])


def sort_directly(places: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` bytes from there, eight bytes in a round; only what
    is still tied goes into the next round."""
    order = places[np.argsort(keys[places], kind="stable")]
    key = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    at = 8
    while at < depth:
        alone = new & np.append(new[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        key = keys[order[tied] + at]
        differ = np.flatnonzero((key[1:] != key[:-1]) & (group[1:] == group[:-1])) + 1
        if len(differ):  # groups of equal keys stay as they are
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[group[differ]] = True
            pick = np.flatnonzero(mixed[group])
            tied, key, group = tied[pick], key[pick], group[pick]
            by = np.lexsort((key, group))
            order[tied] = order[tied][by]
            key = key[by]
            fresh = np.ones(len(tied), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
            new[tied] = fresh
        at += 8
    return order


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """All places of ``text`` (which ends with the separator) in the order of the ``depth``
    bytes from there."""
    n = len(text)
    keys = packed_keys(np.concatenate([text, np.zeros(depth + 16, np.uint8)]))  # the end is smallest
    smaller = rising(text)
    direct = sort_directly(np.flatnonzero(smaller), keys, depth)
    edges = np.searchsorted(text[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    queues[text[-1]].append(np.array([n - 1]))  # its successor is the empty suffix
    out = []

    def induced(placed: np.ndarray) -> np.ndarray:
        before = placed[placed > 0] - 1
        return before[~smaller[before]]

    for byte in range(256):
        fresh = np.concatenate(queues[byte]) if queues[byte] else np.zeros(0, np.int64)
        front = []
        while len(fresh):  # runs of the same byte stay in this bucket
            front.append(fresh)
            before = induced(fresh)
            fresh = before[text[before] == byte]
        bucket = np.concatenate([*front, direct[edges[byte] : edges[byte + 1]]])
        queues[byte] = []
        out.append(bucket)
        before = induced(bucket)
        before = before[text[before] != byte]
        first = text[before]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        for a, b in zip(*(lambda e: (e[:-1], e[1:]))(np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1], [True]])) if len(first) else np.zeros(1, int))):
            queues[first[a]].append(before[a:b])
    return np.concatenate(out)


def prefix_shared(text: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """Whether each suffix shares its first ``width`` bytes with the one before it."""
    keys = packed_keys(np.concatenate([text, np.zeros(width + 16, np.uint8)]))
    same = np.zeros(len(order), bool)
    open_ = np.arange(1, len(order))
    for at in range(0, width, 8):
        drop = np.uint64(8 * max(0, at + 8 - width))
        open_ = open_[(keys[order[open_] + at] >> drop) == (keys[order[open_ - 1] + at] >> drop)]
    same[open_] = True
    return same


def judge_bytes(unit: Unit):
    """Windows of bytes of which an equal one lies earlier: at a smaller doc_id, or at the same
    and further left (rows repeating a doc_id follow each other by the hash of their texts)."""

    def judge(strings: Strings):
        # Occurrences of a string in corpus order.
        owner = np.repeat(np.arange(len(strings.times)), strings.times)
        rank = np.lexsort((strings.local, strings.digest, strings.doc, owner))
        strings.doc, strings.digest, strings.local = strings.doc[rank], strings.digest[rank], strings.local[rank]

        n = len(strings.sizes)
        at = strings.begin + np.arange(n)  # every string is followed by a separator
        text = np.full(len(strings.text) + n, SEPARATOR, np.uint8)
        text[np.arange(len(strings.text)) + np.repeat(np.arange(n), strings.sizes)] = strings.text
        string = np.repeat(np.arange(n), strings.count)
        window = np.arange(len(string)) - np.repeat(np.cumsum(strings.count) - strings.count, strings.count)
        number = np.full(len(text), -1, np.int64)
        number[at[string] + window] = np.arange(len(string))

        order = suffix_order(text, unit.width)
        order = order[number[order] >= 0]
        same = prefix_shared(text, order, unit.width)
        group = np.empty(len(order), np.int64)
        group[number[order]] = np.cumsum(~same) - 1  # by window number

        # The earliest place of a group is the first occurrence of one of its strings.
        head = strings.place[string]
        doc, digest, place = strings.doc[head], strings.digest[head], strings.local[head] + window
        by = np.lexsort((place, digest, doc, group))
        first = np.ones(len(by), bool)
        first[1:] = group[by][1:] != group[by][:-1]
        earliest = np.zeros(len(by), bool)
        earliest[by] = first
        later = ~earliest
        if later.any():
            yield strings.ranges(*spread(later, string, window, unit.width), lambda s: (strings.place[s], np.ones(len(s), np.int64)))
        # Other occurrences of a string repeat the first, window by window.
        many = np.flatnonzero(strings.times > 1)
        if len(many):
            yield strings.ranges(many, np.zeros(len(many), np.int64), strings.count[many] + unit.width - 1, lambda s: (strings.place[s] + 1, strings.times[s] - 1))

    return judge


def remove_repeated_bytes(docs: DataFrame, width: int = BYTES.width, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_bytes``.

    Every byte in a string of ``width`` bytes that also starts earlier (smaller doc_id, or
    the same document further left) is removed; what remains is put together. NULL is the
    empty text; texts shorter than ``width`` lose nothing; a NULL doc_id comes before all
    others. Rows that repeat doc_id and text can't be told apart: each loses what a later
    copy loses. Other columns are ignored; an empty table gives no row.
    """
    unit = Unit(False, width, min(BYTES.gram, width), BYTES.slice_bytes)

    def finish(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for row, n, flat, offsets in slices(batch, limit=unit.slice_bytes):
                gone = covered(batch, row, n, offsets)
                text = flat[~gone]
                kept = np.concatenate([[0], np.cumsum(~gone)])[offsets]
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                inner = offsets[:-1][offsets[:-1] < len(gone)]
                opens[inner] = gone[inner]
                spans = np.concatenate([[0], np.cumsum(opens)])[offsets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row : row + n], mask=ids[row : row + n] == NO_ID), pa.array(np.diff(offsets)), pa.array(np.diff(offsets) - np.diff(kept)), pa.array(np.diff(spans)), binary_column(text, kept)],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes"],
                )

    joined = with_ranges(docs, unit, judge_bytes(unit), id_col, text_col)
    return joined.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary")
