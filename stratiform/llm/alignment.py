"""Two tokenizers' tokens of the same text, matched byte range by byte range.

Every token points to the farthest-right token of the other tokenizer that overlaps it; a
pair that ends at the same byte points to itself. Following the pointers by doubling
(``succ = succ[succ]``) leaves every token at the last token of its component, which names
its group. The arrays hold the tokens of many stretches of text at once.

A text is cut into units at blanks and line ends where neither tokenizer can join across, so
a unit's tokens, groups and links are the same in every text: each unit is tokenized and
aligned when a worker first meets it, and a bounded number of frequent ones are kept. Whether such cuts are allowed is read
from the tokenizer files; where they are not, and in texts with rare blanks, the whole text
is one unit.

How many documents hold a pair of ids linked is counted over the whole table: texts are read
in blocks, every block counts its own documents, the counts of a pair are added up, and each
block gets the totals of the pairs it holds back. Shuffled are one row per block and pair
and, once, each document's pairs as packed numbers; nothing is broadcast.

Defined results: NULL and empty texts, and texts whose joined token bytes differ from a blank
and the text, have no tokens (all numbers 0, ``groups`` empty) and count in no pair. Rows that
repeat a doc_id are documents of their own; a NULL doc_id is kept. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratiform.functions.skew import salted_join
from stratiform.llm.text import binary_column, gather, slices
from stratiform.llm.tokens import plain
from stratiform.session import cut_lineage

BLOCK_BYTES = 4 << 20
CHUNK_CHARS = 1 << 20
CACHE_UNITS = 200_000
CACHE_CHARS = 8 << 20

_CUTS = re.compile(r"(?<=\S)(?=[ \n])")
# Blanks on which the two tokenizers and Python's \s may disagree.
_RARE_BLANKS = re.compile("[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_BLANK_BYTE = "▁"


class Vocabulary:
    """Ids and bytes of the tokens of both files."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The letter that stands for each byte, from the tokenizer's own code; bytes no UTF-8 text holds stay out.
        byte_of = {}
        for c in chain(range(0x250), range(0x250, 0x110000, 0x40)):
            if not 0xD800 <= c < 0xE000:
                byte_of.update(zip(level.pre_tokenize_str(chr(c))[0][0], chr(c).encode()))
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else b"\xff"
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace(_BLANK_BYTE, " ").encode() for p in pieces]
        self.b_blank = next((i for i, p in enumerate(pieces) if p == _BLANK_BYTE), None)
        self.cuts = self._cuts(json.loads(self.a.to_str()), pieces)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)

    def _cuts(self, file: dict, pieces: list[str]) -> bool:
        """Whether both tokenizers cut before a blank or line end that follows another sign: A by
        its pattern, B because no piece spans it and nothing rewrites the text first."""
        cutter = file.get("pre_tokenizer") or {}
        by_pattern = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and file.get("normalizer") is None
        spans = any(re.search(f"[^{_BLANK_BYTE}]{_BLANK_BYTE}|[ \\n]", p) for p in pieces)
        probe = "a  b\nc  \n d "
        return bool(by_pattern and not spans and self.b_blank is not None and b"".join(self.b_bytes[i] for i in self.b.encode(probe)) == (" " + probe).encode())

    def units(self, text: str) -> list[str]:
        """A blank and the text, as stretches that are tokenized alone."""
        full = " " + text
        if not self.cuts or _RARE_BLANKS.search(full):
            return [full]
        return _CUTS.split(full)

    def ids(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch(units, add_special_tokens=False)]
        # B sets a blank before what it gets: a unit's own first blank is left to it, and before a line end it is taken off again.
        b = [[self.b_blank] if u == " " else ids if u[0] == " " else ids[1:] for u, ids in zip(units, self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1))]
        return a, b


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For tokens that cover the same bytes and end at ``a_ends`` and ``b_ends``: the last token
    of each one's component, as its place in ``a_ends``. A's tokens come first, then B's."""
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends - 1, "right")  # the token of B over A's last byte, the farthest right
    over_b = np.searchsorted(a_ends, b_ends - 1, "right")
    succ = np.concatenate([np.where(b_ends[over_a] == a_ends, np.arange(n), n + over_a), over_b])
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            return succ
        succ = further


class Aligner:
    """Units with their tokens, groups and links; aligned on first sight, many at a time."""

    def __init__(self, a_path: str, b_path: str):
        self.words = Vocabulary(a_path, b_path)
        written = [b"%d," % i for i in range(max(len(self.words.a_bytes), len(self.words.b_bytes)))]
        self.digit_pool = np.frombuffer(b"".join(written), np.uint8)
        self.digits = np.cumsum([0, *map(len, written)])
        self.place: dict[str, int] = {}
        self.texts: list[str] = []
        self.odd: set[int] = set()
        self.chars = 0
        self.met = np.zeros(0, np.int64)  # how often each unit was met
        self.numbers = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.codes, self.times, self.bounds = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def forget(self) -> None:
        """Keep the units met most often, at most half of what the cache holds."""
        names = list(self.place)
        order = np.argsort(-self.met, kind="stable")
        sizes = np.cumsum([len(names[i]) for i in order])
        often = self.met[order] > 1
        kept = np.sort(order[often & (np.arange(len(order)) < CACHE_UNITS // 2) & (sizes < CACHE_CHARS // 2)])
        at = kept.tolist()
        self.place = {names[i]: k for k, i in enumerate(at)}
        self.texts = [self.texts[i] for i in at]
        self.odd = {k for k, i in enumerate(at) if i in self.odd}
        self.chars = sum(map(len, self.place))
        width = self.bounds[kept + 1] - self.bounds[kept]
        index, bounds = gather(np.arange(len(self.codes)), self.bounds[kept], width)
        self.codes, self.times, self.bounds = self.codes[index], self.times[index], bounds
        self.met, self.numbers = self.met[kept] // 2, self.numbers[kept]

    def learn(self, units: list[str]) -> None:
        """Align ``units``, all new. One whose bytes a tokenizer does not keep has no tokens here."""
        a_ids, b_ids = self.words.ids(units)
        kept = self._kept(units, a_ids, b_ids)
        if not kept.all():
            a_ids, b_ids = [x if k else [] for x, k in zip(a_ids, kept)], [x if k else [] for x, k in zip(b_ids, kept)]
        a_count, b_count = np.array(list(map(len, a_ids))), np.array(list(map(len, b_ids)))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((a_ids, a_count), (b_ids, b_count)))
        a_unit, b_unit = np.repeat(np.arange(len(units)), a_count), np.repeat(np.arange(len(units)), b_count)
        a_ends, b_ends = np.cumsum(self.words.a_size[a]), np.cumsum(self.words.b_size[b])
        last = terminals(a_ends, b_ends) if len(a) else np.zeros(0, np.int64)
        _, group = np.unique(last, return_inverse=True)

        first = np.searchsorted(b_ends, a_ends - self.words.a_size[a], "right")
        count = np.searchsorted(b_ends, a_ends - 1, "right") - first + 1
        linked, _ = gather(b, first, count)
        codes, link_unit = np.repeat(a, count) * len(self.words.b_bytes) + linked, np.repeat(a_unit, count)
        n_groups = np.bincount(a_unit[np.flatnonzero(np.diff(group[: len(a)], prepend=-1))], minlength=len(units))
        numbers = np.stack([a_count, b_count, n_groups, np.bincount(link_unit, minlength=len(units))], 1)

        order = np.lexsort((codes, link_unit))
        codes, link_unit = codes[order], link_unit[order]
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (link_unit[1:] != link_unit[:-1])
        at = np.flatnonzero(new)
        times = np.diff(at, append=len(codes))
        bounds = np.searchsorted(link_unit[at], np.arange(len(units)), "right")

        self.met = np.append(self.met, np.zeros(len(units), np.int64))
        self.texts += self._written(a, b, group, a_count + b_count)
        self.odd.update((len(self.place) + np.flatnonzero(~kept)).tolist())
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units))))
        self.chars += sum(map(len, units))
        self.numbers = np.concatenate([self.numbers, numbers])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds])
        self.codes, self.times = np.concatenate([self.codes, codes[at]]), np.concatenate([self.times, times])

    def _kept(self, units: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> np.ndarray:
        """Whether the bytes of A's and of B's tokens are those of the unit."""
        raw = [u.encode() for u in units]
        kept = np.ones(len(units), bool)
        for ids, of in ((a_ids, self.words.a_bytes), (b_ids, self.words.b_bytes)):
            kept &= np.fromiter((b"".join(map(of.__getitem__, x)) == r for x, r in zip(ids, raw)), bool, len(units))
        return kept

    def _written(self, a: np.ndarray, b: np.ndarray, group: np.ndarray, counts: np.ndarray) -> list[str]:
        """Each unit's groups as ``a1,a2|b1;a3|b2,b3``."""
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(group * 2 + side, kind="stable")
        group, side = group[order], side[order]
        ids = np.concatenate([a, b])[order]
        size = self.digits[ids + 1] - self.digits[ids]
        flat, offsets = gather(self.digit_pool, self.digits[ids], size)
        closes = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True)[: len(ids)]
        flat[offsets[1:] - 1] = np.where(closes, np.where(side, ord(";"), ord("|")), ord(","))
        text = flat.tobytes().decode("ascii")
        ends = offsets[np.cumsum(counts)].tolist()
        return [text[i : max(i, j - 1)] for i, j in zip([0, *ends], ends)]

    def see(self, texts: list[str]) -> list[np.ndarray]:
        """Places of each text's units; none for a text without tokens."""
        units = [self.words.units(t) if t else [] for t in texts]
        self._learn_new(units)
        flat = np.fromiter(map(self.place.__getitem__, chain.from_iterable(units)), np.int64, sum(map(len, units)))
        self.met += np.bincount(flat, minlength=len(self.met))
        out = np.split(flat, np.cumsum(list(map(len, units)))[:-1])
        # A text with a unit that loses bytes is judged whole, as its tokens may still join to the same bytes.
        if self.odd:
            bad = [i for i, places in enumerate(out) if not self.odd.isdisjoint(places.tolist())]
            whole = [[" " + texts[i]] for i in bad]
            self._learn_new(whole)
            for i, (unit,) in zip(bad, whole):
                place = self.place[unit]
                out[i] = np.array([] if place in self.odd else [place], np.int64)
        return out

    def _learn_new(self, units: list[list[str]]) -> None:
        new = [u for u in dict.fromkeys(chain.from_iterable(units)) if u not in self.place]
        if new:
            self.learn(new)

    def block(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text its numbers and groups; the block's pairs and the documents that hold each;
        and, text after text, which pairs it holds (places in the block's), how often, and offsets."""
        if len(self.place) > CACHE_UNITS or self.chars > CACHE_CHARS:
            self.forget()
        seen, n, at = [], len(texts), 0
        ends = np.cumsum(list(map(len, texts)))
        while at < n:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_CHARS, "right")))
            seen += self.see(texts[at:to])
            at = to
        sizes, places = list(map(len, seen)), np.concatenate([np.zeros(0, np.int64), *seen])
        groups = [";".join(map(self.texts.__getitem__, s.tolist())) for s in seen]
        doc = np.repeat(np.arange(n), sizes)
        numbers = np.zeros((n, 4), np.int64)
        for k in range(4):
            numbers[:, k] = np.bincount(doc, self.numbers[places, k], n)
        key, often = np.unique(doc << 32 | places, return_counts=True)
        doc, place = key >> 32, key & 0xFFFFFFFF
        width = self.bounds[place + 1] - self.bounds[place]
        index, _ = gather(np.arange(len(self.codes)), self.bounds[place], width)
        pairs, local = np.unique(self.codes[index], return_inverse=True)
        key = np.repeat(doc, width) << 32 | local
        order = np.argsort(key, kind="stable")
        key, times = key[order], (np.repeat(often, width) * self.times[index])[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(times, at) if len(at) else times
        doc, local = key[at] >> 32, key[at] & 0xFFFFFFFF
        return numbers, groups, pairs, np.bincount(local, minlength=len(pairs)), local, times, np.searchsorted(doc, np.arange(n + 1))


@lru_cache(maxsize=2)
def _aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per worker process and pair of files."""
    return Aligner(a_path, b_path)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document; a block's first row also holds the block's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, block = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for row, n, _, _ in slices(batch, limit=BLOCK_BYTES):
                numbers, groups, pairs, held, local, times, bounds = tool.block(pc.fill_null(batch.column("text").slice(row, n), "").to_pylist())
                first = [None] * (n - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, block), pa.int64()),
                        batch.column("doc_id").slice(row, n),
                        *(pa.array(numbers[:, k]) for k in range(4)),
                        pa.array(groups, pa.string()),
                        *(binary_column(x.astype("<i4").view(np.uint8), bounds * 4) for x in (local, times)),
                        pa.array([pairs, *first], pa.list_(pa.int64())),
                        pa.array([held, *first], pa.list_(pa.int64())),
                    ],
                    names=["block", "doc_id", *NUMBERS, "groups", "places", "times", "pairs", "held"],
                )
                block += 1

    return docs.mapInArrow(run, f"block long, doc_id long, {', '.join(f'{c} long' for c in NUMBERS)}, groups string, places binary, times binary, pairs array<long>, held array<long>")


def _sums(key, rows: pa.Table, totals: pa.Table) -> pa.Table:
    """Each document's best links and summed counts, from the totals of its block's pairs."""
    order = np.argsort(totals["pair"].to_numpy())
    n, best = totals["n"].to_numpy()[order], totals["best"].to_numpy(zero_copy_only=False)[order]
    out = np.zeros((2, rows.num_rows), np.int64)
    for i, (places, times) in enumerate(zip(rows["places"], rows["times"])):
        at, often = np.frombuffer(places.as_buffer(), "<i4"), np.frombuffer(times.as_buffer(), "<i4").astype(np.int64)
        out[:, i] = (often * best[at]).sum(), (often * n[at]).sum()
    return rows.drop_columns(["block", "places", "times"]).append_column("n_best", pa.array(out[0])).append_column("count_sum", pa.array(out[1]))


def align_tokens(docs: DataFrame, a_path: str, b_path: str, groups: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: tokens of A and of B (``n_a``, ``n_b``), groups, links, the links whose pair
    is the most frequent of its A id (``n_best``), the counts of all links added up
    (``count_sum``), and ``groups``, the ids as ``a1,a2|b1;a3|b2,b3``. ``groups`` as an
    argument is what to keep of that column, such as its checksum.

    The files are read on the executors: a byte-level BPE file (A) and a sentencepiece model (B).
    """
    kept = groups if groups is not None else F.col("groups")
    rows = cut_lineage(_blocks(plain(docs, id_col, text_col), a_path, b_path).withColumn("groups", kept.cast("string")))
    held = rows.filter(F.col("pairs").isNotNull()).select("block", F.explode(F.arrays_zip("pairs", "held")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    of_a = F.expr(f"pair div {_b_size(b_path)}")
    totals = held.groupBy("pair").agg(F.sum("held").alias("n")).withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(of_a)))
    known = salted_join(held.select("block", "pair"), totals, ["pair"], F.col("block")).select(F.col("block").alias("of_block"), "pair", "n", "best")
    fields = ", ".join(["doc_id long", *(f"{c} long" for c in NUMBERS), "groups string", "n_best long", "count_sum long"])
    return rows.select("block", "doc_id", *NUMBERS, "groups", "places", "times").groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_sums, fields)


def _b_size(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()
