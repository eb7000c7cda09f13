"""Token ids of whole texts by a public tokenizer file, fast for repeated words.

The tokenizer cuts a text into pieces before it merges, so a text's ids are those of its
pieces one after another. A text of plain letters, digits, signs and blanks is cut by
the file's own pattern; its pieces are looked up in a bounded cache per worker, and new
ones are handed to the file's merge model. Other texts are cut at blanks, and each word
goes through the tokenizer whole; a text with rare separators does so as one word.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.text import gather, slices

CACHE_PIECES = 400_000

# The tokenizer file's pattern, written for lower-case ASCII and Latin letters.
_LETTERS = "a-zß-öø-ÿ"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ \\t\\n\\r\\x0b\\x0c{_LETTERS}0-9]+")
_PLAIN = re.compile("[ \\t\\n\\r\\x0b\\x0c!-~À-ÖØ-öø-ÿ]*")
_RARE_BLANKS = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


class _Index(dict):
    """Piece (or, as a tuple, word) to its place in the pool of ids; encoded on first sight."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.pool, self.ends = encode, array("I"), array("q", [0])

    def __missing__(self, key) -> int:
        self.pool.extend(self.encode(key))
        self.ends.append(len(self.pool))
        self[key] = place = len(self.ends) - 2
        return place


class WordTokenizer:
    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cache_pieces = cache_pieces
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        latin = [chr(c) for c in range(0xC0, 0x100)]
        self.bytes_of = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in latin})
        self.index = _Index(self._ids)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")

    def _ids(self, key) -> list[int]:
        if isinstance(key, tuple):
            return [key[0]] if isinstance(key[0], int) else self.tokenizer.encode(key[0], add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize(key if key.isascii() else key.translate(self.bytes_of))]

    def encode(self, texts: list[str], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (each followed by ``end_id``), and their offsets."""
        if len(self.index) > self.cache_pieces:
            self.index = _Index(self._ids)
        index = self.index
        tail = [] if end_id is None else [index[(end_id,)]]
        places: list[int] = []
        counts = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if _PLAIN.fullmatch(text) and "<|" not in text:
                keys = _PIECES.findall(text.lower())
            else:
                keys = [(w,) for w in ([text] if _RARE_BLANKS.search(text) else text.split())]
            places += map(index.__getitem__, keys)
            places += tail
            counts[i + 1] = len(places)
        at = np.array(places, np.int64)
        ends = np.array(index.ends, np.int64)
        ids, bounds = gather(np.array(index.pool, self.dtype), ends[at], ends[at + 1] - ends[at])
        return ids, bounds[counts]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process and file."""
    return WordTokenizer(path)


def plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)``, whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _text(F.col(text_col)).alias("text"))


def _text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def encoded(batches, path: str, end_id: int | None) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``(doc_ids, ids, offsets)`` of consecutive rows of the batches."""
    tool = tokenizer(path)
    for batch in batches:
        for row, n, _, _ in slices(batch):
            ids, offsets = tool.encode(batch.column("text").slice(row, n).to_pylist(), end_id)
            yield batch.column("doc_id").slice(row, n), ids, offsets
