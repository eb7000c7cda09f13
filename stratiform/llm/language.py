"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled text is turned into a suffix automaton,
which follows any string as long as it occurs in the sample. A text is parsed greedily:
the longest match from the current place is one phrase, the next phrase starts where it
ends. A text in the sample's language falls apart into few long phrases, so the language
whose sample needs the fewest phrases, divided by the text's length, wins.

The automata are dense tables (state times symbol) that fall back to the first state at
the end of a phrase, so that many stretches of many texts step through all languages in
one array operation. A phrase never crosses a multiple of ``STRETCH`` characters.

Scale: one pass, no shuffle. The sample bounds (``SAMPLE_DOCS`` texts of each language,
``SAMPLE_CHARS`` characters of each) are parameters; the tables take about 10 MB for each
language and travel as one broadcast variable.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.llm.text import slices
from stratiform.llm.tokens import plain

SAMPLE_DOCS = 64
SAMPLE_CHARS = 300
STRETCH = 2048
SYMBOLS = 64
FOLDS = 5
UNKNOWN = "und"
_OTHER, _RARE = 0, 1


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """True for the fold that is kept from learning; a NULL doc_id is in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(True))


class Alphabet:
    """Symbols of the most frequent letters of the samples, lower-cased. 0 is anything that
    is not a letter, 1 any other letter."""

    def __init__(self, texts: list[str], size: int = SYMBOLS):
        letters = Counter(c for t in texts for c in t.lower() if c.isalpha())
        known = {c: i + 2 for i, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0]))[: size - 2])}
        self.table = np.zeros(0x110000, np.uint8)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                self.table[code] = known.get(c.lower(), _RARE)

    def of(self, text: str) -> np.ndarray:
        return self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that follows every substring."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and s not in step[at]:
            step[at][s] = new
            at = link[at]
        if at >= 0:
            to = step[at][s]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and step[at].get(s) == to:
                    step[at][s] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return step


def parse_table(step: list[dict[int, int]], width: int = SYMBOLS) -> np.ndarray:
    """``table[state * width + symbol]``: twice the next state's row start, plus one when a
    new phrase begins with this symbol. A symbol the sample lacks is a phrase of its own."""
    start = np.ones(width, np.int64)
    for s, to in step[0].items():
        start[s] = 2 * width * to + 1
    table = np.tile(start, (len(step), 1))
    for state, moves in enumerate(step[1:], 1):
        for s, to in moves.items():
            table[state, s] = 2 * width * to
    return table.ravel().astype(np.int32)


class Parser:
    """Phrase counts of texts for all languages at once."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        self.alphabet = Alphabet([t for lang in self.languages for t in samples[lang]])
        tables = []
        for lang in self.languages:
            symbols = [s for t in samples[lang] for s in (*self.alphabet.of(t).tolist(), _OTHER)]
            tables.append(parse_table(suffix_automaton(symbols)))
        self.base = np.cumsum([0, *(len(t) for t in tables)])[:-1].astype(np.int32)
        self.table = np.concatenate([t + 2 * b for t, b in zip(tables, self.base)]) if tables else np.zeros(0, np.int32)

    def phrases(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """``count[text, language]`` of texts that lie one after another in ``symbols``."""
        sizes = np.diff(bounds)
        parts = -(-sizes // STRETCH)
        text = np.repeat(np.arange(len(sizes)), parts)
        begin = bounds[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * STRETCH
        length = np.minimum(STRETCH, bounds[1:][text] - begin)
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        count = np.zeros((len(self.languages), len(order)), np.int32)
        state = np.repeat(self.base[:, None], len(order), axis=1)
        live = len(order)
        stops = np.searchsorted(-length, -np.arange(STRETCH), "left")  # stretches longer than t
        for t in range(int(length[0]) if len(length) else 0):
            if stops[t] != live:
                live = int(stops[t])
            move = self.table.take(state[:, :live] + symbols[begin[:live] + t])
            count[:, :live] += move & 1
            state[:, :live] = move >> 1
        out = np.zeros((len(sizes), len(self.languages)), np.int64)
        np.add.at(out, text[order], count.T)
        return out

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each text has a letter, and its phrases for each character and language."""
        symbols = [self.alphabet.of(t) for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in symbols])])
        flat = np.concatenate(symbols) if symbols else np.zeros(0, np.uint8)
        letters = np.add.reduceat(np.append(flat > 0, False), np.minimum(bounds[:-1], len(flat)), dtype=np.int64) if len(texts) else np.zeros(0, np.int64)
        letters[np.diff(bounds) == 0] = 0
        rate = self.phrases(flat, bounds) / np.maximum(np.diff(bounds), 1)[:, None]
        return letters > 0, rate


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, sample_docs: int, sample_chars: int) -> dict[str, list[str]]:
    """At most ``sample_docs`` texts of each language, ``sample_chars`` characters from the
    middle of each, chosen by the checksum of doc_id; short texts as a whole."""
    text = F.col(text_col).cast("string")
    usable = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text")).filter(
        F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), folds) & F.col("text").rlike(r"\p{L}")
    )
    size = F.char_length("text")
    middle = F.substring(F.col("text"), F.greatest(F.lit(1), F.expr(f"cast((char_length(text) - {sample_chars}) div 2 as int) + 1")), F.lit(sample_chars))
    picked = usable.select("lang", F.md5(F.col("doc_id").cast("string")).alias("place"), size.alias("size"), middle.alias("part"))
    best = W.partitionBy("lang").orderBy("place", "size", "part")
    rows = picked.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= sample_docs).select("lang", "nth", "part").collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.nth)):
        out.setdefault(r.lang, []).append(r.part)
    return out


def _predictions(parser: Parser, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(language, score, phrases for each character)`` of texts; NULL is the empty text."""
    n = len(texts)
    known, rate = parser.predict([t or "" for t in texts.to_pylist()])
    if not parser.languages:
        return np.full(n, UNKNOWN, dtype=object), np.zeros(n), np.zeros(n)
    best = rate.argmin(axis=1)
    power = np.maximum(rate, 1e-9) ** -8.0
    share, least = power[np.arange(n), best] / power.sum(axis=1), rate[np.arange(n), best]
    names = np.array([*parser.languages, UNKNOWN], dtype=object)
    return names[np.where(known, best, len(parser.languages))], np.where(known, share, 0.0), np.where(known, least, 0.0)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = FOLDS,
    sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score, phrases``.

    ``phrases`` are phrases for each character in the winning language. ``score`` is that
    language's share when each language weighs by the inverse of its rate to the eighth
    power. Texts that are NULL or have no letter are ``und`` with score 0, and so is every
    text when nothing was labelled. Ties go to the first language in order. Only rows
    outside the held-out fold teach; their label is read from no scored row.
    """
    samples = labelled_sample(docs, id_col, text_col, lang_col, folds, sample_docs, sample_chars)
    shared = docs.sparkSession.sparkContext.broadcast(Parser(samples))

    def score(batches):
        parser = shared.value
        for batch in batches:
            for row, n, _, _ in slices(batch, limit=1 << 21):
                lang, share, least = _predictions(parser, batch.column("text").slice(row, n))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, n), pa.array(lang, pa.string()), pa.array(share), pa.array(least)], names=["doc_id", "lang_pred", "score", "phrases"])

    scored = plain(docs, id_col, text_col).mapInArrow(score, "doc_id long, lang_pred string, score double, phrases double")
    return scored.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "lang_pred", "score", "phrases")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents with a language, in all columns: rows whose text is NULL or without a
    letter go, and all of them when nothing was labelled. Rows are judged where they are
    read, so nothing is shuffled."""
    samples = labelled_sample(docs, "doc_id", "text", "lang", FOLDS, SAMPLE_DOCS, SAMPLE_CHARS)
    shared = docs.sparkSession.sparkContext.broadcast(Parser(samples))

    def keep(batches):
        parser = shared.value
        for batch in batches:
            for row, n, _, _ in slices(batch, limit=1 << 21):
                part = batch.slice(row, n)
                predicted = _predictions(parser, part.column("text"))[0]
                yield part.filter(pa.array([lang != UNKNOWN for lang in predicted]))

    return docs.mapInArrow(keep, docs.schema)
