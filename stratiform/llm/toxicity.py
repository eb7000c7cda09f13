"""Toxicity by a linear-chain conditional random field over words.

Learning. Labels exist for whole documents only, so token labels are distilled first: a
word or word beginning is an offence when the number of toxic texts that bring it in a
context (preceding word) of their own is far above what its count in clean texts would
allow by chance. Own contexts, because copies of one toxic text repeat all its words in
the same context. Tokens with an offence are labelled 1 in toxic texts, all
others 0, and a two-state chain (one weight for each feature, one for each transition) is
fitted to windows of labelled tokens by gradient ascent on the conditional likelihood.

Scoring. The words of every whole text are one chain; forward and backward passes give each
word's marginal probability of being toxic. Runs of words at
or above one half are the offending spans. The document's score is the chance that at least
one word is toxic, from the marginals that reach ``FLOOR``; below it, the largest marginal.

Scale: learning reads at most ``SAMPLE`` labelled texts, chosen by the checksum of
doc_id, and ships candidate features and windows of them, both bounded by that sample.
Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.language import FOLDS, held_out
from stratiform.llm.text import slices
from stratiform.llm.tokens import plain

SAMPLE = 20_000
WINDOW = 16
WINDOWS_PER_TEXT = 4
CHAIN = 256
FLOOR = 0.25
EVIDENCE = 12.0
PRECISION = 0.9
ROUNDS = 150
CACHE_WORDS = 500_000

_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """The lower-cased word and its beginnings of three to five letters."""
    w = word.lower()
    return ["=" + w, *(w[:n] for n in (3, 4, 5) if len(w) >= n)]


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, folds: int, sample: int) -> DataFrame:
    """``(toxic, text)`` of at most ``sample`` labelled texts outside the held-out fold. The
    choice is made on ids alone: those whose checksum lies below a bound that the number of
    labels sets, so no ids travel to the driver."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("id is not null and toxic is not null")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out(F.col("id"), folds))
    )
    place = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("long")
    total = known.count()
    known = known.filter(place < int(2**32 * min(1.0, sample / max(total, 1)))) if total > sample else known
    texts = plain(docs, id_col, text_col)
    return texts.join(known, texts["doc_id"] == known["id"]).select("toxic", "text")


def _contexts(batches):
    """Features of toxic texts with their contexts, each pair once for each text."""
    for batch in batches:
        for place, text in zip(batch.column("place").to_pylist(), batch.column("text").to_pylist()):
            words = _WORD.findall(text)
            pairs = list({(f, before) for before, word in zip(chain([""], words), words) for f in features(word)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string()), pa.array([place] * len(pairs), pa.int64())],
                names=["feature", "before", "place"],
            )


def offences(sampled: DataFrame, evidence: float = EVIDENCE, precision: float = PRECISION) -> set[str]:
    """Features whose counts speak for toxic texts with ``evidence`` (natural logarithm of
    the likelihood ratio against the share of toxic texts) and ``precision``."""
    toxic, clean = (sampled.filter(c).select("text", F.xxhash64("text").alias("place")).dropDuplicates(["place"]) for c in ("toxic > 0", "toxic <= 0"))
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return set()
    seen = toxic.mapInArrow(_contexts, "feature string, before string, place long")
    by_context = seen.groupBy("feature", "before").agg(F.min("place").alias("place")).groupBy("feature").agg(F.count(F.lit(1)).alias("contexts"), F.count_distinct("place").alias("texts"))
    counts = by_context.select("feature", F.least("contexts", "texts").alias("t")).filter("t >= 3")
    candidates = {r.feature: r.t for r in counts.collect()}
    shared = sampled.sparkSession.sparkContext.broadcast(frozenset(candidates))

    def occurrences(batches):
        found: Counter[str] = Counter()
        wanted = shared.value
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update({f for w in set(_WORD.findall(text)) for f in features(w)} & wanted)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["feature", "c"])

    in_clean = clean.mapInArrow(occurrences, "feature string, c long").groupBy("feature").agg(F.sum("c").alias("c"))
    against = {r.feature: r.c for r in in_clean.collect()}
    prior = n_toxic / (n_toxic + n_clean)
    out = set()
    for feature, t in candidates.items():
        c = against.get(feature, 0)
        ratio = t * np.log(t / ((t + c) * prior)) + (c * np.log(c / ((t + c) * (1 - prior))) if c else 0)
        if ratio >= evidence and t / (t + c) >= precision:
            out.add(feature)
    return out


def labelled_windows(sampled: DataFrame, found: set[str]) -> list[tuple[list[str], list[int]]]:
    """Windows of words with their labels: around offences in toxic texts; in the others
    around words that begin like an offence, else from the middle."""
    alike = found | {f for o in found for f in features(o.lstrip("="))}

    def cut(batches):
        for batch in batches:
            words_out, labels_out = [], []
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                words = _WORD.findall(text)
                labels = [int(toxic > 0 and not found.isdisjoint(features(w))) for w in words]
                hits = [i for i, y in enumerate(labels) if y]
                if toxic > 0 and not hits:
                    continue
                hits = hits or [i for i, w in enumerate(words) if not alike.isdisjoint(features(w))] or [len(words) // 2] * bool(words)
                spots = hits[:: max(1, len(hits) // WINDOWS_PER_TEXT)][:WINDOWS_PER_TEXT]
                for spot in spots:
                    low = max(0, spot - WINDOW // 2)
                    words_out.append(words[low : low + WINDOW])
                    labels_out.append(labels[low : low + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(words_out, pa.list_(pa.string())), pa.array(labels_out, pa.list_(pa.int32()))], names=["words", "labels"])

    return [(r.words, r.labels) for r in sampled.mapInArrow(cut, "words array<string>, labels array<int>").collect()]


def odds(gain: np.ndarray, size: np.ndarray, moves: np.ndarray, start: float | np.ndarray, end: float | np.ndarray = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of state 1 against state 0, along axis 0, many chains of
    ``size`` words at a time. ``gain`` are the emission odds, ``moves[i, j]`` the weight of
    going from i to j, ``start`` the odds before the first word's emission, ``end`` those
    that come back to the last word."""
    forward, backward = np.empty_like(gain), np.empty_like(gain)
    backward[-1] = end
    r = start * gain[0]
    forward[0] = r
    for t in range(1, len(gain)):
        r = gain[t] * (moves[0, 1] + r * moves[1, 1]) / (moves[0, 0] + r * moves[1, 0])
        forward[t] = r
    for t in range(len(gain) - 2, -1, -1):
        x = gain[t + 1] * backward[t + 1]
        backward[t] = np.where(t + 1 < size, (moves[1, 0] + moves[1, 1] * x) / (moves[0, 0] + moves[0, 1] * x), end)
    return forward, backward


class Field:
    """The fitted chain: weights of features, bias, transition weights."""

    def __init__(self, weights: dict[str, float], bias: float, moves: np.ndarray, start: float):
        self.weights, self.bias, self.moves, self.start = weights, bias, moves, start
        self.cache: dict[str, float] = _Emission(self)

    def __reduce__(self):
        return Field, (self.weights, self.bias, self.moves, self.start)

    def gains(self, words: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE_WORDS:
            self.cache = _Emission(self)
        return np.array(list(map(self.cache.__getitem__, words)), np.float64)

    def entries(self, grid: np.ndarray, sizes: np.ndarray, nth: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each stretch receives from the one before it in its text (forward odds of that
        one's last word) and from the one after it (odds its first word sends back). Passing
        a stretch turns odds ``r`` into ``(a r + b) / (c r + d)``; these maps are formed for all
        stretches at once and then applied along each text. ``parts`` is by stretch."""
        (m00, m01), (m10, m11) = self.moves
        before, after = np.ones(len(nth)), np.ones(len(nth))
        many = np.flatnonzero(parts > 1)
        if not len(many):
            return before, after
        g, n = grid[:, many], nth[many]
        head, last = n == 0, n == parts[many] - 1
        size = sizes[many]

        def step(state, g, high, low, fixed, value):
            num = g * (m11 * state[0] + high * state[1])
            den = low * state[0] + m00 * state[1]
            num[:, fixed], den[:, fixed] = value[fixed], 1.0
            return np.stack([num, den]) / (num + den).max(axis=0)

        none = np.zeros(len(many), bool)
        start = np.zeros((2, 2, len(many)))
        start[0, 0] = start[1, 1] = 1.0
        ahead, back = start, start
        for t in range(CHAIN):
            ahead = step(ahead, g[t], m01, m10, head if t == 0 else none, self.start * g[t])
        for t in range(CHAIN - 1, -1, -1):
            back = step(back, g[t], m10, m01, last & (t >= size - 1), g[t])

        order = np.argsort(n, kind="stable")
        edges = np.searchsorted(n[order], np.arange(n.max() + 2))
        e, x = np.ones(len(many)), np.ones(len(many))
        for k in range(1, n.max() + 1):
            at = order[edges[k] : edges[k + 1]]
            p = ahead[:, :, at - 1]
            e[at] = (p[0, 0] * e[at - 1] + p[0, 1]) / (p[1, 0] * e[at - 1] + p[1, 1])
        for k in range(n.max(), 0, -1):
            at = order[edges[k] : edges[k + 1]]
            p = back[:, :, at]
            x[at - 1] = (p[0, 0] * x[at] + p[0, 1]) / (p[1, 0] * x[at] + p[1, 1])
        before[many], after[many] = e, x
        return before, after

    def marginals(self, gains: np.ndarray, counts: np.ndarray, whole: bool = False) -> np.ndarray:
        """Of the words of many texts, one after another, in stretches of ``CHAIN`` words: each a
        chain of its own, or with ``whole`` handing on its odds, so that each text is one chain."""
        (m00, m01), (m10, m11) = self.moves
        parts = -(-counts // CHAIN)
        text = np.repeat(np.arange(len(counts)), parts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = (np.cumsum(counts) - counts)[text] + nth * CHAIN
        size = np.minimum(CHAIN, counts[text] - nth * CHAIN)
        chain_of = np.repeat(np.arange(len(size)), size)
        spot = np.arange(len(gains)) - begin[chain_of]
        grid = np.ones((CHAIN, len(size)))
        grid[spot, chain_of] = gains
        opens, closes = self.start, 1.0
        if whole:
            before, after = self.entries(grid, size, nth, parts[text])
            opens = np.where(nth == 0, self.start, (m01 + before * m11) / (m00 + before * m10))
            closes = np.where(nth == parts[text] - 1, 1.0, (m10 + m11 * after) / (m00 + m01 * after))
        forward, backward = odds(grid, size, self.moves, opens, closes)
        x = (forward * backward)[spot, chain_of]
        return x / (1 + x)


class _Emission(dict):
    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word: str) -> float:
        total = self.field.bias + sum(self.field.weights.get(f, 0.0) for f in features(word))
        self[word] = out = float(np.exp(min(30.0, max(-30.0, total))))
        return out


def fit(windows: list[tuple[list[str], list[int]]], rounds: int = ROUNDS, decay: float = 1e-4) -> Field:
    """Gradient ascent (with each weight's own step size) on the conditional likelihood."""
    names = Counter(f for words, _ in windows for w in words for f in features(w))
    index = {f: i + 1 for i, f in enumerate(sorted(f for f, n in names.items() if n >= 2))}
    wide = max((len(w) for w, _ in windows), default=1)
    slots = np.zeros((wide, len(windows), 4), np.int64)
    truth = np.zeros((wide, len(windows)))
    real = np.zeros((wide, len(windows)), bool)
    for c, (words, labels) in enumerate(windows):
        for t, w in enumerate(words):
            for k, f in enumerate(features(w)):
                slots[t, c, k] = index.get(f, 0)
        truth[: len(words), c], real[: len(words), c] = labels, True
    weights, moves, ends = np.zeros(len(index) + 1), np.zeros((2, 2)), np.array([-2.0, -2.0])  # ends: bias, start
    pace = defaultdict(float)
    size, both = real.sum(axis=0), real[1:] & real[:-1]
    seen = np.array([[((1 - truth[:-1]) * (1 - truth[1:]) * both).sum(), ((1 - truth[:-1]) * truth[1:] * both).sum()], [(truth[:-1] * (1 - truth[1:]) * both).sum(), (truth[:-1] * truth[1:] * both).sum()]])
    total = max(1.0, real.sum())

    def climb(name, value, slope):
        pace[name] = pace[name] + slope**2
        return value + 0.5 * slope / (np.sqrt(pace[name]) + 1e-9)

    for _ in range(rounds):
        gain = np.exp(np.clip(weights[slots].sum(axis=2) + ends[0], -30, 30))
        step = np.exp(moves)
        forward, backward = odds(gain, size, step, np.exp(ends[1]))
        p = forward * backward / (1 + forward * backward)
        x = gain[1:] * backward[1:]
        joint = np.stack([np.full_like(x, step[0, 0]), step[0, 1] * x, step[1, 0] * forward[:-1], step[1, 1] * forward[:-1] * x])
        joint = joint / joint.sum(axis=0) * both
        error = np.where(real, truth - p, 0.0)
        slope = np.bincount(slots.ravel(), np.repeat(error.ravel(), 4), minlength=len(weights)) - decay * total * 0.01 * weights
        slope[0] = 0.0
        weights = climb("weights", weights, slope)
        moves = climb("moves", moves, seen - joint.sum(axis=(1, 2)).reshape(2, 2))
        ends = climb("ends", ends, np.array([error.sum(), error[0].sum()]))
    return Field({f: float(weights[i]) for f, i in index.items()}, float(ends[0]), np.exp(moves), float(np.exp(ends[1])))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, sample: int = SAMPLE) -> Field:
    sampled = _sampled(docs, labels, id_col, text_col, folds, sample)
    found = offences(sampled)
    windows = labelled_windows(sampled, found) if found else []
    if not any(any(y) for _, y in windows):
        return Field({}, -10.0, np.ones((2, 2)), 1.0)
    return fit(windows)


def _spans(text: str, hot: np.ndarray) -> list[dict]:
    """Character ranges of the runs of toxic words."""
    out = []
    for i, m in enumerate(_WORD.finditer(text)):
        if hot[i]:
            if i and hot[i - 1]:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
    return out


def score_documents(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted, spans``.

    ``spans`` are the character ranges of offending words. NULL, empty and wordless texts
    score 0; without any offence learned every score is next to 0. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def score(batches):
        model = shared.value
        for batch in batches:
            for row, n, _, _ in slices(batch, limit=1 << 20):
                texts = batch.column("text").slice(row, n).to_pylist()
                words = [_WORD.findall(t) for t in texts]
                counts = np.array([len(w) for w in words], np.int64)
                p = model.marginals(model.gains(list(chain.from_iterable(words))), counts, whole=True)
                ends = np.cumsum(counts)
                begin = ends - counts
                none = np.log1p(-np.minimum(np.where(p >= FLOOR, p, 0.0), 1 - 1e-12))
                sums = np.concatenate([[0.0], np.cumsum(none)])
                result = -np.expm1(sums[ends] - sums[begin])
                full = np.flatnonzero(counts)
                if len(full):
                    most = np.maximum.reduceat(p, begin[full])
                    result[full] = np.where(most >= FLOOR, np.maximum(result[full], most), most)
                hot = p >= 0.5
                hits = np.concatenate([[0], np.cumsum(hot)])
                spans = [_spans(t, hot[a:b]) if hits[b] > hits[a] else [] for t, a, b in zip(texts, begin, ends)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, n), pa.array(np.clip(result, 0.0, 1.0)), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    scored = plain(docs, id_col, text_col).mapInArrow(score, "doc_id long, score double, spans array<struct<start:int,end:int>>")
    return scored.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, sample: int = SAMPLE) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, then score every row."""
    return score_documents(docs, learn(docs, labels, id_col, text_col, folds, sample), id_col, text_col, folds)
