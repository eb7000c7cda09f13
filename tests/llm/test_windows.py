"""Repeated windows against brute force: words (op4) and bytes (op7)."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry_points
from stratiform.llm import suffixes, superkmers

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, digest string, anchors int"


def brute_words(rows, width):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((doc, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def brute_bytes(rows, width):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        raw = (rows[i][1] or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - width + 1):
            piece = raw[k : k + width]
            if piece in seen:
                gone[k : k + width] = [True] * width
            seen.add(piece)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((rows[i][0], len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def invented(seed, n):
    """Texts that share passages, with copies, tiny and empty ones, NULLs and odd blanks."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 3)))
    shared = [" ".join(word() for _ in range(r.randint(3, 30))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 5)):
            parts.append(r.choice(shared) if r.random() < 0.4 else " ".join(word() for _ in range(r.randint(1, 25))))
        rows.append((i * 3, r.choice([" ", "\n", "\t  "]).join(parts)))
    rows += [(1, None), (2, ""), (4, " \t "), (None, rows[3][1]), (5, rows[7][1]), (7, rows[7][1]), (8, "a" * 400), (10, "ab" * 150), (11, "a\0b" * 20)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("width", [6, 9])
def test_words_equal_brute_force(spark, width):
    rows = invented(width, 60)
    got = superkmers.remove_repeated_words(frame(spark, rows), width).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept_text)) for r in got) == Counter(brute_words(rows, width))


@pytest.mark.parametrize("width", [8, 30])
def test_bytes_equal_brute_force(spark, width):
    rows = invented(width, 60)
    got = suffixes.remove_repeated_bytes(frame(spark, rows), width).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got) == Counter(brute_bytes(rows, width))


def test_repeated_rows_and_empty_tables(spark):
    row = (1, "one two three four five six seven eight")
    got = superkmers.remove_repeated_words(frame(spark, [row, row]), 5).collect()
    assert [(r.n_words, r.n_removed) for r in got] == [(8, 8)] * 2
    got = suffixes.remove_repeated_bytes(frame(spark, [row, row]), 10).collect()
    assert [(r.n_removed, r.n_spans) for r in got] == [(39, 1)] * 2
    none = frame(spark, []).limit(0)
    assert superkmers.remove_repeated_words(none).count() == 0 and suffixes.remove_repeated_bytes(none).count() == 0


def test_registered_queries(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = entry_points.queries()["op4_super_kmers"](spark, SF).collect()
    want = [(d, n, g, hashlib.sha256(k).hexdigest()) for d, n, g, k in brute_words(rows, 35)]
    assert Counter(map(tuple, got)) == Counter(want)
    got = entry_points.queries()["op7_suffix_array"](spark, SF).collect()
    want = [(d, n, g, s, hashlib.sha256(k).hexdigest()) for d, n, g, s, k in brute_bytes(rows, 100)]
    assert Counter(map(tuple, got)) == Counter(want)


@pytest.mark.parametrize(("unit", "judge"), [(superkmers.Unit(True, 5, 2, 1 << 20), superkmers.judge_words), (superkmers.Unit(False, 12, 4, 1 << 20), suffixes.judge_bytes)])
def test_parts_of_a_bucket(unit, judge):
    """Judging a bucket in parts of few bytes gives the ranges of the bucket as a whole."""
    rows = [(i, (t or "").encode()) for i, (_, t) in enumerate(invented(5, 40))]
    flat = np.frombuffer(b"".join(t for _, t in rows), np.uint8)
    offsets = np.cumsum([0, *(len(t) for _, t in rows)])
    cut = superkmers.Slice(unit, flat, offsets)
    text, local = cut.strings(np.arange(len(cut.count)))
    body = np.frombuffer(b"".join(text), np.uint8)
    ones = np.ones(len(text), np.int64)

    def whole():
        return superkmers.Strings(cut.anchor, np.array([len(s) for s in text]), cut.count, ones, cut.doc.copy(), cut.doc * 7, local.copy(), body)

    def ranges(parts):
        found = {}
        for part in parts:
            for batch in judge(unit)(part):
                for doc, _, low, high in zip(*(batch.column(c).to_pylist() for c in range(4))):
                    found.setdefault(doc, set()).update(range(low, high))
        return found

    parts = list(whole().parts(300))
    assert len(parts) > 20 and sum(len(p.text) for p in parts) == len(body)
    assert all(len(p.text) <= 300 or len(set(p.anchor.tolist())) == 1 for p in parts)
    want = ranges([whole()])
    assert want and ranges(whole().parts(300)) == want
