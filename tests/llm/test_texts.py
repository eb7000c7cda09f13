"""Operators on single texts and on equal texts: toxicity, fingerprints, language, naming."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
from stratiform.llm import fingerprint, language, naming, text, toxicity

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, name int, digest string, task string, local int, score string"


def frame(spark, rows):
    """Rows of ``(doc_id, text)`` or ``(doc_id, text, lang)``, with columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", 1, "x", "y", 2, "z") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "A."), (None, "a text without id"), (5, "12 34 !?"), (6, "x" * 50_000), (7, "é ü ß"), (7, "é ü ß"), (8, "word " * 9000)]


def test_words_and_hashes():
    raw = ["one two", "", "  three\x0bfour\n", "five"]
    flat = np.frombuffer("".join(raw).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    starts, ends, counts = text.word_bounds(flat, offsets)
    assert [bytes(flat[a:b]) for a, b in zip(starts, ends)] == [b"one", b"two", b"three", b"four", b"five"] and counts.tolist() == [2, 0, 2, 1]
    tool = text.Hasher(1)
    same = np.frombuffer(b"abcab-abc", np.uint8)
    h = tool.of(same, np.array([0, 3, 6]), np.array([3, 5, 9]))
    grams = tool.grams(same, 3)
    assert len(grams) == 7 and grams[0] == h[0] == grams[6] and len(set(grams.tolist())) == 6
    assert h[0] == h[2] != h[1]
    out, at = text.gather(same, np.array([6, 0, 4]), np.array([3, 0, 2]))
    assert bytes(out) == b"abcb-" and at.tolist() == [0, 3, 3, 5]


# -- exact dedup ---------------------------------------------------------------------------


def brute_groups(rows):
    by = {}
    for d, t in rows:
        by.setdefault(t or "", []).append(d)
    keep = {t: max((d for d in ids if d is not None), default=None) for t, ids in by.items()}
    return Counter((d, keep[t or ""], len(by[t or ""]), d == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)


def test_naming_equals_brute_force(spark):
    r = random.Random(4)
    base = ["".join(r.choice("ab") for _ in range(r.randint(0, 40))) for _ in range(30)]
    rows = [(i, r.choice(base)) for i in range(120)] + [(d, t) for d, t in ODD if d != 7] + [(200, "ab" * 300), (201, "ab" * 300), (202, "ab" * 299 + "aa")]
    got = naming.exact_groups(frame(spark, rows), block_bytes=4).collect()
    assert Counter(map(tuple, got)) == brute_groups(rows)


def test_naming_edges(spark):
    assert naming.exact_groups(frame(spark, ODD).limit(0)).count() == 0
    rows = [(1, "same"), (1, "same"), (1, "other"), (0, "same")]
    assert Counter(map(tuple, naming.exact_groups(frame(spark, rows)).collect())) == brute_groups(rows)
    kept = naming.drop_copies(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, "same"), (1, "other")]) and kept[0].digest == "x"


def test_naming_names_are_equal_only_for_equal_texts(spark):
    rows = [(i, format(i % 37, "08b") * (1 + i % 5)) for i in range(150)]
    ids = naming.block_identities(frame(spark, rows), block_bytes=3).collect()
    texts = dict(rows)
    assert len({(r.level, r.name) for r in ids}) == len(set(texts.values()))


# -- fingerprints --------------------------------------------------------------------------


def brute_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (d, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        out[d] = (len(t), hashlib.sha256((t[: len(t) - half] + u[:half]).encode()).hexdigest())
    return out


def test_edited_texts_equal_brute_force(spark):
    rows = [(d, t) for i, (d, t) in enumerate(ODD) if i != 7] + [(i * 7 + 20, f"line {i}\n" * (i % 9) + "ende é") for i in range(80)]
    got = fingerprint.edit_check(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == brute_edits(rows) and len(got) == len(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    alone = fingerprint.edit_check(frame(spark, [(3, "abcd")])).collect()
    assert [(r.n_chars, r.near_next) for r in alone] == [(4, 1.0)]
    assert fingerprint.edit_check(frame(spark, []).limit(0)).count() == 0


def test_fingerprints_are_sums(spark):
    lines = [b"first", b"second one", b"third. " * 60, b"", b"second one"]
    (a, b), (ca, cb) = fingerprint.vectors([b"\n".join(lines), b"\n".join(lines[::-1])])
    assert (a == b).all() and (ca == cb).all()
    short = fingerprint.vectors([b"\n".join(lines[:-1])])
    grown = fingerprint.changed((short[0][0], short[1][0]), lines[-1])
    assert (grown[0] == a).all() and (grown[1] == ca).all()
    back = fingerprint.changed(grown, lines[-1], -1)
    assert (back[0] == short[0][0]).all() and (back[1] == short[1][0]).all()
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(frame(spark, [(1, None), (2, ""), (3, "a\nb"), (4, "b\na"), (5, "a b")])).collect()}
    assert got[1] == got[2] and got[3] == got[4] and len(set(got.values())) == 3


def test_likeness_follows_shared_lines():
    base = [f"line number {i} of the text".encode() for i in range(40)]
    texts = [b"\n".join(base[:k] + [b"new " + x for x in base[k:]]) for k in (40, 30, 20, 10, 0)]
    counts = fingerprint.vectors(texts)[1]
    near = fingerprint.likeness(counts, np.repeat(counts[:1], 5, axis=0))
    assert np.allclose(near, [1, 0.75, 0.5, 0.25, 0], atol=0.15)


# -- language ------------------------------------------------------------------------------


def brute_phrases(symbols, sample):
    """Greedy longest matches, each cut at multiples of the stretch length."""
    count = 0
    for begin in range(0, len(symbols), language.STRETCH):
        part, at = symbols[begin : begin + language.STRETCH], 0
        while at < len(part):
            size = 1
            while at + size < len(part) and part[at : at + size + 1] in sample:
                size += 1
            count, at = count + 1, at + size
    return count


def test_phrases_equal_brute_force(monkeypatch):
    monkeypatch.setattr(language, "STRETCH", 64)
    r = random.Random(9)
    make = lambda abc, n: "".join(r.choice(abc) for _ in range(n))
    samples = {"x": [make("abc ", 80), make("abc", 20)], "y": [make("bcd ", 90)]}
    parser = language.Parser(samples)
    texts = [make("abcdé ", n) for n in (0, 1, 5, 63, 64, 65, 300)]
    known, rate = parser.predict(texts)
    for i, t in enumerate(texts):
        for k, lang in enumerate(parser.languages):
            sample = "".join("".join(map(chr, parser.alphabet.of(s) + 1)) + chr(1) for s in samples[lang])
            want = brute_phrases("".join(map(chr, parser.alphabet.of(t) + 1)), sample)
            assert round(rate[i, k] * max(1, len(t))) == want
    assert not known[0] and known[2:].all()


def test_languages_edges(spark):
    rows = [(i, "der die das und nicht " * 5, "de") for i in range(1, 30)] + [(i, "the of and that with " * 5, "en") for i in range(30, 60)]
    odd = [(100 + i, t, None) for i, (_, t) in enumerate(ODD)] + [(None, "the and of", None)]
    got = language.identify(frame(spark, rows + odd)).collect()
    pred = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows) + len(odd) and all(pred[i] == ("de" if i < 30 else "en") for i in range(1, 60)) and pred[None] == "en"
    assert [pred[100 + i] for i in (0, 1, 2, 5)] == ["und"] * 4
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    unlabelled = language.identify(frame(spark, [(1, "abc", None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]
    assert language.identify(frame(spark, []).limit(0)).count() == 0
    kept = language.keep_identified(frame(spark, rows + [(100, None), (101, "12")]))
    assert kept.count() == len(rows) and kept.columns == frame(spark, rows).columns


def test_language_accuracy(spark):
    got = {r.doc_id: r for r in entry_points.queries()["op8_cross_parsing"](spark, SF01).collect()}
    known = [(got[d].lang_pred, lang) for d, lang in duckdb.sql(f"SELECT doc_id, lang FROM '{SF01}/documents.parquet'").fetchall() if got[d].held_out]
    assert sum(a == b for a, b in known) / len(known) > 0.97


# -- toxicity ------------------------------------------------------------------------------


def test_marginals_equal_enumeration(monkeypatch):
    monkeypatch.setattr(toxicity, "CHAIN", 4)
    moves, start = np.array([[2.0, 0.3], [0.5, 1.5]]), 0.4
    field = toxicity.Field({}, 0.0, moves, start)
    gains = np.array([0.2, 3.0, 1.0, 0.5, 2.0, 0.1, 5.0])
    got = field.marginals(gains, np.array([6, 0, 1]))
    want = []
    for chain in (gains[:4], gains[4:6], gains[6:]):
        weight = np.zeros((len(chain), 2))
        for states in itertools.product((0, 1), repeat=len(chain)):
            w = start if states[0] else 1.0
            for t, s in enumerate(states):
                w *= (chain[t] if s else 1.0) * (moves[states[t - 1], s] if t else 1.0)
            for t, s in enumerate(states):
                weight[t, s] += w
        want += list(weight[:, 1] / weight.sum(axis=1))
    assert np.allclose(got, want)


def test_toxicity_learns_and_marks_spans(spark):
    r = random.Random(2)
    plain = ["lorem", "ipsum", "dolor", "sit", "amet", "tempor", "magna", "aliqua"]
    rows, labels = [], []
    for i in range(400):
        words = [r.choice(plain) + str(r.randint(0, 30)) for _ in range(20)]
        if i % 5 == 0:
            words[r.randrange(20)] = r.choice(["vile", "nasty"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0), "x"))
    labels += [(3, None, "x"), (None, 1, "x"), (9999, 1, "x"), (5, 0, "x")]
    known = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    odd = [(1000 + i, t) for i, (_, t) in enumerate(ODD)] + [(None, "you vile thing"), (2000, "NASTY!")]
    got = toxicity.toxicity(frame(spark, rows + odd), known).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    by = {x.doc_id: x for x in got}
    assert all(by[i].predicted == int(i % 5 == 0) for i in range(400))
    assert by[None].predicted == 1 and by[2000].predicted == 1 and by[1000].score == by[1001].score == 0
    assert [("you vile thing")[s.start : s.end] for s in by[None].spans] == ["vile"]
    for none in (known.limit(0), known.filter("toxic = 1"), known.filter("toxic = 0")):
        assert max(x.score for x in toxicity.toxicity(frame(spark, rows[:20]), none).collect()) < 0.01
    assert toxicity.toxicity(frame(spark, []).limit(0), known).count() == 0


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in entry_points.queries()["op1_toxicity_crf"](spark, SF01).collect()}
    known = [(got[d], y) for d, y in duckdb.sql(f"SELECT doc_id, toxic FROM '{SF01}/labels.parquet'").fetchall() if got[d].held_out]
    assert sum(r.predicted == y for r, y in known) / len(known) > 0.9
    assert sum(r.predicted for r, y in known if y) >= 0.6 * sum(y for _, y in known)


@pytest.mark.parametrize("name", ["op5_source_mixing", "op10_block_naming"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert Counter(map(tuple, entry_points.queries()[name](spark, SF).select(*columns).collect())) == Counter(want.fetchall())


def test_a_long_text_is_one_chain():
    """Marginals of texts of any length equal those of one pass over the whole text."""
    r = np.random.default_rng(3)
    counts = np.array([0, 1, 255, 256, 257, 0, 512, 3000, 5, 700])
    gains = np.exp(r.normal(0, 2, counts.sum()))
    moves = np.array([[1.0, 0.02], [0.3, 40.0]])  # what one word says travels far
    field = toxicity.Field({}, 0.0, moves, 0.05)
    got = field.marginals(gains, counts, whole=True)
    at = 0
    for n in counts[counts > 0]:
        forward, backward = toxicity.odds(gains[at : at + n, None], np.array([n]), moves, 0.05)
        x = (forward * backward)[:, 0]
        assert np.allclose(got[at : at + n], x / (1 + x), rtol=1e-9)
        at += n
    assert len(got) == at


def test_whole_marginals_equal_enumeration(monkeypatch):
    monkeypatch.setattr(toxicity, "CHAIN", 3)
    moves, start = np.array([[2.0, 0.3], [0.5, 1.5]]), 0.4
    gains = np.array([0.2, 3.0, 1.0, 0.5, 2.0, 0.1, 5.0, 0.7, 4.0])
    got = toxicity.Field({}, 0.0, moves, start).marginals(gains, np.array([8, 0, 1]), whole=True)
    want = []
    for chain in (gains[:8], gains[8:]):
        weight = np.zeros((len(chain), 2))
        for states in itertools.product((0, 1), repeat=len(chain)):
            w = start if states[0] else 1.0
            for t, s in enumerate(states):
                w *= (chain[t] if s else 1.0) * (moves[states[t - 1], s] if t else 1.0)
            for t, s in enumerate(states):
                weight[t, s] += w
        want += list(weight[:, 1] / weight.sum(axis=1))
    assert np.allclose(got, want)
