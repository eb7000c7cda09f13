"""Filter audit and licence scan against plain loops."""

import random
import re
from fractions import Fraction
from itertools import permutations

import duckdb
import pytest

import __spark_entry__ as entry_points
from stratiform.llm import filter_audit, licences

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, part string, fails string, words int, n string, digest int, places int, open string, held int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "f", 1, "n", 2, 3, "o", 4) for r in rows], SCHEMA).repartition(3)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# -- filter audit --------------------------------------------------------------------------


def fails(rows):
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    out = []
    for d, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and first[t] < d}
        out.append((d, lang or "", {k for k, v in bad.items() if v}))
    return out


def audit(rows, marks):
    """Every order applied filter by filter."""
    good, toxic = {d for d, q, _ in marks if q == 1 and d is not None}, {d for d, _, x in marks if x == 1 and d is not None}
    failed, out, orders = fails(rows), set(), ["".join(p) for p in permutations("ABCDE")]
    for part in {p for _, p, _ in failed}:
        docs = [(d, f) for d, p, f in failed if p == part]
        steps = {}
        for order in orders:
            left = list(docs)
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                steps[order, step] = (f, len(left), gone)
        total = {f: sum(len(g) for x, _, g in steps.values() if x == f) for f in "ABCDE"}
        for (order, step), (f, kept, gone) in steps.items():
            out.add((part, order, step, kept, len(gone), sum(f in x for _, x in docs) - len(gone), sum(x == {f} for _, x in docs), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), total[f]))
    return out


def test_audit_equals_all_orders_applied(spark):
    r = random.Random(6)
    words = ["alpha", "beta", "GAMMA", "delta#", "eps", "Zeta"]
    texts = [" ".join(r.choice(words) + (str(r.randint(0, 300)) if r.random() < 0.9 else "") for _ in range(r.choice([5, 99, 100, 140]))) for _ in range(40)]
    rows = [(i, r.choice(texts), r.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [(200, None, "en"), (201, "", "en"), (202, " \n\v ", "fr"), (None, texts[0], "en"), (None, texts[0], "en"), (None, None, None), (3, rows[3][1], "en"), (3, rows[3][1], "en"), (203, "x" * 30000, "fr"), (204, "Ä É Ö " * 60, "fr")]
    marks = [(i, r.randint(0, 1), r.randint(0, 1)) for i in range(0, 150, 2)] + [(0, 1, 0), (0, 0, 1), (999, 1, 1), (None, 1, 1), (5, None, None)]
    got = filter_audit.audit_filters(frame(spark, rows), labels(spark, marks)).collect()
    assert len(got) == len({r.part for r in got}) * 600
    assert {tuple(x) for x in got} == audit(rows, marks)


def test_audit_of_an_empty_table(spark):
    assert filter_audit.audit_filters(frame(spark, []), labels(spark, [])).count() == 0
    one = filter_audit.audit_filters(frame(spark, [(1, "a", None)]), labels(spark, [])).collect()
    assert len(one) == 600 and {r.part for r in one} == {""} and sum(r.shapley for r in one if r.filter_order == "ABCDE") == 120


def test_least_squares_give_shapley_values():
    r = random.Random(7)
    for k in (1, 2, 3, 5):
        counts = {m: r.randint(0, 50) for m in range(1 << k)}
        value = filter_audit.coalition_removals(counts, k)
        orders = list(permutations(range(k)))
        plain = [Fraction(0)] * k
        for order in orders:
            seen = 0
            for f in order:
                plain[f] += Fraction(value[seen | 1 << f] - value[seen], len(orders))
                seen |= 1 << f
        assert filter_audit.shapley_values(value, k) == plain


def test_audit_takes_other_filters(spark):
    tests = {"L": lambda text, words: text.rlike("x"), "M": lambda text, words: text.rlike("y")}
    rows = [(1, "x", "a"), (2, "xy", "a"), (3, "y", "a"), (4, "z", "a"), (5, "z", "a")]
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant) for r in filter_audit.audit_filters(frame(spark, rows), labels(spark, []), tests, "R").collect()}
    assert len(got) == 18 and got["LMR", 1] == (3, 2, 0) and got["LMR", 2] == (2, 1, 1) and got["LMR", 3] == (1, 1, 0)


# -- licences ------------------------------------------------------------------------------


def brute_base(text):
    w = licences.split_words(text or "")
    places = [(i, label) for i in range(len(w)) for p, label in licences.PHRASES.items() if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places_equal_brute_force(spark):
    r = random.Random(8)
    words = ["CC", "by", "BY-", "General", "public", "license", "all", "rights", "Reserved", "reserved.", "gnu", "x", "é", "İ", "K", "version", "3", "\x00", "-", "\n"]
    rows = [(i, r.choice(["", " "]) + " ".join(r.choice(words) for _ in range(r.randint(0, 40))), "en") for i in range(300)]
    rows += [(300, None, None), (301, "", "en"), (None, "cc by cc by", "en"), (5, "All-Rights_reserved", "en"), (5, "All-Rights_reserved", "en"), (302, "cc by " * 20_000, "en"), (303, "licenKse", "en"), (304, "a" * 100_000, "en")]
    got = licences.scan_licences(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((x.doc_id, x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in got), key=key) == sorted(((d, *brute_base(t)) for d, t, _ in rows), key=key)
    for x in got:
        assert set(filter(None, x.base_labels.split(","))) <= set(filter(None, x.labels.split(","))) and 0 <= x.score <= 1 and (x.score > 0) == bool(x.labels)


def test_each_notice_is_found_where_it_stands(spark):
    rows = []
    for i, (text, _) in enumerate(licences.NOTICES.values()):
        rows += [(4 * i, f"some words before. {text.upper()}, and after", "en"), (4 * i + 1, " ".join(reversed(text.split())), "en"), (4 * i + 2, "nothing of the kind", "en"), (4 * i + 3, "one " + text + " two " + text, "en")]
    got = {x.doc_id: x for x in licences.scan_licences(frame(spark, rows)).collect()}
    for i, name in enumerate(licences.NOTICES):
        label = licences.SAME_LABEL.get(name, name)
        found, backwards, none, twice = (got[4 * i + k] for k in range(4))
        assert [(p.start, p.share) for p in found.places if p.label == label and not p.base][0] == (3, pytest.approx(1.0)), name
        assert label not in backwards.labels.split(",") and none.labels == "" and none.score == 0.0 and found.score == 1.0, name
        assert len([p for p in twice.places if p.label == label and not p.base]) >= 2, name


def test_notice_with_changed_words(spark):
    words = licences.NOTICES["bsd"][0].split()
    words[-1], words[-3] = "allowed", "change"
    rows = [(1, " ".join(words), "en"), (2, "redistribution of binary forms and source", "en")]
    got = {x.doc_id: x for x in licences.scan_licences(frame(spark, rows)).collect()}
    assert got[1].labels == "bsd" and 0.5 < got[1].score < 1 and got[2].labels == ""


def test_own_templates_and_empty_table(spark):
    known = [licences.phrase("to be or not to be", "quote"), licences.notice("prose", "it was the best of times it was the worst of times", ["the best of times", "worst"])]
    rows = [(1, "To be, or not to be or not to be!", "en"), (2, "it was the best of times, it was the worst of times", "en")]
    got = {x.doc_id: x for x in licences.scan_licences(frame(spark, rows), known).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].labels) == (2, 0, 4, "quote") and got[2].labels == "prose"
    assert licences.scan_licences(frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="must stand"):
        licences.notice("x", "some words", ["other words"])


def test_registered_licence_query_equals_brute_force(spark):
    rows = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    got = entry_points.queries()["op13_rare_word_licences"](spark, SF).collect()
    assert len(got) == len(rows)
    for x in got:
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == brute_base(rows[x.doc_id])
