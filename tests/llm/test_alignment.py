"""Cross-tokenizer alignment: groups, links and corpus counts against both tokenizers on whole texts."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
from stratiform.llm import alignment
from stratiform.llm.queries import token_file

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, block string, pair int, groups string, n string, pairs int, n_a string"


@pytest.fixture(scope="module")
def words():
    return alignment.Vocabulary(token_file("byte_bpe_50k.json"), token_file("piece_bpe_32k.model"))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "y", "z", 2, "w") for d, t in rows], SCHEMA).repartition(3)


def aligned(words, text):
    """Ids, groups by common ends, and linked pairs of one whole text."""
    full = (" " + text).encode()
    a = words.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = words.b.encode(text) if text else []
    a_bytes, b_bytes = [words.a_bytes[i] for i in a], [words.b_bytes[i] for i in b]
    if not text or b"".join(a_bytes) != full or b"".join(b_bytes) != full:
        return [], [], [], []
    a_ends, b_ends = (np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes))
    ends = sorted(set(a_ends) & set(b_ends))
    sides = [[[] for _ in ends] for _ in "ab"]
    for side, ids, last in zip(sides, (a, b), (a_ends, b_ends)):
        for i, e in zip(ids, last):
            side[bisect_left(ends, e)].append(i)
    groups = list(zip(*sides))
    links, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        step = a_ends[i] - b_ends[j]
        i, j = i + (step <= 0), j + (step >= 0)
    return a, b, groups, links


def expected(words, rows):
    out = [(d, *aligned(words, t or "")) for d, t in rows]
    counts = Counter(pair for *_, links in out for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (d, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), written(groups))
        for d, a, b, groups, links in out
    ]


def written(groups):
    return ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)


def got(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.collect()), key=repr)


def align(df, **more):
    return alignment.align_tokens(df, token_file("byte_bpe_50k.json"), token_file("piece_bpe_32k.model"), **more)


def test_pointers_reach_the_last_token_of_each_component():
    r = random.Random(2)
    for _ in range(200):
        n = r.randint(1, 60)
        a, b = (np.array(sorted({n, *(r.randint(1, n) for _ in range(r.randint(0, 30)))})) for _ in "ab")
        last = alignment.terminals(a, b)
        common = np.intersect1d(a, b)
        wanted = common[np.searchsorted(common, np.concatenate([a, b]))]
        assert a[last].tolist() == wanted.tolist()
    # One long chain: no common end before the last.
    a, b = np.append(np.arange(2, 9001, 2), 9001), np.append(np.arange(1, 9001, 2), 9001)
    assert set(alignment.terminals(a, b).tolist()) == {len(a) - 1}


def test_units_give_the_tokens_of_the_whole_text(words):
    assert words.cuts
    r = random.Random(3)
    signs = "a b  \n\n\t\r.,'s1éＡ日ﬁ▁\x00\x1c\xa0 ß💥AB"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(1, 30))) for _ in range(4000)]
    texts += ["".join(r.choice("ab \n.") for _ in range(r.randint(1, 12))) for _ in range(2000)] + ["<|endoftext|> a</s> b<unk>", "x" * 5000, " ", "\n", "a \n b"]
    tool = alignment.Aligner(token_file("byte_bpe_50k.json"), token_file("piece_bpe_32k.model"))
    numbers, groups, *_ = tool.block(texts)
    for text, n, g in zip(texts, numbers.tolist(), groups):
        a, b, common, links = aligned(words, text)
        assert (n, g) == ([len(a), len(b), len(common), len(links)], written(common)), text


def test_counts_over_all_documents_and_edges(spark, words, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 400)
    r = random.Random(5)
    base = ["the cat sat on the mat.", "unbelievable tokenizers, naïve ones", "1234 + 5678 = 6912\n\nend", "Übergröße  and  spaces ", "日本語 text", "loses ▁ this one"]
    rows = [(i, " ".join(r.choices(base, k=r.randint(1, 5)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " "), (None, base[0]), (7, base[1]), (7, base[1]), (63, "word " * 3000), (64, "<|endoftext|>")]
    assert got(align(frame(spark, rows))) == sorted(expected(words, rows), key=repr)
    assert align(frame(spark, [])).count() == 0
    assert got(align(frame(spark, [(1, None), (2, "▁")]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_UNITS", 50)
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 300)
    tool = alignment.Aligner(token_file("byte_bpe_50k.json"), token_file("piece_bpe_32k.model"))
    texts = [" ".join(f"w{i}x{j} the cat ▁" if i % 7 == 0 else f"w{i}x{j} the cat" for j in range(20)) for i in range(30)]
    whole = tool.block(texts)[1]
    single = [tool.block([t])[1][0] for t in texts]
    assert whole == single and len(tool.place) < 100 and " the" in tool.place
    assert [g == "" for g in whole] == [i % 7 == 0 for i in range(30)]
    assert len(tool.place) == len(tool.texts) == len(tool.met) == len(tool.numbers) == len(tool.bounds) - 1 and tool.bounds[-1] == len(tool.codes)


def test_registered_query_equals_whole_texts(spark, words):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    wanted = sorted((*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in expected(words, rows))
    result = entry_points.queries()["op11_pointer_jumping"](spark, SF).collect()
    assert sorted((x.doc_id, x.n_a, x.n_b, x.n_groups, x.n_links, x.n_best, x.count_sum, x.groups_sha256) for x in result) == wanted
