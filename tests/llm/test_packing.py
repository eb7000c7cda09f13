"""Packing, training rows, mixing and the pipeline."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stratiform.llm import bestfit, mixing, packing, tokens
from stratiform.llm.queries import token_file

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n", "Plain words, here.", "ÀÉÎ ÿ ß don't we'll 12345", "emoji 😀 and 漢字", "x" * 3000, "<|endoftext|> inside<|startoftext|>it", "é combining", "wide blank and\x1cmore", "tab\there", "İstanbul ẞ", "a\0b \0001", "ﬁ ½ ² ª"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(token_file())


def texts():
    return ODD + [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]


def frame(spark, values):
    return spark.createDataFrame([(i, t, "x", 1, b"y") for i, t in enumerate(values)], "doc_id long, text string, task string, begin int, ids binary").repartition(3)


def want_ids(plain, text, end=1):
    return [*plain.encode(text or "", add_special_tokens=False).ids, end]


def test_ids_equal_the_tokenizer(plain):
    tool = tokens.WordTokenizer(token_file(), cache_pieces=50)
    for t in texts():
        ids, at = tool.encode([t or "", t or ""], 1)
        assert ids[: at[1]].tolist() == want_ids(plain, t) == ids[at[1] : at[2]].tolist()


def test_pieces_rebuild_the_texts(spark, plain):
    rows = packing.concatenate_and_cut(frame(spark, texts()), token_file(), length=64).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        docs[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts()):
        whole = [x for _, ids, _ in sorted(docs[i]) for x in ids]
        assert whole == want_ids(plain, t) and {n for *_, n in docs[i]} == {len(whole)}
    for k, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or k == max(sequences)
    assert packing.concatenate_and_cut(frame(spark, ["a"]).limit(0), token_file()).count() == 0


def test_best_fit_picks_the_tightest_row():
    r = random.Random(3)
    for _ in range(50):
        lengths = np.array([r.randint(1, 20) for _ in range(r.randint(1, 60))])
        rows = bestfit.best_fit(lengths, 20)
        assert sorted(p for x in rows for p in x) == list(range(len(lengths)))
        free: list[int] = []
        for p in np.argsort(-lengths, kind="stable"):
            fits = [x for x in free if x >= lengths[p]]
            left = min(fits) if fits else 20
            if fits:
                free.remove(left)
            free.append(left - int(lengths[p]))
        assert sorted(20 - sum(int(lengths[p]) for p in x) for x in rows) == sorted(free)


def test_rows_rebuild_the_texts(spark, plain, tmp_path):
    packed = bestfit.packed_rows(frame(spark, texts()), token_file(), length=64, window_ids=5000)
    bestfit.write_packed(packed, str(tmp_path / "rows"))
    docs = defaultdict(list)
    rows = spark.read.parquet(str(tmp_path / "rows")).collect()
    assert len({(r.shard, r.row) for r in rows}) == len(rows)
    for r in rows:
        ids, places = (np.frombuffer(bytes(x), "<u4") for x in (r.input_ids, r.position_ids))
        assert len(ids) == len(places) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens :] == bestfit.PAD_ID).all() and (places[r.n_tokens :] == 0).all()
        for a, b, d, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_starts):
            assert places[a:b].tolist() == list(range(b - a))
            docs[d].append((start, ids[a:b].tolist()))
    for i, t in enumerate(texts()):
        assert [x for _, ids in sorted(docs[i]) for x in ids] == want_ids(plain, t)
    assert bestfit.packed_rows(frame(spark, ["a"]).limit(0), token_file()).count() == 0


# -- mixing --------------------------------------------------------------------------------


def test_shortage_goes_to_siblings_first(spark):
    rows, doc = [], 0
    size = {("d", "en", "a"): 10, ("d", "en", "b"): 1000, ("d", "de", "c"): 1000, ("e", "en", "f"): 1000}
    for (_, lang, source), n in size.items():
        for _ in range(n // 10):
            rows.append((doc, "w " * 10, lang, source, "x", 5))
            doc += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string, tokens int")
    from pyspark.sql import functions as F

    domain = lambda s: F.when(s == "f", "e").otherwise("d")
    got = mixing.mix(docs, percent=20, epochs=1, weights={"domain": {"d": 1, "e": 1}, "language": {"en": 1, "de": 1}}, domain=domain).collect()
    used = Counter()
    for r in got:
        used[r.source] += r.taken
    # 602 tokens, 301 for each domain, 150 for each language below d; a has 10, so b gets 140.
    assert used == {"a": 10, "b": 140, "c": 150, "f": 301}
    for s in used:
        mine = sorted((r.start, r.tokens, r.taken) for r in got if r.source == s)
        assert [m[0] for m in mine] == [10 * i for i in range(len(mine))] and all(t == 10 for _, _, t in mine[:-1])


def test_mixing_edges(spark):
    schema = "doc_id long, text string, lang string, source string, budget int, epoch string"
    rows = [(1, None, "en", "a", 1, "x"), (2, "", None, None, 1, "x"), (3, "one two", None, None, 1, "x"), (None, "three four five", "en", "a", 1, "x"), (5, "six", "en", "a", 1, "x"), (5, "six", "en", "a", 1, "x")]
    docs = spark.createDataFrame(rows, schema)
    all_of_it = mixing.mix(docs, percent=200, epochs=2).collect()
    assert sum(r.taken for r in all_of_it) == 14 and all(r.taken == r.tokens for r in all_of_it)
    assert mixing.mix(docs, percent=0).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    whole = mixing.select_documents(docs, percent=100)
    assert whole.columns == docs.columns and whole.count() == 4


# -- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(1).selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars").union(
        docs.limit(1).selectExpr("100000L", "cast(null as string)", "lang", "source", "0L")
    )
    docs = docs.union(extra)
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], SF)
        assert out.columns == docs.columns, name
        kept.append(spark.createDataFrame(out.collect(), docs.schema))
    counts = [k.count() for k in kept]
    assert counts[1] == counts[0] - 1
    texts_ = [r.text for r in kept[1].collect()]
    assert counts[2] == len(set(texts_)) == len({r.text for r in kept[2].collect()})
    assert counts[2] > counts[3] > counts[4] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF).collect()
    want = sum(len(want_ids(plain, r.text)) for r in kept[-1].collect())
    assert sum(r.length for r in packed) == want


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_near_copies_of_five_words_at_80_percent_go(spark):
    """104 words hold 100 shingles of five words: 25 words more leave 0.8, 26 leave less."""
    base = lambda k: [f"w{k}x{i}" for i in range(104)]
    rows = []
    for k, more in enumerate((20, 25, 26, 40)):
        rows += [(10 * k, " ".join(base(k))), (10 * k + 1, " ".join(base(k) + [f"more{k}x{i}" for i in range(more)]))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()) == [0, 10, 20, 21, 30, 31]
