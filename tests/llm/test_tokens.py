"""BPE, the token store and length counts against the tokenizers library."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from factlake.llm import bpe, token_counts, token_store
from factlake.llm.queries import vocabulary

PATH = vocabulary()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        bpe.Encoder(vocabulary("byte_bpe_50k.json"))


def test_tree_concatenation_is_exact():
    enc, rng = bpe.Encoder(PATH), random.Random(3)
    for _ in range(40):
        letters = rng.choice(["ab", "theinandr", "éñabc", "aA'sß1٣<|endoftext|>", "日本語", "İΣá"])
        text = "".join(rng.choice(letters) for _ in range(rng.choice([600, 3000])))
        assert enc.encode_one(text.encode()).tolist() == expected(enc.tokenizer, text)


def test_a_full_memory_keeps_the_words_that_come_again(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 20_000)
    enc = bpe.Encoder(PATH)
    known, learned = enc.word, []
    monkeypatch.setattr(enc, "word", lambda w: learned.append(w) or known(w))
    common, letters = ["some", "common", "words", "été", "x1y2"], "bcdfghjklmnp"
    for k in range(200):  # each text has 50 words that no other has
        rare = ["q" + "".join(letters[int(d)] for d in f"{50 * k + i:05}") for i in range(50)]
        text = " ".join(common + rare)
        assert enc.encode_one(text.encode()).tolist() == expected(enc.tokenizer, text)
    assert len(enc.words) < 250
    assert all(learned.count(w) == 1 for w in common)


def test_leaves_and_joins_do_not_each_search_the_memory(monkeypatch):
    """A search of the memory of words costs as much as all words in it, so a batch of leaves takes one and the joins none."""
    monkeypatch.setattr(bpe, "PART_BYTES", 200)
    enc, calls = bpe.Encoder(PATH), []
    search = bpe.pc.index_in
    monkeypatch.setattr(bpe.pc, "index_in", lambda *a, **b: calls.append(1) or search(*a, **b))
    text = "Some words, d\u00e9j\u00e0 vu x1y2 \t " * 300 + "q" * 600 + "<|endoftext|>" + "z" * 700 + " and the end."
    rows = bpe.cut(text.encode(), enc)
    assert len(rows) > 40 and {kind for kind, *_ in rows} == {"text", "piece", "id"}
    batch = pa.RecordBatch.from_pylist([dict(zip(("kind", "payload", "number", "last"), r)) for r in rows])
    ids = [x for _, some in enc.encode_leaves(batch) for x in some]
    assert len(calls) <= 2 and len(ids) == len(rows)
    searched, out = len(calls), []
    for _, own in itertools.groupby(zip(rows, ids), key=lambda r: r[0][2]):
        own = list(own)
        parts = [(payload, x) for (_, payload, *_), x in own]
        out += (enc.join_tree(parts) if own[0][0][0] == "text" else np.array(enc.join_all([x.tolist() for _, x in parts], True))).tolist()
    assert len(calls) == searched
    assert out == expected(enc.tokenizer, text)


def test_halves_cut_anywhere_join_exactly(monkeypatch):
    """Texts with words, long blanks, lines of blanks only and accents, cut inside words and blanks."""
    enc, rng = bpe.Encoder(PATH), random.Random(9)
    for size in (5, 40, 300):
        monkeypatch.setattr(bpe, "PART_BYTES", size)
        for _ in range(15):
            words = ["".join(rng.choice("aeinorstéñ.,'sA1日") for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(1, 200))]
            text = "".join(w + rng.choice([" ", " ", "\n", "  \t", " " * 120, "\u00a0", "e\u0301 "]) for w in words)
            parts = [(x, enc.encode_one(x)) for x in bpe.halves(text.encode())]
            assert b"".join(x for x, _ in parts).decode() == text
            assert enc.join_tree(parts).tolist() == expected(enc.tokenizer, text)


def test_given_long_texts_go_through_the_joins(llm, library):
    """Rows of the given table beyond the production bound: every one is cut, joined and equal to the library."""
    docs = llm.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.length("text") > bpe.LONG_CHARS).select("doc_id", "text")
    rows = docs.collect()
    enc = bpe.Encoder(PATH)
    leaves = [[leaf for leaf in bpe.cut(r["text"].encode(), enc) if leaf[0] == "text"] for r in rows]
    assert rows and all(len(x) >= 2 for x in leaves)
    assert any(x[k][1][-1:].strip() and x[k + 1][1][:1].strip() for x in leaves for k in range(len(x) - 1))  # cut inside a word
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(docs, PATH).collect()}
    assert got == {r["doc_id"]: expected(library, r["text"]) for r in rows}


def test_roundtrip(docs, corpus, library):
    for long_chars in (1 << 20, 500):  # in one task, and dealt out
        got = bpe.decode(bpe.encode(docs, PATH, long_chars), PATH).collect()
        want = sorted(((d, expected(library, t)) for d, t, *_ in corpus), key=str)
        assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=str) == want
        assert all(r["text"] == library.decode(list(r["ids"]), skip_special_tokens=False) for r in got)
    one = bpe.digests(bpe.decode(bpe.encode(docs.where("doc_id = 5"), PATH), PATH)).first()
    ids = expected(library, dict((d, t) for d, t, *_ in corpus)[5])
    assert (one["n_tokens"], one["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_one_python_step_a_stage(llm, docs):
    """The stage that encodes hands its ids on as a table, so that no task holds two Python workers."""
    plan = corpus_pipeline.encode(llm, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "FlatMapGroupsInPandas" not in plan


def test_roundtrip_of_nothing(empty):
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0


def test_store(docs, corpus, library, llm, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_BYTES", 6000)
    monkeypatch.setattr(token_store, "BUCKET_KEYS", 20)
    store = token_store.write_store(docs, PATH)
    assert store.read("shards").count() > 3
    got = token_store.fetch(store, docs.select("doc_id").distinct()).collect()
    assert len(got) == len(corpus)
    texts = {}
    for d, t, *_ in corpus:
        texts.setdefault(d, []).append(expected(library, t) + [1])
    end = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == end
        end += r["n_tokens"]
        assert np.frombuffer(r["ids"], "<u4").tolist() in texts[r["doc_id"]]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    absent = llm.createDataFrame([(10**6 + k,) for k in range(50)], "doc_id long")
    assert token_store.lookup(store, absent).count() == 0


def test_store_of_a_hot_key(llm, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_BYTES", 400)
    rows = llm.createDataFrame([(k if k % 3 else 7, f"word {k}") for k in range(300)], "doc_id long, text string")
    store = token_store.write_store(rows, PATH)
    assert token_store.fetch(store, rows.select("doc_id").distinct()).count() == 300
    assert token_store.fetch(store, rows.where("doc_id = 7").select("doc_id").distinct()).count() == 101


def test_store_of_nothing(empty):
    store = token_store.write_store(empty, PATH)
    assert token_store.fetch(store, empty.select("doc_id")).count() == 0


def test_perfect_hash():
    h = np.random.default_rng(1).integers(0, 2**63, 3001).astype(np.uint64)
    d = token_store.perfect_hash(h)
    group = (token_store.mix(h ^ token_store._STEP) % np.uint64(len(d))).astype(np.int64)
    assert sorted(token_store._slot(h, d[group], len(h)).tolist()) == list(range(len(h)))


def test_length_tables(docs, corpus, library):
    lengths = [len(expected(library, t)) for _, t, *_ in corpus]
    histogram = token_counts.length_histogram(docs, PATH).cache()
    for r in token_counts.limit_table(histogram).collect():
        limit = r["length"]
        assert r["n_docs"] == lengths.count(limit)
        assert r["docs_from"] == sum(x >= limit for x in lengths)
        assert r["docs_up_to"] == sum(x <= limit for x in lengths)
        assert r["truncated_tokens"] == sum(min(x, limit) for x in lengths)
        assert (r["docs_total"], r["tokens_total"]) == (len(lengths), sum(lengths))
    for r in token_counts.at_limits(histogram, [0, 3, 100, 10**7]).collect():
        assert r["truncated_tokens"] == sum(min(x, r["context_limit"]) for x in lengths)
        assert r["docs_cut"] == sum(x > r["context_limit"] for x in lengths)
    [half] = token_counts.quantiles(histogram, [0.5]).collect()
    assert half["length"] == sorted(lengths)[(len(lengths) + 1) // 2 - 1]


def test_length_tables_of_nothing(empty):
    assert token_counts.limit_table(token_counts.length_histogram(empty, PATH)).count() == 0


def test_store_keeps_large_keys_beside_a_null(llm):
    rows = [(2**53 + 1, "one"), (None, "two"), (2**53 + 3, "three four"), (2**53 + 2, "five")]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    store = token_store.write_store(docs, PATH)
    asked = llm.createDataFrame([(k,) for k, _ in rows] + [(2**53,), (7,)], "doc_id long")
    assert {r["doc_id"] for r in token_store.fetch(store, asked).collect()} == {k for k, _ in rows}


def test_a_fingerprint_is_not_a_key(llm, monkeypatch):
    """A key whose fingerprint is that of another one is found out at the place read."""
    docs = llm.createDataFrame([(k, f"word {k}") for k in range(20)], "doc_id long, text string")
    store = token_store.write_store(docs, PATH)
    at = token_store.lookup(store, llm.createDataFrame([(3,)], "doc_id long")).withColumn("doc_id", F.lit(99).cast("long"))
    monkeypatch.setattr(token_store, "lookup", lambda store, keys: at)
    assert token_store.fetch(store, docs).count() == 0
