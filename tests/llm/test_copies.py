"""Shingle join and substring dedup against brute force."""

import os

import pytest
from pyspark.sql import functions as F
from brute import components, jaccard_links, removed, shingles

import corpus_pipeline
from factlake.llm import mixing, repeats, shingle_join
from factlake.session import shared_folder


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_components(docs, corpus, n, percent):
    got = shingle_join.linked_components(docs, n, percent).collect()
    rows = [r[:2] for r in corpus]
    want = components([d for d, _ in rows if d is not None], jaccard_links(rows, n, percent))
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got if r["doc_id"] is not None} == set(want.items())
    sizes = {}
    for d, t in rows:
        sizes.setdefault(d, set()).add(len(shingles(t, n)))
    assert all(r["n_shingles"] in sizes[r["doc_id"]] for r in got)


def test_pairs_are_verified_with_few_sets_held(docs, monkeypatch):
    want = {(r["doc_id"], r["component_id"]) for r in shingle_join.linked_components(docs, 5, 80).collect()}
    monkeypatch.setattr(shingle_join, "HELD_HASHES", 0)  # nothing is held from one pair to the next
    assert {(r["doc_id"], r["component_id"]) for r in shingle_join.linked_components(docs, 5, 80).collect()} == want


def test_keep_one(docs, corpus):
    kept = shingle_join.keep_one(docs, 5, 80).collect()
    rows = [r[:2] for r in corpus]
    of = components([d for d, _ in rows if d is not None], jaccard_links(rows, 5, 80))
    texts = dict(rows)
    want = sorted(d for d in of if of[d] == d)
    got = [r["doc_id"] for r in kept]
    single = [d for d in got if d is not None and shingles(texts[d], 5)]
    assert sorted(single) == [d for d in want if shingles(texts[d], 5)]
    assert got.count(None) == 2
    assert kept[0].__fields__ == docs.columns


def test_texts_move_only_for_pairs_that_sketches_leave_open(llm, monkeypatch):
    """Half of each text is common to all: documents meet under keys, but none is near another."""
    common = " ".join(f"c{k}" for k in range(30))
    rows = [(d, common + " " + " ".join(f"w{d}x{k}" for k in range(30))) for d in range(40)]
    rows.append((40, rows[0][1] + " more"))
    given, verified = set(), shingle_join._verified

    def seen(pairs, *more):
        given.update(map(tuple, pairs.collect()))
        return verified(pairs, *more)

    monkeypatch.setattr(shingle_join, "_verified", seen)
    got = shingle_join.linked_components(llm.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert {(r["doc_id"], r["component_id"]) for r in got.collect()} == {(d, d % 40) for d in range(41)}
    assert len(given) == 1


def test_tables_of_texts_are_discarded(llm, docs):
    folder = shared_folder(llm)
    before = set(os.listdir(folder))
    assert shingle_join.keep_one(docs, 5, 80).count()
    left = [k for k in set(os.listdir(folder)) - before if os.path.isdir(f"{folder}/{k}")]
    assert left and not [k for k in left if {"text", "key", "s0"} & set(llm.read.parquet(f"{folder}/{k}").columns)]


def test_no_documents(empty):
    assert shingle_join.linked_components(empty).count() == 0
    assert shingle_join.keep_one(empty).count() == 0
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("window, seed", [(13, 5), (4, 2), (3, 1)])
def test_repeats(docs, corpus, window, seed):
    got = repeats.remove_repeats(docs, window, seed, keep=("start",)).collect()
    want = removed([r[:2] for r in corpus], window)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert sum(s["n"] for s in r["spans"]) == r["n_removed"]
        assert all(s["n"] >= window for s in r["spans"])


def test_different_texts_of_one_id(llm):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(1, a), (2, a), (2, b), (3, b), (3, "short")]
    got = repeats.remove_repeats(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in got) == [(1, 40, 0), (2, 40, 0), (2, 40, 40), (3, 1, 0), (3, 40, 40)]


def test_clashing_columns(llm):
    """Further columns named as the operators name theirs come through, beside right results."""
    names = ["__head", "__copy", "n_words", "n_removed", "kept", "spans", "mix_epoch", "mix_domain", "mix_tokens", "whole", "last", "p__domain", "__domain", "row", "n", "text_key", "node", "part", "label"]
    passage, start = (" ".join(f"{x}{k}" for k in range(30)) for x in "ws")
    rows = [(1, passage + " one", "en", "src1", 1), (2, passage + " one", "en", "src1", 1), (3, start + " " + passage, "en", "src2", 1), (None, None, None, None, None)]
    docs = llm.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in names))
    one = shingle_join.keep_one(docs)
    assert one.columns == docs.columns and sorted(r["doc_id"] or 0 for r in one.collect()) == [0, 1, 3]
    cut = corpus_pipeline.cut_repeats(llm, docs, "")
    assert cut.columns == docs.columns
    assert {(r["doc_id"], r["text"], r["n_words"], r["kept"], r["spans"], r["label"]) for r in cut.collect()} == {(1, rows[0][1], 2, 4, 5, 18), (3, start, 2, 4, 5, 18), (None, None, 2, 4, 5, 18)}
    mixed = corpus_pipeline.mix_sources(llm, docs, "")
    assert mixed.columns == docs.columns and mixed.count() > 0
    added = mixing.mix(docs, {}, 1.0, F.lit("d"))
    assert sorted(added.columns) == sorted(docs.columns) and {(r["mix_domain"], r["whole"]) for r in added.collect()} == {("d", 9)}
