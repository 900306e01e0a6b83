"""Fingerprints, edited texts and near pairs against brute force."""

import hashlib

import pytest

from factlake.llm import spotsigs


def ordered(rows):
    """Documents in descending doc_id, nulls last; rows of one id in any order that the operator may choose."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


@pytest.mark.parametrize("block_bytes", [1 << 24, 2000, 300])
def test_edited_texts(docs, corpus, block_bytes):
    """Whatever the blocks: every row once, with the text of its next document."""
    single = [r for r in corpus if [x[0] for x in corpus].count(r[0]) == 1]
    ids = [r[0] for r in single]
    got = spotsigs.with_edited(docs.where(docs["doc_id"].isin(*ids)), block_bytes).collect()
    line = ordered(single)
    want = {}
    for k, (d, text, *_) in enumerate(line):
        edited = spotsigs.edit(text or "", line[(k + 1) % len(line)][1] or "")
        want[d] = (len(text or ""), hashlib.sha256(edited.encode()).hexdigest())
    assert len(got) == len(line) and {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    for k, (d, text, *_) in enumerate(line):
        own = next(r for r in got if r["doc_id"] == d)
        assert own["near_next"] == pytest.approx(spotsigs.likeness(prints[d], prints[line[(k + 1) % len(line)][0]]))
        assert own["near_edited"] == pytest.approx(spotsigs.likeness(prints[d], own["edited_fingerprint"]))


def test_repeated_and_null_rows_all_come_out(docs, corpus, empty):
    got = spotsigs.with_edited(docs, 500).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in corpus)
    assert spotsigs.with_edited(empty).count() == 0 and spotsigs.fingerprints(empty).count() == 0


def test_a_single_document_is_its_own_next(llm):
    row = spotsigs.with_edited(llm.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0


def test_equal_texts_have_equal_fingerprints(docs, corpus):
    prints, texts = {}, {}
    for r in spotsigs.fingerprints(docs).collect():
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    for d, text, *_ in corpus:
        texts.setdefault(text or "", set()).update(prints[d] if len(prints[d]) == 1 else ())
    assert all(len(p) <= 1 for p in texts.values())


def test_likeness():
    words = [f"the w{k} of x{k % 50}" for k in range(300)]
    import pyarrow as pa

    half = words[:150] + [f"the v{k} of y{k}" for k in range(150)]
    texts = [" ".join(x) for x in (words, half, words[:200], [f"z{k} and q{k}" for k in range(300)], ["again"] * 100, ["again"] * 67, [f"p{k}" for k in range(60)])] + ["", "ab", "abc"]
    prints = spotsigs.Sets(pa.array(texts)).fingerprints()
    near = lambda a, b: spotsigs.likeness(prints[a], prints[b])
    assert near(0, 0) == 1.0 and 0.3 < near(0, 1) < 0.37 and 0.6 < near(0, 2) < 0.68 and near(0, 3) == 0.0
    assert 0.55 < near(4, 5) < 0.75  # uses are counted
    assert near(7, 7) == 1.0 and near(7, 8) == 0.0 and near(8, 9) == 0.0
    assert prints[6].count("-") == 1 and len(prints[6].split("-")[0]) >= 8 * 40  # a text without common words has signatures


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_near_pairs(llm, docs, least):
    found = spotsigs.fingerprints(docs)
    classes, pairs = spotsigs.near_pairs(found, least)
    held = {r["class_id"]: r for r in classes.collect()}
    assert sum(r["n_docs"] for r in held.values()) == found.where("doc_id IS NOT NULL").count()
    want = {}
    sets = [(c, r["fingerprint"]) for c, r in held.items() if r["n_spots"] >= spotsigs.LEAST_SPOTS]
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if spotsigs.likeness(x, y) >= least:
                want[min(a, b), max(a, b)] = spotsigs.likeness(x, y)
    got = pairs.collect()
    assert {(min(r["a"], r["b"]), max(r["a"], r["b"])): r["likeness"] for r in got} == want and len(got) == len(want) > 10
