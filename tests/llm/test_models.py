"""Language ID, toxicity, mixing and the pipeline."""

import hashlib

import corpus_pipeline
import pytest
from brute import WORD, components, jaccard_links, prefix, removed

from factlake.llm import lang_id, mixing, queries, toxicity
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_language_held_out(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    got = queries.op1_language_id(llm, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count()


def test_language_of_odd_rows(docs, empty, corpus):
    model = lang_id.fit(docs)
    got = lang_id.predict(docs, model).collect()
    assert len(got) == len(corpus)
    text = {d: t for d, t, *_ in corpus}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und")
        t = text[r["doc_id"]]
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not t or not any(map(str.isalpha, t)))
    assert lang_id.predict(empty, model).count() == 0
    nothing = lang_id.predict(docs, lang_id.fit(empty)).select("lang_pred").distinct().collect()
    assert [r[0] for r in nothing] == ["und"]
    assert set(lang_id.keep_identified(docs, model).columns) == set(docs.columns)


def test_clauses_of_the_grammar():
    words = {"idiot": 6.0}
    plain, target = (toxicity.clause_score(c, words, {}) for c in ("an idiot came", "you idiot"))
    assert target > plain > 0
    assert toxicity.clause_score("you are not an idiot", words, {}) < plain
    assert toxicity.clause_score('he said "you idiot" then', words, {}) < plain
    assert toxicity.clause_score("i will kill you", words, {}) > 0 == toxicity.clause_score("they kill time", words, {})


def test_toxicity_held_out(llm):
    sf = "/root/testdata/sf0.1"
    labels = llm.read.parquet(f"{sf}/labels.parquet")
    got = queries.op10_toxicity(llm, sf).join(labels, "doc_id").where("held_out").cache()
    assert got.where("predicted = toxic").count() >= 0.97 * got.count()
    toxic = got.where("toxic = 1")
    assert toxic.where("predicted = 1").count() >= 0.9 * toxic.count()


def test_toxicity_of_odd_rows(docs, empty, corpus):
    rows = docs.withColumn("toxic", (F.length("text") % 2).cast("int"))
    model = toxicity.fit(rows)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(corpus) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(docs, toxicity.fit(rows.where("false"))).where("predicted = 1").count() == 0
    assert toxicity.score(empty, model).count() == 0


def test_shortages_go_to_siblings_first():
    tokens = {("a", "x", "1"): 10, ("a", "x", "2"): 100, ("a", "y", "1"): 100, ("b", "x", "1"): 1000}
    weights = {("a",): 1.0, ("b",): 1.0, ("a", "x"): 1.0, ("a", "y"): 1.0, ("a", "x", "1"): 9.0, ("a", "x", "2"): 1.0}
    got = mixing.leaf_budgets(tokens, weights, 200, 1)
    # a gets 100, x of it 50; x's first source has 10 only, its sibling takes the other 40
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 40, ("a", "y", "1"): 50, ("b", "x", "1"): 100}
    # a has 210 tokens in all: what it lacks of 300 goes to b
    got = mixing.leaf_budgets(tokens, weights, 600, 1)
    assert got[("b", "x", "1")] == 390 and sum(got.values()) == 600
    assert sum(mixing.leaf_budgets(tokens, weights, 10**6, 2).values()) == 2 * 1210


@pytest.mark.parametrize("budget, epochs", [(1.0, 4), (0.5, 1), (137, 2), (0, 1)])
def test_mix(docs, corpus, budget, epochs):
    weights = {("d1",): 0.9, ("d2",): 0.1}
    got = mixing.mix(docs, weights, budget, queries.domain(), max_epochs=epochs, seed=3).collect()
    rows = [{"id": d, "text": t, "leaf": ("d1" if s == "src1" else "d2" if s == "src2" else "other", g, s), "n": len(WORD.findall(t or ""))} for d, t, g, s, *_ in corpus]
    leaves = {}
    for r in rows:
        leaves.setdefault(r["leaf"], []).append(r)
    tokens = {leaf: sum(r["n"] for r in own) for leaf, own in leaves.items()}
    total = int(budget * sum(tokens.values())) if isinstance(budget, float) else budget
    room = mixing.leaf_budgets(tokens, weights, total, epochs)
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    want = []
    for leaf, own in leaves.items():
        for e in range(epochs):
            left = room[leaf] - e * tokens[leaf]
            if left <= 0:
                break
            order = lambda r, e=e: md5("|".join(["3", str(e), "" if r["id"] is None else str(r["id"]), "" if r["text"] is None else md5(r["text"])]))
            want += [(r["id"], e) for r in prefix(own, order, left)]
    assert sorted(((r["doc_id"], r["mix_epoch"]) for r in got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", [None, "web"])
def test_mix_of_sources_without_a_number(llm, tmp_path, name):
    """A third of the rows have a null or unnumbered source: they keep their share in op9 and in the pipeline."""
    rows = [(k, "word " * 10, "en", name if k % 3 == 0 else f"src{k % 8}", 50) for k in range(1200)]
    llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    taken = queries.op9_source_mix(llm, str(tmp_path)).groupBy("mix_domain").agg(F.sum("mix_tokens").alias("n")).collect()
    taken = {r[0]: r[1] for r in taken}
    assert taken == {"d0": 3200, "d1": 2400, "d2": 1600, "d3": 800, "other": 4000}
    docs = llm.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.mix_sources(llm, docs, str(tmp_path))
    # 360 rows are its share; the budget of 1080 fills d0 and d1, so it gets some of what they cannot use too
    assert kept.where(F.col("source").eqNullSafe(F.lit(name))).count() >= 360 and 1070 <= kept.count() <= 1080


def test_mix_of_nothing(empty):
    assert mixing.mix(empty, {}, 1.0, queries.domain()).count() == 0


def test_pipeline_stages(llm, tmp_path):
    """Every stage against brute force over what its predecessor kept."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    before = None
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(llm, docs, SF).write.parquet(path)
        after = llm.read.parquet(path)
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        got = after.collect()
        if name != "bpe":
            assert after.columns == docs.columns
        if name == "language_id":
            assert 0.9 * len(rows) <= len(got) <= len(rows)
        elif name == "near_copies":
            of = components([d for d, _ in rows], jaccard_links(rows, 5, 80))
            assert sorted(r["doc_id"] for r in got) == sorted(d for d in of if of[d] == d)
            assert len(got) < len(rows)
        elif name == "substring_dedup":
            cut = {d: (n, gone, kept) for d, n, gone, kept in removed(rows, 13)}
            want = {d: (cut[d][2] if cut[d][1] else t) for d, t in rows if cut[d][1] < cut[d][0] or cut[d][0] == 0}
            assert {r["doc_id"]: r["text"] for r in got} == want
            assert all(r["n_chars"] == len(r["text"]) for r in got)
        elif name == "source_mix":
            n = {d: len(t.split()) for d, t in rows}
            share = sum(n[r["doc_id"]] for r in got) / sum(n.values())
            assert 0.75 <= share <= 0.9 and len({r["doc_id"] for r in got}) == len(got)
        else:
            text = dict(rows)
            assert {r["doc_id"]: list(r["ids"]) for r in got} == {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in text.items()}
        before, docs = docs, after
    assert before is not None
