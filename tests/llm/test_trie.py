"""The prefix trie and the tree contraction against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from factlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, pos string, range long"


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(v)] for c, v in by.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = said.get(c - c % 100, [])[:h] + own[h:]
        ends[tuple(whole)].append(c)
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
    kids = defaultdict(int)
    for n in members:
        if n:
            kids[n[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += kids[n] == 0
            saved[n[:d]] += (len(m) - 1) * (len(n[-1][1]) if n else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n], sha(ends[n])) for n, m in members.items())


def nodes(table):
    base, head = F.col("conv_id") - F.col("conv_id") % 100, F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(6))
    return sorted(tuple(r) for r in prefix_trie.node_table(table, base, head, 5).collect())


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(3)
    rows = []
    for c in [*range(30), *range(200, 230), 405, 407]:  # 400 is absent
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "user", None]), rng.choice(["", None, "ja", "né", "a longer one"]), 1, "x", 2))
    rows += rows[:20] + [(None, 1, "user", "nobody", 1, "x", 2)]
    return rows


def test_trie(llm, talks):
    assert nodes(llm.createDataFrame(talks, SCHEMA)) == brute(talks)


def test_a_hot_conversation_and_very_many_ends(llm, monkeypatch):
    """One conversation holds most turns and runs over several ranges and chunks; very many conversations end alike."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    monkeypatch.setattr(prefix_trie, "ID_RUN", 4)
    rows = [(7, t // 2, "user", f"turn {t}", 1, "x", 2) for t in range(300)]
    rows += [(1000 + k, 1, "user", "hello", 1, "x", 2) for k in range(60)]
    rows += [(c, t, "user", "same", 1, "x", 2) for c in range(2000, 2030) for t in range(40)]
    llm.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert nodes(llm.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", "2")


def test_contraction_of_a_long_chain_with_branches(llm):
    """A chain of 200 nodes takes far fewer rounds than its depth."""
    rows = [(0, d, None if d == 0 else 0, d, 1) for d in range(200)] + [(10 + d, d + 1, 0, 1000, 1) for d in range(0, 200, 7)]
    tree = llm.createDataFrame(rows, "conv_id long, depth long, parent_conv_id long, w long, one long")
    rounds = []
    heads = prefix_trie._heads
    prefix_trie._heads = lambda r, *node: rounds.append(r) or heads(r, *node)
    try:
        got = {(r["conv_id"], r["depth"]): (r["w"], r["one"]) for r in prefix_trie.subtree_sums(tree, ("w", "one")).collect()}
    finally:
        prefix_trie._heads = heads
    want = {}
    for conv, depth, *_ in rows:
        below = [r for r in rows if r[:2] == (conv, depth) or conv == 0 and r[1] > depth]
        want[conv, depth] = (sum(r[3] for r in below), len(below))
    assert got == want and max(rounds) < 40


def test_no_conversations(llm):
    assert nodes(llm.createDataFrame([], SCHEMA)) == []
    assert nodes(llm.createDataFrame([(None, 1, "user", "x", 1, "x", 2)], SCHEMA)) == []
