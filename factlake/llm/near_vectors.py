"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors of a label are one vertex, so copies are never paired with each other.  In each tree a node projects its
vectors on a random direction and splits them at a random point near the middle; vectors within ``spill`` of the
point go to both sides.  A node is split again while one label has more than ``leaf`` vectors in it: all nodes that are too
large are refitted at once, each on a bounded random sample of its own vectors, and every vector is routed.  A branch
ends at ``leaf`` vectors of a label, and where a split would leave more than ``GAIN`` of the pairs to compare, because
the spill covers most of the node.  Such a node, and one too large after ``rounds`` rounds, is compared in blocks, so
no pair in it is lost.  Leaves compare vectors of one label by cosine in double precision.  A pair counts in one of the
leaves that it shares; a block gives links per vector and its components, not its pairs.

``spill`` is in units of the link radius, the distance of unit vectors whose cosine is ``least``: the projections of such a
pair differ by a normal variable of that deviation, however dense the node is.  Recall against brute force is measured in
the tests; a label with at most ``leaf`` different vectors is exact.  Null labels, null or zero vectors and vectors with
null or non-finite components link with nothing; vectors of different lengths do not link.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlake.llm.components import components
from factlake.session import materialize

TREES = 6
LEAF = 256
SPILL = 0.4
#: A node is split if that leaves at most this share of its pairs within a label.
GAIN = 0.9
ROUNDS = 6
#: Levels that a node grows in one round, and the vectors it is fitted on.
LEVELS = 5
SAMPLE = 4000
#: Rows of a block where a node stays too large.
BLOCK = 1024


def vectors(table: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``v`` (doubles); ``v`` is null where a row cannot link."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(v, lambda x: x != 0.0)
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & ~bad
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.when(good, v).alias("v"))


def _direction(tree: int, level: int, size: int) -> np.ndarray:
    return np.random.default_rng([7919, tree, level, size]).standard_normal(size)


def _unit(v: list) -> np.ndarray:
    x = np.array(v, dtype=np.float64)
    x = x / np.max(np.abs(x), axis=1, keepdims=True)  # keeps squares finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def radius(least: float) -> float:
    """Distance of unit vectors with a cosine of ``least``."""
    return float(np.sqrt(max(0.0, 2 - 2 * least)))


def _n_pairs(counts: np.ndarray) -> int:
    return int((counts * (counts - 1)).sum())


def _fit(rows: pd.DataFrame, leaf: int, spill: float) -> pd.DataFrame:
    """Split points of one node's subtree in heap order, from its sample of the ``n`` rows; ``spill`` is a distance."""
    tree, node, depth, size = (rows[c].iloc[0] for c in ("tree", "node", "depth", "size"))
    x = _unit(rows["v"].tolist())
    labels = pd.factorize(rows["label"])[0]
    scale = max(1.0, rows["n"].iloc[0] / len(x))
    rng = np.random.default_rng([int(tree), int(depth), abs(hash_node(node))])
    points = np.full((1 << LEVELS) - 1, np.nan)
    members = {0: np.arange(len(x))}
    for k in range(len(points)):
        own = members.pop(k, np.zeros(0, np.int64))
        counts = np.bincount(labels[own], minlength=1)
        if len(own) < 8 or (k and counts.max() * scale <= leaf):
            continue
        level = int(np.log2(k + 1))
        p = x[own] @ _direction(int(tree), int(depth) + level, int(size))
        low, high = np.quantile(p, [0.4, 0.6])
        point = rng.uniform(low, high)
        left, right = own[p <= point + spill], own[p > point - spill]
        large = counts * scale > leaf
        after = sum(_n_pairs(np.bincount(labels[side], minlength=len(counts))[large]) for side in (left, right))
        if after > GAIN * _n_pairs(counts[large]):
            continue
        points[k], members[2 * k + 1], members[2 * k + 2] = point, left, right
    return pd.DataFrame({"tree": [tree], "node": [node], "size": [size], "points": [points], "ends": [bool(np.isnan(points[0]))]})


def hash_node(node: str) -> int:
    return int.from_bytes(node.encode()[-8:], "little") + 31 * len(node)


def _route(batches, spill: float):
    """Every row goes down its node's subtree; one row comes out per leaf that it reaches."""
    for batch in batches:
        rows = batch.to_pandas()
        for (tree, node, size), part in rows.groupby(["tree", "node", "size"], sort=False):
            points = np.asarray(part["points"].iloc[0])
            x, depth = _unit(part["v"].tolist()), int(part["depth"].iloc[0])
            who, at = np.arange(len(x)), np.zeros(len(x), np.int64)
            done_who, done_at = [], []
            for level in range(LEVELS):
                split = ~np.isnan(points[at])
                done_who.append(who[~split])
                done_at.append(at[~split])
                who, at = who[split], at[split]
                p = (x @ _direction(int(tree), depth + level, int(size)))[who]
                left, right = p <= points[at] + spill, p > points[at] - spill
                who, at = np.concatenate([who[left], who[right]]), np.concatenate([2 * at[left] + 1, 2 * at[right] + 2])
            done_who.append(who)
            done_at.append(at)
            who, at = np.concatenate(done_who), np.concatenate(done_at)
            out = part.iloc[who][["key", "label", "size", "tree", "v"]].copy()
            out["node"] = [f"{node}.{k}" for k in at]
            out["depth"] = depth + LEVELS
            yield pa.RecordBatch.from_pandas(out[["key", "label", "size", "tree", "node", "depth", "v"]], schema=_PLACED, preserve_index=False)


_PLACED = pa.schema([("key", pa.int64()), ("label", pa.string()), ("size", pa.int32()), ("tree", pa.int32()), ("node", pa.string()), ("depth", pa.int32()), ("v", pa.list_(pa.float64()))])
_PLACED_SQL = "key long, label string, size int, tree int, node string, depth int, v array<double>"


def forest(classes: DataFrame, least: float, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, rounds: int = ROUNDS) -> DataFrame:
    """``classes(key, label, v)`` in leaves: ``key``, ``label``, ``size``, ``tree``, ``node``, ``v``; one row per tree at least."""
    width = spill * radius(least)
    placed = classes.select("key", "label", F.size("v").alias("size"), F.explode(F.array(*map(F.lit, range(trees)))).alias("tree"), F.lit("").alias("node"), F.lit(0).alias("depth"), "v")
    finished = None
    at = ["tree", "node", "size"]
    for k in range(rounds):
        placed = materialize(placed)
        counts = placed.groupBy("label", *at).agg(F.count("*").alias("n"))
        large = materialize(counts.groupBy(*at).agg(F.max("n").alias("most"), F.sum("n").alias("n")).where(F.col("most") > leaf))
        if large.isEmpty():
            break
        rest = placed.join(large.select(*at), at, "left_anti")
        finished = rest if finished is None else finished.unionByName(rest)
        split = materialize(placed.join(large.select(*at, "n"), at))
        # a bounded random sample of each node's vectors: a hash keeps it the same when a task is repeated
        chance = F.least(F.lit(1.0), F.lit(SAMPLE) / F.col("n")) * F.lit(float(1 << 30))
        sample = split.where(F.pmod(F.xxhash64("key", "tree", F.lit(k)), F.lit(1 << 30)) < chance)
        models = materialize(sample.groupBy(*at).applyInPandas(lambda rows: _fit(rows, leaf, width), "tree int, node string, size int, points array<double>, ends boolean"))
        # what no split helps ends here, and what had no sample
        finished = finished.unionByName(split.drop("n").join(models.where("NOT ends").select(*at), at, "left_anti"))
        placed = split.drop("n").join(models.where("NOT ends").drop("ends"), at).mapInArrow(lambda b: _route(b, width), _PLACED_SQL)
    out = placed if finished is None else finished.unionByName(placed)
    return out.select("key", "label", "size", "tree", "node", "v")


def _met_before(one: list, two: list, leaf_id: int) -> np.ndarray:
    """Which rows of ``one`` and ``two``, lists of leaf ids, share a leaf of a smaller id."""
    ids, sides = [np.concatenate(side) for side in (one, two)], []
    shared = np.intersect1d(*ids)
    shared = shared[shared < leaf_id]
    for side, own in zip((one, two), ids):
        row, at = np.repeat(np.arange(len(side)), [len(i) for i in side]), np.searchsorted(shared, own)
        good = at < len(shared)
        good[good] = shared[at[good]] == own[good]
        sides.append((row[good], at[good]))
    met = np.zeros((len(one), len(two)), bool)
    for first in range(0, len(shared), 4096):
        inside = [np.zeros((len(side), min(4096, len(shared) - first)), np.float32) for side in (one, two)]
        for matrix, (row, at) in zip(inside, sides):
            here = (at >= first) & (at < first + 4096)
            matrix[row[here], at[here] - first] = 1
        met |= inside[0] @ inside[1].T > 0
    return met


def _parts(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node that each of ``n`` nodes reaches by the links ``i``, ``j``."""
    of = np.arange(n)
    while True:
        least, new = np.minimum(of[i], of[j]), of.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == of).all():
            return of
        of = new


_FOUND = "key long, root long, beside long"


def _compare(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Of one leaf, or two blocks of one: per linked vector the copies beside it, and one vector of its component here."""
    none = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("key", "root", "beside")})
    a, b = rows[rows["side"] != 1], rows[rows["side"] != 0]
    x, y = (np.array(r["v"].tolist(), dtype=np.float64) for r in (a, b))
    if not len(x) or not len(y):
        return none
    scale = [np.max(np.abs(z), axis=1, keepdims=True) for z in (x, y)]
    x, y = x / scale[0], y / scale[1]
    near, far = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    cosine = (x / near[:, None]) @ (y / far[:, None]).T
    good = cosine >= least
    i, j = np.nonzero(np.abs(cosine - least) <= 1e-9)
    good[i, j] = np.einsum("ij,ij->i", x[i], y[j]) / (near[i] * far[j]) >= least
    p, q = a["key"].to_numpy(), b["key"].to_numpy()
    good &= p[:, None] < q if (rows["side"] == 2).all() else p[:, None] != q
    some, other = np.nonzero(good.any(axis=1))[0], np.nonzero(good.any(axis=0))[0]
    if not len(some):
        return none
    good = good[np.ix_(some, other)]
    good &= ~_met_before(a["leaves"].iloc[some].tolist(), b["leaves"].iloc[other].tolist(), int(rows["leaf_id"].iloc[0]))
    p, q = p[some], q[other]
    keys = np.unique(np.concatenate([p[good.any(axis=1)], q[good.any(axis=0)]]))
    if not len(keys):
        return none
    i, j = np.nonzero(good)
    i_key, j_key = np.searchsorted(keys, p)[i], np.searchsorted(keys, q)[j]
    beside = np.zeros(len(keys), np.int64)
    np.add.at(beside, i_key, b["copies"].to_numpy()[other][j])
    np.add.at(beside, j_key, a["copies"].to_numpy()[some][i])
    return pd.DataFrame({"key": keys, "root": keys[_parts(len(keys), i_key, j_key)], "beside": beside})


def linked(classes: DataFrame, least: float, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, rounds: int = ROUNDS) -> DataFrame:
    """``key``, ``root`` and ``beside`` of ``classes(key, label, copies, v)``: per block in which a class links, a class that it
    reaches by links there, and the copies of classes that have a cosine of ``least`` or more to it; a pair counts in one block."""
    group = ["label", "size", "tree", "node"]
    placed = materialize(forest(classes.select("key", "label", "v"), least, trees, leaf, spill, rounds))
    n = materialize(placed.groupBy(*group).agg(F.count("*").alias("n")))
    # one tree is enough for a label that it has in one leaf
    whole = classes.groupBy("label", F.size("v").alias("size")).agg(F.count("*").alias("all"))
    one_leaf = n.join(whole, ["label", "size"]).where("n = all").groupBy("label", "size").agg(F.min("tree").alias("only"))
    n = n.join(one_leaf, ["label", "size"], "left").where("n > 1 AND (only IS NULL OR only = tree)").drop("only")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    sized = materialize(placed.join(n, group).withColumn("leaf_id", F.xxhash64(*group)))
    beside = sized.groupBy("key").agg(F.collect_set("leaf_id").alias("leaves")).join(classes.select("key", "copies"), "key")
    sized = sized.withColumn("blocks", F.when(F.col("n") > leaf * 2, blocks).otherwise(1)).join(beside, "key")
    sized = sized.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = sized.select("key", "v", "copies", "leaves", "leaf_id", *group, "block", other.alias("other")).select(
        "key",
        "v",
        "copies",
        "leaves",
        "leaf_id",
        *group,
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    return met.groupBy(*group, "one", "two").applyInPandas(lambda rows: _compare(rows, least), _FOUND)


def near_duplicates(table: DataFrame, least: float = 0.93, **forest_options) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors linked directly), ``component_id`` and ``kept`` of every row of ``table(vec_id, embedding, label)``.

    Rows that repeat a ``vec_id`` count as further copies and come out as often as they came in.
    """
    digest = F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256))
    rows = materialize(vectors(table).withColumn("digest", digest))
    same = rows.where("digest IS NOT NULL").groupBy("label", "digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v"))
    classes = materialize(same.withColumn("key", F.xxhash64("label", "digest")))
    found = materialize(linked(classes.select("key", "label", "copies", "v"), least, **forest_options))
    beside = found.groupBy("key").agg(F.sum("beside").alias("beside"))
    parts = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("key"), "component")
    named = classes.drop("v").join(beside, "key", "left").join(parts, "key", "left").withColumn("component", F.coalesce("component", "key"))
    least_id = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least_id, "component").select("label", "digest", (F.coalesce("beside", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    return rows.select("vec_id", "label", "digest").join(named, ["label", "digest"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
