"""Hard-negative mining by L2AP-style threshold joins.

Components become ``floor(256 * x)``; a score is the integer inner product.  An anchor's positives are its best rows of the same
label; its negatives, per positive, the best rows of other labels whose score lies in a window below the positive's score.

``threshold_join`` answers, for every query and window [low, high], the ``k`` best rows in it, exactly:

- dimensions are put in order of falling energy and cut into groups of ``GROUP``; rows lie in blocks of one label and one
  band of norms, so a block whose largest norm times the query's stays below the threshold is not visited;
- inside a block the inverted index of a group of dimensions lists the rows that need it: once the norm of what is left of a
  row, times the largest query norm, is below the smallest threshold, the rest of its dimensions is not indexed;
- partial scores are accumulated group by group; a pair goes as soon as its partial score plus the product of both
  remaining norms is below its threshold.  What is left is scored exactly.

Positives start from a threshold that a bounded sample of rows proves to be low enough.  Negative windows start right below
the positive's score and are lowered by ``STEPS`` until they hold enough rows or reach their end.

Rows with a null label, ``vec_id`` or vector, or a null or non-finite component, take no part.  Vectors of different lengths
do not meet; empty vectors score 0.  Of repeated anchors one counts; other repeated rows are candidates each, but no row
meets one of its own ``vec_id``.  Ties go to the smaller ``vec_id``.  An empty table gives no rows; further columns do no harm.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake.llm.topk import _matrix as matrix
from factlake.llm.topk import _scores as exact_scores
from factlake.llm.topk import integers
from factlake.session import materialize

#: Rows and queries that meet in one group at most.
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Dimensions that are indexed and accumulated at once.
GROUP = 8
#: Bands of norms: a factor of the square root of two each.
BANDS_PER_OCTAVE = 2
#: Rows of the sample from which the first thresholds come.
SAMPLE_ROWS = 4096
#: Shares of the positive's score down to which windows are opened, before the end of the window.
STEPS = (95, 88)
#: Room for rounding in bounds, relative.
SLACK = 1e-9
LOWEST = -(1 << 63)
_SIZE = ["size", "label", "band"]


def labelled(table: DataFrame) -> DataFrame:
    """``vec_id``, ``v`` (array of long), ``label``, ``size`` and ``norm`` of the rows that take part."""
    kept = table.where("label IS NOT NULL").select("vec_id", F.struct("embedding", F.col("label").cast("long").alias("label")).alias("own"))
    # ``integers`` knows vec_id and embedding only; the label travels as one more component and is cut off again
    x = F.col("own.embedding").cast("array<double>")
    packed = kept.select("vec_id", F.concat(x, F.array(F.col("own.label") / F.lit(256.0))).alias("embedding"))
    rows = integers(packed).select("vec_id", F.slice("v", F.lit(1), F.size("v") - 1).alias("v"), F.element_at("v", -1).alias("label"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, y: a + y.cast("double") * y.cast("double")))
    return rows.withColumns({"size": F.size("v"), "norm": norm})


class Order:
    """Order of the dimensions by falling energy, for each vector length."""

    def __init__(self, rows: DataFrame):
        def sums(batches):
            for batch in batches:
                part = batch.to_pandas()
                for size, own in part.groupby("size"):
                    yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([(matrix(own["v"]) ** 2).sum(axis=0)], pa.list_(pa.float64()))], ["size", "energy"])

        told = rows.select("size", "v").mapInArrow(sums, "size int, energy array<double>")
        told = told.select("size", F.posexplode("energy").alias("dim", "e")).groupBy("size", "dim").agg(F.sum("e").alias("e"))
        self.of: dict[int, np.ndarray] = {}
        table = told.toPandas()  # one row per dimension and vector length
        for size, own in table.groupby("size"):
            own = own.sort_values(["e", "dim"], ascending=[False, True])
            self.of[int(size)] = own["dim"].to_numpy()

    def apply(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.of[x.shape[1]]] if x.shape[1] in self.of else x


def rests(x: np.ndarray, group: int) -> np.ndarray:
    """Norm of what is left of each row before each group of dimensions, and after the last (0)."""
    starts = np.arange(0, x.shape[1], group)
    square = np.add.reduceat(x * x, starts, axis=1) if len(starts) else np.zeros((len(x), 0))
    left = np.cumsum(square[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([left, np.zeros((len(x), 1))]))


def candidates(q: np.ndarray, low: np.ndarray, x: np.ndarray, group: int = GROUP) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (query, row) that may score ``low`` or more, by index and partial scores, and how many products were taken.

    Rows and queries have their dimensions in order.  No pair that scores ``low`` or more is left out.
    """
    rest_q, rest_x = rests(q, group), rests(x, group)
    most_q, least = rest_q[:, 0].max(initial=0.0), low.min(initial=np.inf)
    slack = SLACK * (1.0 + most_q * rest_x[:, 0].max(initial=0.0))
    partial = np.zeros((len(q), len(x)))
    alive = rest_q[:, :1] * rest_x[:, 0][None, :] >= (low - slack)[:, None]
    work = 0
    for g in range(rest_x.shape[1] - 1):
        # the index of this group: rows that are still wanted and whose rest can still matter
        listed = np.flatnonzero(alive.any(axis=0) & (rest_x[:, g] * most_q >= least - slack if least > 0 else True))
        asked = np.flatnonzero(alive[:, listed].any(axis=1)) if len(listed) else listed
        if not len(asked):
            break
        dims = slice(g * group, (g + 1) * group)
        partial[np.ix_(asked, listed)] += q[asked, dims] @ x[listed, dims].T
        work += len(asked) * len(listed) * (min(x.shape[1], (g + 1) * group) - g * group)
        bound = partial[np.ix_(asked, listed)] + rest_q[asked, g + 1][:, None] * rest_x[listed, g + 1][None, :]
        alive[np.ix_(asked, listed)] &= bound >= (low[asked] - slack)[:, None]
        # a row that the index leaves out stays as it was judged when it was last listed: its partial score stops there,
        # so a later, smaller rest would not bound what it still lacks
    pairs = np.nonzero(alive)
    return pairs[0], pairs[1], work


def best_in_windows(queries: pd.DataFrame, rows: pd.DataFrame, k: int, order: Order) -> tuple[pd.DataFrame, int]:
    """The ``k`` best rows of a block in each window of each query."""
    q, x = (order.apply(matrix(t["v"])) for t in (queries, rows))
    low = np.array([min(w["low"] for w in ws) for ws in queries["windows"]], np.float64)
    i, j, work = candidates(q, np.where(low <= float(LOWEST), -np.inf, low), x)
    ids, vec = queries["query_id"].to_numpy(), rows["vec_id"].to_numpy()
    other = ids[i] != vec[j]
    i, j = i[other], j[other]
    score = np.zeros(len(i), np.int64)
    exact = [t["v"].tolist() for t in (queries, rows)]
    for a in range(0, len(i), 1 << 14):
        p, r = i[a : a + (1 << 14)], j[a : a + (1 << 14)]
        score[a : a + (1 << 14)] = _pair_scores(q[p], x[r], exact, p, r)
    out = []
    # pairs of one query come one after another
    edges = np.searchsorted(i, np.arange(len(queries) + 1))
    for n, windows in enumerate(queries["windows"]):
        own = slice(edges[n], edges[n + 1])
        s, v = score[own], vec[j[own]]
        for w in windows:
            fits = np.flatnonzero((s >= w["low"]) & (s <= w["high"]))
            if len(fits) > k:
                least = np.partition(s[fits], len(fits) - k)[len(fits) - k]
                fits = fits[s[fits] >= least]
            fits = fits[np.lexsort((v[fits], -s[fits].astype(object) if len(fits) and s[fits].min() == LOWEST else -s[fits]))][:k]
            out.append(pd.DataFrame({"query_id": ids[n], "window": w["window"], "vec_id": v[fits], "score": s[fits]}))
    found = pd.concat(out) if out else pd.DataFrame({"query_id": [], "window": [], "vec_id": [], "score": []})
    return found.astype(np.int64), work


def _pair_scores(q: np.ndarray, x: np.ndarray, exact: list, p: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Scores of pairs: in doubles while they hold them exactly, else one by one as integers."""
    bound = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * max(1, q.shape[1])
    if bound < 2**53:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    return np.array([exact_scores([exact[0][a]], [exact[1][b]])[0, 0] for a, b in zip(p, r)], np.int64)


def threshold_join(index: DataFrame, queries: DataFrame, same_label: bool, k: int, order: Order, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id``, ``window``, ``vec_id``, ``score``: the ``k`` best rows of ``index`` in each window of each query.

    ``index`` comes from ``banded``.  ``queries`` has ``query_id``, ``v``, ``label``, ``size``, ``norm`` and ``windows`` (``window``, ``low``,
    ``high``); a query meets the rows of its own label, or those of all others.
    """
    blocks = index.groupBy(*_SIZE).agg(F.max("norm").alias("top"), F.count("*").alias("n"))
    blocks = blocks.withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int"))
    low = F.array_min(F.transform("windows", lambda w: w["low"]))
    asked = queries.withColumn("least", low).withColumnRenamed("label", "q_label")
    met = F.col("label") == F.col("q_label") if same_label else F.col("label") != F.col("q_label")
    reach = F.col("least").cast("double") <= F.col("top") * F.col("norm") * (1 + SLACK) + SLACK
    visits = asked.select("query_id", "q_label", "size", "norm", "least").join(blocks, "size").where(met & reach)
    shared = visits.groupBy(*_SIZE).agg(F.count("*").alias("n_queries"))
    shared = shared.withColumn("chunks", F.ceil(F.col("n_queries") / QUERY_ROWS).cast("int")).join(blocks.select(*_SIZE, "parts"), _SIZE)
    shared = materialize(shared.select(*_SIZE, "chunks", "parts"))
    key = [*_SIZE, "part", "chunk"]
    none = F.lit(None).cast("array<struct<window:int,low:bigint,high:bigint>>")
    part = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("parts")).cast("int")
    left = index.join(shared, _SIZE).withColumns({"part": part, "chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))})
    left = left.select(*key, F.lit(0).alias("is_query"), F.col("vec_id").alias("id"), "v", none.alias("windows"))
    chunk = F.pmod(F.xxhash64("query_id", F.lit(6)), F.col("chunks")).cast("int")
    right = visits.select("query_id", *_SIZE).join(shared, _SIZE).withColumns({"chunk": chunk, "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    right = right.select(*key, "query_id").join(queries.select("query_id", "v", "windows"), "query_id")
    right = right.select(*key, F.lit(1).alias("is_query"), F.col("query_id").alias("id"), "v", "windows")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        is_query = rows["is_query"] == 1
        own, block = rows[is_query].rename(columns={"id": "query_id"}), rows[~is_query].rename(columns={"id": "vec_id"})
        return best_in_windows(own, block, k, order)[0]

    found = left.unionByName(right).groupBy(*key).applyInPandas(run, "query_id long, window long, vec_id long, score long")
    rank = Window.partitionBy("query_id", "window").orderBy(F.desc("score"), "vec_id")  # at most k rows a block
    return found.withColumn("rank", F.row_number().over(rank).cast("int")).where(F.col("rank") <= k)


def banded(rows: DataFrame) -> DataFrame:
    """Rows with ``band``, by the size of their norm."""
    band = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * BANDS_PER_OCTAVE)).otherwise(-1).cast("int")
    return rows.withColumn("band", band)


def _windows(low, high):
    return F.array(F.struct(F.lit(0).cast("int").alias("window"), low.cast("long").alias("low"), high.cast("long").alias("high")))


def _distinct_queries(rows: DataFrame) -> DataFrame:
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v", "size", "norm")).alias("r"))
    return one.select(F.col("vec_id").alias("query_id"), "r.*")


def mine(table: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 5, least_percent: int = 80, sample_rows: int = SAMPLE_ROWS, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` for the rows of ``anchors``.

    A negative's score is at most the positive's and at least ``least_percent`` of it.
    """
    index = materialize(banded(labelled(table)))
    order = Order(index)
    asked = materialize(_distinct_queries(labelled(anchors)))
    top = F.lit((1 << 63) - 1)

    # the k-th best row of a sample bounds the k-th best of all from below
    share = min(1.0, sample_rows / max(1, index.count()))
    drawn = index.where(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    anything = asked.withColumn("windows", _windows(F.lit(LOWEST), top))
    first = threshold_join(drawn, anything, True, n_positives, order).where(F.col("rank") == n_positives)
    bound = first.select("query_id", F.col("score").alias("bound"))
    bounded = materialize(asked.join(bound, "query_id", "left").withColumn("windows", _windows(F.coalesce("bound", F.lit(LOWEST)), top)).drop("bound"))
    positives = materialize(threshold_join(index, bounded, True, n_positives, order).select("query_id", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    # a positive below zero has an empty window
    open_ = positives.where("positive_score >= 0")
    found = None
    for percent in (*(s for s in steps if s > least_percent), least_percent):
        score = F.col("positive_score").cast("decimal(38,0)")
        low = F.ceil(score * percent / F.lit(100)).cast("long")
        spans = open_.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct(F.col("window").cast("int").alias("window"), low.alias("low"), F.col("positive_score").alias("high")))).alias("windows"))
        queries = materialize(asked.join(spans, "query_id"))  # at most n_positives windows a query
        got = materialize(threshold_join(index, queries, False, n_negatives, order))
        full = got.groupBy("query_id", "window").agg(F.count("*").alias("n"))
        full = full.where(F.lit(percent == least_percent) | (F.col("n") >= n_negatives)).select("query_id", "window")
        done = got.join(full, ["query_id", "window"], "left_semi")
        found = done if found is None else found.unionByName(done)
        open_ = materialize(open_.join(full, ["query_id", "window"], "left_anti"))
        if open_.isEmpty():
            break
    named = found.join(positives.withColumn("window", F.col("window").cast("long")), ["query_id", "window"])
    return named.select(F.col("query_id").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
