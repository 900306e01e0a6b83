"""Exact top-k by integer inner product with a pivot-distance index.

Components become ``floor(256 * x)`` (beyond the range of a long: its end).  Every vector is keyed by its nearest pivot and its
distance to it; the vectors of a pivot are cut by distance into annuli, each with its bounds and its largest norm.  For a query q
at distance d of a pivot p, the triangle inequality bounds the score of any x of an annulus [low, high] with |x| <= N three ways:
q.x <= q.p + |q| high, q.x <= |q| N, and q.x <= (|q|^2 + N^2 - g^2) / 2 for g = max(0, d - high, low - d).  The least of
them is the annulus' bound.  The first round searches the annuli of highest bound among the pivots of highest product until they
hold ``first_rows`` vectors, which gives a k-th score; the second opens the pivots, and of these the annuli, whose bound
reaches that score, and no other.  Pivots are drawn from the rows by hash, half the root of their number and at most
``MAX_PIVOTS``, which bounds what reaches every task; annuli and queries meet in groups of about ``annulus_rows`` times
``QUERY_ROWS`` rows, however many there are of either.  On vectors without clusters the bounds leave nearly everything open.

Rows whose vector is null, or holds null or non-finite components, or whose ``vec_id`` is null, take no part; empty
vectors score 0.  Vectors of another length than the most common one are searched among their own length.
Repeated ``vec_id`` rows are candidates each; ties go to the smaller ``vec_id``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake.session import materialize

#: Few and many pivots; in between, half the root of the number of rows.
MIN_PIVOTS, MAX_PIVOTS = 16, 16384
ANNULUS_ROWS = 1024
QUERY_ROWS = 2048
FIRST_ROWS = 1024
#: Room for rounding in bounds, relative to the squared norms.
SLACK = 1e-9


def integers(table: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` (array of long) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), bad.alias("bad")).where("vec_id IS NOT NULL AND x IS NOT NULL AND NOT bad")
    return rows.select("vec_id", F.transform("x", lambda y: F.floor(y * 256).cast("long")).alias("v"))


def _matrix(column) -> np.ndarray:
    rows = column.tolist()
    return np.array(rows, dtype=np.float64).reshape(len(rows), -1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, square))


def _scores(queries: list, rows: list) -> np.ndarray:
    """Exact integer inner products: in doubles while they hold them exactly, else with Python's integers."""
    q, r = np.array(queries, np.int64).reshape(len(queries), -1), np.array(rows, np.int64).reshape(len(rows), -1)
    if q.shape[1] == 0:
        return np.zeros((len(q), len(r)), np.int64)
    bound = float(np.abs(q.astype(float)).max()) * float(np.abs(r.astype(float)).max()) * q.shape[1]
    if bound < 2**53:
        return (q.astype(np.float64) @ r.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ r.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> pd.DataFrame:
    order = np.lexsort((vec, -score.astype(np.float64), query)) if np.abs(score).max(initial=0) < 2**53 else np.array(sorted(range(len(vec)), key=lambda i: (query[i], -int(score[i]), vec[i])), dtype=np.int64)
    query, vec, score = query[order], vec[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
    good = place < k
    return pd.DataFrame({"query_id": query[good], "vec_id": vec[good], "score": score[good]})


def build_index(rows: DataFrame, n_pivots: int | None = None, annulus_rows: int = ANNULUS_ROWS):
    """Rows with ``pivot``, ``distance``, ``norm`` and ``annulus``; the annuli with bounds and counts; pivots by vector length; their cells."""
    sized = rows.withColumn("size", F.size("v"))
    counts = {r["size"]: r["count"] for r in sized.groupBy("size").count().collect()}  # one row per vector length
    total = max(1, sum(counts.values()))
    n_pivots = n_pivots or min(MAX_PIVOTS, max(MIN_PIVOTS, int(total**0.5 / 2)))
    share = Window.partitionBy("size").orderBy(F.xxhash64("vec_id"), "vec_id")
    drawn = sized.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < float(1 << 30) * min(1.0, 64.0 * n_pivots / total))
    picked = drawn.withColumn("k", F.row_number().over(share)).where(F.col("k") <= n_pivots).select("size", "v").collect()
    pivots = {size: _matrix(pd.Series([r["v"] for r in picked if r["size"] == size] or [[0] * size])) for size in counts}

    def assign(batches):
        for batch in batches:
            part = batch.to_pandas()
            for size, own in part.groupby("size", sort=False):
                x = _matrix(own["v"])
                d = _distances(x, pivots[size])
                near = d.argmin(axis=1)
                exact = np.sqrt(((x - pivots[size][near]) ** 2).sum(axis=1))
                own = own.assign(pivot=near.astype(np.int32), distance=exact, norm=np.sqrt((x * x).sum(axis=1)))
                yield pa.RecordBatch.from_pandas(own[_INDEXED.names], schema=_INDEXED, preserve_index=False)

    keyed = materialize(sized.mapInArrow(assign, "vec_id long, v array<long>, size int, pivot int, distance double, norm double"))
    cells = keyed.groupBy("size", "pivot").agg(F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high"), F.max("norm").alias("norm"))
    cells = materialize(cells)
    # annuli of about equal counts: a pivot's distances are cut at quantiles
    ends = cells.select("size", "pivot", "low", "high")
    fine = keyed.join(ends, ["size", "pivot"]).withColumn("slot", F.when(F.col("high") > F.col("low"), F.floor((F.col("distance") - F.col("low")) / (F.col("high") - F.col("low")) * 4095)).otherwise(0))
    slots = fine.groupBy("size", "pivot", "slot").agg(F.count("*").alias("in_slot"))
    upto = Window.partitionBy("size", "pivot").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows per pivot
    cut = slots.withColumn("annulus", F.floor(F.coalesce(F.sum("in_slot").over(upto), F.lit(0)) / annulus_rows)).select("size", "pivot", "slot", "annulus")
    index = materialize(fine.join(cut, ["size", "pivot", "slot"]).select("vec_id", "v", "size", "pivot", "distance", "norm", "annulus"))
    annuli = index.groupBy("size", "pivot", "annulus").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.max("norm").alias("norm"), F.count("*").alias("n"))
    return index, annuli, pivots, cells


def _bound(dot, d, q, low, high, norm, least, most):
    """Highest score of a vector at distance ``low`` to ``high`` of a pivot and of at most ``norm``, and some room; columns or arrays."""
    gap = most(d - high, low - d, 0 * d)
    return least(dot + q * high, q * norm, (q * q + norm * norm - gap * gap) / 2) + SLACK * (q * q + norm * norm) + SLACK


_INDEXED = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("size", pa.int32()), ("pivot", pa.int32()), ("distance", pa.float64()), ("norm", pa.float64())])


def _search(index: DataFrame, visits: DataFrame, queries: DataFrame, k: int, annulus_rows: int) -> DataFrame:
    """The ``k`` best rows of each query among the annuli that ``visits(query_id, size, pivot, annulus, n)`` names with their counts."""
    cell = ["size", "pivot", "annulus"]
    asked = visits.groupBy(*cell).agg(F.count("*").alias("n_queries"), F.max("n").alias("n"))
    asked = asked.withColumn("chunks", F.ceil(F.col("n_queries") / QUERY_ROWS).cast("int")).withColumn("parts", F.ceil(F.col("n") / annulus_rows).cast("int"))
    # a long run of equal distances is one annulus of several parts
    split = index.select("vec_id", "v", *cell).join(asked, cell).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    left = split.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*cell, "part", "chunk", F.lit(0).alias("is_query"), F.col("vec_id").alias("id"), "v")
    wanted = visits.drop("n").join(asked.select(*cell, "chunks", "parts"), cell).withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
    wanted = wanted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("parts") - 1).cast("long"))))
    right = wanted.join(queries.select(F.col("vec_id").alias("query_id"), "v"), "query_id").select(*cell, "part", "chunk", F.lit(1).alias("is_query"), F.col("query_id").alias("id"), "v")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        q, r = rows[rows["is_query"] == 1].drop_duplicates("id"), rows[rows["is_query"] == 0]
        out = []
        ids = r["id"].to_numpy()
        score = _scores(q["v"].tolist(), r["v"].tolist())
        for i, query in enumerate(q["id"].tolist()):
            own = ids != query
            s, v = score[i][own], ids[own]
            if len(s) > k:
                near = s >= np.partition(s, len(s) - k)[len(s) - k]
                s, v = s[near], v[near]
            out.append(_best(np.full(len(v), query), v, s, k))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(np.int64)

    return left.union(right).groupBy(*cell, "part", "chunk").applyInPandas(run, "query_id long, vec_id long, score long")


def top_k(table: DataFrame, queries: DataFrame, k: int = 5, n_pivots: int | None = None, annulus_rows: int = ANNULUS_ROWS, first_rows: int = FIRST_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` rows of ``table`` with the highest scores for each distinct row of ``queries``, itself left out."""
    return _ranked(search(table, queries, k, n_pivots, annulus_rows, first_rows)[0], k)


def search(table: DataFrame, queries: DataFrame, k: int = 5, n_pivots: int | None = None, annulus_rows: int = ANNULUS_ROWS, first_rows: int = FIRST_ROWS) -> tuple[DataFrame, DataFrame]:
    """What ``top_k`` ranks, and the annuli that each query visits with the rows they hold (``n``)."""
    rows = materialize(integers(table))
    asked = materialize(integers(queries).dropDuplicates(["vec_id"]))
    index, annuli, pivots, cells = build_index(rows, n_pivots, annulus_rows)
    annuli = materialize(annuli)
    at = {(r["size"], r["pivot"]): r for r in cells.collect()}  # at most MAX_PIVOTS for a vector length
    enough = max(first_rows, k + 1)

    def cells_of(size):
        own = [at.get((size, p)) for p in range(len(pivots[size]))]
        value = lambda name: np.array([0.0 if r is None else r[name] for r in own])
        return value("n"), value("low"), value("high"), value("norm")

    def measure(batches):
        """The pivots a query opens: those of highest product while the score is unknown, else those whose bound reaches it."""
        for batch in batches:
            part = batch.to_pandas()
            part["size"] = part["v"].map(len)
            for size, own in part.groupby("size", sort=False):
                if size not in pivots:
                    continue
                n, low, high, norm = cells_of(size)
                x = _matrix(own["v"])
                q = np.sqrt((x * x).sum(axis=1))[:, None]
                d, dot = _distances(x, pivots[size]), x @ pivots[size].T
                if own["score"].isna().all():
                    order = np.argsort(-dot, axis=1, kind="stable")
                    before = np.cumsum(n[order], axis=1) - n[order]
                    opened = np.zeros(dot.shape, bool)
                    np.put_along_axis(opened, order, before < enough, axis=1)
                else:
                    least, most = lambda *v: np.minimum.reduce(np.broadcast_arrays(*v)), lambda *v: np.maximum.reduce(np.broadcast_arrays(*v))
                    reach = _bound(dot, d, q, low[None, :], high[None, :], norm[None, :], least, most)
                    opened = (reach >= own["score"].to_numpy(np.float64)[:, None]) | own["score"].isna().to_numpy()[:, None]
                i, j = np.nonzero(opened & (n > 0)[None, :])
                ids, score = own["vec_id"].to_numpy(), own["score"].to_numpy(np.float64)
                columns = [ids[i], np.full(len(i), size, np.int32), j.astype(np.int32), d[i, j], dot[i, j], q[i, 0]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(score[i], from_pandas=True)], ["query_id", "size", "pivot", "d", "dot", "q", "score"])

    near = "query_id long, size int, pivot int, d double, dot double, q double, score double"

    def reach(open_pivots: DataFrame) -> DataFrame:
        c = F.col
        return open_pivots.join(annuli, ["size", "pivot"]).withColumn("bound", _bound(c("dot"), c("d"), c("q"), c("low"), c("high"), c("norm"), F.least, F.greatest))

    visit = ["query_id", "size", "pivot", "annulus"]
    first = reach(asked.withColumn("score", F.lit(None).cast("double")).mapInArrow(measure, near))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("bound"), "pivot", "annulus").rowsBetween(Window.unboundedPreceding, -1)
    first = first.withColumn("before", F.coalesce(F.sum("n").over(nearest), F.lit(0))).where(F.col("before") < enough)
    first = materialize(first.select(*visit, "n"))
    best = materialize(_ranked(_search(index, first, asked, k, annulus_rows), k))

    # a query with fewer than k rows so far has no score to reach, and opens everything
    kth = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("score"))
    known = asked.join(kth, "vec_id")
    unknown = asked.join(kth, "vec_id", "left_anti").withColumn("score", F.lit(float("-inf")))
    second = reach(known.unionByName(unknown).mapInArrow(measure, near)).where(F.col("bound") >= F.col("score"))
    second = materialize(second.select(*visit, "n").join(first.select(*visit), visit, "left_anti"))
    return best.drop("rank").union(_search(index, second, asked, k, annulus_rows)), first.union(second)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
