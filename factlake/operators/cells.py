"""Interval index over the boundaries that a table of requests names.

The distinct window bounds of all requests cut an axis into cells, the distinct cutoffs cut availability into cells.  No cell
is cut by any request: a window is a whole run of cells, and "available by the cutoff" is a prefix of cells.  A run is the
union of at most two dyadic nodes a level, so requests and rows meet by equality of ``(level, node)``, and a row meets
only requests whose cover holds its cell.

The bounds travel as two sorted lists of at most two numbers a request; requests are the small side of a backtest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Line:
    """Sorted bounds on an axis; cell ``k`` holds the instants with exactly ``k`` bounds at or before them."""

    bounds: tuple[int, ...]

    @property
    def levels(self) -> int:
        return max(1, len(self.bounds).bit_length())

    def cell(self, instant: Column) -> Column:
        """Cell of an instant, by binary search in a constant list; null for a null instant."""
        if not self.bounds:
            return F.when(instant.isNotNull(), F.lit(0).cast("bigint"))
        known = F.split(F.lit(",".join(map(str, self.bounds))), ",").cast("array<bigint>")
        steps = F.array(*[F.lit(1 << k).cast("bigint") for k in reversed(range(self.levels))])

        def step(at: Column, size: Column) -> Column:
            return F.when(F.get(known, (at + size - 1).cast("int")) <= instant, at + size).otherwise(at)

        return F.when(instant.isNotNull(), F.aggregate(steps, F.lit(0).cast("bigint"), step))


def line_of(requests: DataFrame, *columns: str) -> Line:
    """Distinct values of the columns over all requests."""
    found = requests.select(F.explode(F.array(*columns)).alias("b")).where("b IS NOT NULL").distinct()
    return Line(tuple(sorted(r["b"] for r in found.collect())))


def _shift(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level)


def cover(ranges: DataFrame, first: Column, last: Column, levels: int) -> DataFrame:
    """``ranges`` with one row per dyadic node of the cells ``first`` to ``last``: ``level`` and ``node``."""
    low, end = first, last + 1
    unit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("level"))
    a, b = _shift(low + unit - 1, F.col("level")), _shift(end, F.col("level"))
    left = F.when((a % 2 == 1) & (a < b), a)
    right = F.when((b % 2 == 1) & (a + a % 2 < b), b - 1)
    per_level = ranges.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    return per_level.withColumn("node", F.explode(F.array_compact(F.array(left, right))))


def highest(covers: DataFrame) -> int:
    """The highest level that a cover names; short windows need few levels."""
    return covers.agg(F.max("level")).first()[0] or 0


def nodes_of(rows: DataFrame, cell: Column, levels: int) -> DataFrame:
    """``rows`` with one row per level: ``level`` and the ``node`` that holds the row's cell."""
    per_level = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    return per_level.withColumn("node", _shift(cell, F.col("level")))


def meet(rows: DataFrame, cell: Column, covers: DataFrame, levels: int) -> DataFrame:
    """Rows joined with the covers that hold their cell; a row is copied only to nodes that some cover names."""
    return nodes_of(rows, cell, levels).join(covers, ["level", "node"])


def prefix_sums(parts: DataFrame, covers: DataFrame, group: list[str], rank: str, asked: str, summed: list[str], keep: list[str], passes: Column, named: tuple[str, ...] = ("level", "node")) -> DataFrame:
    """Per row of ``covers`` and group: the sums of ``parts`` under its node whose ``rank`` is at most ``asked``.

    ``parts`` has ``level``, ``node``, ``group``, ``rank`` and the columns ``summed``, one row per combination; ``covers`` has ``level``,
    ``node``, ``asked`` and ``keep``; both may name their nodes by further columns (``named``).  Running sums along ``rank`` are taken once per node and group, and the questions are put
    into the same line, so no question meets more than its place in it.  A line has at most a row per rank and question.
    """
    at = [*named, *group]
    steps = parts.withColumn("__order", F.lit(0))
    groups = parts.select(*at).distinct()
    questions = covers.join(groups, list(named)).where(passes).select(*at, F.col(asked).alias(rank)).distinct()
    questions = questions.select(*at, rank, *[F.lit(0).cast("bigint").alias(c) for c in summed], F.lit(1).alias("__order"))
    upto = Window.partitionBy(*at).orderBy(rank, "__order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = steps.select(*at, rank, *summed, "__order").unionByName(questions)
    answers = line.select(*at, rank, "__order", *[F.sum(c).over(upto).alias(c) for c in summed]).where("__order = 1").drop("__order")
    asked_again = covers.select(*named, F.col(asked).alias(rank), *keep)
    return asked_again.join(answers, [*named, rank]).where(passes)


def folded(rows: DataFrame, keys: list[str], summed: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in summed])

