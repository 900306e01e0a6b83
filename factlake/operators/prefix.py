"""Cutting a globally ordered set into blocks, for running sums and maxima without one big window."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def default_blocks(df: DataFrame) -> int:
    return max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def block_boundaries(df: DataFrame, column: str, blocks: int | None = None) -> list[float]:
    """Fewer than ``blocks`` boundaries at approximate quantiles of the distinct values.

    This runs one aggregate and brings back ``blocks`` numbers.  They steer balance only: any
    boundaries give the same results.
    """
    blocks = blocks or default_blocks(df)
    if blocks <= 1:
        return []
    q = [i / blocks for i in range(1, blocks)]
    found = df.select(column).distinct().agg(F.percentile_approx(column, q, 10_000).alias("q"))
    return sorted({float(x) for x in found.first()["q"] or []})


def into_blocks(df: DataFrame, column: str, boundaries: list[float]) -> DataFrame:
    """Adds ``block``, never decreasing in ``column``; equal values share a block.

    The lookup is a binary search on the value as a double.  Rounding is monotone, so it can move a
    boundary but never swap two rows.
    """
    if not boundaries:
        return df.withColumn("block", F.lit(0.0))
    cut = Bucketizer(
        splits=[float("-inf"), *boundaries, float("inf")],
        inputCol="__cut",
        outputCol="block",
        handleInvalid="keep",
    )
    return cut.transform(df.withColumn("__cut", F.col(column).cast("double"))).drop("__cut")
