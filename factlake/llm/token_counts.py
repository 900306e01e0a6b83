"""Exact histogram of encoded lengths, with suffix sums that answer every context limit.

Documents are counted by their number of tokens before anything is shuffled.  The suffix sums are taken
inside blocks of ``BLOCK`` lengths and carried across by one row per block.  A null text has length 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake.llm.bpe import encoder
from factlake.llm.text import documents

BLOCK = 1024


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``length`` and ``n_docs``, one row per length that occurs."""

    def count(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            lengths, n = np.unique(np.diff(enc.encode(batch.column("text"))[1]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(lengths.astype(np.int64)), pa.array(n.astype(np.int64))], ["length", "n_docs"])

    counted = documents(docs).select("text").mapInArrow(count, "length long, n_docs long")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds ``docs_from`` and ``tokens_from`` (documents of at least this length, and their tokens) and both totals."""
    h = histogram.withColumns({"block": F.floor(F.col("length") / BLOCK), "tokens": F.col("length") * F.col("n_docs")})
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    all_blocks = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0)
    carried = blocks.select("block", F.coalesce(F.sum("d").over(later), zero).alias("d"), F.coalesce(F.sum("t").over(later), zero).alias("t"), F.sum("d").over(all_blocks).alias("docs_total"), F.sum("t").over(all_blocks).alias("tokens_total"))
    own = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    return h.join(carried, "block").select(
        "length",
        "n_docs",
        (F.sum("n_docs").over(own) + F.col("d")).alias("docs_from"),
        (F.sum("tokens").over(own) + F.col("t")).alias("tokens_from"),
        "docs_total",
        "tokens_total",
    )


def limit_table(histogram: DataFrame) -> DataFrame:
    """Per length, taken as a context limit: what is below and what truncation there keeps.

    ``docs_up_to``/``docs_total`` gives quantiles; ``truncated_tokens`` is the sum of min(length, limit).  For a
    limit that no document has, take the row of the next greater length (see ``at_limits``).
    """
    return suffix_sums(histogram).select(
        "length",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("docs_total") - F.col("docs_from") + F.col("n_docs")).alias("docs_up_to"),
        "docs_total",
        "tokens_total",
        (F.col("tokens_total") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_tokens"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit``, ``docs_cut`` (longer documents) and ``truncated_tokens`` for any limits, in one pass over the histogram."""
    n, length = F.col("n_docs"), F.col("length")
    sums = [
        F.struct(
            F.lit(x).cast("long").alias("context_limit"),
            F.coalesce(F.sum(F.when(length > x, n)), F.lit(0)).alias("docs_cut"),
            F.coalesce(F.sum(F.least(length, F.lit(x)) * n), F.lit(0)).alias("truncated_tokens"),
        )
        for x in limits
    ]
    return histogram.agg(F.array(*sums).alias("rows")).select(F.inline("rows"))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """``share`` and ``length``: the smallest length that at least this share of the documents does not exceed."""
    table = limit_table(histogram)
    picks = [F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("docs_up_to") >= F.lit(float(s)) * F.col("docs_total"), F.col("length"))).alias("length")) for s in shares]
    return table.agg(F.array(*picks).alias("rows")).select(F.inline("rows"))
