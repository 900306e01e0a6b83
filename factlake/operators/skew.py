"""Keyed operators that stay balanced when one key holds a large share of all rows.

Both follow one pattern.  Rows are spread over ``(key, salt)``, where the salt is a hash of the row
id, so a hot key covers ``salts`` tasks.  The distinct ``(key, salt)`` pairs -- at most ``salts`` per
key -- are the only rows that meet per key; their answer is joined back on ``(key, salt)``.  Nothing
is broadcast by hint and no result row is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 256
_SALT = "__salt"


def with_salt(df: DataFrame, row_id: Sequence[str], salts: int = SALTS) -> DataFrame:
    salt = F.pmod(F.xxhash64(*row_id), F.lit(salts).cast("bigint")).cast("int")
    return df.withColumn(_SALT, F.coalesce(salt, F.lit(0)))


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    row_id: Sequence[str],
    carry: Sequence[str],
    prefix: str = "first_",
    salts: int = SALTS,
) -> DataFrame:
    """Attach to every row the ``carry`` columns of the first row of its key, and ``is_first``.

    ``df`` holds exactly ``keys``, ``order`` and ``carry``; the keys are not null.  Both uses of the
    spread rows then need all of its columns, so Spark shuffles (and computes) them once and reads
    that exchange twice.  Only the pre-aggregated pairs cross the network again.
    """
    columns = list(dict.fromkeys([*order, *carry]))
    value = F.struct(*[F.col(c) for c in columns])
    spread = with_salt(df, row_id, salts).repartition(*keys, _SALT)
    pairs = spread.groupBy(*keys, _SALT).agg(F.min(value).alias("__local"))
    per_key = Window.partitionBy(*keys)
    firsts = pairs.select(*keys, _SALT, F.min("__local").over(per_key).alias("__first"))
    joined = spread.join(firsts, [*keys, _SALT])
    is_first = value == F.struct(*[F.col(f"__first.{c}") for c in columns])
    return joined.select(
        *df.columns,
        is_first.alias("is_first"),
        *[F.col(f"__first.{c}").alias(prefix + c) for c in carry],
    )


def lookup_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    salts: int = SALTS,
) -> DataFrame:
    """Left join against a side that has at most one row per key, safe for hot keys on the left.

    Rows whose key is null or unknown keep null right-hand columns.
    """
    spread = with_salt(left, row_id, salts)
    pairs = spread.select(*keys, _SALT).distinct()
    answers = pairs.join(right, list(keys), "left")
    return (
        spread.join(answers, [*keys, _SALT], "left")
        .select(*left.columns, *[c for c in right.columns if c not in keys])
    )


def keep_matching(big: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a large table whose key occurs in a batch; Spark broadcasts the keys where their size allows it."""
    return big.join(keys_of.select(*keys).distinct(), list(keys), "left_semi")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (map-side combined)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One deterministic row per key: the smallest row.  Combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return packed.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def fold_replays(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with ``differs``: whether its rows were anything but exact repeats of one another."""
    row = F.struct(*[c for c in df.columns if c not in keys])
    packed = df.groupBy(*keys).agg(F.min(row).alias("__row"), F.max(row).alias("__last"))
    columns = [F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns]
    return packed.select(*columns, (~F.col("__row").eqNullSafe(F.col("__last"))).alias("differs"))
