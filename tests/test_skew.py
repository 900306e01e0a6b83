"""Answers do not change, and work is split, when one key holds a third of all rows."""

from pyspark.sql import functions as F

from factlake.operators import skew


def rows(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    return spark.range(n).select(
        F.col("id").cast("string").alias("rid"), key.alias("k"), ((F.col("id") * 7919) % n).alias("t")
    )


def test_first_per_key_equals_brute_force(spark):
    df = rows(spark)
    best = {}
    for r in df.collect():
        best[r["k"]] = min(best.get(r["k"], (10**9, "")), (r["t"], r["rid"]))
    got = skew.first_per_key(df, ["k"], ["t", "rid"], ["rid"], ["rid"], salts=16).collect()
    assert len(got) == 3000
    assert all(r["first_rid"] == best[r["k"]][1] for r in got)
    assert sum(r["is_first"] for r in got) == len(best)


def test_hot_key_is_spread_over_tasks(spark):
    spread = skew.with_salt(rows(spark), ["rid"], 64).where("k = 'hot'")
    per_salt = [r["count"] for r in spread.groupBy("__salt").count().collect()]
    assert len(per_salt) == 64 and max(per_salt) < 1000 / 10


def test_spread_rows_are_shuffled_once(spark):
    out = skew.first_per_key(rows(spark), ["k"], ["t", "rid"], ["rid"], ["rid"], salts=16)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_lookups_keep_unmatched_and_null_keys(spark):
    left = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "rid string, k string")
    right = spark.createDataFrame([("a", 10)], "k string, v int")
    for got in (
        skew.lookup_unique(left, right, ["k"], ["rid"], 4),
    ):
        assert {r["rid"]: r["v"] for r in got.collect()} == {"1": 10, "2": None, "3": None}
