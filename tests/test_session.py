"""Tables of the shared folder."""

import os
import time

import pytest
from pyspark.sql import functions as F

from factlake.session import CLEANUP_CONF, discard, materialize


def shuffled(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in dirs for _, _, names in os.walk(str(top)) for f in names if f.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    before = shuffled(spark)
    table = materialize(spark.range(5000).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n")))
    until = time.time() + 10
    while shuffled(spark) - before and time.time() < until:  # removed in the background
        time.sleep(0.1)
    assert not shuffled(spark) - before
    assert table.count() == 97 and spark.conf.get(CLEANUP_CONF, None) is None


def test_cleanup_setting_stays_as_it_was(spark):
    spark.conf.set(CLEANUP_CONF, "false")
    try:
        with pytest.raises(Exception):
            materialize(spark.range(1).select(F.raise_error(F.lit("no"))))
        assert spark.conf.get(CLEANUP_CONF) == "false"
    finally:
        spark.conf.unset(CLEANUP_CONF)


def test_discard(spark):
    gone, stays = materialize(spark.range(3)), materialize(spark.range(2))
    discard(gone)
    assert stays.count() == 2
    with pytest.raises(Exception):
        gone.count()
