"""Structured Streaming forms of ingest, append and decide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from factlake import schemas as S
from factlake.operators import store, truth
from factlake.sources import commits


def read_raw_messages(
    spark: SparkSession, path: str, fmt: str = "json", max_files: int = 1000
) -> DataFrame:
    """Stream of raw messages from files; a message bus gives the same columns."""
    return (
        spark.readStream.schema(S.RAW_MESSAGE)
        .option("maxFilesPerTrigger", max_files)
        .format(fmt)
        .load(path)
    )


def read_raw_messages_batch(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(S.RAW_MESSAGE).format(fmt).load(path)


def stream_append_captures(
    facts: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Continuous sink.  A replayed micro-batch replaces its own part."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # read for its bounds, for the write and for the receipt
        try:
            store.append_captures(batch.sparkSession, path, kept, batch_id)
        finally:
            kept.unpersist()

    return start_batches(facts, write, checkpoint, available_now)


def decide_stream(
    facts: DataFrame,
    decisions_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Continuous adjudication.  Anchors live in a table, so duplicates may come arbitrarily late and
    no state grows in the stream.

    Next to the decisions the stream keeps the anchors in comparable form (identity, order, content
    digest), so a batch reads neither the fact table nor old payloads.  The anchors are laid out by a hash of their identity
    (``truth.anchor_part``), and a batch opens only the parts its own identities hash to.  What the batch itself has committed
    is ignored when it decides and replaced when it writes, so a retried batch reproduces itself.  The rows of finished
    batches are merged by size class, so the files that a batch reads do not grow with the number of batches.
    """
    anchors_path = f"{decisions_path.rstrip('/')}-anchors"

    def decide(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist()
        try:
            stored = _before(spark, decisions_path, S.TRUTH_DECISION, batch_id)
            anchors = _before(spark, anchors_path, ANCHOR_ROW, batch_id)
            truth.require_supported(kept)
            open_facts = truth.undecided(kept, stored)
            fresh = truth.decide_incremental(open_facts, stored, kept, anchors).distinct()  # a repeated message is decided once
            overwrite_batch(fresh, decisions_path, batch_id, S.TRUTH_DECISION)
            written = _only(spark, decisions_path, S.TRUTH_DECISION, batch_id)
            made = truth.anchors_of(written, kept).distinct().withColumn("anchor_part", truth.anchor_part())
            overwrite_batch(made, anchors_path, batch_id, ANCHOR_ROW, "anchor_part")
        finally:
            kept.unpersist()

    return start_batches(facts, decide, checkpoint, available_now)


#: A stored anchor with the part that its identity hashes to.
ANCHOR_ROW = T.StructType([*S.TRADE_ANCHOR.fields, T.StructField("anchor_part", T.IntegerType())])


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def overwrite_batch(rows: DataFrame, path: str, batch_id: int, schema: T.StructType, *by: str) -> None:
    """Commit a batch anew, laid out by ``by``, and merge what earlier batches left in small parts."""
    spark = rows.sparkSession
    named = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*_stored(schema).names)
    commits.write(spark, path, named, by=by, batch=batch_id)
    commits.compact(spark, path, _stored(schema), by=by, before=batch_id)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Committed rows with their ``batch_id``."""
    return commits.read(spark, path, _stored(schema))


def _before(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    return commits.read(spark, path, _stored(schema), lambda p: p.batch != batch_id).drop("batch_id")


def _only(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    return commits.read(spark, path, _stored(schema), lambda p: p.batch == batch_id).drop("batch_id")


def start_batches(df: DataFrame, action, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
