"""The recorder as one stream: facts, decisions and markers of a micro-batch, and a ledger row per fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from factlake import schemas as S
from factlake.operators import availability as A
from factlake.operators import ingest, store, truth
from factlake.plans import recording
from factlake.session import materialize
from factlake.sources import tables
from factlake.streaming import streams

#: What became of one fact of a batch; ``defect`` is null where nothing failed.
LEDGER = T.StructType(
    [
        T.StructField("capture_id", T.StringType()),
        T.StructField("evidence_proof", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("evidence_at", T.LongType()),
        T.StructField("authority_at", T.LongType()),
        T.StructField("defect", T.StringType()),
    ]
)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows with their ``batch_id``; a batch is there in full or not at all."""
    return streams.read_batches(spark, path, LEDGER)


def record_batch(
    spark: SparkSession, paths: recording.LakePaths, ledger: str, raw: DataFrame, identities: DataFrame, batch_id: int
) -> None:
    """Record one micro-batch; a fact that fails is kept out of the steps after its failure, and the others go on.

    ``content_conflict``: the id came, or is stored, with other content; nothing of it is written.  ``mismatch`` and
    ``not_unique``: the read-back differs; no decision and no marker.  ``unsupported``: no rule covers its type; it keeps
    its evidence marker and has no decision.  ``marker_conflict``: a stored marker says otherwise; it is left as it is.
    Unsound stored anchors still stop the batch: they are a fault of the lake and not of a fact.

    The ledger is written last.  A batch that is in it is done and is not run again; one that stopped between two writes
    runs again as a whole, and finds what it wrote by key.
    """
    if not read_ledger(spark, ledger).where(F.col("batch_id") == batch_id).isEmpty():
        return
    facts = materialize(ingest.normalize_messages(raw, identities, S.reference_scope(spark)).select(*S.FACT_COLUMNS))
    stored = tables.read_facts(spark, paths.facts)
    bounds = facts.agg(F.min("received_ns"), F.max("received_ns")).first()
    if bounds[0] is not None:
        stored = tables.in_received_range(stored, bounds[0], bounds[1], closed=True)
    clashes = materialize(store.conflicting_captures(facts, stored).select("capture_id").distinct())
    sound = store.folded_captures(facts.join(clashes, "capture_id", "left_anti"))
    store.append_captures(spark, paths.facts, sound, batch_id, folded=True)

    stored = tables.read_facts(spark, paths.facts)
    markers = store.read_markers(spark, paths.markers)
    floor = A.stored_floor(spark, paths.markers)
    proof = materialize(A.prove_evidence(sound, stored))
    odd = truth.unsupported_facts(sound).select("capture_id")
    known = store.read_decisions(spark, paths.decisions)
    decisions = materialize(recording.decide_proven(sound.join(odd, "capture_id", "left_anti"), proof, stored, known))
    store.append_decisions(spark, paths.decisions, decisions)
    recorded = materialize(recording.mark_proven(sound, proof, decisions, markers, F.col("received_ns"), floor))
    store.append_availability(spark, paths.markers, A.marker_rows(recorded, F.col("available_at_ns")))

    def failed(rows: DataFrame, defect) -> DataFrame:
        return rows.select("capture_id", defect.alias("defect"))

    defects = (
        failed(clashes, F.lit("content_conflict"))
        .unionByName(failed(proof.where("outcome IN ('mismatch', 'not_unique')"), F.col("outcome")))
        .unionByName(failed(odd, F.lit("unsupported")))
        .unionByName(failed(recorded.where("outcome = 'conflict'"), F.lit("marker_conflict")))
    )
    first = defects.groupBy("capture_id").agg(F.min("defect").alias("defect"))
    kept = recorded.where("outcome != 'conflict'")
    rows = recording.progress(facts, proof, decisions, kept).join(first, "capture_id", "left")
    streams.overwrite_batch(rows.select(*LEDGER.names), ledger, batch_id, LEDGER)


def record_stream(
    messages: DataFrame,
    paths: recording.LakePaths,
    ledger: str,
    identities: DataFrame,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """``record_batch`` for every micro-batch of a stream of raw messages."""

    def record(batch: DataFrame, batch_id: int) -> None:
        record_batch(batch.sparkSession, paths, ledger, batch, identities, batch_id)

    return streams.start_batches(messages, record, checkpoint, available_now)
