"""The write path: messages -> facts -> proof -> decision -> proof, one table write between stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.operators import availability as A
from factlake.operators import ingest, store, truth
from factlake.session import materialize, spread
from factlake.sources import tables


@dataclass(frozen=True)
class Stages:
    """What one pass of the recorder produces.  Each part is computed once and kept."""

    sent: DataFrame
    proof: DataFrame
    decisions: DataFrame
    recorded: DataFrame

    def progress(self, facts: DataFrame) -> DataFrame:
        return progress(facts, self.proof, self.decisions, self.recorded)


def gated(facts: DataFrame, outcomes: DataFrame | None) -> DataFrame:
    """Facts whose write outcome lets them go on to read-back."""
    if outcomes is None:
        return facts
    passing = A.persistence_gate(outcomes).where("gate = 'continue'").select("capture_id")
    return facts.join(passing, "capture_id", "left_semi")


def proven(rows: DataFrame, proof: DataFrame) -> DataFrame:
    """The rows whose fact is proven; where every fact is, nothing needs to be joined.  ``proof`` holds every fact of ``rows``."""
    if proof.where("NOT outcome <=> 'proven'").isEmpty():
        return rows
    return rows.join(proof.where("outcome = 'proven'").select("capture_id"), "capture_id", "left_semi")


def decide_proven(
    sent: DataFrame, proof: DataFrame, stored_facts: DataFrame, stored_decisions: DataFrame
) -> DataFrame:
    """Decisions of the facts that were read back exactly; nothing goes past an unproven fact."""
    return truth.decide_facts(proven(sent, proof), stored_decisions, stored_facts)


def mark_proven(
    sent: DataFrame,
    proof: DataFrame,
    decisions: DataFrame,
    stored_markers: DataFrame,
    clock: Column,
    floor: int | None,
    authorities: S.AuthorityIdentities = A.DEFAULT_AUTHORITIES,
) -> DataFrame:
    """Evidence markers of proven facts and authority markers of their decisions."""
    clocked = proven(sent.select("capture_id", clock.cast("bigint").alias("clock_ns")), proof)
    evidence = A.evidence_candidates(clocked, F.col("clock_ns"), authorities.evidence)
    decided = decisions.select(F.col("subject_capture_id").alias("capture_id"), "policy_version").join(
        clocked, "capture_id"
    )
    authority = A.authority_candidates(
        decided.withColumnRenamed("capture_id", "subject_capture_id"), F.col("clock_ns"), authorities.decision
    )
    return A.record_markers(evidence.unionByName(authority), stored_markers, floor)


def plan_recording(
    facts: DataFrame,
    stored_facts: DataFrame,
    stored_decisions: DataFrame,
    stored_markers: DataFrame,
    clock: Column,
    floor: int | None = None,
    outcomes: DataFrame | None = None,
) -> Stages:
    """One pass over captured facts, without storing it.

    ``stored_facts`` is the table as it is read back after the append.  ``clock`` is the candidate
    time of a row.  A fact whose marker fails keeps its decision.
    """
    sent = gated(facts, outcomes)
    proof = materialize(A.prove_evidence(sent, stored_facts))
    decisions = materialize(decide_proven(sent, proof, stored_facts, stored_decisions))
    recorded = materialize(mark_proven(sent, proof, decisions, stored_markers, clock, floor))
    return Stages(sent, proof, decisions, recorded)


def progress(
    facts: DataFrame, proof: DataFrame, decisions: DataFrame, recorded: DataFrame
) -> DataFrame:
    """One row per captured fact: how far it came.

    The parts are stacked and folded by capture id, so one shuffle with map-side combining replaces
    three joins.
    """
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def part(df: DataFrame, capture_id: str, **given: Column) -> DataFrame:
        return df.select(
            F.col(capture_id).alias("capture_id"),
            given.get("outcome", text).alias("outcome"),
            given.get("category", text).alias("category"),
            given.get("evidence_at", number).alias("evidence_at"),
            given.get("authority_at", number).alias("authority_at"),
            given.get("captured", F.lit(0)).alias("captured"),
        )

    evidence = F.col("kind") == "evidence"
    at = F.col("available_at_ns")
    stacked = (
        part(facts, "capture_id", captured=F.lit(1))
        .unionByName(part(proof, "capture_id", outcome=F.col("outcome")))
        .unionByName(part(decisions, "subject_capture_id", category=F.col("category")))
        .unionByName(
            part(recorded, "capture_id", evidence_at=F.when(evidence, at), authority_at=F.when(~evidence, at))
        )
    )
    names = ("outcome", "category", "evidence_at", "authority_at", "captured")
    return (
        spread(stacked, 4 * facts.count(), "capture_id").groupBy("capture_id")
        .agg(*[F.max(n).alias(n) for n in names])
        .where("captured = 1")
        .select(
            "capture_id",
            F.coalesce("outcome", F.lit("not_sent")).alias("evidence_proof"),
            "category",
            "evidence_at",
            "authority_at",
        )
    )


@dataclass(frozen=True)
class LakePaths:
    facts: str
    decisions: str
    markers: str


def record_captures(
    spark: SparkSession,
    paths: LakePaths,
    raw: DataFrame,
    identities: DataFrame,
    batch_id: int | None = None,
) -> DataFrame:
    """Normalise, append, read back, decide and mark one batch of messages; returns its progress."""
    reference = S.reference_scope(spark)
    facts = store.folded_captures(ingest.normalize_messages(raw, identities, reference))
    store.append_captures(spark, paths.facts, facts, batch_id, folded=True)
    return _recover_folded(spark, paths, facts)


def recover_facts(spark: SparkSession, paths: LakePaths, facts: DataFrame) -> DataFrame:
    """Re-prove facts without appending them again; a second run changes nothing.

    Decisions are stored before their markers are issued, so a stop in between leaves facts that the
    next run finishes.  A fact given twice is one fact.
    """
    return _recover_folded(spark, paths, store.folded_captures(facts))


def _recover_folded(spark: SparkSession, paths: LakePaths, facts: DataFrame) -> DataFrame:
    stored = tables.read_facts(spark, paths.facts)
    markers = store.read_markers(spark, paths.markers)
    floor = A.stored_floor(spark, paths.markers)
    proof = materialize(A.prove_evidence(facts, stored))
    if not proof.where("outcome IN ('mismatch', 'not_unique')").isEmpty():
        raise S.ContractError("INVARIANT_CONFLICT", "read-back differs from the captured fact")
    known = store.read_decisions(spark, paths.decisions)
    decisions = materialize(decide_proven(facts, proof, stored, known))
    store.append_decisions(spark, paths.decisions, decisions)
    recorded = materialize(
        mark_proven(facts, proof, decisions, markers, F.col("received_ns"), floor)
    )
    if not recorded.where("outcome = 'conflict'").isEmpty():
        raise S.ContractError("INVARIANT_CONFLICT", "immutable availability conflict")
    store.append_availability(spark, paths.markers, A.marker_rows(recorded, F.col("available_at_ns")))
    return progress(facts, proof, decisions, recorded)
