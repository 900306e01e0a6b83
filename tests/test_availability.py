import hashlib
import json
import random

import pytest
from frames import accepted, decisions, facts, marker, markers, observation
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.operators import availability as A

DDL = "kind string, capture_id string, policy_version string, candidate_ns bigint, source_authority_identity string"


def candidates(spark, rows):
    known = S.AuthorityIdentities()
    return spark.createDataFrame(
        [(k, c, None if k == "evidence" else S.TRUTH_POLICY, t, known.evidence if k == "evidence" else known.decision) for k, c, t in rows],
        DDL,
    )


def recurrence(rows, floor):
    order = sorted(rows, key=lambda r: (r[2], r[0] != "evidence", r[1]))
    out, last = {}, floor
    for kind, cid, t in order:
        last = t if last is None else max(t, last + 1)
        out[(kind, cid)] = last
    return out


@pytest.mark.parametrize("floor", [None, 0, 50, 10_000])
@pytest.mark.parametrize("spread", [1, 40, 100_000])
def test_proof_times_follow_the_recurrence(spark, floor, spread):
    rng = random.Random(spread)
    rows = [(k, f"c{i}", rng.randrange(spread)) for i in range(150) for k in ("evidence", "authority")]
    got = A.assign_proof_times(candidates(spark, rows), floor, blocks=7).collect()
    assert {(r["kind"], r["capture_id"]): r["available_at_ns"] for r in got} == recurrence(rows, floor)


@pytest.mark.parametrize(("floor", "times", "want"), [(100, [90], [101]), (100, [100, 100], [101, 102]), (900, [100], [901])])
def test_published_clock_cases(spark, floor, times, want):
    rows = [("evidence", f"c{i}", t) for i, t in enumerate(times)]
    got = A.assign_proof_times(candidates(spark, rows), floor).collect()
    assert sorted(r["available_at_ns"] for r in got) == want


def test_one_instant_may_hold_a_third_of_all_markers(spark):
    rows = [("evidence", f"c{i}", 500 if i % 3 == 0 else i) for i in range(3000)]
    got = A.assign_proof_times(candidates(spark, rows), 10, blocks=16).collect()
    assert {(r["kind"], r["capture_id"]): r["available_at_ns"] for r in got} == recurrence(rows, 10)


def test_recording_is_idempotent_and_conflicts_show(spark):
    rows = [("evidence", "a", 5), ("evidence", "b", 6)]
    stored = markers(spark, marker("evidence", "a", 3))
    got = {r["capture_id"]: (r["available_at_ns"], r["outcome"]) for r in A.record_markers(candidates(spark, rows), stored, 3).collect()}
    assert got == {"a": (3, "same"), "b": (6, "new")}
    foreign = markers(spark, marker("evidence", "a", 3, "elsewhere"))
    got = {r["capture_id"]: r["outcome"] for r in A.record_markers(candidates(spark, rows), foreign, 3).collect()}
    assert got == {"a": "conflict", "b": "new"}


def test_floor(spark):
    assert A.read_committed_floor(markers(spark)) is None
    assert A.read_committed_floor(markers(spark, marker("evidence", "a", 3), marker("authority", "a", 9))) == 9
    with pytest.raises(S.ContractError):
        A.read_committed_floor(markers(spark, marker("evidence", "a", 3), marker("evidence", "a", 4)))


def test_proof_needs_every_column(spark):
    sent = facts(spark, observation("a"), observation("b"), observation("c"), observation("d"))
    stored = facts(spark, observation("a"), observation("b", seq=1), observation("d"), observation("d"))
    got = {r["capture_id"]: r["outcome"] for r in A.prove_evidence(sent, stored).collect()}
    assert got == {"a": "proven", "b": "mismatch", "c": "absent", "d": "not_unique"}
    d = decisions(spark, accepted("a"), accepted("b"))
    got = {r["subject_capture_id"]: r["outcome"] for r in A.prove_authority(d, decisions(spark, accepted("a"), accepted("b", "conflict"))).collect()}
    assert got == {"a": "proven", "b": "mismatch"}


def test_marker_reference_is_sha256_of_canonical_json(spark):
    row = markers(spark, marker("evidence", "a", 30))
    c = F.col
    got = row.select(A.marker_reference(c("kind"), c("capture_id"), c("policy_version"), c("available_at_ns"), c("proof_schema_version"), c("source_authority_identity")).alias("r")).first()["r"]
    text = json.dumps(
        {"kind": "evidence", "capture_id": "a", "policy_version": None, "available_at_ns": 30, "proof": S.PROOF_SCHEMA, "identity": S.AuthorityIdentities().evidence},
        sort_keys=True, separators=(",", ":"),
    )
    assert got == hashlib.sha256(text.encode()).hexdigest()


def test_a_burst_of_like_ids_is_split(spark):
    """100,000 markers of one instant whose ids begin alike: blocks stay even, the published order holds."""
    ids = spark.range(50_000).select(F.format_string("capture-2026-%08d", F.col("id")).alias("capture_id"))
    rows = A.evidence_candidates(ids, F.lit(1_000), "e").unionByName(
        A.authority_candidates(ids.select(F.col("capture_id").alias("subject_capture_id"), F.lit("p").alias("policy_version")), F.lit(1_000), "d")
    )
    sizes = [r["count"] for r in A.ordered_blocks(rows, 16).groupBy("block").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 100_000 / 16
    got = A.assign_proof_times(rows, 5_000, blocks=16).agg(
        F.countDistinct("available_at_ns"), F.min("available_at_ns"), F.max("available_at_ns"),
        F.max(F.when(F.col("kind") == "evidence", F.col("available_at_ns"))),
        F.count(F.when((F.col("kind") == "evidence") & (F.col("available_at_ns") != 5_001 + F.substring("capture_id", -8, 8).cast("bigint")), 1)),
    ).first()
    assert tuple(got) == (100_000, 5_001, 105_000, 55_000, 0)
