"""Messages that come twice, broken anchors, and what must stop a batch."""

import tempfile

import pytest
from frames import TICKER, accepted, both, decisions, fact, facts, marker, markers, observation, payload
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.operators import ingest, store, truth
from factlake.operators import replay as R
from factlake.plans import recording
from factlake.plans.replay_plan import Lake, replay_as_of
from factlake.sources import tables


@pytest.fixture
def paths():
    root = tempfile.mkdtemp(prefix="factlake-repeats-")
    return recording.LakePaths(f"{root}/facts", f"{root}/decisions", f"{root}/markers")


def messages(spark, *given):
    rows = [("bus", 0, offset, TICKER, value, 1_000 + offset) for offset, value in given]
    named = spark.createDataFrame(rows, "source string, partition int, offset long, binding_ticker string, value string, received_ns long")
    return spark.createDataFrame(named.select(*[F.col(c).cast(S.RAW_MESSAGE[c].dataType) for c in S.RAW_MESSAGE.names]).collect(), S.RAW_MESSAGE)


def identities(spark, *more):
    return spark.createDataFrame([(TICKER, "EVENT-1", "BTC"), *more], "ticker string, event_ticker string, asset string")


def test_a_message_delivered_twice_leaves_a_readable_lake(spark, paths):
    raw = messages(spark, (1, payload()), (1, payload()), (2, payload("fill-78")), (2, payload("fill-78")), (2, payload("fill-78")))
    for _ in range(2):
        progress = recording.record_captures(spark, paths, raw, identities(spark)).collect()
        assert [r["category"] for r in progress] == ["accepted", "accepted"]
    stored, known = tables.read_facts(spark, paths.facts), store.read_decisions(spark, paths.decisions)
    kept = store.read_markers(spark, paths.markers)
    assert (stored.count(), known.count(), kept.count()) == (2, 2, 4)
    view = replay_as_of(Lake(stored, known, kept), R.AsOfRequest(cutoff_ns=10_000, start_ns=0, end_ns=10_000))
    assert view.ordered_records().count() == 2


def test_one_key_with_different_content_stops(spark, paths):
    raw = messages(spark, (1, payload()), (1, payload(price="0.9000")))
    with pytest.raises(S.ContractError):
        recording.record_captures(spark, paths, raw, identities(spark))
    store.append_captures(spark, paths.facts, facts(spark, observation("a")))
    with pytest.raises(S.ContractError):
        store.append_captures(spark, paths.facts, facts(spark, observation("a", payload="{1}")))
    assert tables.read_facts(spark, paths.facts).count() == 1


def test_batches_are_checked_before_they_are_written(spark, paths):
    twice = decisions(spark, accepted("a"), accepted("a"))
    assert store.append_decisions(spark, paths.decisions, twice).rows == 1
    with pytest.raises(S.ContractError):
        store.append_decisions(spark, paths.decisions, decisions(spark, accepted("b"), accepted("b", "conflict")))
    assert store.read_decisions(spark, paths.decisions).count() == 1
    assert store.append_availability(spark, paths.markers, markers(spark, *both("a", 1, 2), *both("a", 1, 2))).rows == 2
    with pytest.raises(S.ContractError):
        store.append_availability(spark, paths.markers, markers(spark, marker("evidence", "b", 3), marker("evidence", "b", 4)))
    assert store.read_markers(spark, paths.markers).count() == 2


def test_a_fact_given_twice_is_decided_once(spark):
    nothing = spark.createDataFrame([], S.TRUTH_DECISION).select(*S.DECISION_COLUMNS)
    batch = facts(spark, fact("a"), fact("a"), observation("o"), observation("o"))
    got = truth.decide_facts(batch, nothing, batch).collect()
    assert sorted((r["subject_capture_id"], r["category"]) for r in got) == [("a", "accepted"), ("o", "accepted")]


def test_unsupported_facts_are_not_lost(spark):
    nothing = spark.createDataFrame([], S.TRUTH_DECISION).select(*S.DECISION_COLUMNS)
    batch = facts(spark, fact("a", message_type="novelty"))
    with pytest.raises(Exception, match="UNSUPPORTED_FACT"):
        truth.decide_facts(batch, nothing, batch).collect()


@pytest.mark.parametrize("stored", [(), (fact("old", payload="not a trade"),), (fact("old", payload=payload("fill-other")),)])
def test_a_broken_anchor_stops_the_decision(spark, stored):
    identity = (S.PROVIDER, TICKER, "trade", "fill-77")
    known = decisions(spark, (S.TRUTH_POLICY, "old", "accepted", ["old"], None, identity))
    with pytest.raises(Exception, match="INVARIANT_CONFLICT"):
        truth.decide_incremental(facts(spark, fact("new", 30)), known, facts(spark, *stored)).collect()


def test_a_sound_anchor_wins(spark):
    identity = (S.PROVIDER, TICKER, "trade", "fill-77")
    known = decisions(spark, (S.TRUTH_POLICY, "old", "accepted", ["old"], None, identity))
    [row] = truth.decide_incremental(facts(spark, fact("new", 30)), known, facts(spark, fact("old"))).collect()
    assert (row["category"], row["contributing_capture_ids"]) == ("duplicate", ["old", "new"])


def test_a_repeated_identity_is_refused(spark):
    with pytest.raises(Exception, match="several identities"):
        ingest.normalize_messages(messages(spark, (1, payload())), identities(spark, (TICKER, "EVENT-2", "BTC")), S.reference_scope(spark)).collect()


def test_fractions_of_any_length(spark):
    rows = spark.createDataFrame([("2026-01-02T03:04:05.123456789Z",), ("2026-01-02T03:04:05.123456Z",), ("2026-01-02T03:04:05.5",)], "ts string")
    a, b, naive = (r[0] for r in rows.select(X.delta_event_time(F.lit(None).cast("bigint"), F.col("ts"))).collect())
    assert a == b and a % 10**9 == 123_456_000 and naive is None


def test_a_bookmark_with_missing_fields_is_refused(spark):
    current = spark.createDataFrame([("r", "s", "arrival")], "request_identity string, snapshot_identity string, ordering string")
    schema = "bookmark_id int, request_identity string, snapshot_identity string, ordering string, last_provider_ns bigint, last_received_ns bigint, last_capture_id string"
    given = [(1, "r", "s", "arrival", None, 20, "a"), (2, None, None, "arrival", None, 20, "a"), (3, "r", "s", None, None, 20, "a"), (4, "x", "s", "arrival", None, 20, "a"), (5, "r", "s", "arrival", None, 20, None)]
    got = R.resume_check(spark.createDataFrame(given, schema), current, facts(spark, observation("a")))
    assert {r["bookmark_id"]: r["outcome"] for r in got.collect()} == {1: "ok", 2: "INVALID_CURSOR", 3: "INVALID_CURSOR", 4: "CURSOR_MISMATCH", 5: "INVALID_CURSOR"}
