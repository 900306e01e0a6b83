import json

import pytest
from frames import TICKER, accepted, decisions, fact, facts, observation, payload

from factlake import schemas as S
from factlake.operators import truth


def categories(df):
    return {r["subject_capture_id"]: r["category"] for r in df.collect()}


def test_first_is_accepted_then_duplicate_then_conflict(spark):
    f = facts(
        spark,
        fact("a", 1),
        fact("b", 2),
        fact("c", 3, payload=payload(price="0.4300")),
        fact("d", 4, payload=payload(price="0.4300")),
    )
    out = truth.adjudicate_trades(f)
    assert categories(out) == {"a": "accepted", "b": "duplicate", "c": "conflict", "d": "conflict"}
    who = {r["subject_capture_id"]: r["contributing_capture_ids"] for r in out.collect()}
    assert who == {"a": ["a"], "b": ["a", "b"], "c": ["a", "c"], "d": ["a", "d"]}


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({"payload": "not JSON"}, "invalid_trade_evidence"),
        ({"schema_version": "market-ingress/v2"}, "unsupported_trade_schema"),
        ({"payload": payload(ticker="OTHER")}, "trade_identity_mismatch"),
        ({"provider": "other"}, "invalid_trade_evidence"),
        ({"payload": payload(trade_id="")}, "invalid_trade_evidence"),
        ({"payload": payload(trade_id=7)}, "invalid_trade_evidence"),
        ({"payload": '{"type":"trade","sid":1,"msg":{"trade_id":"t","trade_id":"u","market_ticker":"' + TICKER + '"}}'}, "invalid_trade_evidence"),
    ],
)
def test_invalid_trades_are_not_accepted_and_never_anchor(spark, changes, reason):
    out = truth.adjudicate_trades(facts(spark, fact("bad", 1, **changes), fact("good", 2))).collect()
    rows = {r["subject_capture_id"]: r for r in out}
    assert rows["bad"]["category"] == "not_accepted" and rows["bad"]["reason"] == reason
    assert rows["bad"]["event"] is None and rows["bad"]["contributing_capture_ids"] == ["bad"]
    assert rows["good"]["category"] == "accepted"


@pytest.mark.parametrize("field,value", [("sid", 99), ("seq", 100), ("received_ns", 30), ("provider_ns", 2)])
def test_transport_fields_do_not_matter(spark, field, value):
    out = truth.adjudicate_trades(facts(spark, fact("a", 1), fact("b", 2, **{field: value})))
    assert categories(out)["b"] == "duplicate"


def test_layout_does_not_matter_but_message_times_do(spark):
    decoded = json.loads(payload())
    shuffled = json.dumps({"msg": dict(reversed(decoded["msg"].items())), "sid": 6, "type": "trade"}, indent=2)
    f = facts(
        spark,
        fact("a", 1),
        fact("b", 2, payload=shuffled),
        fact("c", 3, payload=payload(ts=1)),
        fact("d", 4, payload=payload(ts_ms=1)),
        fact("e", 5, payload=payload(note="extra")),
    )
    assert categories(truth.adjudicate_trades(f)) == {
        "a": "accepted", "b": "duplicate", "c": "conflict", "d": "conflict", "e": "conflict",
    }


def test_observations_are_never_folded(spark):
    f = facts(spark, observation("a", 1), observation("b", 1))
    assert categories(truth.decide_new(f)) == {"a": "accepted", "b": "accepted"}


def test_unsupported_types_are_reported(spark):
    f = facts(spark, observation("a", message_type="mystery"), observation("b"))
    assert [r["capture_id"] for r in truth.unsupported_facts(f).collect()] == ["a"]


def test_existing_decisions_are_kept(spark):
    f = facts(spark, fact("a", 1), fact("b", 2))
    old = decisions(spark, accepted("a", "conflict"))
    assert categories(truth.decide_facts(f, old, f)) == {"a": "conflict", "b": "accepted"}


def test_stored_anchor_wins_over_an_earlier_row(spark):
    later = facts(spark, fact("z", 100, payload=payload(price="0.9000")))
    earlier = facts(spark, fact("a", 1), fact("b", 2, payload=payload(price="0.9000")))
    stored = truth.decide_new(later)
    out = truth.decide_incremental(earlier, stored, later.unionByName(earlier))
    assert categories(out) == {"a": "conflict", "b": "duplicate"}


def test_batches_in_arrival_order_equal_one_batch(spark):
    rows = [fact(f"c{i:02d}", i, payload=payload(trade_id=f"t{i % 3}", price=f"0.4{i % 2}")) for i in range(20)]
    whole = categories(truth.decide_new(facts(spark, *rows)))
    stored, known = decisions(spark), []
    for part in (rows[:7], rows[7:13], rows[13:]):
        known += part
        fresh = truth.decide_incremental(facts(spark, *part), stored, facts(spark, *known))
        stored = decisions(spark, *[tuple(r) for r in stored.unionByName(fresh).collect()])
    assert categories(stored) == whole


def test_anchor_violations(spark):
    f = facts(spark, fact("a", 1), fact("b", 2, payload=payload(trade_id="t2")))
    good = truth.decide_new(f)
    assert truth.check_anchor_invariants(good, f).count() == 0
    event = (S.PROVIDER, TICKER, "trade", "t2")
    bad = decisions(
        spark,
        (S.TRUTH_POLICY, "b", "accepted", ["x"], None, event),
        ("data-truth/v0", "gone", "accepted", ["gone"], None, event),
    )
    found = {(r["subject_capture_id"], r["rule"]) for r in truth.check_anchor_invariants(bad, f).collect()}
    assert found == {
        ("b", "not_a_contributor"),
        ("gone", "missing_evidence"),
        ("gone", "policy_differs"),
        (f"{S.PROVIDER}/{TICKER}/trade/t2", "several_accepted"),
    }
    with pytest.raises(S.ContractError):
        truth.require_sound_anchors(bad, f)


IDENTITY = (S.PROVIDER, TICKER, "trade", "fill-77")


def _anchor(capture_id, contributors=None, policy=S.TRUTH_POLICY):
    return (policy, capture_id, "accepted", contributors or [capture_id], None, IDENTITY)


@pytest.mark.parametrize(
    "known",
    [
        (_anchor("old"), _anchor("older")),
        (_anchor("old", ["older"]),),
        (_anchor("old", policy="data-truth/v0"),),
    ],
    ids=["two accepted", "not its own contributor", "another policy"],
)
def test_unsound_anchors_raise_whatever_is_read(spark, known):
    stored = facts(spark, fact("old", 10), fact("older", 9))
    for read in (lambda d: d.count(), lambda d: d.select("subject_capture_id").collect()):
        with pytest.raises(S.ContractError, match="INVARIANT_CONFLICT"):
            read(truth.decide_incremental(facts(spark, fact("new", 30)), decisions(spark, *known), stored))


def test_doubled_anchors_in_an_anchor_table_raise(spark):
    stored = facts(spark, fact("old", 10), fact("older", 9))
    anchors = truth.comparable_trades(stored)
    with pytest.raises(S.ContractError, match="several_accepted"):
        truth.decide_incremental(facts(spark, fact("new", 30)), decisions(spark), stored, anchors)
    parts = anchors.where("capture_id = 'old'").withColumn("anchor_part", truth.anchor_part())
    [row] = truth.decide_incremental(facts(spark, fact("new", 30)), decisions(spark), stored, parts).collect()
    assert (row["category"], row["contributing_capture_ids"]) == ("duplicate", ["old", "new"])


def test_unsupported_facts_raise_whatever_is_read(spark):
    nothing = decisions(spark).select(*S.DECISION_COLUMNS)
    batch = facts(spark, fact("a"), fact("b", message_type="novelty"))
    for read in (lambda d: d.count(), lambda d: d.select("subject_capture_id").collect()):
        with pytest.raises(S.ContractError, match="UNSUPPORTED_FACT"):
            read(truth.decide_facts(batch, nothing, batch))


def test_no_payload_crosses_the_network_when_anchors_are_looked_up(spark, tmp_path, monkeypatch):
    """Neither the stored side nor the batch ships payloads, even where nothing is small enough to be broadcast."""
    path = str(tmp_path / "facts")
    facts(spark, fact("old", 10), fact("other", 11, payload=payload("fill-2"))).write.parquet(path)
    stored = spark.read.parquet(path)
    plans = []
    keep = truth.materialize
    monkeypatch.setattr(truth, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = truth.decide_incremental(facts(spark, fact("new", 30)), decisions(spark, _anchor("old")), stored)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        assert out.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 3
    for plan in plans:
        for line in plan.splitlines():
            below = plan.splitlines()[plan.splitlines().index(line) + 1 : plan.splitlines().index(line) + 2]
            if "Exchange hashpartitioning" in line:
                assert "payload" not in "".join(below), below
