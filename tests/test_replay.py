import hashlib
import json

import pytest
from frames import accepted, both, decisions, fact, facts, marker, markers, observation
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.operators import replay as R
from factlake.plans.replay_plan import Lake, replay_as_of


def lake(spark, fact_rows, decision_rows, marker_rows):
    return Lake(facts(spark, *fact_rows), decisions(spark, *decision_rows), markers(spark, *marker_rows))


def simple(spark):
    """A and B arrive together; L is late, U unproven, X lacks an event time; one of each category."""
    f = [observation("A", 20), observation("B", 20), observation("L", 21), observation("U", 22),
         observation("D", 23), observation("C", 24), observation("N", 25)]
    d = [accepted("A"), accepted("B"), accepted("L"), accepted("U"), accepted("D", "duplicate"),
         accepted("C", "conflict"), accepted("N", "not_accepted")]
    m = both("A", 30, 40) + both("B", 30, 50) + both("L", 60, 20) + [marker("evidence", "U", 30)]
    for c in "DCN":
        m += both(c, 30, 40)
    return lake(spark, f, d, m)


def request(**changes):
    return R.AsOfRequest(**{"cutoff_ns": 50, "start_ns": 0, "end_ns": 100, **changes})


def ids(df):
    return [r["capture_id"] for r in df.collect()]


def test_all_categories_replay_in_order_and_exclusions_have_one_code(spark):
    v = replay_as_of(simple(spark), request())
    assert ids(v.ordered_keys()) == ["A", "B", "D", "C", "N"]
    assert {r["capture_id"]: r["code"] for r in v.exclusions.collect()} == {
        "L": S.EVIDENCE_MISSING, "U": S.AUTHORITY_MISSING,
    }


def test_a_missing_side_is_judged_before_a_late_one(spark):
    lk = lake(spark, [observation("A")], [accepted("A")], [marker("evidence", "A", 99)])
    assert replay_as_of(lk, request()).exclusions.first()["code"] == S.AUTHORITY_MISSING


def test_pages_of_any_size_join_to_the_whole(spark):
    v = replay_as_of(simple(spark), request())
    whole = ids(v.ordered_records())
    for size in (1, 2, 3, 10):
        got, last = [], None
        while True:
            page = sorted(v.page(last, size).collect(), key=lambda r: r["position"])
            got += [r["capture_id"] for r in page]
            if not page or not page[-1]["has_more"]:
                break
            last = (page[-1]["received_ns"], page[-1]["capture_id"])
        assert got == whole


def test_event_axis_refuses_undated_rows_even_outside_the_window(spark):
    lk = lake(spark, [observation("A"), observation("X", 500, None, channel="orderbook_delta")],
              [accepted("A"), accepted("X")], both("A", 1, 1) + both("X", 1, 1))
    r = request(axis="event_time", ordering="strict_event")
    with pytest.raises(S.ContractError) as stop:
        replay_as_of(lk, r)
    assert stop.value.code == "UNSUPPORTED_EVENT_TIME"
    only = request(axis="event_time", ordering="strict_event", channels=("ticker",))
    assert ids(replay_as_of(lk, only).ordered_keys()) == ["A"]


@pytest.mark.parametrize(
    ("f", "d", "m", "code"),
    [
        ([], [accepted("A")], [], "MALFORMED_EVIDENCE"),
        ([observation("A"), observation("A", 21)], [accepted("A")], [], "MALFORMED_EVIDENCE"),
        ([observation("A", asset="Gold")], [accepted("A")], [], "MALFORMED_EVIDENCE"),
        ([observation("A")], [accepted("A"), accepted("A")], [], "AUTHORITY_CONFLICT"),
        ([observation("A")], [accepted("A", "maybe")], [], "MALFORMED_AUTHORITY"),
        ([observation("A")], [accepted("A")], [marker("evidence", "A", 1), marker("evidence", "A", 2)], "AVAILABILITY_EVIDENCE_MISSING"),
        ([observation("A")], [accepted("A")], [marker("evidence", "A", 1, "elsewhere")], "AVAILABILITY_EVIDENCE_MISSING"),
    ],
)
def test_defects_stop_a_strict_read(spark, f, d, m, code):
    with pytest.raises(S.ContractError) as stop:
        replay_as_of(lake(spark, f, d, m), request())
    assert stop.value.code == code


def test_other_policies_and_undecided_facts_are_ignored(spark):
    lk = lake(spark, [observation("A"), observation("B", asset="Gold")],
              [accepted("A"), accepted("A", "conflict", "data-truth/v0")], both("A", 1, 1))
    assert ids(replay_as_of(lk, request()).keys) == ["A"]


def test_defect_scope(spark):
    lk = lake(spark, [observation("A"), observation("B", asset="ETH"), observation("B", asset="ETH")],
              [accepted("A"), accepted("B")], both("A", 1, 1))
    with pytest.raises(S.ContractError):
        replay_as_of(lk, request(assets=("BTC",)))
    assert ids(replay_as_of(lk, request(assets=("BTC",)), check_scope="filtered").keys) == ["A"]


@pytest.mark.parametrize(
    "changes",
    [
        {"cutoff_ns": True}, {"policy_version": "data-truth/v2"}, {"start_ns": 5, "end_ns": 5}, {"axis": "x"},
        {"ordering": "x"}, {"page_size": 0}, {"page_size": 10**9}, {"assets": ()}, {"assets": ("Gold",)},
        {"channels": ("",)}, {"channels": ("x" * 129,)}, {"channels": "ticker"},
    ],
)
def test_invalid_requests(changes):
    with pytest.raises(S.ContractError) as stop:
        request(**changes).validated()
    assert stop.value.code == "INVALID_REQUEST"


def test_request_identity_is_sha256_of_canonical_json(spark):
    r = request(assets=("ETH", "BTC", "ETH")).validated()
    got = R.request_identity(R.request_row(facts(spark), r)).first()["request_identity"]
    text = json.dumps(
        {
            "assets": ["BTC", "ETH"], "authority_policy_version": S.TRUTH_POLICY, "channels": None,
            "as_of_cutoff_ns": 50, "ordering": "arrival", "ordering_rule_version": S.ORDERING_RULE_VERSION,
            "request_version": S.REQUEST_VERSION, "selection_axis": "arrival_time",
            "selection_end_ns": 100, "selection_start_ns": 0,
        },
        sort_keys=True, separators=(",", ":"), ensure_ascii=False,
    )
    assert got == hashlib.sha256(text.encode()).hexdigest()


def test_snapshot_identity_ignores_layout_page_size_and_late_rows_but_not_membership(spark):
    lk = simple(spark)
    first = replay_as_of(lk, request()).summary().first()

    def again(facts=lk.facts, decisions=lk.decisions, markers=lk.markers, **changes):
        return replay_as_of(Lake(facts, decisions, markers), request(**changes)).summary().first()

    assert again(facts=lk.facts.repartition(5, "payload"), page_size=3)["snapshot_identity"] == first["snapshot_identity"]
    late_f = facts(spark, observation("Q", 30))
    late_d = decisions(spark, accepted("Q"))
    after = lk.markers.unionByName(markers(spark, *both("Q", 901, 901)))
    backdated = lk.markers.unionByName(markers(spark, *both("Q", 10, 10)))
    f, d = lk.facts.unionByName(late_f), lk.decisions.unionByName(late_d)
    assert again(f, d, after)["snapshot_identity"] == first["snapshot_identity"]
    assert again(f, d, backdated)["snapshot_identity"] != first["snapshot_identity"]
    drift = R.detect_drift(replay_as_of(lk, request()).keys, replay_as_of(Lake(f, d, backdated), request()).keys)
    assert [(r["capture_id"], r["change"]) for r in drift.collect()] == [("Q", "added")]


def test_many_requests_equal_single_reads(spark):
    lk = simple(spark)
    asked = [request(), request(cutoff_ns=35), request(cutoff_ns=70, channels=("ticker",), assets=("BTC",)), request(start_ns=21, end_ns=24)]
    table = None
    for i, r in enumerate(asked):
        row = R.request_row(lk.facts, r.validated(), f"r{i}")
        table = row if table is None else table.unionByName(row)
    paired = R.pair_candidates(lk.facts, lk.decisions, lk.markers)
    candidates = R.with_filters(paired, lk.facts)
    records = R.replay_many(table, candidates)
    left_out = R.replay_many_exclusions(table, candidates).collect()
    counts = {r["request_id"]: r for r in R.exclusion_counts(table, candidates, blocks=4).collect()}
    for i, r in enumerate(asked):
        v = replay_as_of(lk, r)
        assert sorted(ids(records.where(F.col("request_id") == f"r{i}"))) == sorted(ids(v.keys))
        s = v.summary().first()
        for name in ("n_evidence_missing", "n_authority_missing"):
            assert counts[f"r{i}"][name] == s[name]
        got = [(r["capture_id"], r["code"]) for r in left_out if r["request_id"] == f"r{i}"]
        assert sorted(got) == sorted((r["capture_id"], r["code"]) for r in v.exclusions.collect())


def test_ends_of_exclusions_are_folded_without_a_sort(spark):
    lk = simple(spark)
    table = R.request_row(lk.facts, request(cutoff_ns=35).validated(), "r0").unionByName(R.request_row(lk.facts, request(cutoff_ns=25).validated(), "r1"))
    candidates = R.with_rank(R.with_filters(R.pair_candidates(lk.facts, lk.decisions, lk.markers), lk.facts))
    listed = R.replay_many_exclusions(table, candidates, ("capture_rank",))
    want = listed.groupBy("request_id", "code").agg(F.count("*").alias("n"), F.min("capture_id").alias("a"), F.max("capture_id").alias("b"))
    got = R.exclusion_ranges(listed, candidates)
    assert got.count() > 0 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    ends = listed.groupBy("request_id", "code").agg(F.min("capture_rank"), F.max("capture_rank"))
    assert "SortAggregate" not in ends._jdf.queryExecution().executedPlan().toString()


def test_page_scan_prunes_payload_until_the_page_is_known(spark):
    v = replay_as_of(simple(spark), request(), strict=False)
    assert "payload" not in v.keys.columns
    plan = R.keyset_page(v.keys, "arrival", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_lone_fact_from_the_contract_example(spark):
    lk = lake(spark, [fact("capture-1", 20, 10)], [accepted("capture-1")], both("capture-1", 30, 40))
    assert replay_as_of(lk, request(cutoff_ns=40)).keys.count() == 1
    assert replay_as_of(lk, request(cutoff_ns=39)).keys.count() == 0


@pytest.mark.parametrize("table, change", [
    ("facts", lambda df: df.withColumn("received_ns", F.col("received_ns").cast("string"))),
    ("facts", lambda df: df.withColumn("note", F.lit("x"))),
    ("decisions", lambda df: df.drop("reason")),
    ("markers", lambda df: df.withColumn("available_at_ns", F.col("available_at_ns").cast("int"))),
])
def test_a_strict_read_refuses_a_foreign_schema(spark, table, change):
    lk = simple(spark)
    parts = {"facts": lk.facts, "decisions": lk.decisions, "markers": lk.markers}
    with pytest.raises(S.ContractError, match="SOURCE_UNAVAILABLE"):
        replay_as_of(Lake(**{**parts, table: change(parts[table])}), request())
    laid_out = lk.facts.withColumn("received_date", F.lit("2026-01-01").cast("date"))
    assert replay_as_of(Lake(laid_out, lk.decisions, lk.markers), request()).keys.count() > 0


def test_a_strict_read_refuses_malformed_rows(spark):
    def read(fact_row, decision_row):
        f = spark.createDataFrame([fact_row], ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in S.CAPTURE_FACT.fields))
        d = spark.createDataFrame([decision_row], ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in S.TRUTH_DECISION.fields))
        return replay_as_of(Lake(f, d, markers(spark, *both("A", 1, 1))), request()).keys.count()

    good = (S.TRUTH_POLICY, "A", "accepted", ["A"], None, None)
    assert read(observation("A"), good) == 1
    with pytest.raises(S.ContractError, match="MALFORMED_EVIDENCE"):
        read(observation("A", payload=None), good)
    for contributors, event in ((None, None), (["A", None], None), (["A"], (None, None, None, None)), (["A"], ("p", "s", None, "t"))):
        with pytest.raises(S.ContractError, match="MALFORMED_AUTHORITY"):
            read(observation("A"), (S.TRUTH_POLICY, "A", "accepted", contributors, None, event))
