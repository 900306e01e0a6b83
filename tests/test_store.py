import glob
import tempfile

import pytest
from frames import accepted, both, decisions, fact, facts, marker, markers, observation
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.operators import dataset, ingest, store
from factlake.operators import replay as R
from factlake.plans.replay_plan import Lake, replay_as_of
from factlake.sources import commits, tables
from factlake.streaming import streams


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="factlake-store-")


DAY = S.NS_PER_DAY


def test_replays_are_absorbed_and_equal_content_is_not(spark, folder):
    path = f"{folder}/facts"
    a, b, c = observation("a", DAY), observation("b", DAY), observation("c", 3 * DAY)
    assert store.append_captures(spark, path, facts(spark, a, a, b)).rows == 2
    store.append_captures(spark, path, facts(spark, b, c))
    stored = tables.read_facts(spark, path)
    assert sorted(r["capture_id"] for r in stored.collect()) == ["a", "b", "c"]


def test_a_retried_batch_leaves_one_copy(spark, folder):
    path = f"{folder}/facts"
    batch = facts(spark, observation("a", DAY), observation("b", 2 * DAY))
    for _ in range(2):
        assert store.append_captures(spark, path, batch, batch_id=4).rows == 2
    store.append_captures(spark, path, facts(spark, observation("b", 2 * DAY), observation("c", 2 * DAY)), batch_id=5)
    assert sorted(r["capture_id"] for r in tables.read_facts(spark, path).collect()) == ["a", "b", "c"]


def test_range_scan_prunes_days(spark, folder):
    path = f"{folder}/facts"
    store.append_captures(spark, path, facts(spark, *[observation(f"c{d}", d * DAY) for d in range(1, 9)]))
    scan = tables.scan_capture_range(tables.read_facts(spark, path), 2 * DAY, 4 * DAY)
    assert [r["capture_id"] for r in scan.collect()] == ["c2", "c3", "c4"]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "received_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        tables.scan_capture_range(scan, 5, 4)


def test_decisions_are_append_only(spark, folder):
    path = f"{folder}/decisions"
    d = decisions(spark, accepted("a"), accepted("b", "conflict"))
    assert store.append_decisions(spark, path, d).rows == 2
    assert store.append_decisions(spark, path, d).rows == 2
    assert store.read_decisions(spark, path).count() == 2
    with pytest.raises(S.ContractError):
        store.append_decisions(spark, path, decisions(spark, accepted("a", "duplicate")))


def test_markers_are_append_only(spark, folder):
    path = f"{folder}/markers"
    m = markers(spark, *both("a", 1, 2))
    store.append_availability(spark, path, m)
    store.append_availability(spark, path, m)
    assert store.read_markers(spark, path).count() == 2
    with pytest.raises(S.ContractError):
        store.append_availability(spark, path, markers(spark, marker("evidence", "a", 9)))


def test_stored_form_round_trips(spark):
    event = (S.PROVIDER, "s", "trade", "t")
    d = decisions(spark, accepted("a"), (S.TRUTH_POLICY, "b", "duplicate", ["a", "b"], None, event))
    back = store.import_decisions(store.export_decisions(d, F.lit(0)))
    assert sorted(map(str, back.collect())) == sorted(map(str, d.collect()))


def test_lookup_refuses_copies(spark):
    f = facts(spark, observation("a"), observation("b"), observation("b", 21))
    ids = spark.createDataFrame([("a",), ("x",)], "capture_id string")
    assert [r["capture_id"] for r in store.read_captures(ids, f).collect()] == ["a"]
    with pytest.raises(S.ContractError):
        store.read_captures(spark.createDataFrame([("b",)], "capture_id string"), f)


def test_old_tables_gain_only_the_approved_columns(spark):
    f = facts(spark, observation("a"))
    assert tables.evolve_capture_schema(f.drop("source_id")).first()["source_id"] is None
    with pytest.raises(S.ContractError):
        tables.evolve_capture_schema(f.drop("payload"))


def test_snapshot_is_written_once_and_named_by_content(spark, folder):
    lk = Lake(
        facts(spark, observation("A"), fact("B"), observation("L")),
        decisions(spark, accepted("A"), accepted("B", "conflict"), accepted("L")),
        markers(spark, *both("A", 1, 1), *both("B", 1, 1), *both("L", 99, 99)),
    )

    def write(lake, **changes):
        v = replay_as_of(lake, R.AsOfRequest(**{"cutoff_ns": 50, "start_ns": 0, "end_ns": 100, **changes}))
        return dataset.write_snapshot(spark, f"{folder}/sets", v.summary(), v.records(), v.exclusions)

    first = write(lk)
    assert first.created and not write(lk, page_size=7).created
    assert [r["capture_id"] for r in spark.read.parquet(f"{first.path}/records").collect()] == ["A"]
    layers = {r["capture_id"]: r["layer"] for r in spark.read.parquet(f"{first.path}/exclusions").collect()}
    assert layers == {"B": "category", "L": "replay"}
    moved = Lake(lk.facts, lk.decisions, markers(spark, *both("A", 2, 1), *both("B", 1, 1), *both("L", 99, 99)))
    other = Lake(lk.facts, lk.decisions, markers(spark, *both("A", 1, 1), *both("B", 1, 1), marker("evidence", "L", 1)))
    names = {first.dataset_identity, write(moved).dataset_identity, write(other).dataset_identity}
    assert len(names) == 3


def test_records_are_written_once_and_an_interrupted_write_is_made_again(spark, folder, monkeypatch):
    lk = Lake(facts(spark, observation("A"), fact("B")), decisions(spark, accepted("A"), accepted("B", "conflict")), markers(spark, *both("A", 1, 1), *both("B", 1, 1)))
    v = replay_as_of(lk, R.AsOfRequest(cutoff_ns=50, start_ns=0, end_ns=100))

    def write(exclusions=v.exclusions):
        return dataset.write_snapshot(spark, f"{folder}/sets", v.summary(), v.records(), exclusions)

    def lost(*given):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(dataset.commits, "move", lost)
        with pytest.raises(RuntimeError):
            write()
    moved = []
    real = dataset.commits.move
    monkeypatch.setattr(dataset.commits, "move", lambda s, a, b: moved.append(sorted(glob.glob(f"{a}/*/*.parquet"))) or real(s, a, b))
    done = write()
    assert done.created and not write().created
    # what lies in place are the very files of the one write
    names = [f.split("/")[-1] for f in moved[0]]
    assert sorted(f.split("/")[-1] for f in glob.glob(f"{done.path}/records/*/*.parquet")) == sorted(names) and len(names) == 1
    assert dataset.read_manifest(spark, done.path) is not None


def test_a_snapshot_without_admitted_records_can_be_read(spark, folder):
    lk = Lake(facts(spark, fact("B")), decisions(spark, accepted("B", "conflict")), markers(spark, *both("B", 1, 1)))
    v = replay_as_of(lk, R.AsOfRequest(cutoff_ns=50, start_ns=0, end_ns=100))
    done = dataset.write_snapshot(spark, f"{folder}/sets", v.summary(), v.records(), v.exclusions)
    read = spark.read.parquet(f"{done.path}/records")
    assert read.count() == 0 and "record_digest" in read.columns


def test_streams_survive_a_restart(spark, folder):
    rows = [fact(f"c{i}", DAY + i) for i in range(6)]
    facts(spark, *rows[:3]).write.json(f"{folder}/in")

    def run():
        stream = spark.readStream.schema(S.CAPTURE_FACT).json(f"{folder}/in")
        streams.stream_append_captures(stream, f"{folder}/facts", f"{folder}/cp1").awaitTermination()
        streams.decide_stream(stream, f"{folder}/decisions", f"{folder}/cp2").awaitTermination()

    run()
    facts(spark, *rows[2:]).write.mode("append").json(f"{folder}/in")
    run()
    run()
    assert tables.read_facts(spark, f"{folder}/facts").count() == 6
    got = {r["subject_capture_id"]: r["category"] for r in store.read_decisions(spark, f"{folder}/decisions").collect()}
    assert got == {"c0": "accepted", **{f"c{i}": "duplicate" for i in range(1, 6)}}


def test_a_subscription_takes_ids_under_their_own_source_only(spark):
    scope = S.reference_scope(spark)
    cf = scope.where("source = 'cf_benchmarks'")
    ids = [r["provider_id"] for r in cf.orderBy("provider_id").collect()]
    raw = spark.createDataFrame(
        [(1, "cf_benchmarks", ids[0]), (2, "pyth_value", ids[0]), (3, "cf_benchmarks", None), (4, None, ids[1]), (5, "cf_benchmarks", "other")],
        "offset long, source string, provider_id string",
    )
    assert [r["offset"] for r in ingest.subscribe_scope_filter(raw, ingest.subscription(cf, "cf_benchmarks")).collect()] == [1]
    for bindings in (cf.limit(0), scope, scope.where("source <> 'cf_benchmarks'")):
        with pytest.raises(S.ContractError):
            ingest.subscription(bindings, "cf_benchmarks")
    with pytest.raises(S.ContractError):
        ingest.subscribe_scope_filter(raw, cf.limit(0))


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_candidates_and_stored_rows_meet_in_one_shuffle(spark, folder):
    path = f"{folder}/decisions"
    store.append_decisions(spark, path, decisions(spark, accepted("a"), accepted("b")))
    sent = decisions(spark, accepted("a"), accepted("b", "duplicate"), accepted("c"), accepted("c"))
    plan = store._judged(sent, store.read_decisions(spark, path), store.DECISION_KEY, S.DECISION_COLUMNS)
    assert _exchanges(plan) == 1
    assert sorted((r["subject_capture_id"], r["outcome"], r["doubled"]) for r in plan.collect()) == [("a", "same", False), ("b", "conflict", False), ("c", "new", False)]


@pytest.mark.parametrize("changed", ["category", "reason"])
def test_changed_content_does_not_read_back(spark, folder, monkeypatch, changed):
    real = commits._store

    def altered(s, p, rows, *rest):
        return real(s, p, rows.withColumn(changed, F.lit("other")), *rest)

    monkeypatch.setattr(commits, "_store", altered)
    with pytest.raises(S.ContractError, match="read back"):
        store.append_decisions(spark, f"{folder}/decisions", decisions(spark, accepted("a")))


def test_large_steps_are_dealt_by_rows(spark, folder, monkeypatch):
    from factlake import session
    from factlake.operators import availability as A

    monkeypatch.setattr(session, "TASK_ROWS", 1)
    many = facts(spark, *[observation(f"c{k:03d}", DAY + k) for k in range(60)])
    stored = facts(spark, *[observation(f"c{k:03d}", DAY + k + (k == 7)) for k in range(55)])
    dealt = A.prove_evidence(many, stored)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    outcomes = {r["capture_id"]: r["outcome"] for r in dealt.collect()}
    assert outcomes == {f"c{k:03d}": "absent" if k >= 55 else "mismatch" if k == 7 else "proven" for k in range(60)}
    times = A.assign_proof_times(A.evidence_candidates(many, F.lit(5), "x"), 9, blocks=20)
    assert [r["available_at_ns"] for r in times.orderBy("capture_id").collect()] == list(range(10, 70))
