"""Pages from bookmarks: they join to the whole, read their own files only, and stop when the snapshot drifted."""

from dataclasses import replace

import pytest
from frames import accepted, both, decisions, facts, markers, observation
from test_replay import ids, request, simple

from factlake import schemas as S
from factlake.operators import replay as R
from factlake.plans.paging import Bookmark, SnapshotPages, read_page
from factlake.plans.replay_plan import Lake, replay_as_of


def in_order(page):
    return [r["capture_id"] for r in sorted(page.records.collect(), key=lambda r: r["position"])]


def many(spark, n=60):
    """Arrivals in threes at one instant; event times run the other way."""
    names = [f"F{k:03d}" for k in range(n)]
    rows = [observation(c, 10 + k // 3, 900 - k // 2) for k, c in enumerate(names)]
    proofs = [m for c in names for m in both(c, 30, 40)]
    return Lake(facts(spark, *rows), decisions(spark, *map(accepted, names)), markers(spark, *proofs))


@pytest.mark.parametrize("ordering", ["arrival", "strict_event"])
def test_pages_from_bookmarks_join_to_the_whole(spark, ordering):
    view = replay_as_of(many(spark), request(ordering=ordering))
    whole = ids(view.ordered_records())
    pages = SnapshotPages(view)
    assert len(whole) == 60
    for size in (7, 20, 60, 100):
        got, at = [], None
        while True:
            page = pages.read(at, size)
            got += in_order(page)
            at = page.next
            if at is None:
                break
        assert got == whole


def test_a_rebuilt_read_goes_on_and_the_last_member_ends_it(spark):
    lk = many(spark)
    first = read_page(lk, request(page_size=50))
    again = Lake(lk.facts.repartition(3), lk.decisions, lk.markers.repartition(2))
    second = read_page(again, request(page_size=50), first.next)
    assert in_order(first) + in_order(second) == [f"F{k:03d}" for k in range(60)] and second.next is None
    end = replace(first.next, last_received_ns=29, last_capture_id="F059")
    last = read_page(lk, request(page_size=50), end)
    assert in_order(last) == [] and last.next is None


def test_a_bookmark_is_refused_by_code(spark):
    lk = simple(spark)
    mark = read_page(lk, request(page_size=2)).next
    assert mark.last_capture_id == "B"

    def code(lake=lk, at=mark, **changes):
        with pytest.raises(S.ContractError) as stop:
            read_page(lake, request(page_size=2, **changes), at)
        return stop.value.code

    assert code(cutoff_ns=51) == "CURSOR_MISMATCH"
    assert code(at=replace(mark, snapshot_identity="other")) == "SOURCE_UNAVAILABLE"
    assert code(at=replace(mark, last_capture_id="L")) == "INVALID_CURSOR"
    assert code(at=replace(mark, last_received_ns=21)) == "INVALID_CURSOR"
    assert code(at=replace(mark, ordering="strict_event", last_provider_ns=1)) == "INVALID_CURSOR"
    assert code(at=Bookmark(None, None, None, None, None)) == "INVALID_CURSOR"
    drifted = Lake(
        lk.facts.unionByName(facts(spark, observation("Q", 30))),
        lk.decisions.unionByName(decisions(spark, accepted("Q"))),
        lk.markers.unionByName(markers(spark, *both("Q", 10, 10))),
    )
    assert code(drifted) == "SOURCE_UNAVAILABLE"
    with pytest.raises(S.ContractError):
        SnapshotPages(replay_as_of(lk, request())).read(page_size=R.MAX_PAGE_SIZE + 1)


def test_a_page_reads_the_files_of_its_range(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        pages = SnapshotPages(replay_as_of(many(spark), request()))
        files = pages.bounds.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert files >= 4
    cut = pages.keys_from(None, 5)
    assert cut.count() < 60 and "PushedFilters: [IsNotNull(received_ns), LessThanOrEqual(received_ns" in cut._jdf.queryExecution().executedPlan().toString()
    last = (19, "F029")
    rest = pages.keys_from(last, 5)
    assert rest.count() < 31 and rest.where("capture_id > 'F029'").count() >= 6


def test_records_of_the_event_axis_read_the_arrival_span_of_their_keys(spark):
    view = replay_as_of(many(spark), request(axis="event_time", ordering="strict_event", start_ns=880, end_ns=891))
    records = view.records()
    assert sorted(ids(records)) == [f"F{k:03d}" for k in range(20, 42)]
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "received_ns#" in plan and ">= 16" in plan and "<= 23" in plan
