"""The recorder as one stream: stops between writes, and facts that fail beside good ones."""

import tempfile

import pytest
from frames import payload
from pyspark.sql import functions as F
from test_repeats import identities, messages

from factlake import schemas as S
from factlake.operators import store
from factlake.plans import recording
from factlake.sources import tables
from factlake.streaming import recorder, streams


class Feed:
    def __init__(self, spark):
        root = tempfile.mkdtemp(prefix="factlake-recorder-")
        self.spark, self.raw, self.ledger, self.checkpoint = spark, f"{root}/raw", f"{root}/ledger", f"{root}/checkpoint"
        self.paths = recording.LakePaths(f"{root}/facts", f"{root}/decisions", f"{root}/markers")

    def send(self, *given):
        messages(self.spark, *given).coalesce(1).write.mode("append").parquet(self.raw)

    def run(self):
        stream = streams.read_raw_messages(self.spark, self.raw, "parquet")
        recorder.record_stream(stream, self.paths, self.ledger, identities(self.spark), self.checkpoint).awaitTermination()

    def rows(self):
        return sorted((r["batch_id"], r["evidence_proof"], r["category"] or "", r["defect"] or "") for r in recorder.read_ledger(self.spark, self.ledger).collect())

    def counts(self):
        return tables.read_facts(self.spark, self.paths.facts).count(), store.read_decisions(self.spark, self.paths.decisions).count(), store.read_markers(self.spark, self.paths.markers).count()


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_a_failing_fact_is_kept_to_itself(feed):
    feed.send((1, payload()), (2, payload("fill-78")), (2, payload("fill-78")))
    feed.run()
    assert feed.rows() == [(0, "proven", "accepted", "")] * 2 and feed.counts() == (2, 2, 4)
    # 1 comes again with other content, 3 twice with different content; 2 is replayed and 4 is new
    feed.send((1, payload(price="0.9000")), (2, payload("fill-78")), (3, payload("a")), (3, payload("b")), (4, payload("fill-80")))
    feed.run()
    late = [r for r in feed.rows() if r[0] == 1]
    assert late == [(1, "not_sent", "", "content_conflict")] * 2 + [(1, "proven", "accepted", "")] * 2
    assert feed.counts() == (3, 3, 6)
    feed.run()
    assert feed.counts() == (3, 3, 6) and len(feed.rows()) == 6


@pytest.mark.parametrize("step", ["append_decisions", "append_availability"])
def test_a_stop_between_two_writes_is_made_good(feed, monkeypatch, step):
    feed.send((1, payload()), (2, payload("fill-78")))

    def lost(*given):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, step, lost)
        with pytest.raises(Exception, match="lost"):
            feed.run()
    assert feed.rows() == [] and tables.read_facts(feed.spark, feed.paths.facts).count() == 2
    feed.run()
    assert feed.rows() == [(0, "proven", "accepted", "")] * 2 and feed.counts() == (2, 2, 4)


def test_a_batch_in_the_ledger_is_not_run_again_and_an_empty_one_leaves_nothing(feed, spark):
    none = spark.createDataFrame([], S.RAW_MESSAGE)
    recorder.record_batch(spark, feed.paths, feed.ledger, none, identities(spark), 0)
    assert feed.rows() == []
    raw = messages(spark, (1, payload()))
    for _ in range(2):
        recorder.record_batch(spark, feed.paths, feed.ledger, raw, identities(spark), 7)
    other = raw.withColumn("value", F.lit("{}"))
    recorder.record_batch(spark, feed.paths, feed.ledger, other, identities(spark), 7)
    assert feed.rows() == [(7, "proven", "accepted", "")] and feed.counts() == (1, 1, 2)
