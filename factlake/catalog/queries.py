"""One registered query per operator, over lake tables derived from the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.catalog import fixture as fx
from factlake.functions import exprs as X
from factlake.functions.trades import projection
from factlake.operators import availability as A
from factlake.operators import dataset, ingest, markets, store, truth
from factlake.operators import replay as R
from factlake.plans import recording
from factlake.plans.paging import SnapshotPages
from factlake.plans.replay_plan import (
    ReplayView,
    many_summaries,
    replay_as_of,
)
from factlake.session import materialize, new_folder
from factlake.sources import tables
from factlake.streaming import recorder, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
every = fx.every


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------------ sources, sinks, storage checks


@query
def scan_capture_range(spark, sf):
    lo, hi = fx.bounds(spark, sf)
    quarter = (hi - lo) // 4
    out = tables.scan_capture_range(
        fx.facts(spark, sf), (lo + quarter) * 1000, (hi - quarter) * 1000, channel="ticker", order="provider"
    )
    return out.select("capture_id", "asset", "source_id", "provider_ns", "received_ns")


@query
def lookup_capture(spark, sf):
    f = fx.facts_with_id(spark, sf)
    stored = f.unionByName(f.where(every(500))).where(~every(9, 4))
    return store.lookup_capture(f.select("capture_id"), stored)


@query
def append_captures(spark, sf):
    f = fx.facts_with_id(spark, sf)
    existing = f.where(every(3))
    sent = f.unionByName(f.where(every(10)))
    return store.plan_append_captures(sent, existing).select("capture_id", "received_ns", "payload")


@query
def commit_captures(spark, sf):
    """Facts written in two commits; the second sends the first's again, and some of its own twice."""
    f, path = fx.facts_with_id(spark, sf), f"{new_folder(spark, 'append')}/facts"
    for sent in (f.where(every(3)), f.unionByName(f.where(every(10)))):
        store.append_captures(spark, path, sent.select(*S.FACT_COLUMNS))
    return tables.read_facts(spark, path).select("capture_id", "received_ns", "payload")


@query
def commit_decisions(spark, sf):
    """Decisions written in two commits that overlap."""
    d, path = materialize(fx.decisions(spark, sf)), f"{new_folder(spark, 'append')}/decisions"
    for sent in (d.where(F.substring("subject_capture_id", 2, 10).cast("bigint") % 2 == 0), d):
        store.append_decisions(spark, path, sent)
    return store.read_decisions(spark, path).select("subject_capture_id", "category")


@query
def commit_availability(spark, sf):
    """Markers written in two commits that overlap, each beside the floor that the commits state."""
    m, path = materialize(fx.markers(spark, sf, with_id=True)), f"{new_folder(spark, 'append')}/markers"
    for sent in (m.where(every(2)), m):
        store.append_availability(spark, path, sent.select(*S.MARKER_COLUMNS))
    floor = F.lit(A.stored_floor(spark, path)).cast("bigint").alias("committed_floor")
    return store.read_markers(spark, path).select("kind", "capture_id", "policy_version", floor)


@query
def stream_append_captures(spark, sf):
    """Appends the whole stream twice over one checkpoint, then replays it from another."""
    base = new_folder(spark, "append")
    stream = _fact_stream(spark, sf)
    for checkpoint in ("a", "a", "b"):
        q = streams.stream_append_captures(stream, f"{base}/facts", f"{base}/checkpoint-{checkpoint}")
        q.awaitTermination()
    return tables.read_facts(spark, f"{base}/facts").select("capture_id", "asset", "received_ns", "payload")


def _fact_stream(spark, sf):
    """The given table as a file stream, through the same derivation as the batch facts.

    The table may be one file or a folder of files; a stream source is always a folder.
    """
    path = f"{sf}/events.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if store.is_file(spark, path):
        given = reader.option("pathGlobFilter", "events.parquet").parquet(sf)
    else:
        given = reader.parquet(path)
    return fx.facts_of(fx.events_of(given)).select(*S.FACT_COLUMNS)


@query
def audit_duplicate_captures(spark, sf):
    f = fx.facts_with_id(spark, sf)
    later = f.where(every(200, 5)).withColumn("received_ns", F.col("received_ns") + 1)
    return store.audit_duplicate_captures(f.unionByName(f.where(every(100, 3))).unionByName(later))


def _broken_facts(spark, sf):
    f = fx.facts_with_id(spark, sf)
    none = F.lit(None)
    return (
        f.withColumn("source_id", F.when(every(20), "").otherwise(F.col("source_id")))
        .withColumn("message_type", F.when(every(20, 1), none).otherwise(F.col("message_type")))
        .withColumn("asset", F.when(every(20, 2), "Gold").otherwise(F.col("asset")))
        .withColumn("sid", F.when(every(20, 3), none).otherwise(F.col("sid")))
        .withColumn("payload", F.when(every(20, 4), none).otherwise(F.col("payload")))
        .withColumn("provider", F.when(every(20, 5), none).otherwise(F.col("provider")))
    )


@query
def validate_capture_rows(spark, sf):
    return tables.validate_rows(_broken_facts(spark, sf), "capture_fact").select(
        "capture_id", "asset", "reject_reason"
    )


def _broken_decisions(spark, sf):
    i = F.substring("subject_capture_id", 2, 10).cast("bigint")
    d = fx.stored_decisions(spark, sf).withColumn("event_id", i)
    none = F.lit(None)
    return (
        d.withColumn("category", F.when(every(20), "maybe").otherwise(F.col("category")))
        .withColumn("reason", F.when(every(20, 1), "because").otherwise(F.col("reason")))
        .withColumn(
            "contributing_capture_ids",
            F.when(every(20, 2), "[1]")
            .when(every(20, 3), "c1")
            .otherwise(F.col("contributing_capture_ids")),
        )
        .withColumn("event_trade_id", F.when(every(20, 4), none).otherwise(F.col("event_trade_id")))
        .drop("event_id")
    )


@query
def validate_decision_rows(spark, sf):
    return tables.validate_rows(_broken_decisions(spark, sf), "truth_decision").select(
        "subject_capture_id", "reject_reason"
    )


def _broken_markers(spark, sf):
    m = fx.markers(spark, sf, with_id=True)
    none = F.lit(None)
    return (
        m.withColumn("kind", F.when(every(20), "hearsay").otherwise(F.col("kind")))
        .withColumn("policy_version", F.when(every(20, 1), none).when(every(20, 2), "p").otherwise(F.col("policy_version")))
        .withColumn("available_at_ns", F.when(every(20, 3), -1).otherwise(F.col("available_at_ns")))
        .withColumn("proof_schema_version", F.when(every(20, 4), "v0").otherwise(F.col("proof_schema_version")))
        .withColumn(
            "source_authority_identity", F.when(every(20, 5), "").otherwise(F.col("source_authority_identity"))
        )
        .drop("event_id")
    )


@query
def validate_availability_rows(spark, sf):
    return (
        tables.validate_rows(_broken_markers(spark, sf), "availability")
        .groupBy("capture_id", "kind")
        .agg(F.max("reject_reason").alias("reject_reason"), F.count(F.lit(1)).alias("n"))
    )


@query
def check_table_contract(spark, sf):
    given = {
        "capture_fact": _broken_facts(spark, sf).drop("event_id"),
        "truth_decision": _broken_decisions(spark, sf),
        "availability": fx.markers(spark, sf).withColumn("written_at_ns", F.lit("x")).withColumn("note", F.lit("")),
    }
    return tables.check_table_contract(spark, given)


@query
def evolve_capture_schema(spark, sf):
    old = fx.facts(spark, sf).drop("source_id", "event_subtype")
    evolved = tables.validate_rows(tables.evolve_capture_schema(old), "capture_fact")
    return evolved.select("capture_id", "message_type", "source_id", "event_subtype", "reject_reason")


@query
def append_decisions(spark, sf):
    d = fx.decisions(spark, sf).withColumn("event_id", F.substring("subject_capture_id", 2, 10).cast("bigint"))
    stored = d.where(every(2)).withColumn("category", F.when(every(10, 4), "conflict").otherwise(F.col("category")))
    return store.plan_append_decisions(d, stored).select("subject_capture_id", "category", "outcome")


@query
def find_subject_decision(spark, sf):
    d = fx.decisions(spark, sf).withColumn("event_id", F.substring("subject_capture_id", 2, 10).cast("bigint"))
    stored = d.where(~every(7)).unionByName(d.where(every(1000, 1)))
    return store.find_subject_decision(d, stored)


@query
def append_availability(spark, sf):
    m = fx.markers(spark, sf, with_id=True)
    stored = m.where(every(2)).withColumn(
        "available_at_ns", F.col("available_at_ns") + F.when(every(10, 4), 1).otherwise(0)
    )
    return store.plan_append_availability(m, stored).select("kind", "capture_id", "policy_version", "outcome")


# ---------------------------------------------------------------------------------------- ingest


@query
def read_raw_messages(spark, sf):
    """Whole feed written as JSON files, read back as a stream."""
    base = new_folder(spark, "raw")
    fx.raw_messages(spark, sf).write.json(f"{base}/in")
    stream = streams.read_raw_messages(spark, f"{base}/in")
    q = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
    )
    q.awaitTermination()
    return spark.read.schema(S.RAW_MESSAGE).parquet(f"{base}/out")


@query
def subscribe_scope_filter(spark, sf):
    """Every message under the source of its feed; the fixture also sends ids of one source under the other."""
    parsed = ingest.parse_messages(fx.raw_messages(spark, sf))
    ids = parsed.select(
        "offset",
        F.when(F.col("m.type") == "pyth_value", "pyth_value").otherwise("cf_benchmarks").alias("source"),
        F.coalesce("m.msg.index_id", "m.msg.underlying_ticker", "m.msg.market_ticker").alias("provider_id"),
    )
    scope = S.reference_scope(spark)
    asked = [ingest.subscription(scope.where(F.col("source") == s), s) for s in ("cf_benchmarks", "pyth_value")]
    return ingest.subscribe_scope_filter(ids, asked[0].unionByName(asked[1]))


@query
def normalize_messages(spark, sf):
    out = ingest.normalize_messages(
        fx.raw_messages(spark, sf), fx.identities(spark, sf), S.reference_scope(spark)
    )
    return out


@query
def reject_messages(spark, sf):
    return ingest.reject_messages(
        fx.raw_messages(spark, sf), fx.identities(spark, sf), S.reference_scope(spark)
    )


@query
def event_time_ms_to_ns(spark, sf):
    m = ingest.parse_messages(fx.raw_messages(spark, sf))
    ms = F.when(F.col("m.type") == "pyth_value", F.col("m.msg.source_ts_ms")).otherwise(F.col("m.msg.ts_ms"))
    return m.where(ms.isNotNull()).select("offset", ms.alias("ts_ms"), X.ms_to_ns(ms).alias("event_ns"))


@query
def delta_event_time(spark, sf):
    m = ingest.parse_messages(fx.raw_messages(spark, sf)).where("m.type = 'orderbook_delta'")
    return m.select("offset", X.delta_event_time(F.col("m.msg.ts_ms"), F.col("m.msg.ts")).alias("event_ns"))


@query
def assign_capture_id(spark, sf):
    return fx.raw_messages(spark, sf).select(
        "partition",
        "offset",
        ingest.assign_capture_id(F.col("source"), F.col("partition"), F.col("offset")).alias("capture_id"),
    )


@query
def bind_reference_asset(spark, sf):
    m = ingest.parse_messages(fx.raw_messages(spark, sf)).select(
        "offset",
        F.when(F.col("m.type") == "cfbenchmarks_value", "cf_benchmarks")
        .when(F.col("m.type") == "pyth_value", "pyth_value")
        .alias("source"),
        F.coalesce("m.msg.index_id", "m.msg.underlying_ticker").alias("provider_id"),
    )
    return ingest.bind_reference_asset(m.where("source IS NOT NULL"), S.reference_scope(spark))


@query
def bind_market_identity(spark, sf):
    bound = ingest.bind_market_identity(fx.raw_messages(spark, sf), fx.identities(spark, sf))
    return bound.select("offset", "binding_ticker", "bound_event_ticker", "bound_asset")


@query
def scope_dimensions(spark, sf):
    """Both dimensions joined to the assets that occur, with the one-to-one check of each."""
    market, reference = S.market_scope(spark), S.reference_scope(spark)
    seen = fx.events(spark, sf).groupBy("asset").agg(F.count(F.lit(1)).alias("n_events"))
    both = seen.join(F.broadcast(market), "asset").join(F.broadcast(reference), "asset")
    checks = [
        ingest.check_scope(market, ("asset", "series_ticker")).select(F.col("bijective").alias("market_ok")),
        ingest.check_scope(reference, ("asset", "provider_id")).select(F.col("bijective").alias("reference_ok")),
    ]
    for check in checks:
        both = X.with_one_row(both, check)
    return both


# -------------------------------------------------------------------------------------- markets


def _us(*names):
    return [F.unix_micros(n).alias(f"{n}_us") for n in names]


def _instants(spark, sf):
    return fx.events(spark, sf).select("event_id", "us", F.timestamp_micros("us").alias("ts"))


@query
def quarter_hour_window(spark, sf):
    return markets.quarter_hour_window(_instants(spark, sf)).select("event_id", *_us("open_time", "close_time"))


@query
def next_window(spark, sf):
    w = markets.next_window(markets.quarter_hour_window(_instants(spark, sf)))
    return w.select("event_id", *_us("open_time", "close_time"))


@query
def valid_window(spark, sf):
    """Windows of the data, some moved or stretched by their id."""
    w = markets.quarter_hour_window(_instants(spark, sf))
    shift = F.when(every(5, 1), 1).when(every(5, 2), 60_000_000).otherwise(0)
    stretch = F.when(every(5, 3), 1).otherwise(0)
    o = F.timestamp_micros(F.unix_micros("open_time") + shift)
    c = F.timestamp_micros(F.unix_micros("close_time") + shift + stretch)
    return w.select("event_id", X.is_quarter_hour_window(o, c).alias("valid"))


@query
def predict_ticker(spark, sf):
    r = fx.series_requests(spark, sf)
    series = F.when(F.col("asset") == "BNB", "OTHER").otherwise(F.col("series_ticker"))
    return r.select("request_id", X.predicted_ticker(series, F.col("close_time")).alias("candidate_ticker"))


@query
def discover_markets(spark, sf):
    m = markets.translate_market(fx.raw_markets(spark, sf))
    return markets.discover_markets(fx.series_requests(spark, sf), m).select(
        "request_id", "ticker", *_us("close_time")
    )


@query
def translate_market(spark, sf):
    m = markets.translate_market(fx.raw_markets(spark, sf))
    return m.select(
        "series_ticker",
        "ticker",
        *_us("open_time"),
        "strike_type",
        F.col("floor_strike").cast("double").alias("floor_strike"),
        F.col("cap_strike").cast("double").alias("cap_strike"),
    )


@query
def usable_strike(spark, sf):
    m = markets.translate_market(fx.raw_markets(spark, sf))
    return m.select("series_ticker", "ticker", *_us("open_time"), markets.usable_strike().alias("usable"))


@query
def verify_market(spark, sf):
    m = markets.translate_market(fx.raw_markets(spark, sf))
    return markets.verify_market(fx.series_requests(spark, sf), m).select(
        "request_id", "n_markets", "status", "reason", "official_ticker", "official_event_ticker"
    )


@query
def shadow_compare(spark, sf):
    m = markets.translate_market(fx.raw_markets(spark, sf))
    v = markets.verify_market(fx.series_requests(spark, sf), m)
    candidate = X.predicted_ticker(F.col("series_ticker"), F.col("close_time"))
    candidate = F.when(F.col("asset") != "XRP", candidate)
    return v.select(
        "request_id", markets.shadow_status(candidate, F.col("status"), F.col("official_ticker")).alias("shadow")
    )


@query
def resolve_markets(spark, sf):
    r = fx.market_requests(spark, sf)
    r = r.withColumn("asset", F.when(F.col("asset") == "HYPE", "WTI").otherwise(F.col("asset")))
    out = markets.resolve_markets(r, markets.translate_market(fx.raw_markets(spark, sf)))
    return out.select(
        "request_id", "asset", "candidate_ticker", "status", "reason", "official_ticker", "shadow"
    )


# ---------------------------------------------------------------------------------------- truth


def _flat(decisions: DataFrame) -> DataFrame:
    return decisions.select(
        "policy_version",
        "subject_capture_id",
        "category",
        F.to_json("contributing_capture_ids").alias("contributors"),
        "reason",
        F.col("event.source_id").alias("event_source_id"),
        F.col("event.trade_id").alias("event_trade_id"),
    )


@query
def route_facts(spark, sf):
    f = fx.facts_with_id(spark, sf)
    f = f.withColumn("message_type", F.when(every(50), "mystery").otherwise(F.col("message_type")))
    return truth.route_facts(f).select("capture_id", "message_type", "family")


@query
def accept_observations(spark, sf):
    return _flat(truth.accept_observations(fx.facts(spark, sf)))


@query
def validate_trades(spark, sf):
    return truth.validate_trades(fx.facts(spark, sf)).select("capture_id", "reason")


@query
def trade_identity(spark, sf):
    opened = truth.validate_trades(fx.facts(spark, sf))
    return opened.where("reason IS NULL").select("capture_id", *S.IDENTITY_COLUMNS)


@query
def trade_projection(spark, sf):
    opened = truth.validate_trades(fx.facts(spark, sf))
    return opened.where("reason IS NULL").select("capture_id", projection(F.col("payload")).alias("projection"))


@query
def adjudicate_trades(spark, sf):
    return _flat(truth.adjudicate_trades(fx.facts(spark, sf)))


def _halves(spark, sf):
    """Facts received before and from the middle of the data."""
    f, c = fx.facts(spark, sf), fx.cutoff_ns(spark, sf)
    return f.where(F.col("received_ns") < c), f.where(F.col("received_ns") >= c)


@query
def decide_facts(spark, sf):
    """Decide everything when the first half is already decided: same result as one batch."""
    first, _ = _halves(spark, sf)
    f = fx.facts(spark, sf)
    return _flat(truth.decide_facts(f, materialize(truth.decide_new(first)), f))


@query
def find_accepted_anchor(spark, sf):
    f = fx.facts(spark, sf)
    found = truth.find_accepted_anchor(truth.decide_new(f), f)
    return found.select(
        "capture_id", F.col("event.source_id").alias("event_source_id"), F.col("event.trade_id").alias("event_trade_id"), "received_ns", "payload"
    )


@query
def check_anchor_invariants(spark, sf):
    """Decisions spoiled by the id of their subject, judged against the facts."""
    f = fx.facts_with_id(spark, sf)
    d = truth.decide_new(f).withColumn("event_id", F.substring("subject_capture_id", 2, 10).cast("bigint"))
    second_trade = F.col("event").isNotNull()
    d = (
        d.withColumn("policy_version", F.when(every(4), "data-truth/v0").otherwise(F.col("policy_version")))
        .withColumn("contributing_capture_ids", F.when(every(4, 1), F.array(F.lit("x"))).otherwise(F.col("contributing_capture_ids")))
        .withColumn("event", F.when(every(4, 2) & second_trade, F.col("event").withField("trade_id", F.lit("t-none"))).otherwise(F.col("event")))
    )
    evidence = f.where(~every(3))
    return truth.check_anchor_invariants(d, evidence)


@query
def decide_incremental(spark, sf):
    """The later half is stored first; its anchors win over the earlier rows that come afterwards."""
    earlier, later = _halves(spark, sf)
    stored = materialize(truth.decide_new(later))
    return _flat(truth.decide_incremental(earlier, stored, fx.facts(spark, sf)))


@query
def decide_stream(spark, sf):
    """Facts decided by a stream; run twice over one checkpoint."""
    base = new_folder(spark, "decide")
    stream = _fact_stream(spark, sf)
    for _ in range(2):
        streams.decide_stream(stream, f"{base}/decisions", f"{base}/checkpoint").awaitTermination()
    return _flat(store.read_decisions(spark, f"{base}/decisions"))


# --------------------------------------------------------------------------------- availability


@query
def prove_evidence(spark, sf):
    f = fx.facts_with_id(spark, sf)
    stored = f.where(~every(9)).withColumn("payload", F.when(every(10), F.concat("payload", F.lit(" "))).otherwise(F.col("payload")))
    return A.prove_evidence(f, stored.unionByName(f.where(every(1000, 1))))


@query
def prove_authority(spark, sf):
    d = truth.decide_new(fx.facts(spark, sf)).withColumn("event_id", F.substring("subject_capture_id", 2, 10).cast("bigint"))
    stored = d.where(~every(9)).withColumn("category", F.when(every(10), "conflict").otherwise(F.col("category")))
    return A.prove_authority(d, stored)


def _candidates(spark, sf):
    """Candidate times that repeat in bursts: a thirteenth of the rows share few instants."""
    m = fx.markers(spark, sf, with_id=True)
    burst = F.lit(1704067200_000_000_000).cast("bigint")
    at = F.when(every(13), burst).otherwise(X.floor_div(F.col("available_at_ns"), 3_600_000_000_000) * 3_600_000_000_000)
    return m.select("event_id", *S.MARKER_KEY, at.alias("candidate_ns"), "source_authority_identity")


@query
def assign_proof_times(spark, sf):
    lo, _ = fx.bounds(spark, sf)
    timed = A.assign_proof_times(_candidates(spark, sf).drop("event_id"), floor=lo * 1000)
    return timed.select("kind", "capture_id", "available_at_ns")


@query
def record_markers(spark, sf):
    lo, _ = fx.bounds(spark, sf)
    c = _candidates(spark, sf)
    stored = fx.markers(spark, sf, with_id=True).where(every(2)).withColumn(
        "source_authority_identity", F.when(every(10, 4), "elsewhere").otherwise(F.col("source_authority_identity"))
    )
    return A.record_markers(c.drop("event_id"), stored, lo * 1000).select("kind", "capture_id", "available_at_ns", "outcome")


@query
def committed_floor(spark, sf):
    m = fx.markers(spark, sf, with_id=True)
    return A.committed_floor(m.unionByName(m.where(every(1000, 1))))


@query
def marker_lookup(spark, sf):
    m = fx.markers(spark, sf, with_id=True)
    stored = m.unionByName(m.where(every(1000, 1))).withColumn(
        "source_authority_identity", F.when(every(90, 2), "elsewhere").otherwise(F.col("source_authority_identity"))
    )
    keys = fx.facts(spark, sf).select(
        "capture_id",
        F.explode(
            F.array(
                F.struct(F.lit("evidence").alias("kind"), F.lit(None).cast("string").alias("policy_version")),
                F.struct(F.lit("authority").alias("kind"), F.lit(S.TRUTH_POLICY).alias("policy_version")),
            )
        ).alias("k"),
    )
    return A.marker_lookup(keys.select("capture_id", "k.*"), stored)


@query
def marker_reference(spark, sf):
    m = fx.markers(spark, sf)
    c = F.col
    ref = A.marker_reference(
        c("kind"), c("capture_id"), c("policy_version"), c("available_at_ns"), c("proof_schema_version"), c("source_authority_identity")
    )
    return m.select("kind", "capture_id", ref.alias("reference"))


def _gate(spark, sf):
    names = [*S.PERSISTENCE_CONTINUE, *S.PERSISTENCE_STOP, "lost"]
    status = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 6 + 1).cast("int"))
    return fx.facts_with_id(spark, sf).select("event_id", "capture_id", status.alias("persistence_status"))


@query
def persistence_gate(spark, sf):
    return A.persistence_gate(_gate(spark, sf)).select("capture_id", "persistence_status", "gate")


@query
def record_captures(spark, sf):
    """Progress of a pass in which some facts were not written and some are not visible yet."""
    f = fx.facts_with_id(spark, sf)
    stored = f.where(~every(9)).select(*S.FACT_COLUMNS)
    none = spark.createDataFrame([], S.TRUTH_DECISION)
    markers = spark.createDataFrame([], S.AVAILABILITY)
    captured = f.select(*S.FACT_COLUMNS)
    stages = recording.plan_recording(
        captured, stored, none, markers, F.col("received_ns"), None, _gate(spark, sf)
    )
    return stages.progress(captured)


@query
def record_stream(spark, sf):
    """The whole feed as a stream that had stopped after its first write, then late messages over the same checkpoint.

    Of the late ones some are exact replays and some bear the id of another content.
    """
    base = new_folder(spark, "lake")
    paths = recording.LakePaths(f"{base}/facts", f"{base}/decisions", f"{base}/markers")
    raw, identities, i = fx.raw_messages(spark, sf), fx.identities(spark, sf), F.col("offset")
    facts = store.folded_captures(ingest.normalize_messages(raw, identities, S.reference_scope(spark)))
    store.append_captures(spark, paths.facts, facts, 0)
    changed = F.when(i % 50 < 5, F.concat("value", F.lit(" "))).otherwise(F.col("value"))
    for sent in (raw, raw.where(i % 50 < 10).withColumn("value", changed)):
        sent.select(*S.RAW_MESSAGE.names).write.mode("append").parquet(f"{base}/raw")
        stream = streams.read_raw_messages(spark, f"{base}/raw", "parquet")
        recorder.record_stream(stream, paths, f"{base}/ledger", identities, f"{base}/checkpoint").awaitTermination()
    rows = recorder.read_ledger(spark, f"{base}/ledger")
    return rows.select("batch_id", "capture_id", "evidence_proof", "evidence_at", "authority_at", "defect")


@query
def recover_facts(spark, sf):
    """Whole feed recorded into stored tables, then proven again: the second run adds nothing."""
    base = new_folder(spark, "lake")
    paths = recording.LakePaths(f"{base}/facts", f"{base}/decisions", f"{base}/markers")
    raw = fx.raw_messages(spark, sf)
    recording.record_captures(spark, paths, raw, fx.identities(spark, sf))
    facts = tables.read_facts(spark, paths.facts).select(*S.FACT_COLUMNS)
    recording.recover_facts(spark, paths, facts)
    return store.read_markers(spark, paths.markers).select("kind", "capture_id", "available_at_ns")


# --------------------------------------------------------------------------------------- replay


def _request(spark, sf, **changes) -> R.AsOfRequest:
    lo, hi = fx.bounds(spark, sf)
    cutoff = (lo + (hi - lo) // 2) * 1000
    given = {"cutoff_ns": cutoff, "start_ns": lo * 1000, "end_ns": (hi + 1) * 1000}
    return R.AsOfRequest(**{**given, **changes})


DATED = ("orderbook_delta", "ticker", "trade")


def _paired(spark, sf):
    lk = fx.lake(spark, sf)
    return R.pair_candidates(lk.facts, lk.decisions, lk.markers)


@query
def validate_requests(spark, sf):
    return R.validate_requests(fx.requests(spark, sf)).select("request_id", "reject_reason")


@query
def canonical_filters(spark, sf):
    c = R.canonical_filters(fx.requests(spark, sf))
    return c.select("request_id", F.to_json("assets").alias("assets"), F.to_json("channels").alias("channels"))


@query
def request_identity(spark, sf):
    return R.request_identity(R.canonical_filters(fx.requests(spark, sf))).select("request_id", "request_identity")


@query
def pair_candidates(spark, sf):
    return _paired(spark, sf).select(
        "capture_id", "category", "received_ns", "provider_ns", "evidence_at", "authority_at", "n_fact", "n_decision", "n_evidence", "n_authority"
    )


@query
def pair_violations(spark, sf):
    """Tables with copies, gaps and foreign markers by id."""
    f, m = fx.facts_with_id(spark, sf), fx.markers(spark, sf, with_id=True)
    d = truth.decide_new(f).withColumn("event_id", F.substring("subject_capture_id", 2, 10).cast("bigint"))
    facts = f.where(~every(100, 1)).unionByName(f.where(every(100, 2)))
    decisions = d.unionByName(d.where(every(100, 3))).withColumn("category", F.when(every(100, 4), "maybe").otherwise(F.col("category")))
    markers = m.unionByName(m.where(every(100, 5))).withColumn("source_authority_identity", F.when(every(100, 6), "elsewhere").otherwise(F.col("source_authority_identity")))
    return R.pair_violations(R.pair_candidates(facts, decisions, markers))


@query
def filter_candidates(spark, sf):
    lk = fx.lake(spark, sf)
    paired = R.pair_candidates(
        lk.facts, lk.decisions, lk.markers, assets=("BTC", "SOL"), channels=("ticker", "trade")
    )
    return R.filter_candidates(paired).select("capture_id", "category")


@query
def check_pairs(spark, sf):
    i = F.col("event_id")
    p = fx.facts_with_id(spark, sf).select(
        "event_id",
        F.lit(S.TRUTH_POLICY).alias("policy_version"),
        F.col("capture_id").alias("fact_capture_id"),
        F.when(i % 70 == 0, F.concat(F.lit("x"), "capture_id")).otherwise(F.col("capture_id")).alias("subject_capture_id"),
    )
    return R.check_pairs(p.unionByName(p.where(every(90))))


@query
def qualify_as_of(spark, sf):
    return R.qualify_as_of(_paired(spark, sf), fx.cutoff_ns(spark, sf)).select("capture_id", "category", "evidence_at", "authority_at")


@query
def check_availability_pairs(spark, sf):
    evidence, authority = fx.availability_times()
    p = fx.facts_with_id(spark, sf).select(
        "capture_id",
        evidence.alias("evidence_at"),
        authority.alias("authority_at"),
        F.when(every(3), "ref").alias("evidence_reference"),
        F.when(every(7), "").when(every(2), "ref").alias("authority_reference"),
    )
    return R.check_availability_pairs(p)


@query
def replay_exclusions(spark, sf):
    return R.replay_exclusions(_paired(spark, sf), fx.cutoff_ns(spark, sf))


@query
def select_arrival_window(spark, sf):
    r = _request(spark, sf)
    q = R.qualify_as_of(_paired(spark, sf), r.cutoff_ns)
    return R.select_arrival_window(q, r.start_ns + S.NS_PER_DAY, r.cutoff_ns - S.NS_PER_DAY).select("capture_id", "received_ns")


def _dated(spark, sf, **changes) -> ReplayView:
    """A strict read on the event axis; the channel filter removes rows without event time."""
    r = _request(spark, sf, axis="event_time", ordering="strict_event", channels=DATED, **changes)
    return replay_as_of(fx.lake(spark, sf), r, strict=True)


@query
def select_event_window(spark, sf):
    lo, hi = fx.bounds(spark, sf)
    v = _dated(spark, sf, start_ns=lo * 1000 + S.NS_PER_DAY, end_ns=hi * 1000 - S.NS_PER_DAY)
    return v.keys.select("capture_id", "provider_ns")


@query
def order_arrival(spark, sf):
    q = R.qualify_as_of(_paired(spark, sf), fx.cutoff_ns(spark, sf))
    return R.order_arrival(q).select("received_ns", "capture_id")


@query
def order_strict_event(spark, sf):
    return _dated(spark, sf).ordered_keys().select("provider_ns", "received_ns", "capture_id")


@query
def snapshot_identity(spark, sf):
    v = replay_as_of(fx.lake(spark, sf), _request(spark, sf), strict=False)
    request = R.request_identity(R.request_row(v.lake.facts, v.request))
    return R.snapshot_identity(request, v.keys).select("request_identity", "n_records", "snapshot_identity")


@query
def detect_drift(spark, sf):
    """A later cutoff adds members; a fact that lost its marker is removed."""
    lk, r = fx.lake(spark, sf), _request(spark, sf)
    before = replay_as_of(lk, r, strict=False).keys
    paired = R.pair_candidates(lk.facts, lk.decisions, lk.markers)
    later = R.qualify_as_of(paired, r.cutoff_ns + S.NS_PER_DAY).where("capture_id NOT LIKE '%77'")
    return R.detect_drift(before, later)


@query
def resume_check(spark, sf):
    """One bookmark per fact, spoiled by id, judged against the rebuilt read."""
    v = replay_as_of(fx.lake(spark, sf), _request(spark, sf), strict=True)
    current = v.summary().select("request_identity", "snapshot_identity", "ordering")
    none = F.lit(None).cast("bigint")
    b = fx.facts_with_id(spark, sf).select("event_id", "capture_id", "received_ns")
    marks = X.with_one_row(b, current).select(
        F.col("capture_id").alias("bookmark_id"),
        F.when(every(7), "other").otherwise(F.col("request_identity")).alias("request_identity"),
        F.when(every(7, 1), "other").otherwise(F.col("snapshot_identity")).alias("snapshot_identity"),
        F.when(every(7, 2), "strict_event").otherwise("arrival").alias("ordering"),
        F.when(every(7, 3), F.col("received_ns")).otherwise(none).alias("last_provider_ns"),
        (F.col("received_ns") + F.when(every(7, 4), 1).otherwise(0)).alias("last_received_ns"),
        F.col("capture_id").alias("last_capture_id"),
    )
    return R.resume_check(marks, current, v.keys)


@query
def keyset_page(spark, sf):
    """The second page of 500 rows of a strict read, whose pairing is kept between the pages."""
    v = replay_as_of(fx.lake(spark, sf), _request(spark, sf), strict=True)
    last = R.keyset_page(v.keys, "arrival", 500).where("position = 500").first()
    key = (last["received_ns"], last["capture_id"])
    page = R.keyset_page(v.keys, "arrival", 500, key)
    return page.select(F.col("position").cast("bigint").alias("position"), "received_ns", "capture_id", "has_more")


@query
def replay_pages(spark, sf):
    """The first pages of a strict read, each continued from the bookmark of the one before."""
    pages = SnapshotPages(replay_as_of(fx.lake(spark, sf), _request(spark, sf), strict=True))
    at, parts = None, []
    while len(parts) < 4 and (at or not parts):
        page = pages.read(at, 500)
        parts.append(
            page.records.select(
                F.lit(len(parts) + 1).cast("bigint").alias("page"),
                F.col("position").cast("bigint").alias("position"),
                "received_ns",
                "capture_id",
                "category",
                "payload",
                "has_more",
            )
        )
        at = page.next
    return reduce(DataFrame.unionByName, parts)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Adjudicate every fact, then read the lake strictly as of the middle of the data."""
    v = replay_as_of(fx.decided_lake(spark, sf), _request(spark, sf), strict=True)
    return v.ordered_records().select(
        "capture_id",
        "asset",
        "channel",
        "source_id",
        "provider_ns",
        "received_ns",
        "payload",
        "category",
        F.to_json("contributing_capture_ids").alias("contributors"),
        F.col("event.trade_id").alias("event_trade_id"),
        "evidence_reference",
        "authority_reference",
    )


QUERIES["replay_as_of"] = flagship


@query
def view_summary(spark, sf):
    v = replay_as_of(fx.lake(spark, sf), _request(spark, sf), strict=False)
    return v.summary().select(
        "request_identity", "policy_version", "cutoff_ns", "axis", "start_ns", "end_ns", "ordering", "ordering_rule_version",
        "snapshot_identity", "completeness", "n_records", "n_evidence_missing", "n_authority_missing",
    )


def _many_candidates(spark, sf) -> DataFrame:
    return materialize(R.with_filters(_paired(spark, sf), fx.facts(spark, sf)))


@query
def replay_many(spark, sf):
    valid = R.canonical_filters(R.validate_requests(fx.requests(spark, sf)).where("reject_reason IS NULL"))
    return R.replay_many(valid, _many_candidates(spark, sf)).select("request_id", "capture_id", "category", "received_ns", "provider_ns")


@query
def replay_many_exclusions(spark, sf):
    """The exclusions of every request, folded to counts and the ends of their range of ids."""
    valid = R.canonical_filters(R.validate_requests(fx.requests(spark, sf)).where("reject_reason IS NULL"))
    candidates = R.with_rank(_many_candidates(spark, sf))
    return R.exclusion_ranges(R.replay_many_exclusions(valid, candidates, ("capture_rank",)), candidates)


@query
def replay_many_summaries(spark, sf):
    return many_summaries(fx.lake(spark, sf), fx.requests(spark, sf)).select(
        "request_id", "request_identity", "snapshot_identity", "outcome", "n_records", "n_qualified", "n_evidence_missing", "n_authority_missing"
    )


# -------------------------------------------------------------------------------------- dataset


def _view(spark, sf) -> ReplayView:
    return replay_as_of(fx.decided_lake(spark, sf), _request(spark, sf), strict=True)


@query
def collect_view(spark, sf):
    """The unpaged view of a strict read, in full."""
    v = replay_as_of(fx.decided_lake(spark, sf), _request(spark, sf), strict=True)
    return v.records().select("capture_id", "category", "message_type", "received_ns")


@query
def admit_records(spark, sf):
    return dataset.admit_records(_view(spark, sf).records()).select("capture_id", "asset", "payload", "evidence_reference")


@query
def record_digest(spark, sf):
    return _view(spark, sf).records().select("capture_id", dataset.record_digest().alias("record_digest"))


@query
def category_exclusions(spark, sf):
    return dataset.category_exclusions(_view(spark, sf).records())


@query
def exclusion_provenance(spark, sf):
    v = _view(spark, sf)
    return dataset.exclusion_provenance(v.records(), v.exclusions)


@query
def dataset_manifest(spark, sf):
    v = _view(spark, sf)
    return dataset.dataset_manifest(v.summary(), v.records(), v.exclusions)


@query
def write_snapshot(spark, sf):
    """Written twice: the second write finds the identity and leaves it alone."""
    v = _view(spark, sf)
    root = new_folder(spark, "datasets")
    for _ in range(2):
        done = dataset.write_snapshot(spark, root, v.summary(), v.records(), v.exclusions)
    return spark.read.parquet(f"{done.path}/records").select("capture_id", "asset", "record_digest")


@query
def compare_snapshots(spark, sf):
    """Two datasets of one lake, cut a day apart, with some payloads changed by id."""
    lk, r = fx.decided_lake(spark, sf), _request(spark, sf)
    before = dataset.admit_records(replay_as_of(lk, r, strict=True).records())
    later = _request(spark, sf, cutoff_ns=r.cutoff_ns + S.NS_PER_DAY)
    after = dataset.admit_records(replay_as_of(lk, later, strict=True).records())
    touched = F.col("capture_id").endswith("7")
    after = after.where("capture_id NOT LIKE '%55'").withColumn(
        "payload", F.when(touched, F.concat("payload", F.lit(" "))).otherwise(F.col("payload"))
    )
    return dataset.compare_snapshots(before, after).select("capture_id", "change")
