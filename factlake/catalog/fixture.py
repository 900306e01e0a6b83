"""Lake tables derived from the given ``events`` table by arithmetic on its ids.

Every event becomes one fact (or one raw message, or one market request), so the derived tables grow
with the given one.  The rules are plain enough to be restated in the SQL twins of the queries.

Plans are built once per session and folder: building an expression costs more than a small scan.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.operators import availability as A
from factlake.operators import store, truth
from factlake.operators.replay import REQUEST_DDL
from factlake.plans.replay_plan import Lake
from factlake.session import materialize

MINUTE_NS = 60 * S.NS_PER_SECOND
SERIES_SUFFIX = "15M-24JAN"


def asset_of(user_id: Column) -> Column:
    names = F.array(*[F.lit(a) for a in S.ASSETS])
    return F.element_at(names, (F.pmod(user_id, F.lit(9)) + 1).cast("int"))


def events_of(given: DataFrame) -> DataFrame:
    """The given table with ``us``, its instant in epoch microseconds, and an asset."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return given.select(
        "event_id", "user_id", "event_type", us.alias("us"), asset_of(F.col("user_id")).alias("asset")
    )


@lru_cache(maxsize=16)
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given table; when it arrives in fewer splits than there are cores (one small file), its
    rows are spread first, because every derived payload is built and parsed from here on."""
    given = events_of(spark.read.parquet(f"{sf_dir}/events.parquet"))
    cores = spark.sparkContext.defaultParallelism
    if given.rdd.getNumPartitions() * 2 <= cores:
        given = given.repartition(cores, "event_id")
    return given


@lru_cache(maxsize=16)
def bounds(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last instant, in µs: one aggregate, two numbers."""
    row = events(spark, sf_dir).agg(F.min("us"), F.max("us")).first()
    return row[0], row[1]


def cutoff_ns(spark: SparkSession, sf_dir: str) -> int:
    lo, hi = bounds(spark, sf_dir)
    return (lo + (hi - lo) // 2) * 1000


def every(n: int, k: int = 0) -> Column:
    return F.col("event_id") % n == k


# ----------------------------------------------------------------------------------------- facts


@lru_cache(maxsize=16)
def facts_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts_of(events(spark, sf_dir))


def facts_of(e: DataFrame) -> DataFrame:
    """One fact per event."""
    kind = (
        F.when(F.col("event_type") == "purchase", "trade")
        .when(F.col("event_type") == "error", "market_lifecycle_v2")
        .when(F.col("event_type") == "view", "ticker")
        .otherwise("orderbook_delta")
    )
    e = e.withColumn("kind", kind).withColumn(
        "defect", F.when((F.col("kind") == "trade") & every(41), F.col("event_id") % 5).otherwise(-1)
    )
    ticker = F.concat(F.lit("KX"), "asset", F.lit(SERIES_SUFFIX))
    e = e.withColumn("source_id", ticker)
    sid = F.col("event_id") % 7 + 1
    second = F.lit(1704067200).cast("bigint") + F.col("event_id") % 97
    trade_id = F.when(F.col("defect") == 3, "").otherwise(
        F.concat(F.lit("t"), (F.col("event_id") % 97).cast("string"))
    )
    market = F.when(F.col("defect") == 4, "OTHER").otherwise(F.col("source_id"))
    args = {
        "sid": sid.cast("string"),
        "tid": trade_id,
        "market": market,
        "p": (F.col("event_id") % 3).cast("string"),
        "ts": second.cast("string"),
    }
    plain = fill(
        '{"type":"trade","sid":<sid>,"seq":null,"msg":{"trade_id":"<tid>","market_ticker":"<market>",'
        '"yes_price":"0.4<p>00","no_price":"0.6150","count":"9.00","taker_side":"yes","ts":<ts>,'
        '"is_block_trade":false,"ts_ms":<ts>000}}',
        args,
    )
    reordered = fill(
        '{ "msg": {"ts_ms": <ts>000, "ts": <ts>, "is_block_trade": false, "taker_side": "yes", '
        '"count": "9.00", "no_price": "0.6150", "yes_price": "0.4<p>00", "market_ticker": "<market>", '
        '"trade_id": "<tid>"}, "sid": <sid>, "type": "trade"}',
        args,
    )
    other = fill(
        '{"type":"<kind>","sid":<sid>,"msg":{"market_ticker":"<market>"}}', {**args, "kind": F.col("kind")}
    )
    payload = (
        F.when(F.col("kind") != "trade", other)
        .when(F.col("defect") == 2, "not json")
        .when(every(4, 1), reordered)
        .otherwise(plain)
    )
    lag_us = F.col("event_id") % 5 * 1000
    return e.select(
        "event_id",
        F.concat(F.lit("c"), F.lpad(F.col("event_id").cast("string"), 10, "0")).alias("capture_id"),
        "asset",
        F.when(F.col("defect") == 1, "other").otherwise(S.PROVIDER).alias("provider"),
        "source_id",
        F.col("kind").alias("channel"),
        F.col("kind").alias("message_type"),
        F.when(F.col("kind") == "market_lifecycle_v2", "created").alias("event_subtype"),
        sid.alias("sid"),
        F.when(every(3), F.col("event_id")).alias("seq"),
        F.when(F.col("event_type") != "error", (F.col("us") - lag_us) * 1000).alias("provider_ns"),
        (F.col("us") * 1000).alias("received_ns"),
        F.when(F.col("defect") == 0, "market-ingress/v2")
        .otherwise(S.MESSAGE_SCHEMA)
        .alias("schema_version"),
        payload.alias("payload"),
    )


def fill(template: str, args: dict[str, Column]) -> Column:
    """Concatenation of a text with ``<name>`` holes."""
    parts: list[Column] = []
    for piece in template.replace("<", "\0<").replace(">", ">\0").split("\0"):
        if piece.startswith("<"):
            parts.append(args[piece[1:-1]])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


@lru_cache(maxsize=16)
def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts_with_id(spark, sf_dir).select(*S.FACT_COLUMNS)


@lru_cache(maxsize=16)
def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truth.decide_new(facts(spark, sf_dir))


# --------------------------------------------------------------------------------------- markers


def availability_times() -> tuple[Column, Column]:
    received, i = F.col("received_ns"), F.col("event_id")
    minute = F.lit(MINUTE_NS).cast("bigint")
    evidence = F.when(~every(50, 7), received + i % 11 * minute)
    authority = F.when(~every(70, 9), received + i % 17 * minute)
    return evidence, authority


def markers(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """Markers of every fact that has them; one scan, up to two rows per fact."""
    evidence, authority = availability_times()
    auth = A.DEFAULT_AUTHORITIES
    f = facts_with_id(spark, sf_dir).select("event_id", "capture_id", "received_ns")
    sides = F.array(
        F.struct(
            F.lit("evidence").alias("kind"),
            F.lit(None).cast("string").alias("policy_version"),
            evidence.alias("available_at_ns"),
            F.lit(auth.evidence).alias("source_authority_identity"),
        ),
        F.struct(
            F.lit("authority").alias("kind"),
            F.lit(S.TRUTH_POLICY).alias("policy_version"),
            authority.alias("available_at_ns"),
            F.lit(auth.decision).alias("source_authority_identity"),
        ),
    )
    out = (
        f.select("event_id", "capture_id", "received_ns", F.explode(sides).alias("m"))
        .select("event_id", "capture_id", "received_ns", "m.*")
        .where("available_at_ns IS NOT NULL")
        .withColumn("proof_schema_version", F.lit(S.PROOF_SCHEMA))
        .withColumn("written_at_ns", F.col("available_at_ns"))
    )
    return out.select(*(["event_id"] if with_id else []), *S.MARKER_COLUMNS)


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The three tables as plans, for queries that read each of them once."""
    return Lake(facts(spark, sf_dir), decisions(spark, sf_dir), markers(spark, sf_dir))


def decided_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The same with the decisions settled first, as in a lake that stores them.

    Every call adjudicates anew; nothing is kept from one query to the next.
    """
    return Lake(facts(spark, sf_dir), materialize(decisions(spark, sf_dir)), markers(spark, sf_dir))


# -------------------------------------------------------------------------------------- requests


#: Requests per day of the fixture.
PER_DAY = 68


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``PER_DAY`` overlapping requests per UTC day of the data, with changing window, cutoff, axis, order and filters; some are bad."""
    day_us = 86_400 * 1_000_000
    days = (
        events(spark, sf_dir)
        .select(F.call_function("div", F.col("us"), F.lit(day_us).cast("bigint")).alias("day"))
        .distinct()
        .select("day", F.explode(F.sequence(F.lit(0), F.lit(PER_DAY - 1))).alias("k"))
    )
    day = F.lit(S.NS_PER_DAY).cast("bigint")
    hour = F.lit(3_600 * 1_000_000_000).cast("bigint")
    n = F.col("day") * PER_DAY + F.col("k")
    start = (F.col("day") - F.col("k") % 2) * day + F.col("k") * hour
    no_strings = F.lit(None).cast("array<string>")
    assets = (
        F.when(n % 5 == 1, F.array(F.lit("ETH"), F.lit("BTC"), F.lit("ETH")))
        .when(n % 5 == 2, F.array(F.lit("SOL")))
        .when(n % 23 == 3, F.array(F.lit("Gold")))
        .otherwise(no_strings)
    )
    channels = (
        F.when(n % 3 == 0, F.array(F.lit("trade"), F.lit("ticker"), F.lit("trade")))
        .when(n % 3 == 1, F.array(F.lit("ticker")))
        .otherwise(no_strings)
    )
    return days.select(
        F.concat(F.lit("r"), n.cast("string")).alias("request_id"),
        (F.col("day") * day + 2 * day + F.col("k") * hour).alias("cutoff_ns"),
        F.when(n % 29 == 4, "data-truth/v2").otherwise(S.TRUTH_POLICY).alias("policy_version"),
        F.when(F.col("k") % 2 == 0, "arrival_time").otherwise("event_time").alias("axis"),
        F.when(n % 4 == 0, "arrival").otherwise("strict_event").alias("ordering"),
        start.alias("start_ns"),
        F.when(n % 31 == 5, start - day).otherwise(start + (F.col("k") % 31 + 1) * hour).alias("end_ns"),
        assets.alias("assets"),
        channels.alias("channels"),
        F.when(n % 37 == 6, 0).otherwise(100).cast("bigint").alias("page_size"),
    ).select(*[c.split()[0] for c in REQUEST_DDL.split(", ")])


# --------------------------------------------------------------------------------- raw messages

RAW_TEMPLATES = {
    0: '{"type":"orderbook_snapshot","sid":1,"seq":<i>,"msg":{"market_ticker":"<ticker>","market_id":"m","yes":[["0.3650","31.00"]]}}',
    1: '{"type":"orderbook_delta","sid":2,"seq":<i>,"msg":{"market_ticker":"<ticker>","price":"0.3650","ts":<iso>,"ts_ms":<ms_or_null>}}',
    2: '{"type":"ticker","sid":3,"seq":null,"msg":{"market_ticker":"<ticker>","price":"0.3650","ts_ms":<ms>}}',
    3: '{"type":"trade","sid":4,"seq":null,"msg":{"trade_id":"t<i>","market_ticker":"<ticker>","yes_price":"0.3650","ts_ms":<ms>}}',
    4: '{"type":"market_lifecycle_v2","sid":5,"seq":null,"msg":{"event_type":"created","market_ticker":"<ticker>"}}',
    5: '{"type":"event_fee_update","sid":6,"seq":null,"msg":{"event_ticker":"EV-<asset>","fee_type_override":null}}',
    6: '{"type":"cfbenchmarks_value","sid":7,"seq":null,"msg":{"index_id":"<ref>","received_at":1}}',
    7: '{"type":"pyth_value","sid":8,"seq":<i>,"msg":{"underlying_ticker":"<ref>","value_usd":"1.50","source_ts_ms":<ms>}}',
    8: '{"type":"cfbenchmarks_value_indexlist","sid":9,"seq":null,"msg":{"index_ids":["BRTI"]}}',
    9: '{"type":"mystery","sid":10,"msg":{}}',
    10: '{"type":"ticker","sid":3,"seq":null,"msg":{"market_ticker":"OTHER","ts_ms":<ms>}}',
    11: "not json <i>",
}
REF_ID = {asset: provider_id for asset, _, provider_id in S.REFERENCE_IDS}


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event; its position is the event id."""
    e = events(spark, sf_dir)
    i = F.col("event_id")
    ref = F.create_map(*[F.lit(x) for kv in REF_ID.items() for x in kv])
    ticker = F.when(i % 36 == 14, "UNVERIFIED").otherwise(F.concat(F.lit("KX"), "asset", F.lit(SERIES_SUFFIX)))
    e = e.withColumn("ticker", ticker)
    ms = F.call_function("div", F.col("us"), F.lit(1000).cast("bigint"))
    ts = F.timestamp_micros("us")
    iso = (
        F.when(i % 5 == 0, F.concat(F.lit('"'), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z"')))
        .when(i % 5 == 1, F.concat(F.lit('"'), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('+01:00"')))
        .when(i % 5 == 2, F.concat(F.lit('"'), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit('"')))
        .when(i % 5 == 3, F.lit('"soon"'))
        .otherwise(F.lit("null"))
    )
    args = {
        "i": i.cast("string"),
        "ticker": F.col("ticker"),
        "asset": F.col("asset"),
        "ref": ref[F.col("asset")],
        "ms": ms.cast("string"),
        "ms_or_null": F.when(i % 7 == 0, ms.cast("string")).otherwise(F.lit("null")),
        "iso": iso,
    }
    value: Column | None = None
    for k, template in RAW_TEMPLATES.items():
        text = fill(template, args)
        value = F.when(i % 12 == k, text) if value is None else value.when(i % 12 == k, text)
    return e.select(
        F.lit("feed").alias("source"),
        F.pmod(F.col("user_id"), F.lit(4)).alias("partition"),
        i.alias("offset"),
        (F.col("us") * 1000).alias("received_ns"),
        F.when(~(i % 12).isin(6, 7, 8), F.col("ticker")).alias("binding_ticker"),
        value.alias("value"),
    )


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified identities of the assets that occur."""
    return (
        events(spark, sf_dir)
        .select("asset")
        .distinct()
        .select(
            F.concat(F.lit("KX"), "asset", F.lit(SERIES_SUFFIX)).alias("ticker"),
            F.concat(F.lit("EV-"), "asset").alias("event_ticker"),
            "asset",
        )
    )


# --------------------------------------------------------------------------------------- markets


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (asset, 15-minute window) pairs; ``w`` is the window index since the epoch."""
    width = F.lit(S.QUARTER_HOUR_US).cast("bigint")
    start = F.col("w") * width
    return (
        events(spark, sf_dir)
        .select("asset", F.call_function("div", F.col("us"), width).alias("w"))
        .distinct()
        .select(
            F.concat_ws(":", "asset", F.col("w").cast("string")).alias("request_id"),
            "asset",
            "w",
            F.timestamp_micros(start).alias("open_time"),
            F.timestamp_micros(start + width).alias("close_time"),
        )
    )


def market_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows(spark, sf_dir).select("request_id", "asset", "open_time", "close_time")


def series_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_requests(spark, sf_dir).withColumn(
        "series_ticker", F.concat(F.lit("KX"), "asset", F.lit("15M"))
    )


def raw_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets of those windows: every 17th absent, every 13th twice, every 7th without a usable
    strike, every third under another ticker than predicted."""
    from factlake.functions.exprs import predicted_ticker

    w = F.col("w")
    series = F.concat(F.lit("KX"), "asset", F.lit("15M"))
    ticker = F.when(w % 3 == 0, F.concat(series, F.lit("-W"), w.cast("string"))).otherwise(
        predicted_ticker(series, F.col("close_time"))
    )
    copies = F.when(w % 13 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    none = F.lit(None).cast("string")
    return (
        windows(spark, sf_dir)
        .where(w % 17 != 0)
        .withColumn("copy", F.explode(copies))
        .select(
            series.alias("series_ticker"),
            ticker.alias("ticker"),
            F.concat(F.lit("EV-"), "asset").alias("event_ticker"),
            "open_time",
            "close_time",
            F.when(w % 5 == 0, "less_or_equal")
            .when(w % 5 == 1, "between")
            .otherwise("greater")
            .alias("strike_type"),
            F.when(w % 7 == 0, "n/a").when(w % 5 != 0, "100.5").otherwise(none).alias("floor_strike"),
            F.when((w % 7 != 0) & (w % 5).isin(0, 1), "200.25").otherwise(none).alias("cap_strike"),
            F.lit("").alias("yes_sub_title"),
            none.alias("functional_strike"),
        )
    )


# ------------------------------------------------------------------------------- stored decisions


def stored_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.export_decisions(decisions(spark, sf_dir), F.lit(0))
