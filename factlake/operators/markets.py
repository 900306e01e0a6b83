"""Quarter-hour windows, candidate tickers and verification against official markets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.operators.skew import lookup_unique

ENVELOPE_SECONDS = 900


def quarter_hour_window(df: DataFrame, ts: str = "ts") -> DataFrame:
    w = F.window(ts, "15 minutes")
    return df.withColumn("open_time", w["start"]).withColumn("close_time", w["end"])


def next_window(df: DataFrame) -> DataFrame:
    step = F.expr("INTERVAL 15 MINUTES")
    return df.withColumn("open_time", F.col("open_time") + step).withColumn(
        "close_time", F.col("close_time") + step
    )


def strike_decimal(text: Column) -> Column:
    return text.try_cast("decimal(38,18)")


def translate_market(raw: DataFrame) -> DataFrame:
    """Typed market rows; a strike that is not a decimal becomes null."""
    return raw.select(
        "series_ticker",
        "ticker",
        "event_ticker",
        "open_time",
        "close_time",
        "strike_type",
        strike_decimal(F.col("floor_strike")).alias("floor_strike"),
        strike_decimal(F.col("cap_strike")).alias("cap_strike"),
        "yes_sub_title",
        "functional_strike",
    )


def usable_strike() -> Column:
    floor, cap = F.col("floor_strike").isNotNull(), F.col("cap_strike").isNotNull()
    kind = F.col("strike_type")
    return (
        F.when(kind.isin("greater", "greater_or_equal"), floor & ~cap)
        .when(kind.isin("less", "less_or_equal"), ~floor & cap)
        .when(kind == "between", floor & cap)
        .otherwise(F.lit(False))
    )


def discover_markets(requests: DataFrame, markets: DataFrame) -> DataFrame:
    """Markets of the series that close within 15 minutes of the requested close, both ends included.

    There are only nine series, so joining on the series alone would pair everything with everything.
    Close times are put into quarter-hour cells; a request asks the three cells its envelope can
    touch, and the exact bound is checked on what meets.
    """
    cell = ENVELOPE_SECONDS
    close_s = F.floor(F.unix_micros("close_time") / 1_000_000).cast("bigint")
    own_cell = X.floor_div(close_s, cell)
    asked = requests.select(
        "request_id",
        "series_ticker",
        F.col("close_time").alias("request_close"),
        F.explode(F.array(own_cell - 1, own_cell, own_cell + 1)).alias("cell"),
    )
    offered = markets.withColumn("cell", own_cell)
    gap = F.unix_micros("close_time") - F.unix_micros("request_close")
    bound = F.lit(ENVELOPE_SECONDS * 1_000_000).cast("bigint")
    return (
        asked.join(offered, ["series_ticker", "cell"])
        .where((gap >= -bound) & (gap <= bound))
        .drop("cell")
    )


def exact_markets(markets: DataFrame) -> DataFrame:
    """Markets folded to one row per (series, open, close): how many, and the one when single.

    Folding is map-side combined, so thousands of copies of one market cost nothing downstream.
    """
    return (
        markets.withColumn("usable", usable_strike())
        .groupBy("series_ticker", "open_time", "close_time")
        .agg(
            F.count(F.lit(1)).alias("n_markets"),
            F.min(F.struct("ticker", "event_ticker", "usable")).alias("only"),
        )
    )


def verify_market(requests: DataFrame, markets: DataFrame) -> DataFrame:
    """Verification status of each request.  Duplicates are judged before the strike is.

    ``requests(request_id, asset, series_ticker, open_time, close_time)``; a request whose
    ``(asset, series_ticker)`` is not an approved pair is invalid.
    """
    keys = ["series_ticker", "open_time", "close_time"]
    spark = requests.sparkSession
    approved = F.broadcast(S.market_scope(spark).withColumn("approved", F.lit(True)))
    asked = requests.join(approved, ["asset", "series_ticker"], "left")
    found = lookup_unique(asked, exact_markets(markets), keys, ["request_id"])
    n = F.coalesce(F.col("n_markets"), F.lit(0).cast("bigint"))
    ok = F.col("approved").isNotNull()
    ticker, event_ticker = F.col("only.ticker"), F.col("only.event_ticker")
    nameless = X.blank(ticker) | X.blank(event_ticker)
    status = (
        F.when(~ok, "invalid")
        .when(n == 0, "no_match")
        .when(n > 1, "ambiguous")
        .when(nameless | ~F.col("only.usable"), "invalid")
        .otherwise("verified")
    )
    reason = (
        F.when(~ok, "binding_not_approved")
        .when(n == 0, "no_market")
        .when(n > 1, "several_markets")
        .when(nameless, "market_without_name")
        .when(~F.col("only.usable"), "strike_not_usable")
    )
    return found.select(
        "request_id",
        "asset",
        *keys,
        n.alias("n_markets"),
        status.alias("status"),
        reason.alias("reason"),
        F.when(status == "verified", ticker).alias("official_ticker"),
        F.when(status == "verified", event_ticker).alias("official_event_ticker"),
    )


def shadow_status(candidate: Column, status: Column, official: Column) -> Column:
    return (
        F.when(candidate.isNull(), "candidate_missing")
        .when(status == "no_match", "official_missing")
        .when(status != "verified", "verification_failed")
        .when(candidate == official, "match")
        .otherwise("mismatch")
    )


def resolve_markets(requests: DataFrame, markets: DataFrame) -> DataFrame:
    """(asset, window) requests -> candidate, verification and comparison, in one plan.

    An exact match lies inside the discovery envelope by definition, so verification reads the market
    table directly; ``discover_markets`` is for listing the neighbours.
    """
    scope = F.broadcast(S.market_scope(requests.sparkSession))
    bound = requests.join(scope, "asset", "left")
    verified = verify_market(bound, markets)
    unknown = F.col("series_ticker").isNull()
    candidate = X.predicted_ticker(F.col("series_ticker"), F.col("close_time"))
    return verified.select(
        "request_id",
        "asset",
        "open_time",
        "close_time",
        candidate.alias("candidate_ticker"),
        "status",
        F.when(unknown, "unknown asset").otherwise(F.col("reason")).alias("reason"),
        "official_ticker",
        shadow_status(candidate, F.col("status"), F.col("official_ticker")).alias("shadow"),
    )
