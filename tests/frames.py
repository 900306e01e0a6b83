"""Small hand-written tables for the tests."""

from __future__ import annotations

import json

from factlake import schemas as S

TICKER = "KXBTC15M-SAMPLE"


def payload(trade_id="fill-77", ticker=TICKER, price="0.3150", ts=1_801_234_567, ts_ms=1_801_234_567_089, **extra):
    """A trade on the wire; the price of the other side follows from ``price``."""
    cents = round(10_000 * float(price)) if price.replace(".", "", 1).isdigit() else 0
    sides = {"yes_price": price, "no_price": f"{(10_000 - cents) / 10_000:.4f}"}
    times = {"ts_ms": ts_ms, "ts": ts}
    msg = {"market_ticker": ticker, "trade_id": trade_id, **times, **sides, "count": "7.00", "taker_side": "no", "is_block_trade": False, **extra}
    return json.dumps({"type": "trade", "sid": 41, "seq": None, "msg": msg})


def fact(capture_id, received=20, provider_ns=10, **changes):
    row = {
        "capture_id": capture_id,
        "asset": "BTC",
        "provider": S.PROVIDER,
        "source_id": TICKER,
        "channel": "trade",
        "message_type": "trade",
        "event_subtype": None,
        "sid": 6,
        "seq": None,
        "provider_ns": provider_ns,
        "received_ns": received,
        "schema_version": S.MESSAGE_SCHEMA,
        "payload": payload(),
    }
    row.update(changes)
    return tuple(row[c] for c in S.FACT_COLUMNS)


def observation(capture_id, received=20, provider_ns=10, **changes):
    given = {"channel": "ticker", "message_type": "ticker", "payload": "{}", **changes}
    return fact(capture_id, received, provider_ns, **given)


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), S.CAPTURE_FACT)


def accepted(capture_id, category="accepted", policy=S.TRUTH_POLICY):
    return (policy, capture_id, category, [capture_id], None, None)


def decisions(spark, *rows):
    return spark.createDataFrame(list(rows), S.TRUTH_DECISION)


def marker(kind, capture_id, at, authority=None):
    known = S.AuthorityIdentities()
    source = authority or (known.evidence if kind == "evidence" else known.decision)
    policy = None if kind == "evidence" else S.TRUTH_POLICY
    return (kind, capture_id, policy, at, S.PROOF_SCHEMA, source, at)


def both(capture_id, evidence, authority):
    return [marker("evidence", capture_id, evidence), marker("authority", capture_id, authority)]


def markers(spark, *rows):
    return spark.createDataFrame(list(rows), S.AVAILABILITY)
