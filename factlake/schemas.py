"""Table schemas, vocabularies and the fixed scope dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values.  These must equal the published contract exactly, or identities and results differ.
# ---------------------------------------------------------------------------------------------
ASSETS = ("BTC", "ETH", "GOLD", "SILVER", "XRP", "SOL", "HYPE", "DOGE", "BNB")
PROVIDER = "kalshi"
MESSAGE_SCHEMA = "market-ingress/v1"
TRUTH_POLICY = "data-truth/v1"
PROOF_SCHEMA = "replay-availability-proof/v1"
REQUEST_VERSION = "replay-as-of-request/v1"
ORDERING_RULE_VERSION = "replay-as-of-ordering/v1"
SOURCE_VERSION = "replay-as-of-source/v1"
DATASET_POLICY = "canonical-dataset/v1"
COMPLETENESS = "not_asserted"

MARKET_SERIES = (
    ("BTC", "KXBTC15M"),
    ("ETH", "KXETH15M"),
    ("GOLD", "KXGOLD15M"),
    ("SILVER", "KXSILVER15M"),
    ("XRP", "KXXRP15M"),
    ("SOL", "KXSOL15M"),
    ("HYPE", "KXHYPE15M"),
    ("DOGE", "KXDOGE15M"),
    ("BNB", "KXBNB15M"),
)
REFERENCE_IDS = (
    ("BTC", "cf_benchmarks", "BRTI"),
    ("ETH", "cf_benchmarks", "ETHUSD_RTI"),
    ("GOLD", "pyth_value", "Metal.XAU/USD"),
    ("SILVER", "pyth_value", "Metal.XAG/USD"),
    ("XRP", "cf_benchmarks", "XRPUSD_RTI"),
    ("SOL", "cf_benchmarks", "SOLUSD_RTI"),
    ("HYPE", "cf_benchmarks", "HYPEUSD_RTI"),
    ("DOGE", "cf_benchmarks", "DOGEUSD_RTI"),
    ("BNB", "cf_benchmarks", "BNBUSD_RTI"),
)

# message type -> transport channel
MARKET_CHANNEL = {
    "orderbook_snapshot": "orderbook_delta",
    "orderbook_delta": "orderbook_delta",
    "ticker": "ticker",
    "trade": "trade",
    "market_lifecycle_v2": "market_lifecycle_v2",
    "event_fee_update": "market_lifecycle_v2",
}
REFERENCE_CHANNEL = {"cfbenchmarks_value": "cfbenchmarks_value", "pyth_value": "pyth_value"}
CONTROL_TYPES = ("cfbenchmarks_value_indexlist", "pyth_value_underlying_list")
EVENT_TYPES = ("trade",)
OBSERVATION_TYPES = (
    "orderbook_snapshot",
    "orderbook_delta",
    "ticker",
    "market_lifecycle_v2",
    "event_fee_update",
    "cfbenchmarks_value",
    "pyth_value",
)

CATEGORIES = ("accepted", "duplicate", "conflict", "not_accepted")
NOT_ACCEPTED_REASONS = (
    "invalid_trade_evidence",
    "trade_identity_mismatch",
    "unsupported_trade_schema",
)
MARKER_KINDS = ("evidence", "authority")
PERSISTENCE_STOP = ("local_persistence_failed", "definitely_rejected")
PERSISTENCE_CONTINUE = ("persisted_pending", "acknowledged_ok", "in_doubt")

EVIDENCE_MISSING = "evidence_not_available_by_cutoff"
AUTHORITY_MISSING = "authority_not_available_by_cutoff"

# Precedence in which a strict read reports defects, most important first.
ERROR_PRECEDENCE = (
    "INVALID_REQUEST",
    "SOURCE_UNAVAILABLE",
    "MALFORMED_AUTHORITY",
    "AUTHORITY_CONFLICT",
    "MALFORMED_EVIDENCE",
    "AVAILABILITY_EVIDENCE_MISSING",
    "UNSUPPORTED_EVENT_TIME",
    "INVALID_CURSOR",
    "CURSOR_MISMATCH",
)

NS_PER_US = 1_000
NS_PER_MS = 1_000_000
NS_PER_SECOND = 1_000_000_000
NS_PER_DAY = 86_400 * NS_PER_SECOND
QUARTER_HOUR_US = 900 * 1_000_000


class ContractError(RuntimeError):
    """A fail-closed stop with its bounded code."""

    def __init__(self, code: str, message: str = "") -> None:
        super().__init__(f"{code}: {message}" if message else code)
        self.code = code


# ---------------------------------------------------------------------------------------------
# Table schemas.  Nanosecond instants are BIGINT: a Spark timestamp only keeps microseconds.
# ---------------------------------------------------------------------------------------------
def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_S, _L = T.StringType(), T.LongType()

CAPTURE_FACT = _struct(
    ("capture_id", _S, False),
    ("asset", _S, False),
    ("provider", _S, False),
    ("source_id", _S, False),
    ("channel", _S, False),
    ("message_type", _S, False),
    ("event_subtype", _S, True),
    ("sid", _L, False),
    ("seq", _L, True),
    ("provider_ns", _L, True),
    ("received_ns", _L, False),
    ("schema_version", _S, False),
    ("payload", _S, False),
)
FACT_COLUMNS = CAPTURE_FACT.names
EVOLVABLE_FACT_COLUMNS = ("source_id", "message_type", "event_subtype")

IDENTITY_COLUMNS = ("provider", "source_id", "message_type", "trade_id")
EVENT_IDENTITY = T.StructType([T.StructField(n, _S, True) for n in IDENTITY_COLUMNS])

TRUTH_DECISION = _struct(
    ("policy_version", _S, False),
    ("subject_capture_id", _S, False),
    ("category", _S, False),
    ("contributing_capture_ids", T.ArrayType(_S), False),
    ("reason", _S, True),
    ("event", EVENT_IDENTITY, True),
)
DECISION_COLUMNS = TRUTH_DECISION.names

# The stored (exported) form keeps contributors as JSON text and the identity as four columns.
STORED_DECISION = _struct(
    ("policy_version", _S, False),
    ("subject_capture_id", _S, False),
    ("category", _S, False),
    ("contributing_capture_ids", _S, False),
    ("reason", _S, True),
    ("event_provider", _S, True),
    ("event_source_id", _S, True),
    ("event_message_type", _S, True),
    ("event_trade_id", _S, True),
    ("physical_written_at", _L, False),
)

AVAILABILITY = _struct(
    ("kind", _S, False),
    ("capture_id", _S, False),
    ("policy_version", _S, True),
    ("available_at_ns", _L, False),
    ("proof_schema_version", _S, False),
    ("source_authority_identity", _S, False),
    ("written_at_ns", _L, False),
)
MARKER_COLUMNS = AVAILABILITY.names
MARKER_KEY = ("kind", "capture_id", "policy_version")

# Anchors of trade identities in comparable form; derived, and kept beside the decisions by a stream.
TRADE_ANCHOR = _struct(
    ("capture_id", _S, False),
    ("received_ns", _L, False),
    ("provider", _S, False),
    ("source_id", _S, False),
    ("message_type", _S, False),
    ("trade_id", _S, False),
    ("fault", _S, False),
    ("content", _S, False),
)

RAW_MESSAGE = _struct(
    ("source", _S, False),
    ("partition", _L, False),
    ("offset", _L, False),
    ("received_ns", _L, False),
    ("binding_ticker", _S, True),
    ("value", _S, False),
)

TABLES = {
    "capture_fact": CAPTURE_FACT,
    "truth_decision": STORED_DECISION,
    "availability": AVAILABILITY,
}


@dataclass(frozen=True)
class AuthorityIdentities:
    """Names of the two sources that a marker may be bound to."""

    evidence: str = "capture-facts/v1"
    decision: str = "truth-decisions/v1"


def market_scope(spark: SparkSession) -> DataFrame:
    """Nine rows asset <-> series."""
    return spark.createDataFrame(list(MARKET_SERIES), "asset string, series_ticker string")


def reference_scope(spark: SparkSession) -> DataFrame:
    """Nine rows asset <-> (source, provider id)."""
    return spark.createDataFrame(
        list(REFERENCE_IDS), "asset string, source string, provider_id string"
    )
