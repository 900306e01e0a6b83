"""Raw feed messages -> capture facts, one row in and one row out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X

# Only these fields of a message are opened; the rest stays opaque text.
MESSAGE_SCHEMA_DDL = (
    "type string, sid bigint, seq bigint, msg struct<"
    "market_ticker:string, event_ticker:string, index_id:string, underlying_ticker:string,"
    "event_type:string, ts:string, ts_ms:bigint, source_ts_ms:bigint, trade_id:string>"
)


def parse_messages(raw: DataFrame) -> DataFrame:
    """Opens the message text once, as the struct ``m``; unreadable text leaves its fields null.

    The generator keeps later filters from being pushed below the parse and repeating it.
    """
    opened = F.struct(F.from_json("value", MESSAGE_SCHEMA_DDL).alias("m"))
    return raw.select(*raw.columns, F.inline(F.array(opened)))


def assign_capture_id(source: Column, partition: Column, offset: Column) -> Column:
    """Opaque id of a received message: a digest of its position in the source.

    A retried task or a replayed file gives the same id; equal content at another position does not.
    """
    return F.sha2(F.concat_ws(":", source, partition.cast("string"), offset.cast("string")), 256)


def channel_of(message_type: Column) -> Column:
    pairs = {**S.MARKET_CHANNEL, **S.REFERENCE_CHANNEL}
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.try_element_at(table, message_type)


def event_time_ns(message_type: Column, msg: Column) -> Column:
    return (
        F.when(message_type == "orderbook_delta", X.delta_event_time(msg["ts_ms"], msg["ts"]))
        .when(message_type.isin("ticker", "trade"), X.ms_to_ns(msg["ts_ms"]))
        .when(message_type == "pyth_value", X.ms_to_ns(msg["source_ts_ms"]))
    )


def subscription(bindings: DataFrame, source: str) -> DataFrame:
    """The bindings one source is asked for; none, or one of another source, is refused as the feed refuses it.

    ``bindings`` are rows of the fixed nine-row scope.
    """
    n, foreign = bindings.agg(F.count(F.lit(1)), F.count_if(~F.col("source").eqNullSafe(F.lit(source)))).first()
    if not n or foreign:
        raise S.ContractError("INVALID_REQUEST", f"{source} needs approved bindings of its own")
    return bindings


def subscribe_scope_filter(raw: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows whose ``(source, provider_id)`` is in the scope: an id counts under its own source only.

    The scope is the fixed nine-row dimension, hence broadcast.  An empty one is refused; null ids match nothing.
    """
    if scope.isEmpty():
        raise S.ContractError("INVALID_REQUEST", "a subscription needs a scope")
    keys = ["source", "provider_id"]
    return raw.join(F.broadcast(scope.select(*keys).distinct()), keys, "left_semi")


def bind_reference_asset(reference: DataFrame, scope: DataFrame) -> DataFrame:
    """``(source, provider_id)`` -> asset; no row in the nine-row scope leaves a null asset."""
    return reference.join(F.broadcast(scope), ["source", "provider_id"], "left")


def bind_market_identity(messages: DataFrame, identities: DataFrame) -> DataFrame:
    """Attach the verified identity each message was received under.

    ``identities(ticker, event_ticker, asset)`` has one row per ticker; a repeated ticker fails the query
    as soon as a message needs it.  One plan serves batches and streams (there as a stream-static join) and
    any number of identities: Spark broadcasts a small set by its size, and splits a hot ticker otherwise.
    """
    bound = F.min(F.struct("event_ticker", "asset"))
    known = identities.groupBy(F.col("ticker").alias("binding_ticker")).agg(F.count(F.lit(1)).alias("n"), bound.alias("b"))
    repeated = F.raise_error(F.concat(F.lit("MALFORMED_EVIDENCE: several identities of ticker "), F.col("binding_ticker")))
    known = known.select("binding_ticker", F.col("b.event_ticker").alias("bound_event_ticker"), F.col("b.asset").alias("bound_asset"), F.col("n").alias("n_bound"))
    # the refusal is a condition on the rows: it stays whatever columns are read
    bound = messages.join(known, "binding_ticker", "left")
    return bound.where(F.when(F.col("n_bound") > 1, repeated.cast("boolean")).otherwise(True)).drop("n_bound")


def classify_messages(raw: DataFrame, identities: DataFrame, reference: DataFrame) -> DataFrame:
    """Every message with its fact columns and ``reject_class`` (null when it becomes a fact)."""
    bound = parse_messages(bind_market_identity(raw, identities))
    kind, msg = F.col("m.type"), F.col("m.msg")
    source = F.when(kind == "cfbenchmarks_value", "cf_benchmarks").when(kind == "pyth_value", "pyth_value")
    provider_id = F.when(kind == "cfbenchmarks_value", msg["index_id"]).when(
        kind == "pyth_value", msg["underlying_ticker"]
    )
    scope = F.broadcast(
        reference.select(
            F.col("source").alias("scope_source"),
            F.col("provider_id").alias("scope_id"),
            F.col("asset").alias("reference_asset"),
        )
    )
    bound = bound.join(
        scope, (source == F.col("scope_source")) & (provider_id == F.col("scope_id")), "left"
    )
    is_market = X.in_set(kind, S.MARKET_CHANNEL)
    is_reference = X.in_set(kind, S.REFERENCE_CHANNEL)
    asset = F.when(is_market, F.col("bound_asset")).when(is_reference, F.col("reference_asset"))
    wrong_ticker = F.when(
        kind == "event_fee_update", ~msg["event_ticker"].eqNullSafe(F.col("bound_event_ticker"))
    ).otherwise(~msg["market_ticker"].eqNullSafe(F.col("binding_ticker")))
    needs_ms = F.when(kind.isin("ticker", "trade"), msg["ts_ms"].isNull()).when(
        kind == "pyth_value", msg["source_ts_ms"].isNull()
    )
    reject = X.first_failure(
        (kind.isNull(), "unsupported"),
        (~(is_market | is_reference), "unsupported"),
        (F.col("m.sid").isNull(), "incompatible"),
        (is_market & F.col("bound_event_ticker").isNull(), "authority"),
        (is_reference & F.col("reference_asset").isNull(), "authority"),
        (~X.in_set(asset, S.ASSETS), "authority"),
        (is_market & wrong_ticker, "incompatible"),
        (F.coalesce(needs_ms, F.lit(False)), "incompatible"),
    )
    return bound.select(
        assign_capture_id(F.col("source"), F.col("partition"), F.col("offset")).alias("capture_id"),
        asset.alias("asset"),
        F.lit(S.PROVIDER).alias("provider"),
        F.when(is_market, F.col("binding_ticker")).otherwise(provider_id).alias("source_id"),
        channel_of(kind).alias("channel"),
        kind.alias("message_type"),
        F.when(kind == "market_lifecycle_v2", msg["event_type"]).alias("event_subtype"),
        F.col("m.sid").alias("sid"),
        F.col("m.seq").alias("seq"),
        event_time_ns(kind, msg).alias("provider_ns"),
        "received_ns",
        F.lit(S.MESSAGE_SCHEMA).alias("schema_version"),
        F.col("value").alias("payload"),
        reject.alias("reject_class"),
    )


def normalize_messages(raw: DataFrame, identities: DataFrame, reference: DataFrame) -> DataFrame:
    return (
        classify_messages(raw, identities, reference)
        .where("reject_class IS NULL")
        .select(*S.FACT_COLUMNS)
    )


def reject_messages(raw: DataFrame, identities: DataFrame, reference: DataFrame) -> DataFrame:
    """The quarantine: messages that cannot become facts, with their class."""
    return (
        classify_messages(raw, identities, reference)
        .where("reject_class IS NOT NULL")
        .select("capture_id", "message_type", "received_ns", "payload", "reject_class")
    )


def check_scope(scope: DataFrame, columns: tuple[str, str]) -> DataFrame:
    """One row: the dimension must have nine rows and be one-to-one in both columns."""
    left, right = columns
    row = scope.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(left).alias("n_left"),
        F.count_distinct(right).alias("n_right"),
    )
    nine = (F.col("n_rows") == 9) & (F.col("n_left") == 9) & (F.col("n_right") == 9)
    return row.withColumn("bijective", nine)
