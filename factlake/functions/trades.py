"""Opening trade payloads: validity, identity and the comparable content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X

OUTSIDE_PROJECTION = ("trade_id", "market_ticker")
TEXT_FIELDS = ("trade_id", "market_ticker")
INTEGER_FIELDS = ("ts", "ts_ms")
NUMBER_FIELDS = ("yes_price", "no_price", "count")
FLAG_FIELDS = ("is_block_trade",)
CHECKED_FIELDS = (*TEXT_FIELDS, *INTEGER_FIELDS, *NUMBER_FIELDS, *FLAG_FIELDS)
MESSAGE_DDL = "struct<" + ",".join(f"{name}:variant" for name in CHECKED_FIELDS) + ">"


def canonical_text(fields: Column) -> Column:
    """JSON text of a field map in key order, so layout and key order of the input do not count."""
    keys = F.array_sort(F.map_keys(fields))
    return F.to_json(
        F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.try_element_at(fields, k)))),
        {"ignoreNullFields": "false"},
    )


def projection(payload: Column) -> Column:
    """The comparable content as text: the message without the two identity fields."""
    fields = F.try_variant_get(F.try_parse_json(payload), "$.msg", "map<string,variant>")
    return canonical_text(F.map_filter(fields, lambda k, _: ~k.isin(*OUTSIDE_PROJECTION)))


def open_trades(facts: DataFrame) -> DataFrame:
    """Adds ``reason`` (null = valid), ``trade_id`` and ``content``, parsing each payload once.

    ``content`` digests the message in canonical form.  It still holds the trade id and the ticker,
    which are equal for all trades that are ever compared, so it decides as ``projection`` would.
    The checks run in contract order.  Duplicate JSON keys and malformed text do not parse.
    """
    v = F.col("__v")
    # A generator is a barrier for predicate pushdown: without it a later filter on ``reason`` would
    # be copied below this projection and parse the payload once per check.
    opened = facts.withColumn("__v", F.try_parse_json("payload")).select(
        *facts.columns,
        F.inline(
            F.array(
                F.struct(
                    F.try_variant_get(v, "$.type", "string").alias("__type"),
                    F.try_variant_get(v, "$.sid", "variant").alias("__sid"),
                    F.try_variant_get(v, "$.msg", MESSAGE_DDL).alias("__m"),
                    F.sha2(F.to_json(F.try_variant_get(v, "$.msg", "variant")), 256).alias("__content"),
                )
            )
        ),
    )

    def kind(name: str) -> Column:
        return F.schema_of_variant(f"__m.{name}")

    def optional(name: str, allowed: str) -> Column:
        return F.coalesce(kind(name).rlike(f"^({allowed}|VOID)$"), F.lit(True))

    typed = (F.col("__type") == "trade") & (F.schema_of_variant("__sid") == "BIGINT")
    for name in TEXT_FIELDS:
        typed = typed & (kind(name) == "STRING")
    for name in INTEGER_FIELDS:
        typed = typed & optional(name, "BIGINT")
    for name in NUMBER_FIELDS:
        typed = typed & optional(name, "STRING|BIGINT|DECIMAL.*|DOUBLE")
    for name in FLAG_FIELDS:
        typed = typed & optional(name, "BOOLEAN")
    trade_id, ticker = (F.try_variant_get(f"__m.{name}", "$", "string") for name in TEXT_FIELDS)
    reason = X.first_failure(
        (F.col("schema_version") != S.MESSAGE_SCHEMA, "unsupported_trade_schema"),
        (
            (F.col("provider") != S.PROVIDER) | (F.col("message_type") != "trade"),
            "invalid_trade_evidence",
        ),
        (~F.coalesce(typed, F.lit(False)), "invalid_trade_evidence"),
        (X.blank(F.col("__trade_id")), "invalid_trade_evidence"),
        (~F.col("__ticker").eqNullSafe(F.col("source_id")), "trade_identity_mismatch"),
    )
    ok = F.col("reason").isNull()
    return (
        opened.withColumns({"__trade_id": trade_id, "__ticker": ticker})
        .withColumn("reason", reason)
        .select(
            *facts.columns,
            "reason",
            F.when(ok, F.col("__trade_id")).alias("trade_id"),
            F.when(ok, F.col("__content")).alias("content"),
        )
    )
