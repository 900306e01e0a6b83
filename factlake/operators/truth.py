"""Adjudication: every fact gets exactly one append-only decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.functions.trades import open_trades
from factlake.operators.skew import duplicate_keys, first_per_key, keep_matching
from factlake.session import materialize

NARROW = ("capture_id", "received_ns", "provider", "source_id", "message_type", "schema_version", "payload")


def route(message_type: Column) -> Column:
    return (
        F.when(X.in_set(message_type, S.EVENT_TYPES), "event")
        .when(X.in_set(message_type, S.OBSERVATION_TYPES), "observation")
        .otherwise("unsupported")
    )


def route_facts(facts: DataFrame) -> DataFrame:
    return facts.withColumn("family", route(F.col("message_type")))


def accept_observations(facts: DataFrame) -> DataFrame:
    """Every observation is accepted on its own; equal content stays two facts."""
    return facts.where(F.col("message_type").isin(*S.OBSERVATION_TYPES)).select(
        F.lit(S.TRUTH_POLICY).alias("policy_version"),
        F.col("capture_id").alias("subject_capture_id"),
        F.lit("accepted").alias("category"),
        F.array("capture_id").alias("contributing_capture_ids"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast(S.EVENT_IDENTITY).alias("event"),
    )


def validate_trades(facts: DataFrame) -> DataFrame:
    """Trade facts with ``reason`` (null = valid), ``trade_id`` and ``content``."""
    return open_trades(facts.where(F.col("message_type") == "trade").select(*NARROW))


def comparable_trades(facts: DataFrame) -> DataFrame:
    """What adjudication moves: no payload, the comparable content as a digest.

    ``fault`` is the reason a trade is not accepted, or empty.  It is part of the key, so valid and
    invalid rows travel together and the payload is parsed once.
    """
    return validate_trades(facts).select(
        "capture_id",
        "received_ns",
        "provider",
        "source_id",
        "message_type",
        F.coalesce("trade_id", F.lit("")).alias("trade_id"),
        F.coalesce("reason", F.lit("")).alias("fault"),
        F.coalesce("content", F.lit("")).alias("content"),
    )


def _decisions(trades: DataFrame) -> DataFrame:
    """Decision rows from trades that carry their anchor in ``first_*``."""
    valid, own = F.col("fault") == "", F.col("is_first")
    category = (
        F.when(~valid, "not_accepted")
        .when(own, "accepted")
        .when(F.col("first_content") == F.col("content"), "duplicate")
        .otherwise("conflict")
    )
    return trades.select(
        F.lit(S.TRUTH_POLICY).alias("policy_version"),
        F.col("capture_id").alias("subject_capture_id"),
        category.alias("category"),
        F.when(~valid | own, F.array("capture_id"))
        .otherwise(F.array("first_capture_id", "capture_id"))
        .alias("contributing_capture_ids"),
        F.when(~valid, F.col("fault")).alias("reason"),
        F.when(valid, F.struct(*S.IDENTITY_COLUMNS)).cast(S.EVENT_IDENTITY).alias("event"),
    )


KEY = [*S.IDENTITY_COLUMNS, "fault"]


def adjudicate_trades(facts: DataFrame) -> DataFrame:
    """First valid trade of an identity in ``(received_ns, capture_id)`` order is accepted; the
    others are compared with that one only.

    One identity may carry a large share of all trades, hence ``first_per_key``.
    """
    anchored = first_per_key(
        comparable_trades(facts),
        keys=KEY,
        order=["received_ns", "capture_id"],
        row_id=["capture_id"],
        carry=["capture_id", "content"],
    )
    return _decisions(anchored)


def undecided(facts: DataFrame, existing: DataFrame) -> DataFrame:
    """Facts without a decision.  The stored side is first cut down to the subjects of the batch."""
    done = existing.where(F.col("policy_version") == S.TRUTH_POLICY).select(
        F.col("subject_capture_id").alias("capture_id")
    )
    return facts.join(keep_matching(done, facts, ["capture_id"]), "capture_id", "left_anti")


def unsupported_facts(facts: DataFrame) -> DataFrame:
    return route_facts(facts).where("family = 'unsupported'").select("capture_id", "message_type")


def require_supported(facts: DataFrame) -> None:
    """Raise if a fact has a type that no rule covers.

    The check runs before a plan is handed on: a failing column in the plan could be pruned away with the defect in it.
    """
    first = unsupported_facts(facts).select(F.coalesce("message_type", F.lit("no type")).alias("t")).head(1)
    if first:
        raise S.ContractError("UNSUPPORTED_FACT", first[0]["t"])


def decide_new(facts: DataFrame) -> DataFrame:
    """Decisions for facts none of which has been decided, with no stored anchors."""
    return accept_observations(facts).unionByName(adjudicate_trades(facts))


def decide_facts(facts: DataFrame, existing: DataFrame, stored_facts: DataFrame) -> DataFrame:
    """Existing decisions of these facts as they are, plus new ones for the rest.

    A fact that comes twice is decided once; a fact of an unsupported type raises.
    """
    require_supported(facts)
    subjects = facts.select(F.col("capture_id").alias("subject_capture_id"))
    kept = existing.where(F.col("policy_version") == S.TRUTH_POLICY).join(
        subjects, "subject_capture_id", "left_semi"
    )
    fresh = decide_incremental(undecided(facts, existing), existing, stored_facts)
    return kept.select(*S.DECISION_COLUMNS).unionByName(fresh.distinct())


def find_accepted_anchor(decisions: DataFrame, facts: DataFrame) -> DataFrame:
    """Accepted trade decisions with their evidence.  The lookup does not filter by policy."""
    accepted = decisions.where("category = 'accepted' AND event IS NOT NULL").select(
        F.col("subject_capture_id").alias("capture_id"),
        F.col("policy_version").alias("anchor_policy"),
        "contributing_capture_ids",
        "event",
    )
    return accepted.join(facts.select(*NARROW), "capture_id", "left")


def stored_anchors(
    decisions: DataFrame, facts: DataFrame, wanted: DataFrame
) -> DataFrame:
    """Stored anchors of the wanted identities, in the shape of ``comparable_trades``; an unsound one raises.

    The decisions are cut down to the identities of the batch first.  Facts meet them as comparable trades: the content
    crosses the network as a digest, never as a payload.
    """
    accepted = decisions.where("category = 'accepted' AND event IS NOT NULL").select(
        F.col("subject_capture_id").alias("capture_id"),
        "policy_version",
        F.array_contains("contributing_capture_ids", F.col("subject_capture_id")).alias("contributes"),
        "event.*",
    )
    said = materialize(keep_matching(accepted, wanted, S.IDENTITY_COLUMNS))
    own = F.struct(*S.IDENTITY_COLUMNS)
    # an inner join, so that the small side can be broadcast; what it leaves out has no evidence
    found = comparable_trades(facts).select("capture_id", "received_ns", "content", "fault", own.alias("own"))
    held = materialize(found.join(said.select("capture_id").distinct(), "capture_id"))
    rule = F.coalesce(
        F.when(F.col("own").isNull(), "missing_evidence"),
        F.when(F.col("policy_version") != S.TRUTH_POLICY, "policy_differs"),
        F.when(~F.coalesce("contributes", F.lit(False)), "not_a_contributor"),
        F.when(F.col("fault") != "", "invalid_evidence"),
        F.when(~F.col("own").eqNullSafe(own), "identity_differs"),
    )
    anchors = said.join(held, "capture_id", "left").withColumn("rule", rule)
    _raise_rule(anchors.where("rule IS NOT NULL").select("capture_id", "rule"))
    anchors = anchors.select("capture_id", "received_ns", *S.IDENTITY_COLUMNS, "fault", "content")
    require_one_anchor(anchors)
    return anchors


def _raise_rule(broken: DataFrame) -> None:
    first = broken.head(1)
    if first:
        raise S.ContractError("INVARIANT_CONFLICT", f"a stored anchor is not sound: {first[0]['rule']}: {first[0]['capture_id']}")


def require_one_anchor(anchors: DataFrame) -> None:
    """Raise if an identity has several anchors, or an anchor is no valid trade (map-side combined, narrow)."""
    broken = anchors.groupBy(*S.IDENTITY_COLUMNS).agg(F.count(F.lit(1)).alias("n"), F.max("fault").alias("fault"), F.min("capture_id").alias("capture_id"))
    rule = F.when(F.col("n") > 1, "several_accepted").when(F.col("fault") != "", "invalid_evidence")
    _raise_rule(broken.select("capture_id", rule.alias("rule")).where("rule IS NOT NULL"))


#: Parts of an anchor table; a batch reads those that its identities hash to.
ANCHOR_PARTS = 256


def anchor_part() -> Column:
    return F.pmod(F.xxhash64(*S.IDENTITY_COLUMNS), F.lit(ANCHOR_PARTS)).cast("int")


def anchors_near(anchors: DataFrame, trades: DataFrame) -> DataFrame:
    """The parts of an anchor table (partitioned by ``anchor_part``) that can hold an identity of ``trades``.

    At most ``ANCHOR_PARTS`` numbers reach the driver; the scan then opens only their folders.
    """
    parts = [r["anchor_part"] for r in trades.where("fault = ''").select(anchor_part().alias("anchor_part")).distinct().collect()]
    return anchors.where(F.col("anchor_part").isin(parts) if parts else F.lit(False)).drop("anchor_part")


def decide_incremental(
    new: DataFrame,
    decisions: DataFrame,
    stored_facts: DataFrame,
    anchors: DataFrame | None = None,
) -> DataFrame:
    """Decisions for a new batch; a stored anchor wins over any new row, even an earlier one.

    ``anchors`` may give the stored anchors in comparable form (see ``anchors_of``); they are then
    not looked up in the decision and fact tables.  Doubled or unsound anchors raise before anything is decided.
    """
    trades = comparable_trades(new)
    if anchors is None:
        anchors = stored_anchors(decisions, stored_facts, trades)
    else:
        if "anchor_part" in anchors.columns:
            anchors = anchors_near(anchors, trades)
        anchors = materialize(keep_matching(anchors, trades, S.IDENTITY_COLUMNS).select(*S.TRADE_ANCHOR.names))
        require_one_anchor(anchors)
    both = anchors.withColumn("is_new", F.lit(0)).unionByName(trades.withColumn("is_new", F.lit(1)))
    anchored = first_per_key(
        both,
        keys=KEY,
        order=["is_new", "received_ns", "capture_id"],
        row_id=["capture_id", "is_new"],
        carry=["capture_id", "content"],
    )
    fresh = _decisions(anchored.where("is_new = 1"))
    return accept_observations(new).unionByName(fresh)


def anchors_of(decisions: DataFrame, facts: DataFrame) -> DataFrame:
    """Comparable form of the anchors among these decisions, for a narrow anchor table."""
    accepted = decisions.where("category = 'accepted' AND event IS NOT NULL").select(
        F.col("subject_capture_id").alias("capture_id")
    )
    return comparable_trades(facts.join(accepted, "capture_id", "left_semi"))


def check_anchor_invariants(decisions: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per failed rule and anchor; an empty report means every anchor is sound."""
    anchors = find_accepted_anchor(decisions, facts)
    identity = F.struct(*S.IDENTITY_COLUMNS)
    opened = open_trades(anchors)
    missing = F.col("payload").isNull()
    valid = F.col("reason").isNull()
    rules = F.array(
        F.when(missing, "missing_evidence"),
        F.when(F.col("anchor_policy") != S.TRUTH_POLICY, "policy_differs"),
        F.when(
            ~F.array_contains("contributing_capture_ids", F.col("capture_id")), "not_a_contributor"
        ),
        F.when(~missing & ~valid, "invalid_evidence"),
        F.when(~missing & valid & (identity != F.col("event")), "identity_differs"),
    )
    per_anchor = opened.select(
        F.col("capture_id").alias("subject_capture_id"), F.explode(F.array_compact(rules)).alias("rule")
    )
    repeated = duplicate_keys(
        decisions.where("category = 'accepted' AND event IS NOT NULL").select("event.*"),
        list(S.IDENTITY_COLUMNS),
    ).select(
        F.concat_ws("/", *S.IDENTITY_COLUMNS).alias("subject_capture_id"),
        F.lit("several_accepted").alias("rule"),
    )
    unsettled = duplicate_keys(
        decisions.where("category = 'accepted' AND event IS NOT NULL"), ["subject_capture_id"]
    ).select("subject_capture_id", F.lit("anchors_itself").alias("rule"))
    return per_anchor.unionByName(repeated).unionByName(unsettled)


def require_sound_anchors(decisions: DataFrame, facts: DataFrame) -> None:
    if not check_anchor_invariants(decisions, facts).isEmpty():
        raise S.ContractError("INVARIANT_CONFLICT", "a stored anchor is not sound")
