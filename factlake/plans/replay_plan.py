"""The whole as-of read, composed from the replay operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.operators import availability as A
from factlake.operators import replay as R
from factlake.session import materialize
from factlake.sources import tables


@dataclass(frozen=True)
class Lake:
    """The three tables a read needs."""

    facts: DataFrame
    decisions: DataFrame
    markers: DataFrame
    authorities: S.AuthorityIdentities = A.DEFAULT_AUTHORITIES


@dataclass(frozen=True)
class ReplayView:
    """A complete view: narrow keys of the selected rows, exclusions, and how to widen them."""

    lake: Lake
    request: R.AsOfRequest
    scoped: DataFrame
    keys: DataFrame
    exclusions: DataFrame
    max_page_size: int = R.MAX_PAGE_SIZE

    def ordered_keys(self) -> DataFrame:
        return self.keys.orderBy(*R.ORDER_COLUMNS[self.request.ordering])

    def records(self) -> DataFrame:
        """Every selected record in full, unordered.

        On the event axis the arrival span of the keys, one aggregate of them, prunes the days of the facts.
        """
        span = (None, None)
        if self.request.axis == "event_time":
            span = tuple(self.keys.agg(F.min("received_ns"), F.max("received_ns")).first())
        return widen(self.lake, self.keys, self.request, received=span)

    def ordered_records(self) -> DataFrame:
        return self.records().orderBy(*R.ORDER_COLUMNS[self.request.ordering])

    def page(self, last_key: tuple | None = None, page_size: int | None = None) -> DataFrame:
        """One page of full records.

        The page holds at most ``page_size`` keys, a bound the request check enforces.  They are found
        first; payloads are then read only from the arrival range of the page.
        """
        size = page_size or self.request.page_size
        if not 0 < size <= self.max_page_size:
            raise S.ContractError("INVALID_REQUEST", "page size is outside the bound")
        page = materialize(R.keyset_page(self.keys, self.request.ordering, size, last_key))
        span = page.agg(F.min("received_ns"), F.max("received_ns")).first()
        return widen(self.lake, page, self.request, received=tuple(span))

    def summary(self) -> DataFrame:
        return view_summary(self)


def replay_as_of(
    lake: Lake,
    request: R.AsOfRequest,
    strict: bool = True,
    check_scope: str = "policy",
    max_page_size: int = R.MAX_PAGE_SIZE,
) -> ReplayView:
    """Stages in contract order: validate, pair, check, filter, qualify, select.

    A strict read computes the pairing once, keeps it in the shared folder, and raises the most
    important defect before it returns.  ``max_page_size`` is for the owner of the service to set.
    """
    request = request.validated(max_page_size)
    if strict:
        require_sources(lake)
    paired = R.pair_candidates(
        lake.facts,
        lake.decisions,
        lake.markers,
        request.policy_version,
        request.assets,
        request.channels,
        lake.authorities,
    )
    if strict:
        paired = materialize(paired)
        raise_first(R.pair_violations(paired, check_scope).unionByName(R.payload_violations(paired, lake.facts, check_scope)))
    scoped = R.filter_candidates(paired)
    qualified = R.qualify_as_of(scoped, request.cutoff_ns)
    if request.axis == "event_time":
        selected = R.select_event_window(qualified, request.start_ns, request.end_ns, strict)
    else:
        selected = R.select_arrival_window(qualified, request.start_ns, request.end_ns)
    if strict and request.ordering == "strict_event":
        R.require_event_time(selected)
    keys = selected.select(
        "capture_id", "category", "received_ns", "provider_ns", "evidence_at", "authority_at"
    )
    return ReplayView(lake, request, scoped, keys, R.replay_exclusions(scoped, request.cutoff_ns), max_page_size)


def require_sources(lake: Lake) -> None:
    """Every table of the lake has exactly the columns and types of its contract."""
    tables.require_contract(lake.facts, "capture_fact", S.CAPTURE_FACT)
    tables.require_contract(lake.decisions, "truth_decision", S.TRUTH_DECISION)
    tables.require_contract(lake.markers, "availability", S.AVAILABILITY)


def raise_first(violations: DataFrame) -> None:
    """Raise the defect that comes first in the fixed precedence (one bounded aggregate)."""
    counts = {r["code"]: r["n"] for r in violations.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    for code in S.ERROR_PRECEDENCE:
        if code in counts:
            raise S.ContractError(code, f"{counts[code]} rows")


def references(authorities: S.AuthorityIdentities, policy: str) -> list:
    null = F.lit(None).cast("string")
    proof = F.lit(S.PROOF_SCHEMA)
    cid = F.col("capture_id")
    return [
        A.marker_reference(
            F.lit("evidence"), cid, null, F.col("evidence_at"), proof, F.lit(authorities.evidence)
        ).alias("evidence_reference"),
        A.marker_reference(
            F.lit("authority"), cid, F.lit(policy), F.col("authority_at"), proof, F.lit(authorities.decision)
        ).alias("authority_reference"),
    ]


def widen(
    lake: Lake,
    keys: DataFrame,
    request: R.AsOfRequest,
    received: tuple[int | None, int | None] = (None, None),
) -> DataFrame:
    """Full records of selected keys: payload and decision are joined only here.

    On the arrival axis the window also prunes the fact partitions, and so does a known ``received``
    range of the keys.
    """
    facts = lake.facts
    if request.axis == "arrival_time":
        facts = R.select_arrival_window(facts, request.start_ns, request.end_ns)
    if received[0] is not None:
        facts = tables.in_received_range(facts, received[0], received[1], closed=True)
    known = {"capture_id", "category", "received_ns", "provider_ns"}
    facts = facts.select("capture_id", *[c for c in S.FACT_COLUMNS if c not in known])
    decisions = lake.decisions.where(F.col("policy_version") == request.policy_version).select(
        F.col("subject_capture_id").alias("capture_id"),
        *[c for c in S.DECISION_COLUMNS if c not in ("subject_capture_id", "category")],
    )
    refs = references(lake.authorities, request.policy_version)
    extra = [c for c in ("position", "has_more") if c in keys.columns]
    small = keys.select("capture_id", "category", "received_ns", "provider_ns", *extra, *refs)
    # no hint: a page is a small table that Spark broadcasts by its size, payloads have no bound
    of_keys = decisions.join(keys.select("capture_id"), "capture_id", "left_semi")
    return small.join(facts, "capture_id").join(of_keys, "capture_id").select(*record_columns(), *extra)


def record_columns() -> list[str]:
    decision = [c for c in S.DECISION_COLUMNS if c != "subject_capture_id"]
    return [*S.FACT_COLUMNS, *decision, "evidence_reference", "authority_reference"]


def view_summary(view: ReplayView) -> DataFrame:
    """One row: identities, selection, completeness and counts, from one pass over the candidates."""
    r = view.request
    code = R.exclusion_code(F.lit(r.cutoff_ns).cast("bigint"))
    t = F.col(R.AXIS_COLUMN[r.axis])
    member = code.isNull() & (t >= F.lit(r.start_ns)) & (t < F.lit(r.end_ns))

    def how_many(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    judged = view.scoped.select("capture_id", code.alias("code"), member.alias("member"))
    words = X.with_words(judged, w=F.when(F.col("member"), F.col("capture_id")))
    folded = words.agg(
        how_many(F.col("member")).alias("n_records"),
        how_many(F.col("code") == S.EVIDENCE_MISSING).alias("n_evidence_missing"),
        how_many(F.col("code") == S.AUTHORITY_MISSING).alias("n_authority_missing"),
        *X.set_digest("w"),
    )
    request = R.request_identity(R.request_row(view.lake.facts, r))
    return (
        R.bind_snapshot(X.with_one_row(request, folded), view.lake.authorities)
        .withColumn("ordering_rule_version", F.lit(S.ORDERING_RULE_VERSION))
        .withColumn("completeness", F.lit(S.COMPLETENESS))
    )


def many_summaries(lake: Lake, requests: DataFrame, strict: bool = True) -> DataFrame:
    """``view_summary`` for a whole table of requests.

    A refused request carries its code and neither members nor an identity.  A strict call raises the defects of the
    lake that stop a single read.
    """
    if strict:
        require_sources(lake)
    valid = materialize(
        R.canonical_filters(R.validate_requests(requests).where("reject_reason IS NULL"))
    )
    paired = R.pair_candidates(lake.facts, lake.decisions, lake.markers, authorities=lake.authorities)
    if strict:
        paired = materialize(paired)
        raise_first(R.pair_violations(paired).unionByName(R.payload_violations(paired, lake.facts)))
    candidates = materialize(R.with_filters(paired, lake.facts))
    members = materialize(R.replay_many_members(valid, candidates))
    zero = F.lit(0).cast("bigint")
    joined = R.request_identity(valid).join(members.drop("ordering", "n_undated"), "request_id", "left")
    joined = joined.withColumns(
        {
            "n_records": F.coalesce("n_records", zero),
            **{f"w{i}": F.coalesce(f"w{i}", zero) for i in range(X.DIGEST_WORDS)},
        }
    )
    return (
        R.bind_snapshot(joined, lake.authorities)
        .join(R.exclusion_counts(valid, candidates), "request_id")
        .join(R.replay_many_status(valid, candidates, members), "request_id")
        .withColumns({c: F.when(F.col("outcome") == "ok", F.col(c)) for c in ("n_records", "snapshot_identity")})
        .withColumn("ordering_rule_version", F.lit(S.ORDERING_RULE_VERSION))
        .withColumn("completeness", F.lit(S.COMPLETENESS))
    )
