"""Strict two-dimensional as-of reads: what was known, and decided, by a cutoff."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.operators import availability as A
from factlake.operators import cells as C
from factlake.operators.prefix import block_boundaries, into_blocks
from factlake.session import materialize, spread
from factlake.sources import tables

SNAPSHOT_SCHEME = "set-digest/v1"
AXES = ("arrival_time", "event_time")
ORDERINGS = ("arrival", "strict_event")
MAX_PAGE_SIZE = 10_000
AXIS_COLUMN = {"arrival_time": "received_ns", "event_time": "provider_ns"}
ORDER_COLUMNS = {
    "arrival": ("received_ns", "capture_id"),
    "strict_event": ("provider_ns", "received_ns", "capture_id"),
}


@dataclass(frozen=True)
class AsOfRequest:
    cutoff_ns: int
    start_ns: int
    end_ns: int
    axis: str = "arrival_time"
    ordering: str = "arrival"
    policy_version: str = S.TRUTH_POLICY
    assets: tuple[str, ...] | None = None
    channels: tuple[str, ...] | None = None
    page_size: int = 1000

    def validated(self, max_page_size: int = MAX_PAGE_SIZE) -> AsOfRequest:
        """Canonical form, or INVALID_REQUEST."""
        for number in (self.cutoff_ns, self.start_ns, self.end_ns, self.page_size):
            if isinstance(number, bool) or not isinstance(number, int):
                raise S.ContractError("INVALID_REQUEST", "times and sizes must be integers")
        problems = (
            (self.policy_version != S.TRUTH_POLICY, "unsupported authority policy"),
            (self.axis not in AXES, "the axis is neither arrival nor event time"),
            (self.ordering not in ORDERINGS, "the ordering is not known"),
            (self.start_ns >= self.end_ns, "window must be half-open and non-empty"),
            (not 0 < self.page_size <= max_page_size, "page size is outside the bound"),
        )
        for failed, message in problems:
            if failed:
                raise S.ContractError("INVALID_REQUEST", message)
        assets, channels = self.assets, self.channels
        for values in (assets, channels):
            if values is not None and (not isinstance(values, tuple) or not values):
                raise S.ContractError("INVALID_REQUEST", "a filter is a non-empty tuple or None")
        if assets is not None and not set(assets) <= set(S.ASSETS):
            raise S.ContractError("INVALID_REQUEST", "assets must be approved")
        if channels is not None and not all(isinstance(c, str) and 0 < len(c) <= 128 for c in channels):
            raise S.ContractError("INVALID_REQUEST", "a channel is a string of 1 to 128 characters")
        return AsOfRequest(
            self.cutoff_ns,
            self.start_ns,
            self.end_ns,
            self.axis,
            self.ordering,
            self.policy_version,
            None if assets is None else tuple(sorted(set(assets))),
            None if channels is None else tuple(sorted(set(channels))),
            self.page_size,
        )


# ------------------------------------------------------------------------------ request tables


def validate_requests(requests: DataFrame, max_page_size: int = MAX_PAGE_SIZE) -> DataFrame:
    """Adds ``reject_reason`` to a table of requests."""
    assets, channels = F.col("assets"), F.col("channels")
    approved = F.forall(assets, lambda a: F.coalesce(a.isin(*S.ASSETS), F.lit(False)))
    bounded = F.forall(
        channels, lambda c: F.coalesce((F.length(c) > 0) & (F.length(c) <= 128), F.lit(False))
    )

    def unless(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(False))

    return requests.withColumn(
        "reject_reason",
        X.first_failure(
            (F.col("cutoff_ns").isNull(), "cutoff"),
            (unless(F.col("policy_version") == S.TRUTH_POLICY), "policy"),
            (unless(F.col("axis").isin(*AXES)), "axis"),
            (unless(F.col("start_ns") < F.col("end_ns")), "window"),
            (unless(F.col("ordering").isin(*ORDERINGS)), "ordering"),
            (unless((F.col("page_size") > 0) & (F.col("page_size") <= max_page_size)), "page_size"),
            (assets.isNotNull() & unless((F.size(assets) > 0) & approved), "assets"),
            (channels.isNotNull() & unless((F.size(channels) > 0) & bounded), "channels"),
        ),
    )


def canonical_filters(requests: DataFrame) -> DataFrame:
    return requests.withColumn("assets", F.array_sort(F.array_distinct("assets"))).withColumn(
        "channels", F.array_sort(F.array_distinct("channels"))
    )


def _request_fields() -> dict[str, Column]:
    return {
        "assets": F.col("assets"),
        "authority_policy_version": F.col("policy_version"),
        "channels": F.col("channels"),
        "as_of_cutoff_ns": F.col("cutoff_ns"),
        "ordering": F.col("ordering"),
        "ordering_rule_version": F.lit(S.ORDERING_RULE_VERSION),
        "selection_axis": F.col("axis"),
        "selection_end_ns": F.col("end_ns"),
        "selection_start_ns": F.col("start_ns"),
    }


def request_identity(requests: DataFrame) -> DataFrame:
    """Adds the identity of the semantic fields; page size is delivery only.  Filters canonical."""
    fields = {**_request_fields(), "request_version": F.lit(S.REQUEST_VERSION)}
    return requests.withColumn("request_identity", X.digest(fields))


REQUEST_DDL = (
    "request_id string, cutoff_ns bigint, policy_version string, axis string, ordering string, "
    "start_ns bigint, end_ns bigint, assets array<string>, channels array<string>, page_size bigint"
)


def request_row(facts: DataFrame, request: AsOfRequest, request_id: str = "r") -> DataFrame:
    r = request
    row = (
        request_id,
        r.cutoff_ns,
        r.policy_version,
        r.axis,
        r.ordering,
        r.start_ns,
        r.end_ns,
        None if r.assets is None else list(r.assets),
        None if r.channels is None else list(r.channels),
        r.page_size,
    )
    return facts.sparkSession.createDataFrame([row], REQUEST_DDL)


# ------------------------------------------------------------------------------------- pairing


def pair_candidates(
    facts: DataFrame,
    decisions: DataFrame,
    markers: DataFrame,
    policy: str = S.TRUTH_POLICY,
    assets: tuple[str, ...] | None = None,
    channels: tuple[str, ...] | None = None,
    authorities: S.AuthorityIdentities = A.DEFAULT_AUTHORITIES,
) -> DataFrame:
    """One row per decided capture: its times, category, and how often each part is stored.

    The tables are stacked and folded by capture id in one aggregate instead of joined three times.
    All carried values are numbers, so the fold is a hash aggregate that combines before the only
    shuffle: copies of one id, however many, become a count, and uniqueness is checked for free.
    """
    null = F.lit(None).cast("bigint")
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    scoped = F.lit(True)
    if assets is not None:
        scoped = scoped & F.col("asset").isin(*assets)
    if channels is not None:
        scoped = scoped & F.col("channel").isin(*channels)
    category_code = F.array_position(F.array(*[F.lit(c) for c in S.CATEGORIES]), F.col("category"))
    named = [F.col(f"event.{c}").isNull() for c in S.IDENTITY_COLUMNS]
    contributors = F.col("contributing_capture_ids")
    bad_decision = (
        ~X.in_set(F.col("category"), S.CATEGORIES)
        | (F.col("reason").isNotNull() & ~X.in_set(F.col("reason"), S.NOT_ACCEPTED_REASONS))
        | (F.col("event").isNotNull() & (named[0] | named[1] | named[2] | named[3]))
        | contributors.isNull()
        | F.coalesce(F.exists(contributors, lambda c: c.isNull()), F.lit(False))
    )
    is_evidence = F.col("kind") == "evidence"

    columns = {
        "n_fact": zero,
        "n_decision": zero,
        "n_evidence": zero,
        "n_authority": zero,
        "received_ns": null,
        "provider_ns": null,
        "scoped": null,
        "category_code": null,
        "evidence_at": null,
        "authority_at": null,
        "bad_fact": zero,
        "bad_decision": zero,
        "bad_marker": zero,
    }

    def part(df: DataFrame, capture_id: str, **given: Column) -> DataFrame:
        return df.select(
            F.col(capture_id).alias("capture_id"),
            *[given.get(n, default).cast("bigint").alias(n) for n, default in columns.items()],
        )

    fact_part = part(
        facts,
        "capture_id",
        n_fact=one,
        received_ns=F.col("received_ns"),
        provider_ns=F.col("provider_ns"),
        scoped=F.coalesce(scoped, F.lit(False)),
        bad_fact=tables.fact_reject_reason(with_payload=False).isNotNull(),
    )
    decision_part = part(
        decisions.where(F.col("policy_version") == policy),
        "subject_capture_id",
        n_decision=one,
        category_code=category_code,
        bad_decision=bad_decision,
    )
    wanted = (is_evidence & F.col("policy_version").isNull()) | (
        (F.col("kind") == "authority") & (F.col("policy_version") == policy)
    )
    at = F.col("available_at_ns")
    marker_part = part(
        markers.where(wanted),
        "capture_id",
        n_evidence=is_evidence,
        n_authority=~is_evidence,
        evidence_at=F.when(is_evidence, at),
        authority_at=F.when(~is_evidence, at),
        bad_marker=A.marker_is_bad(authorities),
    )
    summed = ("n_fact", "n_decision", "n_evidence", "n_authority")
    folded = (
        fact_part.unionByName(decision_part)
        .unionByName(marker_part)
        .groupBy("capture_id")
        .agg(*[(F.sum(c) if c in summed else F.max(c)).alias(c) for c in columns])
    )
    category = F.try_element_at(
        F.array(*[F.lit(c) for c in S.CATEGORIES]),
        F.when(F.col("category_code") > 0, F.col("category_code").cast("int")),
    )
    return folded.where("n_decision > 0").withColumn("category", category)


def pair_violations(paired: DataFrame, check_scope: str = "policy") -> DataFrame:
    """Candidates that must stop a strict read, each with its most important code.

    ``policy`` checks every decision of the policy; ``filtered`` only those the request's asset and
    channel filters keep (a decision without evidence belongs to no asset, so it always counts).
    """
    code = (
        F.when(F.col("bad_decision") > 0, "MALFORMED_AUTHORITY")
        .when(F.col("n_decision") > 1, "AUTHORITY_CONFLICT")
        .when((F.col("n_fact") != 1) | (F.col("bad_fact") > 0), "MALFORMED_EVIDENCE")
        .when(
            (F.col("n_evidence") > 1) | (F.col("n_authority") > 1) | (F.col("bad_marker") > 0),
            "AVAILABILITY_EVIDENCE_MISSING",
        )
    )
    out = paired.withColumn("code", code).where("code IS NOT NULL")
    if check_scope == "filtered":
        out = out.where("n_fact = 0 OR scoped = 1")
    return out.select("capture_id", "code")


def payload_violations(paired: DataFrame, facts: DataFrame, check_scope: str = "policy") -> DataFrame:
    """Candidates whose stored fact has no payload.

    The condition reaches the scan, which skips every row group whose statistics count no null; payloads are not read.
    """
    lost = facts.where("payload IS NULL").select("capture_id").distinct()
    out = paired.where("n_fact > 0") if check_scope == "policy" else paired.where("n_fact > 0 AND scoped = 1")
    return out.join(lost, "capture_id", "left_semi").select("capture_id", F.lit("MALFORMED_EVIDENCE").alias("code"))


def check_pairs(pairs: DataFrame) -> DataFrame:
    """For input that arrives already paired: ``(policy_version, fact_capture_id, subject_capture_id)``."""
    mismatched = pairs.where(
        ~F.col("fact_capture_id").eqNullSafe(F.col("subject_capture_id"))
    ).select("subject_capture_id", F.lit("MALFORMED_AUTHORITY").alias("code"))
    repeated = (
        pairs.groupBy("policy_version", "subject_capture_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("subject_capture_id", F.lit("AUTHORITY_CONFLICT").alias("code"))
    )
    return mismatched.unionByName(repeated)


def check_availability_pairs(candidates: DataFrame) -> DataFrame:
    """Time without reference, or reference without time, on either side, for given pairs."""

    def partial(side: str) -> Column:
        at, ref = F.col(f"{side}_at"), F.col(f"{side}_reference")
        return (at.isNotNull() & X.blank(ref)) | (at.isNull() & ref.isNotNull())

    sides = F.array(
        F.when(partial("evidence"), F.lit("evidence")), F.when(partial("authority"), F.lit("authority"))
    )
    return candidates.select("capture_id", F.explode(F.array_compact(sides)).alias("side")).withColumn(
        "code", F.lit("AVAILABILITY_EVIDENCE_MISSING")
    )


# ------------------------------------------------------------------------- qualify, select, order


def exclusion_code(cutoff: Column) -> Column:
    """Null when both sides were available by the cutoff; a missing side is judged before a late one."""
    ev, au = F.col("evidence_at"), F.col("authority_at")
    return (
        F.when(ev.isNull(), S.EVIDENCE_MISSING)
        .when(au.isNull(), S.AUTHORITY_MISSING)
        .when(ev > cutoff, S.EVIDENCE_MISSING)
        .when(au > cutoff, S.AUTHORITY_MISSING)
    )


def filter_candidates(paired: DataFrame) -> DataFrame:
    return paired.where("scoped = 1")


def qualify_as_of(candidates: DataFrame, cutoff_ns: int) -> DataFrame:
    c = F.lit(cutoff_ns).cast("bigint")
    return candidates.where((F.col("evidence_at") <= c) & (F.col("authority_at") <= c))


def replay_exclusions(candidates: DataFrame, cutoff_ns: int) -> DataFrame:
    """Why each excluded capture is missing.  Not limited to the selection window."""
    c = F.lit(cutoff_ns).cast("bigint")
    return candidates.select("capture_id", exclusion_code(c).alias("code")).where("code IS NOT NULL")


def select_arrival_window(qualified: DataFrame, start_ns: int, end_ns: int) -> DataFrame:
    return tables.in_received_range(qualified, start_ns, end_ns, closed=False)


def select_event_window(
    qualified: DataFrame, start_ns: int, end_ns: int, strict: bool = True
) -> DataFrame:
    """Half-open event-time window; any qualified row without event time refuses the whole read."""
    if strict:
        require_event_time(qualified)
    t = F.col("provider_ns")
    return qualified.where((t >= F.lit(start_ns)) & (t < F.lit(end_ns)))


def require_event_time(rows: DataFrame) -> None:
    if not rows.where("provider_ns IS NULL").isEmpty():
        raise S.ContractError("UNSUPPORTED_EVENT_TIME", "a row lacks its event time")


def order_arrival(selected: DataFrame) -> DataFrame:
    return selected.orderBy("received_ns", "capture_id")


def order_strict_event(selected: DataFrame, strict: bool = True) -> DataFrame:
    if strict:
        require_event_time(selected)
    return selected.orderBy("provider_ns", "received_ns", "capture_id")


# ---------------------------------------------------------------------------- snapshot and pages


def source_identity(role: str, logical_identity: str, table: str, schema: dict[str, str]) -> Column:
    """Identity of one source: what it is and its columns, never where it is."""
    spec = F.create_map(*[F.lit(x) for name in sorted(schema) for x in (name, schema[name])])
    return X.digest(
        {
            "role": F.lit(role),
            "logical_identity": F.lit(logical_identity),
            "table": F.lit(table),
            "schema": spec,
            "version": F.lit(S.SOURCE_VERSION),
        }
    )


def source_identities(authorities: S.AuthorityIdentities = A.DEFAULT_AUTHORITIES) -> dict[str, Column]:
    def columns(table: str) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in S.TABLES[table].fields}

    return {
        "evidence": source_identity(
            "evidence", authorities.evidence, "capture_fact", columns("capture_fact")
        ),
        "decision": source_identity(
            "truth-decision", authorities.decision, "truth_decision", columns("truth_decision")
        ),
        "availability": source_identity(
            "availability", "availability/v1", "availability", columns("availability")
        ),
    }


def snapshot_identity(
    request: DataFrame,
    selected: DataFrame,
    authorities: S.AuthorityIdentities = A.DEFAULT_AUTHORITIES,
) -> DataFrame:
    """``request`` (one row) with ``n_records`` and ``snapshot_identity`` of its selected rows.

    Membership enters as count plus set digest: one map-side combined aggregate of a few sums.
    """
    members = X.with_words(selected.select("capture_id"), w=F.col("capture_id")).agg(
        F.count(F.lit(1)).alias("n_records"), *X.set_digest("w")
    )
    return bind_snapshot(X.with_one_row(request, members), authorities)


def bind_snapshot(
    requests: DataFrame, authorities: S.AuthorityIdentities = A.DEFAULT_AUTHORITIES
) -> DataFrame:
    sources = source_identities(authorities)
    fields = {
        **_request_fields(),
        "availability_authority_identity": sources["availability"],
        "evidence_authority_identity": sources["evidence"],
        "truth_decision_authority_identity": sources["decision"],
        "membership_count": F.col("n_records"),
        "membership_digest": X.set_digest_text(),
        "snapshot_scheme_version": F.lit(SNAPSHOT_SCHEME),
    }
    words = [f"w{i}" for i in range(X.DIGEST_WORDS)]
    return requests.withColumn("snapshot_identity", X.digest(fields)).drop(*words)


def detect_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Members added to or removed from a rebuilt snapshot; empty means no drift."""
    b = before.select("capture_id", F.lit(1).alias("before"))
    a = after.select("capture_id", F.lit(1).alias("after"))
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed")
    return (
        b.join(a, "capture_id", "full").select("capture_id", change.alias("change")).where("change IS NOT NULL")
    )


def keyset_page(
    selected: DataFrame, ordering: str, page_size: int, last_key: tuple | None = None
) -> DataFrame:
    """The rows strictly after ``last_key``, first ``page_size`` of them, with ``has_more``.

    The page is a top-k of ``page_size + 1`` keys; no offset and no full sort.
    """
    keys = ORDER_COLUMNS[ordering]
    rows = selected
    if last_key is not None:
        # the plain bound on the first key is implied, and is what a scan can use to prune
        rows = rows.where(F.col(keys[0]) >= F.lit(last_key[0])).where(
            F.struct(*keys) > F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, last_key, strict=True)])
        )
    top = rows.orderBy(*keys).limit(page_size + 1)
    # at most page_size + 1 rows from here on
    everything = Window.orderBy(*keys)
    counted = top.withColumn("position", F.row_number().over(everything)).withColumn(
        "has_more", F.count(F.lit(1)).over(Window.partitionBy()) > page_size
    )
    return counted.where(F.col("position") <= page_size)


def resume_check(bookmarks: DataFrame, current: DataFrame, selected: DataFrame) -> DataFrame:
    """Judges stored bookmarks against the rebuilt request and snapshot (``current``, one row).

    ``bookmarks(bookmark_id, request_identity, snapshot_identity, ordering, last_provider_ns,
    last_received_ns, last_capture_id)``; an arrival key has no provider time.  A bookmark with missing
    fields is judged by its shape before anything it says is compared.
    """
    now = current.select(
        F.col("request_identity").alias("now_request"),
        F.col("snapshot_identity").alias("now_snapshot"),
        F.col("ordering").alias("now_ordering"),
    )
    members = selected.select(
        F.col("capture_id").alias("last_capture_id"),
        F.col("received_ns").alias("m_received"),
        F.col("provider_ns").alias("m_provider"),
    )
    asked = bookmarks.select("last_capture_id").distinct()
    members = members.join(asked, "last_capture_id", "left_semi")
    strict = F.col("ordering") == "strict_event"
    shape_ok = F.col("last_received_ns").isNotNull() & (strict == F.col("last_provider_ns").isNotNull())
    named = F.col("request_identity").isNotNull() & F.col("snapshot_identity").isNotNull() & F.col("last_capture_id").isNotNull()
    member = (F.col("last_received_ns") == F.col("m_received")) & (
        ~strict | F.col("last_provider_ns").eqNullSafe(F.col("m_provider"))
    )
    code = (
        F.when(~F.coalesce(shape_ok & named, F.lit(False)), "INVALID_CURSOR")
        .when(~F.col("request_identity").eqNullSafe(F.col("now_request")), "CURSOR_MISMATCH")
        .when(~F.col("snapshot_identity").eqNullSafe(F.col("now_snapshot")), "SOURCE_UNAVAILABLE")
        .when(~F.col("ordering").eqNullSafe(F.col("now_ordering")), "INVALID_CURSOR")
        .when(~F.coalesce(member, F.lit(False)), "INVALID_CURSOR")
        .otherwise("ok")
    )
    return (
        X.with_one_row(bookmarks, now)
        .join(members, "last_capture_id", "left")
        .select("bookmark_id", code.alias("outcome"))
    )


# ------------------------------------------------------------------------------- many requests


def with_filters(paired: DataFrame, facts: DataFrame) -> DataFrame:
    """Candidates with asset and channel, for requests that filter differently.

    A candidate stays one row: without a fact it has no asset, and a fact that is stored twice counts once.
    """
    rows = facts.count()
    scope = spread(facts.select("capture_id", "asset", "channel"), rows, "capture_id")
    scope = scope.groupBy("capture_id").agg(F.min("asset").alias("asset"), F.min("channel").alias("channel"))
    return spread(paired, rows, "capture_id").join(scope, "capture_id", "left")


def with_rank(candidates: DataFrame) -> DataFrame:
    """Candidates with ``capture_rank``, a number that rises with ``capture_id`` (null for a null id), as a table.

    The ends of a range of ids are then a minimum and a maximum of numbers, which Spark folds by hash; texts it would sort first.
    """
    line = candidates.repartitionByRange("capture_id").sortWithinPartitions("capture_id")
    return materialize(line.withColumn("capture_rank", F.when(F.col("capture_id").isNotNull(), F.monotonically_increasing_id())))


def exclusion_ranges(listed: DataFrame, ranked: DataFrame) -> DataFrame:
    """Per request and code of ``listed`` (which keeps ``capture_rank``): how many exclusions, and the first and last id.

    However many pairs are listed, a task holds one row per request and code.
    """
    ends = materialize(listed.groupBy("request_id", "code").agg(F.count("*").alias("n"), F.min("capture_rank").alias("lo"), F.max("capture_rank").alias("hi")))
    wanted = ends.select(F.explode(F.array("lo", "hi")).alias("capture_rank")).distinct()
    names = ranked.select("capture_rank", "capture_id").join(wanted, "capture_rank", "left_semi")
    first = names.select(F.col("capture_rank").alias("lo"), F.col("capture_id").alias("first_capture_id"))
    last = names.select(F.col("capture_rank").alias("hi"), F.col("capture_id").alias("last_capture_id"))
    named = ends.join(first, "lo", "left").join(last, "hi", "left")
    return named.select("request_id", "code", "n", "first_capture_id", "last_capture_id")


def _passes_filters() -> Column:
    assets, channels = F.col("assets"), F.col("channels")
    return (assets.isNull() | F.array_contains(assets, F.col("asset"))) & (
        channels.isNull() | F.array_contains(channels, F.col("channel"))
    )


AXIS_LINES = {"arrival_time": "received_ns", "event_time": "provider_ns"}


def _cells_of(requests: DataFrame) -> tuple[C.Line, C.Line]:
    """The window bounds and the cutoffs that the requests name."""
    return C.line_of(requests, "start_ns", "end_ns"), C.line_of(requests, "cutoff_ns")


def _covers(requests: DataFrame, windows: C.Line, cutoffs: C.Line) -> DataFrame:
    """Dyadic nodes of each request's window, with the cell of its cutoff (``by_cell``)."""
    first, last = windows.cell(F.col("start_ns")), windows.cell(F.col("end_ns")) - 1
    placed = requests.select("request_id", "axis", "ordering", "assets", "channels", first.alias("first"), last.alias("last"), (cutoffs.cell(F.col("cutoff_ns")) - 1).alias("by_cell"))
    return materialize(C.cover(placed, F.col("first"), F.col("last"), windows.levels).drop("first", "last"))


def _available_cell(cutoffs: C.Line) -> Column:
    """How many cutoffs come before both sides of a candidate were available; such a request does not see it."""
    both = F.col("evidence_at").isNotNull() & F.col("authority_at").isNotNull()
    return F.when(both, cutoffs.cell(F.greatest("evidence_at", "authority_at") - 1))


def replay_many_members(requests: DataFrame, candidates: DataFrame, digest: bool = True) -> DataFrame:
    """Per request: how many rows it selects, how many lack event time, and (with ``digest``) their set digest, without listing them.

    Candidates are folded into cells of (axis, time, availability, asset, channel) once, cells into the dyadic nodes above them,
    and running sums over availability answer every cutoff.  From the first fold on, nothing depends on the number of rows.
    """
    windows, cutoffs = _cells_of(requests)
    covers = _covers(requests, windows, cutoffs)
    levels = C.highest(covers)
    words = [f"w{i}" for i in range(X.DIGEST_WORDS)] if digest else []
    summed = ["n_records", "n_undated", *words]
    group, node = ["asset", "channel"], ("axis", "level", "node")
    seen = candidates.withColumn("ac", _available_cell(cutoffs)).where(F.col("ac") < len(cutoffs.bounds))
    seen = seen.select(*group, "ac", "received_ns", "provider_ns", "capture_id")
    seen = X.with_words(seen, w=F.col("capture_id")) if digest else seen
    on_axis = [F.struct(F.lit(axis).alias("axis"), windows.cell(F.col(column)).alias("tc")) for axis, column in AXIS_LINES.items()]
    one = seen.select(*group, "ac", F.lit(1).cast("bigint").alias("n_records"), F.col("provider_ns").isNull().cast("bigint").alias("n_undated"), *words, F.explode(F.array(*on_axis)).alias("on"))
    one = one.select(*group, "ac", *summed, "on.*").where("tc IS NOT NULL")
    cells = C.folded(one, [*group, "axis", "tc", "ac"], summed)
    # what every request on a node sees is one step there, and what none of them sees is none
    named = covers.groupBy(*node).agg(F.min("by_cell").alias("all_by"), F.max("by_cell").alias("any_by"))
    above = C.nodes_of(cells, F.col("tc"), levels).join(named, list(node)).where(F.col("ac") <= F.col("any_by"))
    above = above.withColumn("ac", F.greatest("ac", "all_by"))
    parts = materialize(C.folded(above, [*node, *group, "ac"], summed))
    found = C.prefix_sums(parts, covers, group, "ac", "by_cell", summed, ["request_id", "ordering", "assets", "channels"], _passes_filters(), node)
    return C.folded(found, ["request_id", "ordering"], summed)


def answered(requests: DataFrame, candidates: DataFrame) -> DataFrame:
    """Requests less those that ``replay_many_status`` refuses; only rows without event time are counted for that."""
    ordered = requests.where("axis = 'arrival_time' AND ordering = 'strict_event'")
    undated = replay_many_members(ordered, candidates.where("provider_ns IS NULL"), digest=False)
    status = replay_many_status(requests, candidates, undated)
    return materialize(requests.join(status.where("outcome = 'ok'").select("request_id"), "request_id", "left_semi"))


def replay_many(requests: DataFrame, candidates: DataFrame) -> DataFrame:
    """Selected rows of every request in the table; per request equal to a single read.

    A request that a single read refuses has no rows.  A row meets only requests whose window holds it (see ``cells``);
    availability and filters are left to the join's residual.
    """
    requests = answered(requests, candidates)
    windows, cutoffs = _cells_of(requests)
    covers = _covers(requests, windows, cutoffs)
    levels = C.highest(covers)
    seen = candidates.withColumn("ac", _available_cell(cutoffs)).where(F.col("ac") < len(cutoffs.bounds))
    seen = seen.select("capture_id", "category", "asset", "channel", "received_ns", "provider_ns", "ac")
    out = None
    for axis, column in AXIS_LINES.items():
        rows = seen.withColumn("tc", windows.cell(F.col(column))).where("tc IS NOT NULL")
        met = C.meet(rows, F.col("tc"), covers.where(F.col("axis") == axis), levels)
        part = met.where((F.col("ac") <= F.col("by_cell")) & _passes_filters())
        part = part.select("request_id", "ordering", "capture_id", "category", "received_ns", "provider_ns")
        out = part if out is None else out.unionByName(part)
    return out


def replay_many_exclusions(requests: DataFrame, candidates: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``request_id``, ``capture_id``, ``code``: the exclusions of every request, as ``replay_exclusions`` gives them for one.

    ``keep`` names further columns of the candidates that go along.

    A candidate that was never available on both sides is excluded from every request its filters let in, by definition; a
    late one meets only requests whose cutoff comes before it.
    """
    requests = answered(requests, candidates)
    cutoffs = C.line_of(requests, "cutoff_ns")
    never = F.lit(len(cutoffs.bounds)).cast("bigint")
    # cell k of this line: candidates that the first k cutoffs do not see
    rows = candidates.select("capture_id", *keep, "asset", "channel", "evidence_at", "authority_at", F.coalesce(_available_cell(cutoffs), never).alias("ac"))
    asked = requests.select("request_id", "assets", "channels", "cutoff_ns", cutoffs.cell(F.col("cutoff_ns")).alias("after"))
    covers = C.cover(asked, F.col("after"), never, cutoffs.levels).drop("after")
    met = C.meet(rows.where("ac > 0"), F.col("ac"), covers, cutoffs.levels).where(_passes_filters())
    return met.select("request_id", "capture_id", exclusion_code(F.col("cutoff_ns")).alias("code"), *keep)


def replay_many_status(requests: DataFrame, candidates: DataFrame, members: DataFrame) -> DataFrame:
    """``ok`` or ``UNSUPPORTED_EVENT_TIME`` per request; ``members`` comes from ``replay_many_members``.

    On the event axis any qualified row without event time refuses the request.  Such rows are folded
    to the earliest qualifying time per (asset, channel) before they meet the requests.
    """
    undated = (
        candidates.where("provider_ns IS NULL AND evidence_at IS NOT NULL AND authority_at IS NOT NULL")
        .groupBy("asset", "channel")
        .agg(F.min(F.greatest("evidence_at", "authority_at")).alias("earliest"))
    )
    by_asset = requests.where("axis = 'event_time'").withColumn("asset", _asked_assets())
    refused = (
        by_asset.join(undated, "asset")
        .where(_passes_filters() & (F.col("earliest") <= F.col("cutoff_ns")))
        .select("request_id")
    )
    unordered = members.where("ordering = 'strict_event' AND n_undated > 0").select("request_id")
    bad = refused.unionByName(unordered).distinct().withColumn("code", F.lit("UNSUPPORTED_EVENT_TIME"))
    return requests.join(bad, "request_id", "left").select(
        "request_id", F.coalesce("code", F.lit("ok")).alias("outcome")
    )


def _asked_assets() -> Column:
    return F.explode(F.coalesce("assets", F.array(*[F.lit(a) for a in S.ASSETS])))


def exclusion_counts(requests: DataFrame, candidates: DataFrame, blocks: int | None = None) -> DataFrame:
    """Exclusions per request and code, without pairing requests with captures.

    Each capture is late-evidence until ``evidence_at``, late-authority until both are in, and
    qualified from then on, so the counts at a cutoff are running counts over time.  Times and asked
    cutoffs are put in one order, cut into blocks, and summed in two levels.
    """
    group = ["asset", "channel"]
    both = F.col("evidence_at").isNotNull() & F.col("authority_at").isNotNull()
    one = F.lit(1).cast("bigint")
    fixed = candidates.groupBy(*group).agg(
        F.sum(F.when(F.col("evidence_at").isNull(), one).otherwise(0)).alias("no_evidence"),
        F.sum(
            F.when(F.col("evidence_at").isNotNull() & F.col("authority_at").isNull(), one).otherwise(0)
        ).alias("no_authority"),
        F.sum(F.when(both, one).otherwise(0)).alias("n_both"),
    )
    asked = requests.withColumn("asset", _asked_assets()).join(fixed, "asset").where(_passes_filters())
    at = F.explode(
        F.array(
            F.struct(F.col("evidence_at").alias("t"), one.alias("d_ev"), (one * 0).alias("d_q")),
            F.struct(F.greatest("evidence_at", "authority_at").alias("t"), (one * 0).alias("d_ev"), one.alias("d_q")),
        )
    )
    steps = (
        candidates.where(both)
        .select(*group, at.alias("s"))
        .select(*group, "s.*")
        .groupBy(*group, "t")
        .agg(F.sum("d_ev").alias("d_ev"), F.sum("d_q").alias("d_q"))
        .withColumn("asks", F.lit(0))
    )
    questions = (
        asked.select(*group, F.col("cutoff_ns").alias("t")).distinct()
        .select(*group, "t", (one * 0).alias("d_ev"), (one * 0).alias("d_q"), F.lit(1).alias("asks"))
    )
    boundaries = block_boundaries(candidates.select(F.col("evidence_at").alias("t")), "t", blocks)
    line = into_blocks(steps.unionByName(questions), "t", boundaries)
    inside = Window.partitionBy(*group, "block").orderBy("t", "asks").rowsBetween(
        Window.unboundedPreceding, 0
    )
    across = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        line.groupBy(*group, "block")
        .agg(F.sum("d_ev").alias("b_ev"), F.sum("d_q").alias("b_q"))
        .select(
            *group,
            "block",
            F.coalesce(F.sum("b_ev").over(across), F.lit(0)).alias("c_ev"),
            F.coalesce(F.sum("b_q").over(across), F.lit(0)).alias("c_q"),
        )
    )
    answers = (
        line.withColumn("in_ev", F.sum("d_ev").over(inside))
        .withColumn("in_q", F.sum("d_q").over(inside))
        .where("asks = 1")
        .join(carried, [*group, "block"])
        .select(
            *group,
            F.col("t").alias("cutoff_ns"),
            (F.col("in_ev") + F.col("c_ev")).alias("ev_by"),
            (F.col("in_q") + F.col("c_q")).alias("q_by"),
        )
    )
    per_request = (
        asked.join(answers, [*group, "cutoff_ns"])
        .groupBy("request_id")
        .agg(
            F.sum(F.col("no_evidence") + F.col("n_both") - F.col("ev_by")).alias("n_evidence_missing"),
            F.sum(F.col("no_authority") + F.col("ev_by") - F.col("q_by")).alias("n_authority_missing"),
            F.sum("q_by").alias("n_qualified"),
        )
    )
    zero = F.lit(0).cast("bigint")
    counts = ("n_evidence_missing", "n_authority_missing", "n_qualified")
    return requests.select("request_id").join(per_request, "request_id", "left").select(
        "request_id", *[F.coalesce(c, zero).alias(c) for c in counts]
    )
