"""Append-only writes, keyed lookups and audits over the three tables.

The ``plan_*`` functions are pure: they return the rows a write would add.  The ``append_*`` functions
perform it.  Every write is harmless to repeat, because the rows already stored are removed by key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.operators.skew import duplicate_keys, fold_replays, one_row_per_key
from factlake.session import materialize
from factlake.sources import commits, tables

FACT_KEY = ("received_ns", "capture_id")
DECISION_KEY = ("policy_version", "subject_capture_id")


@dataclass(frozen=True)
class AppendReceipt:
    rows: int


def same_row(left: str, right: str, columns: list[str] | tuple[str, ...]) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns],
    )


# ---------------------------------------------------------------------------------------- facts


def plan_append_captures(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New facts less exact transport replays: one row per ``(received_ns, capture_id)``."""
    fresh = one_row_per_key(new.select(*S.FACT_COLUMNS), FACT_KEY)
    return fresh.join(existing.select(*FACT_KEY), list(FACT_KEY), "left_anti")


def conflicting_captures(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Keys of new facts that differ from a stored fact, or from one another, under one key."""
    digest = X.digest({c: F.col(c) for c in S.FACT_COLUMNS}).alias("d")
    ours = new.select(*FACT_KEY, digest)
    theirs = existing.select(*S.FACT_COLUMNS).join(new.select(*FACT_KEY).distinct(), list(FACT_KEY), "left_semi").select(*FACT_KEY, digest)
    folded = ours.unionByName(theirs).groupBy(*FACT_KEY).agg(F.min("d").alias("x"), F.max("d").alias("y"))
    return folded.where("x != y").select(*FACT_KEY)


def stored_clashes(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Keys of folded facts that are stored with other content."""
    digest = F.unhex(X.digest({c: F.col(c) for c in S.FACT_COLUMNS}))
    theirs = existing.select(*FACT_KEY, digest.alias("theirs"))
    return new.select(*FACT_KEY, digest.alias("ours")).join(theirs, list(FACT_KEY)).where("ours != theirs").select(*FACT_KEY)


def folded_captures(facts: DataFrame) -> DataFrame:
    """Facts with exact replays folded to one row; one key with different content stops the batch."""
    folded = materialize(fold_replays(facts.select(*S.FACT_COLUMNS), FACT_KEY))
    if not folded.where("differs").isEmpty():
        raise S.ContractError("INVARIANT_CONFLICT", "one capture came with different content")
    return folded.drop("differs")


def append_captures(
    spark: SparkSession, path: str, new: DataFrame, batch_id: int | None = None, folded: bool = False
) -> AppendReceipt:
    """Commit the planned rows, laid out by ``received_date`` in files sized by bytes.

    A retried batch replaces its own part, so at-least-once delivery leaves one row.  The
    stored side is pruned to the parts and days the new rows touch.  Only exact replays are folded: a key that comes, or is
    stored, with different content is a conflict, and nothing is written.  ``folded`` says that ``new`` comes from
    ``folded_captures``: its keys are unique and need not be folded again.
    """
    bounds = new.agg(F.min("received_ns"), F.max("received_ns")).first()
    if bounds[0] is None:
        return AppendReceipt(0)

    def may_hold(part: commits.Part) -> bool:
        known = part.stats.get("first_ns"), part.stats.get("last_ns")
        return (batch_id is None or part.batch != batch_id) and (None in known or (known[0] <= bounds[1] and known[1] >= bounds[0]))

    stored = commits.read(spark, path, tables.STORED_FACT, may_hold)
    stored = tables.in_received_range(stored, bounds[0], bounds[1], closed=True)
    clash = stored_clashes(new, stored) if folded else conflicting_captures(new, stored)
    if not clash.isEmpty():
        raise S.ContractError("INVARIANT_CONFLICT", "one capture came with different content")
    fresh = new.select(*S.FACT_COLUMNS).join(stored.select(*FACT_KEY), list(FACT_KEY), "left_anti") if folded else plan_append_captures(new, stored)
    rows = fresh.withColumn("received_date", X.received_date(F.col("received_ns")))
    span = {"first_ns": F.min("received_ns"), "last_ns": F.max("received_ns")}
    part = commits.write(spark, path, rows, by=("received_date",), batch=batch_id, stats=span)
    commits.compact(spark, path, tables.STORED_FACT, by=("received_date",), stats=span, before=batch_id)
    if batch_id is not None:
        return AppendReceipt(part.rows)
    return AppendReceipt(new.count() if folded else new.select(*FACT_KEY).distinct().count())


def lookup_capture(ids: DataFrame, facts: DataFrame) -> DataFrame:
    """Set form of fetch-by-id: how many rows each asked id has; >1 is an invariant error.

    Only ids and counts meet in the join; ``read_captures`` fetches the rows.
    """
    wanted = ids.select("capture_id").distinct()
    found = facts.join(wanted, "capture_id", "left_semi").groupBy("capture_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return wanted.join(found, "capture_id", "left").select(
        "capture_id",
        n.alias("n_rows"),
        F.when(n == 0, "absent").when(n == 1, "found").otherwise("not_unique").alias("outcome"),
    )


def read_captures(ids: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows of the asked ids; raises if any id is stored more than once."""
    report = lookup_capture(ids, facts)
    if not report.where("outcome = 'not_unique'").isEmpty():
        raise S.ContractError("MALFORMED_EVIDENCE", "a capture id is stored more than once")
    return facts.join(ids.select("capture_id").distinct(), "capture_id", "left_semi")


def audit_duplicate_captures(facts: DataFrame) -> DataFrame:
    """Both uniqueness audits; any row means stop, nothing is repaired."""
    pairs = duplicate_keys(facts, FACT_KEY).select(
        F.lit("received_ns_capture_id").alias("audit"), "capture_id", "received_ns", "n"
    )
    ids = duplicate_keys(facts, ["capture_id"]).select(
        F.lit("capture_id").alias("audit"),
        "capture_id",
        F.lit(None).cast("bigint").alias("received_ns"),
        "n",
    )
    return pairs.unionByName(ids)


# ------------------------------------------------------------------------------------ decisions


def export_decisions(decisions: DataFrame, written_ns: Column) -> DataFrame:
    """Stored form: contributors as JSON text, identity as four columns."""
    return decisions.select(
        "policy_version",
        "subject_capture_id",
        "category",
        F.to_json("contributing_capture_ids").alias("contributing_capture_ids"),
        "reason",
        *[F.col(f"event.{c}").alias(f"event_{c}") for c in S.IDENTITY_COLUMNS],
        written_ns.cast("bigint").alias("physical_written_at"),
    )


def import_decisions(stored: DataFrame) -> DataFrame:
    """Back to the typed form; use after ``validate_rows``."""
    event = F.struct(*[F.col(f"event_{c}").alias(c) for c in S.IDENTITY_COLUMNS])
    return stored.select(
        "policy_version",
        "subject_capture_id",
        "category",
        tables.parse_string_list(F.col("contributing_capture_ids")).alias(
            "contributing_capture_ids"
        ),
        "reason",
        F.when(F.col("event_trade_id").isNotNull(), event).alias("event"),
    )


def plan_append_decisions(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Each candidate with its outcome: ``new``, ``same`` or ``conflict``; stored rows never change."""
    columns = list(S.DECISION_COLUMNS)
    c, e = candidates.alias("c"), existing.alias("e")
    joined = c.join(e, [F.col(f"c.{k}") == F.col(f"e.{k}") for k in DECISION_KEY], "left")
    absent = F.col("e.subject_capture_id").isNull()
    outcome = F.when(absent, "new").when(same_row("c", "e", columns), "same").otherwise("conflict")
    return joined.select(*[F.col(f"c.{x}").alias(x) for x in columns], outcome.alias("outcome"))


def append_decisions(spark: SparkSession, path: str, candidates: DataFrame) -> AppendReceipt:
    """Write the new rows, read them back, require them exactly as given, and commit them."""
    columns = list(S.DECISION_COLUMNS)
    existing = read_decisions(spark, path)
    plan = materialize(_judged(candidates.select(*columns), existing, DECISION_KEY, columns))
    if not plan.where("doubled").isEmpty():
        raise S.ContractError("AUTHORITY_CONFLICT", "a subject has several candidates, or is stored twice")
    if not plan.where("outcome = 'conflict'").isEmpty():
        raise S.ContractError("AUTHORITY_CONFLICT", "a stored decision differs from its candidate")
    new = plan.where("outcome = 'new'").select(*columns)

    def read_back(written: DataFrame) -> None:
        if _content(written, columns) != _content(new, columns):
            raise S.ContractError("SOURCE_UNAVAILABLE", "appended decisions did not read back exactly")

    commits.write(spark, path, new, check=read_back)
    commits.compact(spark, path, S.TRUTH_DECISION)
    return AppendReceipt(plan.count())


def _judged(candidates: DataFrame, existing: DataFrame, key: tuple[str, ...], columns: list[str], may_lack: tuple[str, ...] = ()) -> DataFrame:
    """One row per candidate key: its smallest candidate, ``outcome`` against the stored row, and ``doubled``.

    Candidates and stored rows are stacked and folded by key, so each crosses the network once.  Exact copies of a candidate
    count once; ``doubled`` marks keys with different candidates or several stored rows.  A key with a null in it meets no
    stored row, unless the column is one of ``may_lack``.
    """
    rest = F.struct(*[c for c in columns if c not in key])
    extra = [c for c in candidates.columns if c not in columns]
    ours = candidates.select(*key, *extra, rest.alias("ours"))
    theirs = existing.dropna(subset=[c for c in key if c not in may_lack]).select(*key, rest.alias("theirs"))
    folded = (
        ours.unionByName(theirs, allowMissingColumns=True)
        .groupBy(*key)
        .agg(*[F.min(c).alias(c) for c in extra], F.min("ours").alias("ours"), F.max("ours").alias("last"), F.min("theirs").alias("theirs"), F.count("theirs").alias("n"))
        .where("ours IS NOT NULL")
    )
    outcome = F.when(F.col("n") == 0, "new").when(F.col("ours").eqNullSafe(F.col("theirs")), "same").otherwise("conflict")
    doubled = (F.col("n") > 1) | ~F.col("ours").eqNullSafe(F.col("last"))
    named = [F.col(c) if c in key or c in extra else F.col(f"ours.{c}").alias(c) for c in [*columns, *extra]]
    return folded.select(*named, outcome.alias("outcome"), doubled.alias("doubled"))


def _content(rows: DataFrame, columns: list[str]) -> tuple:
    """Count and set digest of rows; nothing is shuffled but one row a task."""
    told = X.with_words(rows.select(X.digest({c: F.col(c) for c in columns}).alias("d")), w=F.col("d"))
    return tuple(told.agg(F.count(F.lit(1)).alias("n"), *X.set_digest("w")).first())


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    return commits.read(spark, path, S.TRUTH_DECISION).select(*S.DECISION_COLUMNS)


def find_subject_decision(keys: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decision of each asked ``(policy, subject)``; ``n_decisions`` > 1 is an invariant error."""
    wanted = keys.select(*DECISION_KEY).distinct()
    found = (
        decisions.join(wanted, list(DECISION_KEY), "left_semi")
        .groupBy(*DECISION_KEY)
        .agg(F.count(F.lit(1)).alias("n"), F.min("category").alias("category"))
    )
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return wanted.join(found, list(DECISION_KEY), "left").select(
        *DECISION_KEY,
        n.alias("n_decisions"),
        F.when(n == 1, F.col("category")).alias("category"),
        F.when(n == 0, "absent").when(n == 1, "found").otherwise("not_unique").alias("outcome"),
    )


# ---------------------------------------------------------------------------------- availability


def plan_append_availability(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Each marker with its outcome against the stored one of its key.

    ``written_at_ns`` is diagnostic and not part of the comparison.
    """
    compared = [c for c in S.MARKER_COLUMNS if c != "written_at_ns"]
    c, e = candidates.alias("c"), existing.alias("e")
    on = (
        (F.col("c.capture_id") == F.col("e.capture_id"))
        & (F.col("c.kind") == F.col("e.kind"))
        & F.col("c.policy_version").eqNullSafe(F.col("e.policy_version"))
    )
    absent = F.col("e.capture_id").isNull()
    outcome = F.when(absent, "new").when(same_row("c", "e", compared), "same").otherwise("conflict")
    return c.join(e, on, "left").select(
        *[F.col(f"c.{x}").alias(x) for x in S.MARKER_COLUMNS], outcome.alias("outcome")
    )


def append_availability(spark: SparkSession, path: str, candidates: DataFrame) -> AppendReceipt:
    """Write, read back and commit; copies of a marker in the batch count once, and must be equal.

    The commit states the latest time of its markers, from which ``stored_floor`` has the floor.
    """
    compared = [c for c in S.MARKER_COLUMNS if c != "written_at_ns"]
    existing = read_markers(spark, path).select(*compared)
    if candidates.isEmpty():
        existing = existing.limit(0)
    plan = materialize(_judged(candidates.select(*S.MARKER_COLUMNS), existing, S.MARKER_KEY, compared, ("policy_version",)))
    if not plan.where("doubled").isEmpty():
        raise S.ContractError("INVARIANT_CONFLICT", "a marker key has several candidates, or is stored twice")
    if not plan.where("outcome = 'conflict'").isEmpty():
        raise S.ContractError("INVARIANT_CONFLICT", "immutable availability conflict")
    new = plan.where("outcome = 'new'").select(*S.MARKER_COLUMNS)

    def read_back(written: DataFrame) -> None:
        if _content(written, compared) != _content(new, compared):
            raise S.ContractError("SOURCE_UNAVAILABLE", "appended markers did not read back exactly")

    latest = {"latest_ns": F.max("available_at_ns")}
    commits.write(spark, path, new, stats=latest, check=read_back)
    commits.compact(spark, path, S.AVAILABILITY, stats=latest)
    return AppendReceipt(plan.count())


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    return commits.read(spark, path, S.AVAILABILITY).select(*S.MARKER_COLUMNS)


def is_file(spark: SparkSession, path: str) -> bool:
    target, system = _file_system(spark, path)
    return system.exists(target) and system.getFileStatus(target).isFile()


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
