"""When facts and decisions became provably available."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.operators import store
from factlake.operators.prefix import default_blocks
from factlake.session import many, materialize, spread
from factlake.sources import commits, tables

DEFAULT_AUTHORITIES = S.AuthorityIdentities()


def row_digest(columns: list[str] | tuple[str, ...]) -> Column:
    return X.digest({c: F.col(c) for c in columns})


def _prove(
    sent: DataFrame, stored: DataFrame, comparable: DataFrame, key: list[str], columns: list[str]
) -> DataFrame:
    """Outcome per sent key: absent, proven, mismatch or not_unique.

    How often a key is stored is counted over the whole table, reading only the key.  Rows are
    compared by the digest of every column, and only over ``comparable``, the part of the table that
    can hold an equal row; a key stored elsewhere is a mismatch by itself.  Payloads never cross the
    network, and both stored sides are cut to the sent keys and folded before they do.
    """
    # all sides are dealt alike, so that the joins and folds by key follow in the same tasks
    rows = sent.count() + stored.count()
    ours = spread(sent.select(*key, F.unhex(row_digest(columns)).alias("sent_digest")), rows, *key)
    asked = spread(sent.select(*key), rows, *key)
    counts = (
        spread(stored.select(*key), rows, *key)
        .join(asked, key, "left_semi")
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_stored"))
    )
    digests = (
        spread(comparable.select(*key, F.unhex(row_digest(columns)).alias("d")), rows, *key)
        .join(asked, key, "left_semi")
        .groupBy(*key)
        .agg(F.min("d").alias("stored_digest"))
    )
    n = F.coalesce(F.col("n_stored"), F.lit(0).cast("bigint"))
    outcome = (
        F.when(n == 0, "absent")
        .when(n > 1, "not_unique")
        .when(F.col("sent_digest") == F.col("stored_digest"), "proven")
        .otherwise("mismatch")
    )
    return (
        ours.join(counts, key, "left").join(digests, key, "left").select(*key, outcome.alias("outcome"))
    )


def prove_evidence(sent: DataFrame, stored: DataFrame) -> DataFrame:
    """A fact is proven by reading back a row equal in every column.

    When the stored table carries its day partition, payloads are read only for the days of the batch.
    """
    comparable = stored
    if "received_date" in stored.columns:
        span = sent.agg(F.min("received_ns"), F.max("received_ns")).first()
        if span[0] is not None:
            comparable = tables.in_received_range(stored, span[0], span[1], closed=True)
    return _prove(sent, stored, comparable, ["capture_id"], list(S.FACT_COLUMNS))


def prove_authority(decided: DataFrame, stored: DataFrame) -> DataFrame:
    return _prove(decided, stored, stored, list(store.DECISION_KEY), list(S.DECISION_COLUMNS))


def evidence_candidates(ids: DataFrame, candidate_ns: Column, authority: str) -> DataFrame:
    return ids.select(
        F.lit("evidence").alias("kind"),
        "capture_id",
        F.lit(None).cast("string").alias("policy_version"),
        candidate_ns.cast("bigint").alias("candidate_ns"),
        F.lit(authority).alias("source_authority_identity"),
    )


def authority_candidates(decisions: DataFrame, candidate_ns: Column, authority: str) -> DataFrame:
    return decisions.select(
        F.lit("authority").alias("kind"),
        F.col("subject_capture_id").alias("capture_id"),
        "policy_version",
        candidate_ns.cast("bigint").alias("candidate_ns"),
        F.lit(authority).alias("source_authority_identity"),
    )


# ---------------------------------------------------------------------------------- proof times

#: Rows of a block at most, about.
BLOCK_ROWS = 1 << 19


def ordered_blocks(candidates: DataFrame, blocks: int | None = None) -> DataFrame:
    """Candidates in issue order, cut into ranges: ``block``, and ``at``, rising within a block.

    The ranges are quantiles of the whole key, id included, so a burst at one instant is split wherever its ids allow, whatever
    they look like.  The result is a table, because a second run of the sort could cut it elsewhere.
    """
    if blocks is None:
        blocks = max(default_blocks(candidates), candidates.count() // BLOCK_ROWS + 1)
    kind_rank = F.when(F.col("kind") == "evidence", 0).otherwise(1)
    order = ["candidate_ns", "kind_rank", "capture_id", "policy_version"]
    line = candidates.withColumn("kind_rank", kind_rank).repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    return materialize(line.select(*candidates.columns, F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("at")))


def assign_proof_times(candidates: DataFrame, floor: int | None, blocks: int | None = None) -> DataFrame:
    """Strictly increasing times ``x_i = max(c_i, x_{i-1} + 1)`` starting above ``floor``.

    Issue order is ``(candidate_ns, evidence before authority, id, policy)``.  With the candidates sorted the recurrence has the
    closed form ``x_i = i + max(floor + 1, max(c_j - j))`` over j <= i (counting from 0), which needs a global rank:

    1. one range sort puts the rows into blocks of about equal size (see ``ordered_blocks``);
    2. ranks and running maxima are taken inside each block in parallel;
    3. one row per block carries the totals across.

    No window sees all rows, and nothing loops.
    """
    line = ordered_blocks(candidates, blocks)
    n = many(line.sparkSession, line.count())
    if n is not None:
        # about one block a task
        line = line.repartitionByRange(n, "block")
    inside = Window.partitionBy("block").orderBy("at")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = line.withColumn("local_rank", (F.row_number().over(inside) - 1).cast("bigint")).withColumn(
        "local_max", F.max(F.col("candidate_ns") - F.col("local_rank")).over(upto)
    )
    totals = local.groupBy("block").agg(F.count(F.lit(1)).alias("block_n"), F.max("local_max").alias("block_max"))
    # one row a block from here on
    across = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("rank_base", F.coalesce(F.sum("block_n").over(across), F.lit(0)))
    offsets = offsets.withColumn(
        "carried", F.max(F.col("block_max") - F.col("rank_base")).over(across)
    ).select("block", "rank_base", "carried")
    rank = F.col("rank_base") + F.col("local_rank")
    lead = F.greatest(
        F.lit(None if floor is None else floor + 1).cast("bigint"),
        F.col("carried"),
        F.col("local_max") - F.col("rank_base"),
    )
    return local.join(F.broadcast(offsets), "block").select(*candidates.columns, (rank + lead).alias("available_at_ns"))


def committed_floor(markers: DataFrame) -> DataFrame:
    """One row: highest stored time (null when empty) and how many keys are stored twice."""
    per_key = markers.groupBy(*S.MARKER_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.max("available_at_ns").alias("at")
    )
    return per_key.agg(
        F.max("at").alias("committed_floor"),
        F.coalesce(F.sum((F.col("n") > 1).cast("bigint")), F.lit(0).cast("bigint")).alias(
            "duplicate_keys"
        ),
    )


def read_committed_floor(markers: DataFrame) -> int | None:
    row = committed_floor(markers).first()
    if row["duplicate_keys"]:
        raise S.ContractError("INVARIANT_CONFLICT", "a marker key is stored twice")
    if row["committed_floor"] is not None and row["committed_floor"] < 0:
        raise S.ContractError("SOURCE_UNAVAILABLE", "invalid committed floor")
    return row["committed_floor"]


def stored_floor(spark: SparkSession, path: str) -> int | None:
    """Highest stored time, from the statistics of the commits alone; null for an empty table.

    Keys are unique because every append compares its own with the stored ones; ``committed_floor`` audits them.
    """
    live = commits.parts(spark, path)
    if live is None:
        return read_committed_floor(store.read_markers(spark, path))
    floor = max((p.stats["latest_ns"] for p in live), default=None)
    if floor is not None and floor < 0:
        raise S.ContractError("SOURCE_UNAVAILABLE", "invalid committed floor")
    return floor


# -------------------------------------------------------------------------------------- markers


def compare_markers(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates with their outcome: ``new``, ``same`` (stored time kept) or ``conflict``."""
    c, e = candidates.alias("c"), existing.alias("e")
    on = (
        (F.col("c.capture_id") == F.col("e.capture_id"))
        & (F.col("c.kind") == F.col("e.kind"))
        & F.col("c.policy_version").eqNullSafe(F.col("e.policy_version"))
    )
    agrees = (F.col("e.proof_schema_version") == S.PROOF_SCHEMA) & (
        F.col("e.source_authority_identity") == F.col("c.source_authority_identity")
    )
    outcome = (
        F.when(F.col("e.capture_id").isNull(), "new").when(agrees, "same").otherwise("conflict")
    )
    return c.join(e, on, "left").select(
        "c.*", F.col("e.available_at_ns").alias("stored_at_ns"), outcome.alias("outcome")
    )


def record_markers(candidates: DataFrame, existing: DataFrame, floor: int | None) -> DataFrame:
    """Idempotent recording: known keys keep their time, new keys get the next proof times.

    The comparison is kept in the shared folder, because its two outcomes and the block boundaries
    each read it.
    """
    compared = materialize(compare_markers(candidates, existing))
    known = compared.where("outcome != 'new'").select(
        *S.MARKER_KEY, "source_authority_identity", F.col("stored_at_ns").alias("available_at_ns"), "outcome"
    )
    fresh = assign_proof_times(
        compared.where("outcome = 'new'").select(*candidates.columns), floor
    ).select(
        *S.MARKER_KEY, "source_authority_identity", "available_at_ns", F.lit("new").alias("outcome")
    )
    return known.unionByName(fresh)


def marker_rows(recorded: DataFrame, written_ns: Column) -> DataFrame:
    """Table rows of the newly recorded markers."""
    return recorded.where("outcome = 'new'").select(
        *S.MARKER_KEY,
        "available_at_ns",
        F.lit(S.PROOF_SCHEMA).alias("proof_schema_version"),
        "source_authority_identity",
        written_ns.cast("bigint").alias("written_at_ns"),
    )


def marker_reference(
    kind: Column, capture_id: Column, policy: Column, at_ns: Column, proof: Column, identity: Column
) -> Column:
    """SHA-256 that stands for one marker in replayed rows."""
    return X.digest(
        {
            "kind": kind,
            "capture_id": capture_id,
            "policy_version": policy,
            "available_at_ns": at_ns,
            "proof": proof,
            "identity": identity,
        }
    )


def expected_authority(kind: Column, authorities: S.AuthorityIdentities) -> Column:
    return F.when(kind == "evidence", authorities.evidence).otherwise(F.lit(authorities.decision))


def marker_is_bad(authorities: S.AuthorityIdentities = DEFAULT_AUTHORITIES) -> Column:
    """A stored marker that must stop a read: broken row, or bound to another source."""
    foreign = F.col("source_authority_identity") != expected_authority(F.col("kind"), authorities)
    return tables.marker_reject_reason().isNotNull() | foreign


def marker_lookup(
    keys: DataFrame, markers: DataFrame, authorities: S.AuthorityIdentities = DEFAULT_AUTHORITIES
) -> DataFrame:
    """Marker of each asked key: found, absent, or ``AVAILABILITY_EVIDENCE_MISSING``."""
    folded = (
        markers.withColumn("bad", marker_is_bad(authorities))
        .groupBy(*S.MARKER_KEY)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("bad").alias("bad"),
            F.max("available_at_ns").alias("at"),
        )
    )
    k, m = keys.alias("k"), folded.alias("m")
    on = (
        (F.col("k.capture_id") == F.col("m.capture_id"))
        & (F.col("k.kind") == F.col("m.kind"))
        & F.col("k.policy_version").eqNullSafe(F.col("m.policy_version"))
    )
    n = F.coalesce(F.col("m.n"), F.lit(0).cast("bigint"))
    outcome = (
        F.when(n == 0, "absent")
        .when((n > 1) | F.col("m.bad"), "AVAILABILITY_EVIDENCE_MISSING")
        .otherwise("found")
    )
    return k.join(m, on, "left").select(
        *[F.col(f"k.{c}").alias(c) for c in S.MARKER_KEY],
        outcome.alias("outcome"),
        F.when(outcome == "found", F.col("m.at")).alias("available_at_ns"),
    )


def persistence_gate(outcomes: DataFrame) -> DataFrame:
    """Facts that go on to read-back.  No write outcome counts as proof; unknown ones are refused."""
    known = (*S.PERSISTENCE_STOP, *S.PERSISTENCE_CONTINUE)
    status = F.col("persistence_status")
    return outcomes.withColumn(
        "gate",
        F.when(X.in_set(status, S.PERSISTENCE_CONTINUE), "continue")
        .when(X.in_set(status, known), "stop")
        .otherwise("refused"),
    )
