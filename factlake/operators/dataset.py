"""Immutable, content-identified datasets cut from one replay view."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.sources import commits

DISPOSITION = "excluded_by_category"
MANIFEST_VERSION = "set-digest/v1"


def record_digest() -> Column:
    """Digest of one replayed record: every fact field, every decision field, both references."""
    names = [*S.FACT_COLUMNS, *[c for c in S.DECISION_COLUMNS if c != "subject_capture_id"]]
    names += ["evidence_reference", "authority_reference"]
    fields = {n: F.col(n) for n in names}
    event = F.struct(*[F.col(f"event.{c}").alias(c) for c in sorted(S.IDENTITY_COLUMNS)])
    fields["event"] = F.when(F.col("event").isNotNull(), event)
    return X.digest(fields)


def admit_records(records: DataFrame) -> DataFrame:
    """Only accepted rows enter; equal content is never folded."""
    return records.where("category = 'accepted'")


def category_exclusions(records: DataFrame) -> DataFrame:
    known = "record_digest" in records.columns
    return records.where("category != 'accepted'").select(
        "capture_id",
        "category",
        (F.col("record_digest") if known else record_digest()).alias("record_digest"),
        F.lit(DISPOSITION).alias("disposition"),
    )


def exclusion_provenance(records: DataFrame, replay_exclusions: DataFrame) -> DataFrame:
    """Both exclusion layers; a replay exclusion states only its id and code."""
    by_category = category_exclusions(records).withColumn("layer", F.lit("category"))
    by_replay = replay_exclusions.select("capture_id", "code").withColumn("layer", F.lit("replay"))
    return by_category.unionByName(by_replay, allowMissingColumns=True)


def with_digest(records: DataFrame) -> DataFrame:
    return records.withColumn("record_digest", record_digest())


def dataset_manifest(summary: DataFrame, records: DataFrame, replay_exclusions: DataFrame) -> DataFrame:
    """Manifest core and ``dataset_identity`` (one row).

    ``summary`` is the one-row request summary.  The order of a dataset follows from its records (the
    order keys are fields of the record) and the bound ordering rule, so the set digest of the record
    digests binds the sequence too, without a global sort.
    """
    digested = records if "record_digest" in records.columns else with_digest(records)
    accepted = F.col("category") == "accepted"
    excluded = X.canonical_json(
        {
            "capture_id": F.col("capture_id"),
            "category": F.col("category"),
            "digest": F.col("record_digest"),
            "disposition": F.lit(DISPOSITION),
        }
    )
    core = X.with_words(
        digested.select("category", F.when(accepted, F.col("record_digest")).alias("d"), F.when(~accepted, excluded).alias("x")),
        i=F.col("d"),
        c=F.col("x"),
    ).agg(
        F.count_if(accepted).alias("n_included"),
        F.count_if(~accepted).alias("n_category_excluded"),
        *X.set_digest("i"),
        *X.set_digest("c"),
    )
    entry = X.canonical_json({"capture_id": F.col("capture_id"), "code": F.col("code")})
    replayed = X.with_words(replay_exclusions, r=entry).agg(
        F.count(F.lit(1)).alias("n_replay_excluded"), *X.set_digest("r")
    )
    one_row = X.with_one_row(X.with_one_row(summary, core), replayed)
    counts = ("n_included", "n_category_excluded", "n_replay_excluded")
    identity = X.digest(
        {
            "dataset_policy_version": F.lit(S.DATASET_POLICY),
            "manifest_version": F.lit(MANIFEST_VERSION),
            "request_identity": F.col("request_identity"),
            "source_snapshot_identity": F.col("snapshot_identity"),
            "authority_policy_version": F.col("policy_version"),
            "ordering": F.col("ordering"),
            "completeness": F.lit(S.COMPLETENESS),
            "included": X.set_digest_text("i"),
            "category_exclusions": X.set_digest_text("c"),
            "replay_exclusions": X.set_digest_text("r"),
            **{c: F.col(c) for c in counts},
        }
    )
    return one_row.select(
        identity.alias("dataset_identity"),
        F.lit(S.DATASET_POLICY).alias("dataset_policy_version"),
        "request_identity",
        "snapshot_identity",
        "policy_version",
        "ordering",
        F.lit(S.COMPLETENESS).alias("completeness"),
        *counts,
        X.set_digest_text("i").alias("included_digest"),
        X.set_digest_text("c").alias("category_exclusion_digest"),
        X.set_digest_text("r").alias("replay_exclusion_digest"),
    )


@dataclass(frozen=True)
class WrittenSnapshot:
    dataset_identity: str
    path: str
    created: bool


def write_snapshot(
    spark: SparkSession,
    root: str,
    summary: DataFrame,
    records: DataFrame,
    replay_exclusions: DataFrame,
) -> WrittenSnapshot:
    """Write once under ``dataset_identity=...``.  The manifest goes last and is the commit mark.

    The records are computed and written a single time, into a staging folder under ``root`` where their identity is derived;
    the admitted ones are then renamed into place.  An
    identity that is already committed is left alone after its manifest is compared; a folder without
    a manifest is an interrupted write and is made again in full, so no reader that waits for the
    manifest sees a part.  Files are sized by bytes within a day.
    """
    root = root.rstrip("/")
    staged = f"{root}/_staging/{uuid.uuid4().hex}"
    rows = with_digest(records).withColumn("received_date", X.received_date(F.col("received_ns")))
    rows = rows.withColumn("admitted", F.coalesce(F.col("category") == "accepted", F.lit(False)))
    by = ("admitted", "received_date")
    rows.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{staged}/records")
    kept = spark.read.schema(rows.schema).parquet(f"{staged}/records").drop(*by)
    manifest = dataset_manifest(summary, kept, replay_exclusions)
    core = manifest.first().asDict()
    path = f"{root}/dataset_identity={core['dataset_identity']}"
    stored = read_manifest(spark, path)
    if stored is not None:
        commits.remove(spark, staged)
        if stored != core:
            raise S.ContractError("INVARIANT_CONFLICT", "one identity, two manifests")
        return WrittenSnapshot(core["dataset_identity"], path, created=False)
    commits.remove(spark, path)
    exclusion_provenance(kept, replay_exclusions).write.parquet(f"{path}/exclusions")
    admitted = f"{staged}/records/admitted=true"
    if commits.exists(spark, admitted):
        commits.move(spark, admitted, f"{path}/records")
    else:
        admit_records(kept).withColumn("received_date", X.received_date(F.col("received_ns"))).limit(0).write.parquet(f"{path}/records")
    commits.remove(spark, staged)
    spark.createDataFrame([core], manifest.schema).coalesce(1).write.parquet(f"{path}/manifest")
    return WrittenSnapshot(core["dataset_identity"], path, created=True)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    if not commits.exists(spark, f"{path}/manifest/_SUCCESS"):
        return None
    return spark.read.parquet(f"{path}/manifest").first().asDict()


def compare_snapshots(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows added, removed or changed between two datasets, by capture id and record digest."""
    b = before.select("capture_id", record_digest().alias("before_digest"))
    a = after.select("capture_id", record_digest().alias("after_digest"))
    change = (
        F.when(F.col("before_digest").isNull(), "added")
        .when(F.col("after_digest").isNull(), "removed")
        .when(F.col("before_digest") != F.col("after_digest"), "changed")
    )
    return (
        b.join(a, "capture_id", "full")
        .select("capture_id", change.alias("change"), "before_digest", "after_digest")
        .where("change IS NOT NULL")
    )
