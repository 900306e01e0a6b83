"""Reading, checking and evolving the three stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factlake import schemas as S
from factlake.functions import exprs as X
from factlake.sources import commits

STORED_FACT = T.StructType([*S.CAPTURE_FACT.fields, T.StructField("received_date", T.DateType())])


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Committed facts, partitioned by ``received_date``; the schema is declared, never inferred."""
    return commits.read(spark, path, STORED_FACT)


def in_received_range(df: DataFrame, start_ns: int, end_ns: int, closed: bool) -> DataFrame:
    """Range on ``received_ns`` plus the implied date range, so that day partitions are pruned."""
    ns = F.col("received_ns")
    upper = ns <= end_ns if closed else ns < end_ns
    out = df.where((ns >= F.lit(start_ns)) & upper)
    if "received_date" in df.columns:
        day = F.col("received_date")
        out = out.where(
            (day >= X.received_date(F.lit(start_ns).cast("bigint")))
            & (day <= X.received_date(F.lit(end_ns).cast("bigint")))
        )
    return out


def scan_capture_range(
    facts: DataFrame,
    start_ns: int,
    end_ns: int,
    asset: str | None = None,
    channel: str | None = None,
    order: str = "received",
) -> DataFrame:
    """Closed range on arrival time with optional equality filters; ties break on capture_id."""
    if start_ns > end_ns:
        raise ValueError("start must not be after end")
    if order not in ("received", "provider"):
        raise ValueError("order must be 'received' or 'provider'")
    out = in_received_range(facts, start_ns, end_ns, closed=True)
    if asset is not None:
        out = out.where(F.col("asset") == asset)
    if channel is not None:
        out = out.where(F.col("channel") == channel)
    return out.orderBy(F.col(f"{order}_ns").asc_nulls_first(), "capture_id")


# ------------------------------------------------------------------------------------ row rules


def fact_reject_reason(with_payload: bool = True) -> Column:
    """``with_payload=False`` leaves the wide column unread; writers check it before storing."""
    no_payload = F.col("payload").isNull() if with_payload else F.lit(False)
    return X.first_failure(
        (X.blank(F.col("capture_id")), "blank_capture_id"),
        (X.blank(F.col("source_id")), "blank_source_id"),
        (X.blank(F.col("message_type")), "blank_message_type"),
        (~X.in_set(F.col("asset"), S.ASSETS), "non_canonical_asset"),
        (
            F.col("provider").isNull() | F.col("channel").isNull() | F.col("schema_version").isNull(),
            "missing_text",
        ),
        (no_payload, "missing_payload"),
        (F.col("sid").isNull(), "missing_sid"),
        (F.col("received_ns").isNull(), "missing_received_time"),
    )


def decision_reject_reason() -> Column:
    """Over the stored form: contributors as JSON text, identity as four columns."""
    identity = [F.col(f"event_{c}") for c in S.IDENTITY_COLUMNS]
    present = sum((c.isNotNull().cast("int") for c in identity), F.lit(0))
    ids = parse_string_list(F.col("contributing_capture_ids"))
    return X.first_failure(
        (F.col("policy_version").isNull() | F.col("subject_capture_id").isNull(), "missing_key"),
        (~X.in_set(F.col("category"), S.CATEGORIES), "unknown_category"),
        (
            F.col("reason").isNotNull() & ~X.in_set(F.col("reason"), S.NOT_ACCEPTED_REASONS),
            "unknown_reason",
        ),
        (ids.isNull(), "bad_contributors"),
        (~present.isin(0, 4), "partial_identity"),
    )


def parse_string_list(text: Column) -> Column:
    """``array<string>`` of a JSON list whose members are all strings, else null."""
    parsed = F.try_parse_json(text)
    members = F.try_variant_get(parsed, "$", "array<variant>")
    strings = F.forall(members, lambda v: F.schema_of_variant(v) == "STRING")
    return F.when(strings, F.try_variant_get(parsed, "$", "array<string>"))


def marker_reject_reason() -> Column:
    kind, policy = F.col("kind"), F.col("policy_version")
    return X.first_failure(
        (~X.in_set(kind, S.MARKER_KINDS), "unknown_kind"),
        (X.blank(F.col("capture_id")), "blank_capture_id"),
        ((kind == "evidence") & policy.isNotNull(), "evidence_with_policy"),
        ((kind == "authority") & X.blank(policy), "authority_without_policy"),
        (F.coalesce(F.col("available_at_ns") < 0, F.lit(True)), "bad_time"),
        (
            F.coalesce(F.col("proof_schema_version") != S.PROOF_SCHEMA, F.lit(True)),
            "unsupported_proof",
        ),
        (X.blank(F.col("source_authority_identity")), "blank_authority"),
    )


REJECT_REASON = {
    "capture_fact": fact_reject_reason,
    "truth_decision": decision_reject_reason,
    "availability": marker_reject_reason,
}


def validate_rows(df: DataFrame, table: str) -> DataFrame:
    """Adds ``reject_reason``: null for a row that meets the contract of its table."""
    return df.withColumn("reject_reason", REJECT_REASON[table]())


def split_valid(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    checked = validate_rows(df, table)
    return (
        checked.where("reject_reason IS NULL").drop("reject_reason"),
        checked.where("reject_reason IS NOT NULL"),
    )


# ------------------------------------------------------------------------------------- contract


#: Columns of the layout on disk, which are no part of a table's contract.
LAYOUT_COLUMNS = ("received_date", "batch_id")


def schema_differences(df: DataFrame, table: str, contract: T.StructType | None = None) -> list[tuple[str, str, str]]:
    """Driver-side comparison of two schemas (a handful of columns, no data)."""
    declared = {f.name: f.dataType for f in (contract or S.TABLES[table]).fields}
    actual = {f.name: f.dataType for f in df.schema.fields if f.name not in LAYOUT_COLUMNS}
    out = [(table, f"missing_column:{n}", "schema") for n in declared if n not in actual]
    out += [(table, f"extra_column:{n}", "schema") for n in actual if n not in declared]
    out += [
        (table, f"wrong_type:{n}", "schema")
        for n in declared
        if n in actual and actual[n].simpleString() != declared[n].simpleString()
    ]
    return out


def require_contract(df: DataFrame, table: str, contract: T.StructType) -> None:
    """The gate of a strict read: exact columns and types, or the source is not available."""
    found = schema_differences(df, table, contract)
    if found:
        raise S.ContractError("SOURCE_UNAVAILABLE", ", ".join(f"{name}: {finding}" for name, finding, _ in found))


def check_table_contract(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One report over all tables: schema differences, then rejected rows per rule."""
    reports = []
    differences: list[tuple[str, str, str]] = []
    for name, df in tables.items():
        found = schema_differences(df, name)
        differences += found
        if not found:
            reports.append(
                validate_rows(df, name)
                .where("reject_reason IS NOT NULL")
                .groupBy("reject_reason")
                .agg(F.count(F.lit(1)).alias("n"))
                .select(
                    F.lit(name).alias("table_name"),
                    F.col("reject_reason").alias("finding"),
                    F.lit("rows").alias("scope"),
                    "n",
                )
            )
    report = spark.createDataFrame(
        [(*d, 1) for d in differences],
        "table_name string, finding string, scope string, n bigint",
    )
    for r in reports:
        report = report.unionByName(r)
    return report


def evolve_capture_schema(df: DataFrame) -> DataFrame:
    """Adds the three columns an older table may lack, as null; any other gap is an error."""
    missing = [c for c in S.FACT_COLUMNS if c not in df.columns]
    refused = [c for c in missing if c not in S.EVOLVABLE_FACT_COLUMNS]
    if refused:
        raise S.ContractError("SOURCE_UNAVAILABLE", f"missing required columns {refused}")
    for c in missing:
        df = df.withColumn(c, F.lit(None).cast("string"))
    return df.select(*S.FACT_COLUMNS)
