"""Column expressions shared by the operators: canonical JSON, digests, time and payload access."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import schemas as S

# ---------------------------------------------------------------------------------------- JSON


def canonical_json(fields: Mapping[str, Column]) -> Column:
    """JSON text with keys in code-point order, no spaces, explicit nulls."""
    ordered = [fields[name].alias(name) for name in sorted(fields)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def digest(fields: Mapping[str, Column]) -> Column:
    """SHA-256 of the canonical JSON."""
    return F.sha2(canonical_json(fields), 256)


DIGEST_WORDS = 16


def with_words(df: DataFrame, **texts: Column) -> DataFrame:
    """Adds, per named text, the sixteen 16-bit words of its SHA-256 (null for a null text)."""
    hashed = df.withColumns({f"__{name}": F.sha2(text, 256) for name, text in texts.items()})
    words = {
        f"{name}{i}": F.conv(F.substring(f"__{name}", 1 + 4 * i, 4), 16, 10).cast("bigint")
        for name in texts
        for i in range(DIGEST_WORDS)
    }
    return hashed.withColumns(words).drop(*[f"__{name}" for name in texts])


def set_digest(name: str) -> list[Column]:
    """Aggregates over the words of ``with_words`` that identify a *set* of texts.

    The words are added up, so the result does not depend on order or partitioning and merges like
    any ``sum``: the digest of 10^12 rows is one map-side combined hash aggregate with sixteen
    numbers per task, and no group of rows ever meets in one place.  Sums stay exact up to 2^47 rows
    and an overflow raises.
    """
    zero = F.lit(0).cast("bigint")
    return [
        F.coalesce(F.sum(f"{name}{i}"), zero).alias(f"{name}{i}") for i in range(DIGEST_WORDS)
    ]


def set_digest_text(name: str = "w") -> Column:
    """The sums as one text, ready to be bound into an identity."""
    return F.concat_ws(".", *[F.col(f"{name}{i}").cast("string") for i in range(DIGEST_WORDS)])


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds the columns of a one-row aggregate as a scalar subquery."""
    value = one_row.select(F.struct("*").alias("__one")).scalar()
    return df.withColumn("__one", value).select(*df.columns, "__one.*")


# ---------------------------------------------------------------------------------------- time


def floor_div(value: Column, unit: int) -> Column:
    """Exact integer floor division; Spark's ``/`` would go through a double."""
    u = F.lit(unit).cast("bigint")
    return F.call_function("div", value - F.pmod(value, u), u)


def received_date(ns: Column) -> Column:
    """UTC date of an epoch-ns instant (the partition column of the fact table)."""
    return F.date_from_unix_date(floor_div(ns, S.NS_PER_DAY).cast("int"))


def ms_to_ns(ms: Column) -> Column:
    return ms.cast("bigint") * F.lit(S.NS_PER_MS).cast("bigint")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


ISO_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"


def delta_event_time(ts_ms: Column, ts: Column) -> Column:
    """``ts_ms`` first; else an ISO text that carries an offset; naive or absent text is null.

    A fraction of any length is cut to microseconds.
    """
    aware = F.regexp_replace(F.when(ts.rlike(ISO_WITH_OFFSET), ts), r"(\.\d{6})\d+", "$1")
    return F.coalesce(
        ms_to_ns(ts_ms),
        F.unix_micros(F.try_to_timestamp(aware)) * F.lit(S.NS_PER_US).cast("bigint"),
    )


def quarter_start_us(us: Column) -> Column:
    """Start of the UTC quarter hour that holds an epoch-µs instant."""
    return us - F.pmod(us, F.lit(S.QUARTER_HOUR_US).cast("bigint"))


def is_quarter_hour_window(open_ts: Column, close_ts: Column) -> Column:
    o, c = F.unix_micros(open_ts), F.unix_micros(close_ts)
    width = F.lit(S.QUARTER_HOUR_US).cast("bigint")
    return ((c - o) == width) & (F.pmod(o, width) == 0)


def predicted_ticker(series: Column, close_ts: Column) -> Column:
    """Candidate ticker of a ``KX...15M`` series, from the close time on the New York clock."""
    ny = F.from_utc_timestamp(close_ts, "America/New_York")
    stamp = F.upper(F.date_format(ny, "yyMMMddHHmm"))
    shaped = series.startswith("KX") & series.endswith("15M")
    return F.when(shaped, F.concat_ws("-", series, stamp, F.date_format(ny, "mm")))


# --------------------------------------------------------------------------------- vocabularies


def in_set(col: Column, values: Iterable[str]) -> Column:
    return F.coalesce(col.isin(*values), F.lit(False))


def blank(col: Column) -> Column:
    return F.coalesce(F.length(col) == 0, F.lit(True))


def first_failure(*checks: tuple[Column, str]) -> Column:
    """Name of the first check that holds, else null."""
    out: Column | None = None
    for condition, name in checks:
        out = F.when(condition, F.lit(name)) if out is None else out.when(condition, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")
