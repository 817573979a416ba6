"""Running the checks and summing them up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from regchron.functions.checks import CHECKS, CRITICAL, INFO, WARNING, Subject
from regchron.operators.lookup import lookup_join
from regchron.schema import KEY, RECORD_SCHEMA

_SEVERITY_ORDER = (INFO, WARNING, CRITICAL)


def complete_records(records: DataFrame) -> DataFrame:
    """Business records with all optional columns; those not delivered are NULL."""
    have = set(records.columns)
    return records.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in RECORD_SCHEMA if f.name not in have}
    )


def run_checks(
    records: DataFrame,
    reference: DataFrame,
    as_of: date,
    checked_at: datetime | None = None,
    checks: Mapping[str, Callable[[Subject], Column]] | Sequence[str] | None = None,
    key: str = KEY,
    salted: bool | None = None,
    rows_per_salt: int = 1_000_000,
    reduce: bool | None = None,
    **parameters,
) -> DataFrame:
    """One result row per record and check.

    One join for all checks and one inline of five structs; there is no shuffle besides that of
    the join. ``reference`` has one row per key (as the current view has by construction). A
    key of 0 counts as missing. ``parameters`` go to :class:`Subject`.
    """
    if checks is None:
        checks = CHECKS
    elif not isinstance(checks, Mapping):
        checks = {name: CHECKS[name] for name in checks}
    mine = complete_records(records)
    lookup = mine.withColumn("_lookup", F.nullif(F.col(key), F.lit(0)))
    theirs = reference.select(*[F.col(c).alias(f"_ref_{c}") for c in reference.columns])
    paired = lookup_join(lookup, theirs, "_lookup", f"_ref_{key}", rows_per_salt, salted, reduce)
    subject = Subject(
        record=F.col,
        reference=lambda name: F.col(f"_ref_{name}"),
        found=F.col(f"_ref_{key}").isNotNull(),
        as_of=as_of,
        **parameters,
    )
    # The structs are computed in a projection of their own, where shared parts of them are
    # evaluated once, and only then unfolded. The outer form, as for the plain one Spark infers
    # a filter on the array's size, for which it would compute all checks a second time.
    results = paired.select(
        F.col(key), F.array(*[check(subject) for check in checks.values()]).alias("_results")
    ).select(key, F.inline_outer("_results"))
    stamp = F.lit((checked_at or datetime.combine(as_of, datetime.min.time())).isoformat())
    return results.select(
        "check_id", "check_name", key, "passed", "severity", "detail", "expected", "actual",
        stamp.alias("checked_at"),
    )


def with_status(results: DataFrame) -> DataFrame:
    """Results with the derived PASS/FAIL text."""
    return results.withColumn("status", F.when(F.col("passed"), "PASS").otherwise("FAIL"))


def pass_rate(passed: Column, total: Column) -> Column:
    """Percentage with one decimal, 0.0 if there is nothing to count."""
    return F.when(total > 0, F.round(passed / total * 100, 1)).otherwise(F.lit(0.0))


def tally(results: DataFrame) -> DataFrame:
    """The results counted as ``n`` by what the reports tell apart: a few rows per check."""
    return results.groupBy("check_id", "check_name", "severity", "passed").agg(F.count("*").alias("n"))


def _counted(condition: Column, weight: str | None) -> Column:
    """Aggregate: rows that meet a condition, each counted once or ``weight`` times."""
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0).cast("bigint"))


def report(
    results: DataFrame,
    source_system: str = "unknown",
    run_id: str | None = None,
    started_at: datetime | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Totals over all results, or over their tally with ``weight="n"``: always one row."""
    failed = ~F.col("passed")
    totals = results.agg(
        _counted(F.lit(True), weight).alias("total_checks"),
        _counted(F.col("passed"), weight).alias("passed"),
        _counted(failed, weight).alias("failed"),
        _counted(failed & (F.col("severity") == CRITICAL), weight).alias("critical_fails"),
    )
    return totals.select(
        F.lit(source_system).alias("source_system"),
        F.lit(run_id).cast("string").alias("run_id"),
        "total_checks",
        "passed",
        "failed",
        "critical_fails",
        pass_rate(F.col("passed"), F.col("total_checks")).alias("pass_rate"),
        F.lit(started_at.isoformat() if started_at else None).cast("string").alias("started_at"),
    )


def report_by_check(results: DataFrame, weight: str | None = None) -> DataFrame:
    """Passes and failures per check and name, with the most severe level among them.

    ``results`` may also be their tally, with ``weight="n"``.
    """
    rank = F.array_position(F.array(*map(F.lit, _SEVERITY_ORDER)), F.col("severity"))
    label = F.concat(F.lit("["), F.col("check_id"), F.lit("] "), F.col("check_name"))
    counted = results.groupBy(label.alias("check")).agg(
        _counted(F.col("passed"), weight).alias("passed"),
        _counted(~F.col("passed"), weight).alias("failed"),
        F.max(rank).cast("int").alias("_rank"),
    )
    severity = F.try_element_at(F.array(*map(F.lit, _SEVERITY_ORDER)), F.nullif(F.col("_rank"), F.lit(0)))
    return counted.select("check", "passed", "failed", severity.alias("severity"))
