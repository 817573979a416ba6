"""The history after many runs in one pass, instead of one merge per run.

Merging R runs one after the other reads and writes the current rows R times. When the log of
all runs is there already (first build, rebuild after a change of the hash columns), the same
history follows from the order of the runs within each key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from regchron.functions.columns import sql_timestamp
from regchron.schema import KEY, OPEN_END, REGISTRY_COLUMNS

Run = tuple[str, datetime]


def list_runs(bronze: DataFrame) -> list[Run]:
    """Run ids with their load time, oldest first: one row per run reaches the driver.

    All rows of a run carry the same time. They are made distinct first, as a greatest text per
    run would be found by sorting the log.
    """
    rows = (
        bronze.select("_run_id", "_ingested_at")
        .distinct()
        .groupBy("_run_id")
        .agg(F.max("_ingested_at").alias("at"))
        .orderBy("at", "_run_id")
        .collect()
    )
    return [(r["_run_id"], datetime.fromisoformat(r["at"])) for r in rows]


def run_calendar(spark: SparkSession, runs: Sequence[Run]) -> DataFrame:
    """Runs numbered in order, each with its own time and that of the next run."""
    following = [at for _, at in runs[1:]] + [None]
    rows = [
        (run_id, number, at.isoformat(sep=" "), after.isoformat(sep=" ") if after else None)
        for number, ((run_id, at), after) in enumerate(zip(runs, following))
    ]
    schema = T.StructType(
        [
            T.StructField("_run_id", T.StringType()),
            T.StructField("_run_no", T.LongType()),
            T.StructField("_now", T.StringType()),
            T.StructField("_next_now", T.StringType()),
        ]
    )
    return spark.createDataFrame(rows, schema).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("_now", "_next_now")}
    )


def scd2_replay(
    staged: DataFrame,
    runs: Sequence[Run],
    keys: Sequence[str] = (KEY,),
    columns: Sequence[str] = tuple(REGISTRY_COLUMNS),
    delete_missing: bool = True,
    scopes: Mapping[str, Sequence[str]] | None = None,
    region: str = "gdekt",
) -> DataFrame:
    """History after ``runs``, from the newest row per key and run (``record_hash`` included).

    Within a key, ordered by run, a version begins where there is no row before, where the
    fingerprint differs from the row before, or (``delete_missing``) where the key was absent in
    the run before. It ends where the next version begins or where the key is first absent.
    All windows share one partitioning and order, so the rows are shuffled and sorted once, and
    a key has at most one row per run. The run calendar comes from a list on the driver, which
    bounds what is broadcast.

    With ``scopes`` absence counts as it does when the runs are merged one by one: run id ->
    the values of ``region`` which that run loaded in full; other runs delete nothing.
    """
    if scopes is not None:
        return _replay_scoped(staged, runs, scopes, keys, columns, region)
    calendar = F.broadcast(run_calendar(staged.sparkSession, runs))
    key_order = Window.partitionBy(*keys).orderBy("_run_no")
    rows = staged.select(*columns, "record_hash", "_run_id").join(calendar, "_run_id")

    marked = rows.withColumns(
        {
            "_hash_before": F.lag("record_hash").over(key_order),
            "_hash_after": F.lead("record_hash").over(key_order),
            "_run_before": F.lag("_run_no").over(key_order),
            "_run_after": F.lead("_run_no").over(key_order),
        }
    )
    gap_before = gap_after = "false"
    if delete_missing:
        gap_before = "_run_before != _run_no - 1"
        gap_after = "coalesce(_run_after != _run_no + 1, true)"
    edges = marked.selectExpr(
        "*",
        f"_run_before is null or _hash_before != record_hash or {gap_before} as _begins",
        f"_run_after is null or _hash_after != record_hash or {gap_after} as _ends",
        f"{gap_after} and _next_now is not null as _gone",
    ).filter("_begins or _ends")

    # After the filter the row behind a beginning is its end, unless it is its own end. A
    # version ends at the run behind its last row; without deletions that is the run in which
    # the next version begins.
    next_begin = F.lead("_now").over(key_order)
    end_next_now = F.when(F.col("_ends"), F.col("_next_now")).otherwise(
        F.lead("_next_now").over(key_order)
    )
    end_gone = F.when(F.col("_ends"), F.col("_gone")).otherwise(F.lead("_gone").over(key_order))
    if delete_missing:
        end = end_next_now
    else:
        end = F.when(F.col("_ends"), next_begin).otherwise(F.lead("_now", 2).over(key_order))
    spans = edges.withColumns({"_end": end, "_deleted": end_gone}).filter("_begins")

    data = [f"`{c}`" for c in columns]
    return spans.selectExpr(
        *data,
        "_now as valid_from",
        f"coalesce(_end, {sql_timestamp(OPEN_END)}) as valid_to",
        "_end is null as is_current",
        "record_hash",
        "_end is not null and _deleted as dqa_deleted",
        "coalesce(_end, _now) as _silver_loaded",
    )


def _replay_scoped(
    staged: DataFrame,
    runs: Sequence[Run],
    scopes: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    columns: Sequence[str],
    region: str,
) -> DataFrame:
    """The replay with a deletion scope per run.

    A row is gone at the first later run that loaded its region in full, if the key is not back
    by then. What is broadcast has one row per run and one per region.
    """
    spark = staged.sparkSession
    calendar = run_calendar(spark, runs)
    full: dict[str, list[int]] = {}
    for number, (run_id, _) in enumerate(runs):
        for name in scopes.get(run_id, ()):
            full.setdefault(name, []).append(number)
    loads = spark.createDataFrame(list(full.items()), "_region string, _full array<bigint>")
    key_order = Window.partitionBy(*keys).orderBy("_run_no")
    rows = (
        staged.select(*columns, "record_hash", "_run_id")
        .join(F.broadcast(calendar.select("_run_id", "_run_no", "_now")), "_run_id")
        .join(F.broadcast(loads), F.col(region) == F.col("_region"), "left")
        .withColumn("_gone_no", F.array_min(F.filter("_full", lambda n: n > F.col("_run_no"))))
        .withColumns(
            {
                "_run_after": F.lead("_run_no").over(key_order),
                "_now_after": F.lead("_now").over(key_order),
                "_hash_after": F.lead("record_hash").over(key_order),
                "_hash_before": F.lag("record_hash").over(key_order),
            }
        )
        .withColumn(
            "_gone",
            F.expr("_gone_no is not null and (_run_after is null or _gone_no < _run_after)"),
        )
        .withColumn("_gone_before", F.lag("_gone").over(key_order))
    )
    edges = rows.selectExpr(
        "*",
        "_hash_before is null or _hash_before != record_hash or _gone_before as _begins",
        "_run_after is null or _hash_after != record_hash or _gone as _ends",
    ).filter("_begins or _ends")
    # Behind a beginning that is not its own end stands its end.
    at_end = {
        c: F.when(F.col("_ends"), F.col(c)).otherwise(F.lead(c).over(key_order))
        for c in ("_gone", "_gone_no", "_now_after")
    }
    gone_at = calendar.select(F.col("_run_no").alias("_no"), F.col("_now").alias("_gone_at"))
    spans = (
        edges.select("*", *[v.alias(f"_end{c}") for c, v in at_end.items()])
        .filter("_begins")
        .join(F.broadcast(gone_at), F.col("_end_gone_no") == F.col("_no"), "left")
        .withColumn("_end", F.expr("if(_end_gone, _gone_at, _end_now_after)"))
    )
    return spans.selectExpr(
        *[f"`{c}`" for c in columns],
        "_now as valid_from",
        f"coalesce(_end, {sql_timestamp(OPEN_END)}) as valid_to",
        "_end is null as is_current",
        "record_hash",
        "_end_gone as dqa_deleted",
        "coalesce(_end, _now) as _silver_loaded",
    )
