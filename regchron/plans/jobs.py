"""The jobs a user starts. Each is a short composition; the driver only starts Spark jobs and
reads counts.

``base`` is a folder that holds the tables ``bronze`` (log of the batch jobs), ``bronze_bulk``
(log of the bulk loader), ``runs`` (one row per load), ``silver`` (history) and ``watermark``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regchron.functions.columns import utc
from regchron.functions.lineage import new_run_id, stamp_lineage
from regchron.operators.quality import report, report_by_check, run_checks, tally
from regchron.operators.replay import scd2_replay
from regchron.operators.staging import build_staging, carry_forward, newest_state
from regchron.operators.watermark import (
    advance_watermarks,
    canton_marks,
    canton_source,
    changed_since,
    changed_since_marks,
    greatest_date,
    in_cantons,
    max_mutation,
    read_watermark,
)
from regchron.plans import gold, profile
from regchron.schema import (
    CANTONS,
    HASH_COLUMNS,
    KEY,
    REGISTRY_COLUMNS,
    RUN_SCHEMA,
    SKIPPED_SCHEMA,
    WATERMARK_SCHEMA,
    WATERMARK_SOURCE,
    bulk_columns,
)
from regchron.sources.delimited import canton_paths, read_records_csv, read_registry_tsv, sound_parts
from regchron.sources.store import HistoryStore
from regchron.sources.tables import ensure_tables, path_exists, publish_run, read_bronze, write_table
from regchron.sources.xml import read_registry_xml, read_response_files
from regchron.streaming.load_once import Run, load_files_once


def open_bronze(spark: SparkSession, base: str) -> DataFrame:
    """The logs of the batch jobs and of the bulk loader as one."""
    return read_bronze(spark, f"{base}/bronze", f"{base}/bronze_bulk")


def open_history(spark: SparkSession, base: str) -> HistoryStore:
    """The history table."""
    return HistoryStore(spark, f"{base}/silver")


def open_watermark(spark: SparkSession, base: str) -> DataFrame:
    """The watermark log."""
    return spark.read.schema(WATERMARK_SCHEMA).parquet(f"{base}/watermark")


class Load(NamedTuple):
    """A load of the log: when, from where, the cantons it holds in full, the columns it fills.

    ``records`` and ``keyed`` count its rows and those with a key, where that is known.
    """

    run_id: str
    loaded_at: datetime
    source: str | None
    full_load: bool
    cantons: tuple[str, ...]
    columns: tuple[str, ...]
    records: int | None = None
    keyed: int | None = None


def _canton_names(cantons: str | Sequence[str]) -> list[str]:
    if isinstance(cantons, str):
        cantons = CANTONS if cantons.lower() == "all" else [cantons]
    return [c.lower() for c in cantons]


_LOGS = ("bronze", "bronze_bulk")
_CODES = [c.upper() for c in CANTONS]


def known_cantons() -> Column:
    """Aggregate: cantons among the rows, of a fixed set of codes, so that unclean values cannot add up."""
    return F.collect_set(F.when(F.col("gdekt").isin(_CODES), F.col("gdekt")))


def _note_run(spark: SparkSession, base: str, load: Load, done: bool) -> None:
    row = (
        load.run_id, utc(load.loaded_at).isoformat(), load.source, load.full_load,
        ",".join(sorted(load.cantons)), ",".join(load.columns), load.records, load.keyed, done,
    )
    write_table(spark.createDataFrame([row], RUN_SCHEMA).coalesce(1), f"{base}/runs")


def run_notes(spark: SparkSession, base: str) -> DataFrame:
    """One row per run: the note that it is done, or else the one that it was begun."""
    if not path_exists(spark, f"{base}/runs"):
        return spark.createDataFrame([], RUN_SCHEMA)
    rows = spark.read.schema(RUN_SCHEMA).parquet(f"{base}/runs")
    rows = rows.withColumn("done", F.coalesce("done", F.lit(True)))
    values = F.struct(*[c for c in rows.columns if c != "run_id"])
    return rows.groupBy("run_id").agg(F.max_by(values, F.col("done").cast("int")).alias("note")).select("run_id", "note.*")


def _loads(notes: DataFrame) -> list[Load]:
    """Notes as loads, oldest first."""
    loads = [
        Load(
            r["run_id"], datetime.fromisoformat(r["loaded_at"]), r["source"], r["full_load"],
            tuple(filter(None, (r["cantons"] or "").split(","))), tuple(r["columns"].split(",")),
            r["records"], r["keyed"],
        )
        for r in notes.collect()
    ]
    return sorted(loads, key=lambda x: (x.loaded_at, x.run_id))


def reconcile_runs(spark: SparkSession, base: str) -> list[str]:
    """Finish the notes of runs that were published, but whose job died before it noted that.

    A run is published as one partition of a log, so if the partition is there the run is whole.
    A run without it was only begun: its rows come with the next load.
    """
    begun = _loads(run_notes(spark, base).filter(~F.col("done")))
    found = []
    for load in begun:
        day = load.loaded_at.date().isoformat()
        logs = [f"{base}/{log}" for log in _LOGS]
        there = [x for x in logs if path_exists(spark, f"{x}/_ingestion_date={day}/_run_id={load.run_id}")]
        if there:
            rows = read_bronze(spark, *there).filter(F.col("_run_id") == load.run_id)
            seen = rows.agg(F.count("*").alias("n"), F.count(KEY).alias("keyed"), known_cantons().alias("c")).first()
            cantons = tuple(set(seen["c"]) - set(load.cantons)) if load.full_load else ()
            _note_run(spark, base, load._replace(cantons=cantons, records=seen["n"], keyed=seen["keyed"]), True)
            found.append(load.run_id)
    return found


def _unnoted_loads(spark: SparkSession, base: str) -> list[Load]:
    """Loads of a log that was put there without notes; they count as filling all columns."""
    log = open_bronze(spark, base)
    known = F.when(F.col("gdekt").isin(_CODES), F.col("gdekt"))
    found = log.groupBy("_run_id", "_ingested_at", "_source", "_is_full_load", known.alias("gdekt")).count()
    loads: dict[str, Load] = {}
    for r in found.collect():
        at = datetime.fromisoformat(r["_ingested_at"])
        old = loads.get(r["_run_id"], Load(r["_run_id"], at, r["_source"], False, (), tuple(REGISTRY_COLUMNS)))
        new = (r["gdekt"],) if r["_is_full_load"] and r["gdekt"] else ()
        loads[r["_run_id"]] = old._replace(
            loaded_at=max(at, old.loaded_at),
            full_load=old.full_load or bool(r["_is_full_load"]),
            cantons=tuple(sorted({*old.cantons, *new})),
        )
    return sorted(loads.values(), key=lambda x: (x.loaded_at, x.run_id))


def open_runs(spark: SparkSession, base: str) -> list[Load]:
    """All loads, oldest first, from the small table of notes; unfinished notes are finished first.

    A log that was put there in another way has none; its loads are listed from the log, by
    canton.
    """
    if not path_exists(spark, f"{base}/runs"):
        return _unnoted_loads(spark, base)
    reconcile_runs(spark, base)
    return _loads(run_notes(spark, base).filter("done"))


def pending_runs(spark: SparkSession, base: str) -> list[Load]:
    """The loads that the history does not hold yet, oldest first."""
    merged = open_history(spark, base).merged_runs()
    if not path_exists(spark, f"{base}/runs"):
        done = {r["run_id"] for r in merged.collect()}
        return [load for load in _unnoted_loads(spark, base) if load.run_id not in done]
    reconcile_runs(spark, base)
    return _loads(run_notes(spark, base).filter("done").join(merged, "run_id", "left_anti"))


def _find_run(spark: SparkSession, base: str, run_id: str) -> Load | None:
    if not path_exists(spark, f"{base}/runs"):
        return next((x for x in _unnoted_loads(spark, base) if x.run_id == run_id), None)
    return next(iter(_loads(run_notes(spark, base).filter(F.col("run_id") == run_id))), None)


def bronze_ingest(
    spark: SparkSession,
    base: str,
    rows: DataFrame | Callable[[str | None], DataFrame],
    now: datetime,
    source: str = "gwr_api",
    full_load: bool = False,
    cantons: str | list[str] | None = None,
    dry_run: bool = False,
    buffer_days: int = 1,
    run_id: str | None = None,
    batch_size: int = 1000,
    move_watermark: bool = True,
    skip_unreadable: bool = False,
    marks: str = "source",
    not_held: Sequence[str] = (),
) -> dict:
    """Append the registry rows that changed since the watermark, and move the watermark.

    ``rows`` may be a function that makes them from the mark, for a source that can leave out older
    documents before it parses them; it gets ``None`` if all rows are wanted or each canton has its own mark.

    A full load takes all rows. The new mark is the greatest mutation date written less
    ``buffer_days``, so that the last, possibly incomplete day is read again; it moves only
    forward and only if rows were written. With one mark per source (``marks="source"``) a load
    of some ``cantons`` leaves it where it is, as the other cantons' changes up to that day are
    still to come. With ``marks="canton"`` each canton has a mark of its own, which any load of
    its rows moves; a canton without one goes by the source's mark.

    ``not_held`` names cantons that a full load does not hold in full, whatever rows it has of them.

    The run is noted as begun before its rows are published, as one partition of the log, and as
    done after that. A job that dies in between loses nothing: see ``reconcile_runs``.
    """
    if marks not in ("source", "canton"):
        raise ValueError(f"marks is source or canton, not {marks}")
    began = time.monotonic()
    run_id = run_id or new_run_id()
    ensure_tables(spark, base)
    log = open_watermark(spark, base)
    since = None if full_load else read_watermark(log)
    if callable(rows):
        rows = rows(since if marks == "source" else None)
    if full_load or marks == "source":
        changed = changed_since(rows, since)
    else:
        changed = changed_since_marks(rows, canton_marks(log), since)
    wanted = in_cantons(changed, cantons)
    stamped = stamp_lineage(wanted, run_id, now, source, full_load, batch_size, mark_batches="_starts_batch")
    if dry_run:
        counted = stamped.agg(F.count("*").alias("written"), F.count_if("_starts_batch").alias("batches")).first().asDict()
    else:
        filled = tuple(c for c in REGISTRY_COLUMNS if c in rows.columns)
        # Until it is done, a note lists the cantons that the load will not hold.
        load = Load(run_id, utc(now), source, full_load, tuple(c.upper() for c in not_held), filled)
        _note_run(spark, base, load, done=False)
        measures = [
            F.count_if("_starts_batch").alias("batches"),
            known_cantons().alias("cantons"),
            greatest_date("gdat", skip_unreadable).alias("newest"),
        ]
        by_canton = {c: f"newest_{c}" for c in _CODES} if marks == "canton" else {}
        for code, name in by_canton.items():
            own = F.when(F.col("gdekt") == code, F.col("gdat"))
            measures.append(greatest_date(own, skip_unreadable).alias(name))
        counted = publish_run(stamped, f"{base}/bronze", measures, ["_starts_batch"])
        if counted["written"]:
            held = set(counted["cantons"]) - {c.upper() for c in not_held} if full_load else set()
            load = load._replace(cantons=tuple(held), records=counted["written"], keyed=counted["keyed"])
            _note_run(spark, base, load, done=True)
            newest = {c: counted[name] for c, name in by_canton.items() if counted[name]}
            sources = {canton_source(c): date for c, date in newest.items()} if move_watermark else {}
            if move_watermark and not cantons:
                sources[WATERMARK_SOURCE] = counted["newest"]
            move_marks(spark, base, sources, now, buffer_days)
    # The names that the result of a load has.
    return {
        "run_id": run_id,
        "since_date": since,
        "total_written": counted["written"],
        "batch_count": counted["batches"],
        "elapsed_s": round(time.monotonic() - began, 1),
        "dry_run": dry_run,
    }


def move_marks(spark: SparkSession, base: str, newest: dict[str, str | None], now: datetime, buffer_days: int = 1) -> None:
    """Move the mark of each source to its greatest mutation date less the buffer, forward only."""
    if newest:
        found = spark.createDataFrame(list(newest.items()), "source string, gdat string")
        rows = advance_watermarks(open_watermark(spark, base), found, now, buffer_days).collect()
        if rows:
            write_table(spark.createDataFrame(rows, WATERMARK_SCHEMA).coalesce(1), f"{base}/watermark")


def bronze_from_responses(
    spark: SparkSession,
    base: str,
    paths: str | list[str],
    now: datetime,
    by_line: bool = False,
    **options,
) -> dict:
    """Ingest landed XML responses, one per file or one per line."""

    def rows(newer_than: str | None) -> DataFrame:
        return read_registry_xml(read_response_files(spark, paths, by_line), newer_than=newer_than)

    return bronze_ingest(spark, base, rows, now, source="gwr_api", **options)


def bronze_from_tsv(
    spark: SparkSession,
    base: str,
    extracts: str,
    now: datetime,
    cantons: str | Sequence[str] = "all",
    layout: str = "{canton}",
    **options,
) -> dict:
    """Ingest the full extract of one canton, several, or all.

    A canton whose extract is missing or damaged is left out as a whole and listed in the table
    ``skipped``; the load does not count as holding it, so nothing of it is closed. Extracts leave
    the watermark of the incremental loads alone: none can be sure to hold everything up to
    its newest date.
    """
    names = _canton_names(cantons)
    paths = dict(zip(canton_paths(extracts, names, layout), names, strict=True))
    parts, skipped = sound_parts(spark, list(paths))
    if not parts:
        raise FileNotFoundError(f"none of the extracts could be read: {skipped}")
    options = {"source": "gwr_zip", "full_load": True, "move_watermark": False, "run_id": new_run_id()} | options
    rows = read_registry_tsv(spark, parts)
    out = bronze_ingest(spark, base, rows, now, not_held=[paths[p] for p in skipped], **options)
    if skipped and not out["dry_run"]:
        listed = [(out["run_id"], part, reason, utc(now)) for part, reason in sorted(skipped.items())]
        write_table(spark.createDataFrame(listed, SKIPPED_SCHEMA).coalesce(1), f"{base}/skipped")
    return out | {"skipped": {paths[p].upper(): reason for p, reason in skipped.items()}}


def open_skipped(spark: SparkSession, base: str) -> DataFrame:
    """Parts of extracts that were left out, by run, with what was wrong with them."""
    if not path_exists(spark, f"{base}/skipped"):
        return spark.createDataFrame([], SKIPPED_SCHEMA)
    return spark.read.schema(SKIPPED_SCHEMA).parquet(f"{base}/skipped")


def bronze_bulk(
    spark: SparkSession,
    base: str,
    extracts: str,
    now: datetime,
    canton: str,
    layout: str = "{canton}",
    merge: bool = False,
    on_step: Callable[[str, str], None] | None = None,
    **options,
) -> dict:
    """Bulk load of a canton's extract files that were not loaded before.

    Such a load is partial; ``full_load=True`` says that the new files are the whole canton. The
    files found are one run: begun, published, noted and, with ``merge``, merged into the
    history, each step exactly once even if the job dies on the way and is started again.
    """
    began = time.monotonic()
    name = canton.lower()
    src = canton_paths(extracts, name, layout)[0]
    full, source = options.get("full_load", False), options.get("source", "gwr_zip")
    filled = tuple(options.get("names") or bulk_columns())

    def note_of(run: Run) -> Load:
        held = tuple(run.counts.get("cantons", ())) if full else ()
        counts = (run.counts.get("written"), run.counts.get("keyed"))
        return Load(run.run_id, run.loaded_at, source, full, held, filled, *counts)

    def begin(run: Run) -> None:
        if _find_run(spark, base, run.run_id) is None:
            _note_run(spark, base, note_of(run), done=False)

    def note(run: Run) -> None:
        if run.records:
            _note_run(spark, base, note_of(run), done=True)

    def merge_run(run: Run) -> None:
        if run.records:
            silver_pending(spark, base, utc(now), only=run.run_id)

    loaded = load_files_once(
        spark, src, f"{base}/bronze_bulk", f"{base}/checkpoints/bulk-{name}", now,
        measures=[known_cantons().alias("cantons")], begin=begin, note=note, on_step=on_step or (lambda step, run_id: None),
        **({"merge": merge_run} if merge else {}), **options,
    )
    return loaded | {"kanton": name.upper(), "elapsed_s": round(time.monotonic() - began, 1)}


def silver(
    spark: SparkSession,
    base: str,
    now: datetime,
    run_id: str,
    delete_scope: str | None = "auto",
    compare: Sequence[str] | None = None,
    tie_break: Sequence[Column] | None = None,
    load: Load | None = None,
) -> dict:
    """Merge one run of the log into the history.

    ``delete_scope`` decides what a key's absence means: ``"all"`` closes every current row
    that was not staged, ``"none"`` closes nothing, and a condition such as
    ``"gdekt in ('AG','ZH')"`` limits it. ``"auto"`` closes, after a full load, within the
    cantons that were loaded, and after an incremental load nothing. Several states of a key in
    the run are decided by ``tie_break``, by default the latest mutation. Columns that the
    run's source does not fill keep the values the history has.
    """
    began = time.monotonic()
    loaded = open_bronze(spark, base).filter(F.col("_run_id") == run_id)
    rows = loaded.filter(F.col(KEY).isNotNull())
    if load is None:
        load = _find_run(spark, base, run_id)
    if delete_scope == "auto":
        delete_scope = _in_cantons(load.cantons if load and load.full_load else ())
    # Counted when the run was written; else from the footers of its files.
    records = load.records if load and load.records is not None else loaded.count()
    empty = load.keyed == 0 if load and load.keyed is not None else rows.isEmpty()
    store = open_history(spark, base)
    touched = store.touched(rows, records)
    staging = build_staging(rows, tie_break=newest_state() if tie_break is None else tie_break)
    staging = store.dealt(staging)
    if load is not None:
        staging = carry_forward(staging, store.current(touched), load.columns)
    counts = store.merge(
        staging,
        now,
        delete_scope,
        compare,
        staging_empty=empty,
        staging_rows=records,
        run_id=run_id,
        touched=touched,
        dealt=True,
    )
    return counts | {"run_id": run_id, "elapsed_s": round(time.monotonic() - began, 1)}


def silver_pending(spark: SparkSession, base: str, now: datetime, only: str | None = None, **options) -> list[dict]:
    """Merge all runs that are in the log and not in the history yet, oldest first.

    The last one is merged as of ``now``, those before as of their load, and each later than
    the one before. ``only`` names one of them.
    """
    head = open_history(spark, base).head()
    last = datetime.fromisoformat(head["now"]) if head else datetime.min
    pending = [load for load in pending_runs(spark, base) if only in (None, load.run_id)]
    merged = []
    for position, load in enumerate(pending):
        moment = utc(now) if position == len(pending) - 1 else load.loaded_at
        last = max(moment, last + timedelta(microseconds=1))
        merged.append(silver(spark, base, last, load.run_id, load=load, **options))
    return merged


def _in_cantons(names: Sequence[str]) -> str:
    """Deletion scope of the cantons a run holds in full, a few dozen codes at most."""
    if not names:
        return "none"
    quoted = ", ".join("'" + n.replace("'", "''") + "'" for n in names)
    return f"gdekt in ({quoted})"


def rebuild_history(
    spark: SparkSession,
    base: str,
    now: datetime,
    delete_missing: bool | None = None,
    tie_break: Sequence[Column] | None = None,
) -> None:
    """First build of the history from all runs of the log, in one pass.

    By default the history is the one that merging the runs in order gives: a key's absence
    counts in full loads and in the cantons they hold. ``delete_missing`` overrides this: every
    run counts as a full load of everything, or as none. If a run's source fills only some
    columns, a row depends on the versions before it, and the runs are merged one by one.
    """
    loads = open_runs(spark, base)
    if any(set(REGISTRY_COLUMNS) - set(load.columns) for load in loads):
        scope = {None: "auto", True: "all", False: "none"}[delete_missing]
        silver_pending(spark, base, now, delete_scope=scope, tie_break=tie_break)
        return
    order = newest_state() if tie_break is None else tie_break
    staged = build_staging(open_bronze(spark, base), hash_columns=HASH_COLUMNS, tie_break=order, per_run=True)
    scopes = None
    if delete_missing is None:
        scopes = {load.run_id: load.cantons if load.full_load else () for load in loads}
    history = scd2_replay(
        staged,
        [(load.run_id, load.loaded_at) for load in loads],
        columns=REGISTRY_COLUMNS,
        delete_missing=bool(delete_missing),
        scopes=scopes,
    )
    open_history(spark, base).replace(history, now, [load.run_id for load in loads])


def gold_views(spark: SparkSession, base: str) -> dict:
    """Publish the views and return the summary."""
    gold.publish_views(open_history(spark, base).read())
    return status(spark, base)


def status(spark: SparkSession, base: str) -> dict:
    """The summary as a dict, empty if there is nothing."""
    found = gold.summary(gold.current_view(open_history(spark, base).current())).first().asDict()
    return found if found["total_buildings"] else {}


def refresh(
    spark: SparkSession,
    base: str,
    rows: DataFrame | Callable[[str | None], DataFrame],
    now: datetime,
    tie_break: Sequence[Column] | None = None,
    **options,
) -> dict[str, dict]:
    """Ingest, merge that run, publish the views."""
    bronze = bronze_ingest(spark, base, rows, now, **options)
    merged = {}
    if not bronze["dry_run"] and bronze["total_written"]:
        merged = silver(spark, base, now, run_id=bronze["run_id"], tie_break=tie_break)
    return {"bronze": bronze, "silver": merged, "gold": gold_views(spark, base)}


def write_results(results: DataFrame, path: str) -> DataFrame:
    """Write all results as compressed JSON below ``path``, and return what was written."""
    results.write.mode("overwrite").json(f"{path}/results", compression="gzip")
    return results.sparkSession.read.schema(results.schema).json(f"{path}/results")


def write_totals(totals: DataFrame, path: str) -> DataFrame:
    """Write the totals as JSON below ``path``, and return what was written."""
    totals.write.mode("overwrite").json(f"{path}/summary")
    return totals.sparkSession.read.schema(totals.schema).json(f"{path}/summary")


def write_report(results: DataFrame, path: str, source_system: str, run_id: str, started_at: datetime) -> DataFrame:
    """Write all results and their totals as JSON below ``path``; returns the totals.

    The totals are taken from the written results, so the checks run once.
    """
    written = write_results(results, path)
    return write_totals(report(written, source_system, run_id, started_at), path)


def dqa(
    spark: SparkSession,
    base: str,
    records: str | DataFrame,
    as_of: date,
    output: str,
    source_system: str = "csv",
    run_id: str | None = None,
    started_at: datetime | None = None,
    **parameters,
) -> dict:
    """Check business records (a CSV path or a DataFrame) against the current view."""
    if isinstance(records, str):
        records = read_records_csv(spark, records)
    reference = gold.current_view(open_history(spark, base).current())
    results = run_checks(records, reference, as_of, checked_at=started_at, **parameters)
    run_id = run_id or new_run_id()
    started_at = started_at or datetime.combine(as_of, datetime.min.time())
    # The written results are read once; the totals and those by check follow from their few counts.
    counted = tally(write_results(results, output)).coalesce(1).cache()
    try:
        totals = write_totals(report(counted, source_system, run_id, started_at, weight="n"), output)
        by_check = report_by_check(counted, weight="n").orderBy("check").collect()
    finally:
        counted.unpersist()
    return totals.first().asDict() | {"by_check": [r.asDict() for r in by_check]}


def explore(spark: SparkSession, base: str, k: int | None = None) -> dict[str, DataFrame]:
    """The exploration reports, by name: whole, or the first ``k`` rows of each."""
    bronze, store = open_bronze(spark, base), open_history(spark, base)
    history = store.read()
    current = gold.current_view(store.current())
    desc = F.desc
    return {
        "runs": profile.top(profile.run_overview(bronze), [desc("_ingestion_date"), F.col("_run_id")], k),
        "latest_run": profile.top(profile.latest_run_counts(bronze), [desc("count"), F.col("gdekt")], k),
        "row_counts": profile.row_counts(history),
        "versions": profile.top(profile.version_counts(history), [desc("versionen"), F.col(KEY)], k),
        "status": profile.status_counts(current).orderBy("gstat"),
        "cantons": profile.top(profile.region_overview(current), [desc("gebaeude"), F.col("gdekt")], k),
        "mutation_years": profile.top(profile.mutation_years(current), [desc("mutation_jahr")], k),
        "transitions": profile.top(
            profile.transitions(history), [desc("anzahl"), F.col("prev_gstat"), F.col("gstat")], k
        ),
        "gaps": profile.null_profile(current),
    }


def max_gdat(spark: SparkSession, base: str, run_id: str) -> str | None:
    """Greatest mutation date a run brought."""
    return max_mutation(open_bronze(spark, base), run_id).first()["max_gdat"]
