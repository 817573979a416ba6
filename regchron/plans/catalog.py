"""One query per operator of the inventory, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from regchron.functions import columns as C
from regchron.functions.lineage import stamp_lineage
from regchron.operators import history as H, quality as Q, watermark as M
from regchron.operators.replay import list_runs, scd2_replay
from regchron.operators.staging import build_staging, latest_per_key
from regchron.plans import gold, jobs, profile, standin as S
from regchron.schema import (
    HASH_COLUMNS,
    REGISTRY_COLUMNS,
    RESULT_SCHEMA,
    STATUS_LABELS,
    WATERMARK_SCHEMA,
)
from regchron.session import scratch_path
from regchron.sources import delimited, tables, xml
from regchron.sources.store import HistoryStore
from regchron.streaming.load_once import load_files_once

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = date(2001, 12, 31)
LOADED_AT = datetime(2002, 1, 1, 8, 30)
# Text files with a header that keep the blanks around values.
AS_IS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
VERSION_COLUMNS = [
    "egid", "gstat", "ganzwhg", "strname", "gdat", "valid_from", "valid_to", "is_current",
    "record_hash", "dqa_deleted", "_silver_loaded",
]


def query(build: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[build.__name__] = build
    return build


# ---- scans, sources, sinks ------------------------------------------------------------------


@query
def registry_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses parsed into registry rows."""
    return xml.read_registry_xml(S.responses(spark, sf_dir))


@query
def xml_dwelling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of dwellings per response."""
    item = xml.parse_responses(S.responses(spark, sf_dir))
    return item.select("requested", xml.dwelling_count(F.col("_item")).alias("dwellings"))


@query
def xml_street_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets by whether the German or another name was taken."""
    rows = xml.read_registry_xml(S.responses(spark, sf_dir))
    other = F.col("strname").startswith("Rue ")
    return rows.groupBy(F.when(other, "other").otherwise("german").alias("language")).agg(
        F.count("*").alias("streets")
    )


@query
def key_range_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order numbers from the lowest to the highest, with a mark where no building is."""
    parsed = xml.read_registry_xml(S.responses(spark, sf_dir))
    ends = S.table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return xml.lookup_range(parsed, ends[0], ends[1], skip_missing=False).select(
        "egid", "gdekt", "gstat", "_not_found"
    )


@query
def key_range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys found and missing in the range."""
    return xml.range_counts(key_range_lookup(spark, sf_dir))


def _write_extract(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "extract")
    S.raw_extract(spark, sf_dir).write.partitionBy("kanton").csv(path, sep="\t", **AS_IS)
    return path


@query
def tsv_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts of all cantons, written and read back; missing cantons are left out."""
    paths = delimited.canton_paths(_write_extract(spark, sf_dir), "all", "kanton={canton}")
    return delimited.read_registry_tsv(spark, paths)


@query
def tsv_cantons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some cantons only, one of them without an extract."""
    paths = delimited.canton_paths(
        _write_extract(spark, sf_dir), ["ZH", "be", "ag", "xx"], "kanton={canton}"
    )
    rows = delimited.read_registry_tsv(spark, paths)
    return rows.groupBy("gdekt").agg(
        F.count("*").alias("records"), F.count("gbauj").alias("with_year"), F.count("gvol").alias("with_volume")
    )


@query
def bulk_load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulk load, run twice over the same files: the second time nothing is added."""
    base = scratch_path(spark, "bulk")
    raw = S.raw_extract(spark, sf_dir).drop("kanton")
    clean = raw.withColumns({"GBAUJ": F.nullif("GBAUJ", F.lit("n/a")), "GVOL": F.trim("GVOL")})
    clean.write.csv(f"{base}/src", sep="\t", **AS_IS)
    for run_id in ("first", "second"):
        load_files_once(
            spark, f"{base}/src", f"{base}/log", f"{base}/checkpoint", LOADED_AT, run_id=run_id
        )
    return tables.read_bronze(spark, f"{base}/log").select(
        *REGISTRY_COLUMNS, "_run_id", "_batch_id", "_source", "_is_full_load"
    )


@query
def records_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business records written as CSV and read back."""
    path = scratch_path(spark, "records")
    S.business_records(spark, sf_dir).drop("o_orderkey").write.csv(path, **AS_IS)
    return delimited.read_records_csv(spark, path)


@query
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by name."""
    name = "regchron_orders"
    S.table(spark, sf_dir, "orders").createOrReplaceTempView(name)
    if not tables.table_exists(spark, name):
        raise RuntimeError(f"{name} is not in the catalog")
    return spark.table(name)


@query
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs appended to the partitioned log, read back per run and date."""
    path = scratch_path(spark, "bronze")
    tables.append_bronze(S.bronze_log(spark, sf_dir), path)
    log = tables.read_bronze(spark, path)
    return log.groupBy("_run_id", "_ingestion_date", "_is_full_load").agg(
        F.count("*").alias("records"),
        F.count_distinct("egid").alias("buildings"),
        F.max(C.iso_date("gdat")).alias("max_gdat"),
        F.count("plz4").alias("with_postcode"),
    )


@query
def bronze_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, the later one with a column more: rows of the earlier one have NULL there."""
    path = scratch_path(spark, "merge")
    log = S.bronze_log(spark, sf_dir)
    late = F.col("_run_id") >= "1998"
    tables.append_bronze(log.filter(~late), path)
    tables.append_bronze(log.filter(late).withColumn("gwaerzh1", F.col("gkat") + 1), path)
    return tables.read_bronze(spark, path, merge=True).select(
        "egid", "_run_id", "_batch_id", "gwaerzh1"
    )


@query
def table_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite, then append twice, one of them empty."""
    path = scratch_path(spark, "table")
    nations = S.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    tables.write_table(nations, path, "overwrite")
    tables.write_table(nations, path, "overwrite")
    tables.write_table(nations, path, "append")
    tables.write_table(nations.filter(F.lit(False)), path, "append")
    return spark.read.parquet(path)


@query
def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest state per building over the whole log, with fingerprint."""
    log = S.bronze_log(spark, sf_dir)
    rows = build_staging(log, order_by=S.newest_first())
    return rows.select(*REGISTRY_COLUMNS, "_run_id", "_batch_id", "record_hash")


@query
def published_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gold views published and counted by name."""
    names = gold.publish_views(S.history(spark, sf_dir))
    counts = [spark.table(n).agg(F.count("*").alias("n")).select(F.lit(n).alias("view"), "n") for n in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def watermark_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark moved by every run in turn; a second, older candidate adds nothing."""
    path = scratch_path(spark, "watermark")
    tables.ensure_table(spark, path, WATERMARK_SCHEMA)
    log = S.bronze_log(spark, sf_dir)
    for run_id, at in list_runs(log):
        rows = log.filter(F.col("_run_id") == run_id)
        mark = M.safe_watermark(rows).first()["watermark_date"]
        for candidate in (mark, date(1999, 6, 30)):
            marks = spark.read.schema(WATERMARK_SCHEMA).parquet(path)
            new = M.advance_watermark(marks, candidate, at).collect()
            if new:
                tables.write_table(spark.createDataFrame(new, WATERMARK_SCHEMA), path)
    return spark.read.schema(WATERMARK_SCHEMA).parquet(path)


@query
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results and totals written as JSON; the totals read back."""
    return jobs.write_report(
        check_results(spark, sf_dir), scratch_path(spark, "report"), "orders", "run00001", LOADED_AT
    )


@query
def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that only counts: rows that would be written, and whether anything was."""
    path = scratch_path(spark, "dry")
    rows = tables.append_bronze(S.bronze_log(spark, sf_dir), path, dry_run=True)
    written = tables.path_exists(spark, path)
    return rows.agg(F.count("*").alias("records")).withColumn("written", F.lit(written))


# ---- scalar functions -----------------------------------------------------------------------


@query
def safe_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers out of the events' property text and other text, NULL where there is none."""
    digits = F.regexp_extract("props", r": (.*)\}", 1)
    return S.table(spark, sf_dir, "events").select(
        "event_id",
        C.to_int(F.concat(F.lit(" "), digits, F.lit("\t"))).alias("as_int"),
        C.to_double(F.col("value").cast("string")).alias("as_double"),
        C.to_int("event_type").alias("bad_int"),
        C.to_double("event_type").alias("bad_double"),
    )


@query
def strict_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts that would fail the job on bad text."""
    rows = S.table(spark, sf_dir, "lineitem")
    text = {c: F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_discount")}
    return rows.withColumns(text).select(
        C.to_type("l_orderkey", "bigint", strict=True).alias("key"),
        C.to_type("l_linenumber", "int", strict=True).alias("line"),
        C.to_type("l_discount", "double", strict=True).alias("discount"),
        C.to_type(F.when(F.col("l_tax") > 0, "true").otherwise("false"), "boolean", strict=True).alias("taxed"),
    )


@query
def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage columns on every event: constant per run, batches of at most 1000 rows."""
    rows = S.table(spark, sf_dir, "events").select(F.col("event_id").alias("egid"))
    stamped = stamp_lineage(rows, "0a1b2c3d", LOADED_AT, "gwr_api", False)
    per_batch = stamped.groupBy(
        "_ingested_at", "_ingestion_date", "_run_id", "_source", "_is_full_load", "_batch_id"
    ).agg(F.count("*").alias("n"))
    return per_batch.groupBy(
        "_ingested_at", "_ingestion_date", "_run_id", "_source", "_is_full_load"
    ).agg(
        F.sum("n").alias("records"),
        (F.max("n") <= 1000).alias("batches_fit"),
        F.bool_and(F.col("_batch_id").startswith("0a1b2c3d_")).alias("batches_named"),
    )


@query
def row_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every log row over the 21 columns."""
    log = S.bronze_log(spark, sf_dir)
    return log.select("_batch_id", C.row_hash(HASH_COLUMNS).alias("record_hash"))


@query
def status_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label of every status code in the log, known or not."""
    log = S.bronze_log(spark, sf_dir)
    code = F.when(F.col("egid") % 29 == 0, 8).when(F.col("egid") % 31 == 0, 4).otherwise(F.col("gstat"))
    return log.groupBy(code.alias("code")).agg(F.count("*").alias("n")).withColumn(
        "label", C.status_label("code", STATUS_LABELS)
    )


@query
def normalised_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text in comparison form."""
    return S.table(spark, sf_dir, "documents").select("doc_id", C.norm_text("text").alias("text"))


@query
def code_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number against padded text, both compared as stripped text."""
    rows = S.table(spark, sf_dir, "customer")
    padded = F.concat(F.lit(" "), (F.col("c_custkey") % 25).cast("string"), F.lit("\t"))
    return rows.select(
        "c_custkey", C.strip(F.col("c_nationkey")).eqNullSafe(C.strip(padded)).alias("same")
    )


@query
def text_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose whole text contains a word part, in any case."""
    return (
        S.table(spark, sf_dir, "documents")
        .groupBy("lang", C.contains_text("text", "THE").alias("hit"))
        .agg(F.count("*").alias("documents"))
    )


@query
def percent_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference of a line's quantity from its number, in percent."""
    return S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.round(C.pct_diff(F.floor("l_quantity"), F.col("l_linenumber") - 1), 6).alias("difference"),
    )


@query
def date_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mutation year and the day before, from date text; bad text gives NULL."""
    log = S.bronze_log(spark, sf_dir)
    text = F.when(F.col("egid") % 10 == 0, "unbekannt").otherwise(F.concat("gdat", F.lit("T12:00:00")))
    return log.select(
        "_batch_id", C.mutation_year(text).alias("mutation_year"), C.day_before(text).alias("day_before")
    )


# ---- latest row, history --------------------------------------------------------------------


@query
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order per customer."""
    orders = S.table(spark, sf_dir, "orders")
    return latest_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query
def staged_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per building and run."""
    return S.staged_runs(S.bronze_log(spark, sf_dir)).select("egid", "_run_id", "_batch_id", "record_hash")


@query
def history_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of all runs in one pass."""
    return S.history(spark, sf_dir).select(*VERSION_COLUMNS)


@query
def history_replay_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without deletions: absence in a run means nothing."""
    return S.history(spark, sf_dir, delete_missing=False).select(*VERSION_COLUMNS)


def _merge_runs(spark: SparkSession, sf_dir: str) -> tuple[HistoryStore, list[dict]]:
    """Every run merged into a stored history, one after the other."""
    log = S.bronze_log(spark, sf_dir)
    store = HistoryStore(spark, scratch_path(spark, "silver"))
    counts = []
    for run_id, at in list_runs(log):
        found = store.merge(S.staged_run(log, run_id), at, "all", staging_empty=False, run_id=run_id)
        counts.append({"run": run_id} | found)
    return store, counts


@query
def history_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of all runs, each merged and published in turn."""
    store, _ = _merge_runs(spark, sf_dir)
    return store.read().select(*VERSION_COLUMNS)


@query
def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions closed, inserted and deleted by each run's merge."""
    history = S.history(spark, sf_dir)
    opened = history.groupBy(F.col("valid_from").alias("at")).agg(F.count("*").alias("inserted"))
    ended = (
        history.filter(~F.col("is_current"))
        .groupBy(F.col("valid_to").alias("at"))
        .agg(
            F.count_if(~F.col("dqa_deleted")).alias("closed"),
            F.count_if(F.col("dqa_deleted")).alias("deleted"),
        )
    )
    zero = F.lit(0).cast("long")
    return opened.join(ended, "at", "full_outer").select(
        "at", *[F.coalesce(c, zero).alias(f"records_{c}") for c in ("closed", "inserted", "deleted")]
    )


def _before_last(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, datetime]:
    """History before the last run, that run's staging, and its time."""
    log = S.bronze_log(spark, sf_dir)
    runs = list_runs(log)
    last, at = runs[-1]
    earlier = S.staged_runs(log.filter(F.col("_run_id") < last))
    return scd2_replay(earlier, runs[:-1]), S.staged_run(log, last), at


@query
def classify_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last run means for each building."""
    history, staged, _ = _before_last(spark, sf_dir)
    return H.scd2_classify(history, staged)


@query
def merge_last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run merged into the history of those before."""
    history, staged, at = _before_last(spark, sf_dir)
    merged = H.scd2_apply(history, staged, at, delete_scope="all", staging_empty=False)
    return merged.select(*VERSION_COLUMNS)


@query
def merge_last_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run merged as a small increment: its marks broadcast, nothing deleted."""
    history, staged, at = _before_last(spark, sf_dir)
    merged = H.scd2_merge_small(H.current_rows(history), staged, at)
    return H.closed_rows(history).unionByName(merged).select(*VERSION_COLUMNS)


@query
def merge_last_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last run's merge closed, inserted and deleted."""
    history, staged, at = _before_last(spark, sf_dir)
    merged = H.scd2_apply(history, staged, at, delete_scope="all", staging_empty=False)
    return H.merge_counts(merged, at)


@query
def merge_some_cantons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run merged, absence counting in three cantons only."""
    history, staged, at = _before_last(spark, sf_dir)
    scope = F.col("gdekt").isin("ZH", "BE", "AG")
    merged = H.scd2_apply(history, staged, at, delete_scope=scope, staging_empty=False)
    return merged.select(*VERSION_COLUMNS)


@query
def vanished_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings that the last run no longer has."""
    history, staged, _ = _before_last(spark, sf_dir)
    return H.scd2_classify(history, staged).filter(F.col("action") == H.DELETED).select("egid")


@query
def reappeared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings that are current again after having been deleted."""
    history = S.history(spark, sf_dir)
    return (
        history.groupBy("egid")
        .agg(
            F.count_if("dqa_deleted").alias("deletions"),
            F.count_if("is_current").alias("now_current"),
        )
        .filter("deletions > 0 and now_current > 0")
    )


@query
def history_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of buildings whose history breaks a rule."""
    broken = H.history_violations(S.history(spark, sf_dir))
    return broken.agg(F.count("*").alias("broken"))


@query
def point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions valid in the middle of 1998."""
    at = datetime(1998, 6, 30, 12)
    return H.as_of_view(S.history(spark, sf_dir), at).select(*VERSION_COLUMNS)


# ---- views ----------------------------------------------------------------------------------


@query
def current_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current view."""
    return S.current(spark, sf_dir)


@query
def building_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history view in reading order."""
    return gold.ordered_history(gold.history_view(S.history(spark, sf_dir), AS_OF))


@query
def changed_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change view; the list of codes as text."""
    view = gold.change_view(S.history(spark, sf_dir))
    listed = F.array_join(F.transform("gstat_history", lambda c: c.cast("string")), ",")
    return view.withColumn("gstat_history", listed)


@query
def most_changed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of the building with the most versions."""
    history = S.history(spark, sf_dir)
    key = gold.most_changed_key(history).first()["egid"]
    return gold.history_of(history, key)


@query
def stock_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the current view."""
    return gold.summary(S.current(spark, sf_dir))


# ---- profiling ------------------------------------------------------------------------------


@query
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten newest runs of the event log with their records."""
    runs = profile.run_overview(S.event_log(spark, sf_dir))
    return profile.top(runs, [F.desc("_ingestion_date"), F.col("_run_id")], 10)


@query
def newest_run_cantons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the newest run by canton."""
    counts = profile.latest_run_counts(S.event_log(spark, sf_dir))
    return profile.top(counts, [F.desc("count"), F.col("gdekt")], 30)


@query
def version_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions in total, current, historic, deleted."""
    return profile.row_counts(S.history(spark, sf_dir))


@query
def versions_per_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings with several versions."""
    return profile.version_counts(S.history(spark, sf_dir))


@query
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current buildings by status."""
    return profile.status_counts(S.current(spark, sf_dir))


@query
def canton_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings, dwellings and mean year per canton."""
    cantons = profile.region_overview(S.current(spark, sf_dir))
    return cantons.withColumn("durchschnitt_baujahr", F.round("durchschnitt_baujahr", 6))


@query
def buildings_by_mutation_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current buildings by year of the last mutation."""
    return profile.mutation_years(S.current(spark, sf_dir))


@query
def previous_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version with the status before it."""
    return profile.with_previous(S.history(spark, sf_dir)).select(
        "egid", "valid_from", "prev_gstat", "gstat"
    )


@query
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often one status followed another."""
    return profile.transitions(S.history(spark, sf_dir))


@query
def gap_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current buildings without coordinates, year, postcode."""
    return profile.null_profile(S.current(spark, sf_dir))


@query
def label_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same profile over documents and their labels, which are often missing."""
    documents = S.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rows = documents.join(S.table(spark, sf_dir, "labels"), "doc_id", "left")
    gaps = {
        "no_label": F.col("quality").isNull() | F.col("toxic").isNull(),
        "long_without_label": (F.col("n_chars") > 1000) & F.col("quality").isNull(),
        "no_length": F.col("n_chars").isNull(),
    }
    return profile.null_profile(rows, gaps)


# ---- quality checks -------------------------------------------------------------------------


@query
def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks for every business record."""
    records = S.business_records(spark, sf_dir)
    return Q.run_checks(records, S.stored_current(spark, sf_dir), AS_OF, checked_at=LOADED_AT)


def _one_check(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = S.business_records(spark, sf_dir)
        results = Q.run_checks(records, S.stored_current(spark, sf_dir), AS_OF, checks=[name])
        return Q.with_status(results).select(
            "check_id", "check_name", "egid", "status", "severity", "detail", "expected", "actual"
        )

    build.__name__ = f"check_{name}"
    return query(build)


for _name in Q.CHECKS:
    _one_check(_name)


@query
def check_results_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks with the salted join, every building with two or more records being salted."""
    records = S.business_records(spark, sf_dir)
    return Q.run_checks(
        records, S.stored_current(spark, sf_dir), AS_OF, checked_at=LOADED_AT, salted=True, rows_per_salt=2
    )


@query
def record_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with the reference row of its key."""
    records = S.business_records(spark, sf_dir).select("o_orderkey", "egid")
    reference = S.stored_current(spark, sf_dir).select(F.col("egid").alias("ref_egid"), "gstat", "plz4")
    return Q.lookup_join(records, reference, "egid", "ref_egid")


@query
def record_lookup_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, the reference being reduced to the keys that records may have before it is shuffled."""
    records = S.business_records(spark, sf_dir).select("o_orderkey", "egid")
    reference = S.stored_current(spark, sf_dir).select(F.col("egid").alias("ref_egid"), "gstat", "plz4")
    return Q.lookup_join(records, reference, "egid", "ref_egid", reduce=True)


@query
def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all checks."""
    return Q.report(check_results(spark, sf_dir), "orders", "run00001", LOADED_AT)


@query
def check_report_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes and failures per check."""
    return Q.report_by_check(check_results(spark, sf_dir))


# ---- watermark ------------------------------------------------------------------------------


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A watermark log: one mark per run and canton as source."""
    return S.bronze_log(spark, sf_dir).groupBy(F.col("gdekt").alias("source"), "_run_id").agg(
        F.max(C.iso_date("gdat")).alias("watermark_date")
    )


@query
def watermark_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current mark of a source with marks and of one without."""
    log = _marks(spark, sf_dir)
    known, unknown = M.current_watermark(log, "ZH"), M.current_watermark(log, "XX")
    return known.withColumn("source", F.lit("ZH")).unionByName(
        unknown.withColumn("source", F.lit("XX"))
    )


@query
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to append for candidates behind, at, and before the current mark."""
    log = _marks(spark, sf_dir)
    mark = M.current_watermark(log, "ZH").first()["watermark_date"]
    later = date(mark.year + 1, 1, 1)
    rows = [M.advance_watermark(log, c, LOADED_AT, "ZH") for c in (later, mark, date(1990, 1, 1))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def watermark_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest date less a day; the previous mark for text that is no date, and for no rows."""
    log = S.bronze_log(spark, sf_dir)
    bad = log.withColumn("gdat", F.when(F.col("egid") == 7, "unbekannt").otherwise(F.col("gdat")))
    none = log.withColumn("gdat", F.lit(None).cast("string"))
    cases = {"dated": log, "bad": bad, "none": none}
    parts = [
        M.safe_watermark(rows, previous="1999-09-09").withColumn("input", F.lit(name))
        for name, rows in cases.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def run_max_mutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest mutation date of the run of 1997."""
    return M.max_mutation(S.bronze_log(spark, sf_dir), "1997")


@query
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows mutated since a mark, in two cantons."""
    rows = M.changed_since(S.bronze_log(spark, sf_dir), "1999-12-31")
    return M.in_cantons(rows, ["zh", "be"]).select("egid", "gdekt", "gdat", "_batch_id")


@query
def full_load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a full load takes per run, the mark being ignored."""
    rows = M.changed_since(S.bronze_log(spark, sf_dir), None)
    return rows.groupBy("_run_id").agg(F.count("*").alias("records"))


# ---- jobs -----------------------------------------------------------------------------------


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a registry row: all states of a building, several in a load."""
    return S.registry_rows(S.dealt_out(S.table(spark, sf_dir, "orders"))).drop("o_orderkey", "o_orderdate")


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[str, list[dict]]:
    """The whole chain for two loads: everything up to the middle of 2000 in full, then what changed since."""
    base = scratch_path(spark, "jobs")
    rows = _states(spark, sf_dir)
    early = rows.filter(F.col("gdat") < "2000-07-01")
    first = jobs.refresh(spark, base, early, datetime(2000, 7, 1), full_load=True, run_id="00000001")
    second = jobs.refresh(spark, base, rows, datetime(2001, 9, 1), run_id="00000002")
    return base, [first, second]


@query
def refresh_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History after a full and an incremental run of the whole chain."""
    base, _ = _refreshed(spark, sf_dir)
    return jobs.open_history(spark, base).read().select(*VERSION_COLUMNS)


@query
def refresh_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both runs report: rows written, mark used, versions closed, inserted and deleted."""
    _, steps = _refreshed(spark, sf_dir)
    rows = [
        (
            step["bronze"]["run_id"], step["bronze"]["since_date"], step["bronze"]["total_written"],
            step["bronze"]["batch_count"] > 0, step["silver"]["records_closed"],
            step["silver"]["records_inserted"], step["silver"]["records_deleted"],
        )
        for step in steps
    ]
    return spark.createDataFrame(
        rows,
        "run_id string, since_date string, total_written bigint, has_batches boolean,"
        " records_closed bigint, records_inserted bigint, records_deleted bigint",
    )


@query
def status_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary after both runs, as the job reports it."""
    base, _ = _refreshed(spark, sf_dir)
    schema = gold.summary(gold.current_view(jobs.open_history(spark, base).current())).schema
    found = jobs.status(spark, base)
    return spark.createDataFrame([tuple(found[name] for name in schema.fieldNames())], schema)


@query
def explore_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine exploration reports after both runs, as rows of report, key and value."""
    base, _ = _refreshed(spark, sf_dir)
    found = jobs.explore(spark, base)
    keyed = {
        "runs": ("_run_id", "records"),
        "latest_run": ("gdekt", "count"),
        "versions": ("egid", "versionen"),
        "status": ("gstat", "count"),
        "cantons": ("gdekt", "gebaeude"),
        "mutation_years": ("mutation_jahr", "count"),
        "transitions": ("concat_ws('>', prev_gstat, gstat)", "anzahl"),
    }
    rows = [
        found[name].selectExpr(f"'{name}' AS report", f"cast({key} AS string) AS key", f"cast(`{value}` AS bigint) AS value")
        for name, (key, value) in keyed.items()
    ]
    for name in ("row_counts", "gaps"):
        one = found[name]
        pairs = ", ".join(f"'{c}', `{c}`" for c in one.columns)
        rows.append(one.selectExpr(f"'{name}' AS report", f"stack({len(one.columns)}, {pairs}) AS (key, value)"))
    return reduce(DataFrame.unionByName, rows)


@query
def watermark_cantons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of one canton between two of all: the other cantons' changes arrive all the same."""
    base = scratch_path(spark, "jobs")
    rows = _states(spark, sf_dir)
    early = rows.filter(F.col("gdat") < "2000-07-01")
    jobs.bronze_ingest(spark, base, early, datetime(2000, 7, 1), full_load=True, run_id="00000001")
    jobs.bronze_ingest(spark, base, rows, datetime(2001, 8, 1), cantons="zh", run_id="00000002")
    jobs.bronze_ingest(spark, base, rows, datetime(2001, 9, 1), run_id="00000003")
    later = jobs.open_bronze(spark, base).filter("_run_id > '00000001'")
    return later.select("egid", "gdekt", "gdat", "_run_id")


@query
def watermark_per_canton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks per canton: a canton is loaded between two loads of all, twice.

    The second time it brings its last day only, and the load of all takes each canton from its
    own mark on.
    """
    base = scratch_path(spark, "jobs")
    rows = _states(spark, sf_dir)
    early = rows.filter(F.col("gdat") < "2000-07-01")
    loads = [
        (early, datetime(2000, 7, 1), {"full_load": True}),
        (rows, datetime(2001, 8, 1), {"cantons": "zh"}),
        (rows, datetime(2001, 8, 2), {"cantons": "zh"}),
        (rows, datetime(2001, 9, 1), {}),
    ]
    for number, (brought, now, options) in enumerate(loads, 1):
        jobs.bronze_ingest(spark, base, brought, now, run_id=f"0000000{number}", marks="canton", **options)
    later = jobs.open_bronze(spark, base).filter("_run_id > '00000001'")
    return later.select("egid", "gdekt", "gdat", "_run_id")


@query
def increment_without_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows an increment takes if every fifth building has no mutation date."""
    base = scratch_path(spark, "jobs")
    rows = _states(spark, sf_dir)
    rows = rows.withColumn("gdat", F.when(F.col("egid") % 5 != 0, F.col("gdat")))
    early = rows.filter(F.col("gdat") < "2000-07-01")
    jobs.bronze_ingest(spark, base, early, datetime(2000, 7, 1), full_load=True, run_id="00000001")
    jobs.bronze_ingest(spark, base, rows, datetime(2001, 9, 1), run_id="00000002")
    return jobs.open_bronze(spark, base).filter("_run_id = '00000002'").select("egid", "gstat", "gdat")


@query
def refresh_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load of all columns, then responses with 20 of them: what they lack stays."""
    base = scratch_path(spark, "jobs")
    jobs.refresh(
        spark, base, _states(spark, sf_dir), datetime(2001, 9, 1), source="gwr_zip", full_load=True,
        move_watermark=False, run_id="00000001",
    )

    def answers(newer_than: str | None) -> DataFrame:
        return xml.read_registry_xml(S.responses(spark, sf_dir), newer_than=newer_than).drop("requested")

    jobs.refresh(spark, base, answers, datetime(2001, 10, 1), run_id="00000002")
    return jobs.open_history(spark, base).read().select(*VERSION_COLUMNS, "gbaum", "gabbj", "gvol", "gazzi", "gschutzr")


@query
def rebuild_mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History rebuilt in one pass from a full load, one of two cantons, and an increment."""
    base = scratch_path(spark, "jobs")
    rows = _states(spark, sf_dir)
    first, then = rows.filter("gdat < '1998-01-01'"), rows.filter("gdat >= '1998-01-01' and gdat < '1999-06-01'")
    jobs.bronze_ingest(spark, base, first, datetime(1998, 1, 1), full_load=True, run_id="00000001")
    jobs.bronze_ingest(spark, base, then, datetime(1999, 6, 1), full_load=True, cantons=["zh", "be"], run_id="00000002")
    jobs.bronze_ingest(spark, base, rows, datetime(2001, 9, 1), run_id="00000003")
    jobs.rebuild_history(spark, base, datetime(2001, 9, 1))
    return jobs.open_history(spark, base).read().select(*VERSION_COLUMNS)


def _write_clean_extract(spark: SparkSession, sf_dir: str, condition: str, path: str) -> None:
    """Extract files of the orders that meet a condition, without unreadable numbers."""
    raw = S.raw_extract(spark, sf_dir).withColumn("_day", F.to_date("GEXPDAT")).filter(condition).drop("_day")
    clean = raw.withColumns({"GBAUJ": F.nullif("GBAUJ", F.lit("n/a")), "GVOL": F.trim("GVOL")})
    clean.write.mode("append").partitionBy("kanton").csv(path, sep="\t", **AS_IS)


@query
def bulk_second_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk loads of a canton, the second one with new files only: it deletes nothing."""
    base = scratch_path(spark, "bulk")
    for month, condition in ((7, "_day < '1998-07-01'"), (8, "_day >= '1998-07-01'")):
        _write_clean_extract(spark, sf_dir, condition, f"{base}/src")
        jobs.bronze_bulk(
            spark, base, f"{base}/src", datetime(2001, month, 1), "AG", layout="kanton={canton}", run_id=f"0000000{month}"
        )
    jobs.silver_pending(spark, base, datetime(2001, 9, 1))
    return jobs.open_history(spark, base).read().select("egid", "gstat", "ganzwhg", "is_current", "dqa_deleted")


def _stop_after(wanted: str) -> Callable[[str, str], None]:
    """A watcher that ends a load when a step is done, as a job that dies there would."""

    def watch(step: str, run_id: str) -> None:
        if step == wanted:
            raise RuntimeError(f"run {run_id} ends after it was {step}")

    return watch


@query
def bulk_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk loads of four cantons that die, each after another step, and are started again.

    The one that was published only is merged by the listing of the log before it is started
    again. The history is that of four loads that went through.
    """
    base = scratch_path(spark, "bulk")
    _write_clean_extract(spark, sf_dir, "true", f"{base}/src")
    options = {"layout": "kanton={canton}", "merge": True}
    for month, (canton, step) in enumerate((("AG", "begun"), ("BE", "published"), ("ZH", "noted"), ("VD", "merged")), 1):
        try:
            jobs.bronze_bulk(
                spark, base, f"{base}/src", datetime(2002, month, 1), canton, run_id=f"0000000{month}",
                on_step=_stop_after(step), **options,
            )
        except StreamingQueryException:
            pass
        else:
            raise RuntimeError("the load was to end early")
        if step == "published":
            jobs.silver_pending(spark, base, datetime(2002, month, 1, 12))
        jobs.bronze_bulk(spark, base, f"{base}/src", datetime(2002, month, 2), canton, run_id=f"1000000{month}", **options)
    history = jobs.open_history(spark, base).read()
    return history.select("egid", "gdekt", "gstat", "ganzwhg", "valid_from", "is_current", "dqa_deleted")


@query
def bulk_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bulk job reports for a canton, run twice over the same files."""
    base = scratch_path(spark, "bulk")
    _write_clean_extract(spark, sf_dir, "true", f"{base}/src")
    rows = []
    for month in (7, 8):
        out = jobs.bronze_bulk(
            spark, base, f"{base}/src", datetime(2001, month, 1), "ZH", layout="kanton={canton}", run_id=f"0000000{month}"
        )
        rows.append((out["run_id"], out["kanton"], out["records"]))
    return spark.createDataFrame(rows, "run_id string, kanton string, records bigint")


@query
def tsv_damaged_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full extracts of three cantons, then newer ones of which one is broken off: it is left out.

    Of the other two, buildings that are gone are closed; nothing of the damaged canton is.
    """
    base = scratch_path(spark, "jobs")
    cantons = ["zh", "be", "ag"]
    for month, condition in ((7, "_day < '1998-07-01'"), (8, "_day >= '1998-07-01'")):
        src = f"{base}/src{month}"
        _write_clean_extract(spark, sf_dir, condition, src)
        if month == 8:
            whole = spark.read.text(f"{src}/kanton=be").filter("value not like 'EGID%'")
            header = spark.read.csv(f"{src}/kanton=be", sep="\t", header=True).columns
            cut = whole.orderBy("value").limit(1).select(F.substring_index("value", "\t", 3).alias("value"))
            lines = spark.createDataFrame([("\t".join(header),)], "value string").unionByName(cut)
            lines.coalesce(1).write.mode("append").text(f"{src}/kanton=be")
        out = jobs.bronze_from_tsv(
            spark, base, src, datetime(2001, month, 1), cantons, layout="kanton={canton}", run_id=f"0000000{month}"
        )
        jobs.silver(spark, base, datetime(2001, month, 2), out["run_id"])
    skipped = jobs.open_skipped(spark, base).agg(F.count("*").alias("skipped"), F.max("run_id").alias("skipped_in"))
    history = jobs.open_history(spark, base).read()
    counts = history.groupBy("gdekt", "is_current", "dqa_deleted").agg(
        F.count("*").alias("versions"), F.max("valid_to").alias("valid_to")
    )
    return counts.crossJoin(skipped)


@query
def extract_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the extract job reports for all cantons, and the mark it leaves."""
    base = scratch_path(spark, "jobs")
    out = jobs.bronze_from_tsv(
        spark, base, _write_extract(spark, sf_dir), LOADED_AT, layout="kanton={canton}", run_id="00000001"
    )
    mark = M.read_watermark(jobs.open_watermark(spark, base))
    row = (out["run_id"], out["since_date"], out["total_written"], out["batch_count"] > 0, out["dry_run"], mark)
    return spark.createDataFrame(
        [row],
        "run_id string, since_date string, total_written bigint, has_batches boolean, dry_run boolean, watermark string",
    )


@query
def responses_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the response job reports, and the mark it leaves."""
    base = scratch_path(spark, "jobs")
    S.responses(spark, sf_dir).select("response").write.text(f"{base}/responses", compression="gzip")
    out = jobs.bronze_from_responses(
        spark, base, f"{base}/responses", LOADED_AT, by_line=True, run_id="00000001"
    )
    mark = M.read_watermark(jobs.open_watermark(spark, base))
    row = (out["run_id"], out["since_date"], out["total_written"], out["batch_count"] > 0, out["dry_run"], mark)
    return spark.createDataFrame(
        [row],
        "run_id string, since_date string, total_written bigint, has_batches boolean, dry_run boolean, watermark string",
    )


@query
def merge_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each merge of the stored history reports."""
    _, counts = _merge_runs(spark, sf_dir)
    rows = [(c["run"], c["records_closed"], c["records_inserted"], c["records_deleted"]) for c in counts]
    return spark.createDataFrame(
        rows, "run string, records_closed bigint, records_inserted bigint, records_deleted bigint"
    )


@query
def ensured_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables after they were ensured twice, and rows that meet the NOT NULL columns."""
    base = scratch_path(spark, "tables")
    tables.ensure_tables(spark, base)
    tables.append_bronze(S.bronze_log(spark, sf_dir), f"{base}/bronze")
    paths = tables.ensure_tables(spark, base)
    log = tables.read_bronze(spark, paths["bronze"]).agg(F.count("*").alias("n")).withColumn("name", F.lit("bronze"))
    marks = jobs.open_watermark(spark, base).agg(F.count("*").alias("n")).withColumn("name", F.lit("watermark"))
    complete = tables.require_not_null(S.history(spark, sf_dir)).agg(F.count("valid_from").alias("n"))
    return log.unionByName(marks).unionByName(complete.withColumn("name", F.lit("silver")))


@query
def dqa_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of CSV records against the stored current rows: the written results, counted."""
    base, _ = _refreshed(spark, sf_dir)
    path = f"{base}/records"
    S.business_records(spark, sf_dir).drop("o_orderkey").write.csv(path, **AS_IS)
    jobs.dqa(spark, base, path, AS_OF, f"{base}/report", "orders", "run00002", LOADED_AT)
    results = spark.read.schema(RESULT_SCHEMA).json(f"{base}/report/results")
    return Q.report_by_check(results)
