"""Runs exactly once, marks per canton, damaged parts, and what is counted while it is written."""

from __future__ import annotations

import gzip
import json
import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from regchron.functions.lineage import stamp_lineage
from regchron.operators import watermark as M
from regchron.plans import jobs
from regchron.schema import REGISTRY_SCHEMA, WATERMARK_SCHEMA
from regchron.session import scratch_path
from regchron.sources import delimited, tables
from regchron.streaming.load_once import Run, load_files_once, run_of_batch

HEADER = "EGID\tGDEKT\tGSTAT\tGEXPDAT\n"


def registry(spark, *buildings):
    names = REGISTRY_SCHEMA.fieldNames()
    rows = [tuple(({"gdekt": "AG", "gstat": 1004, "plz4": "5000"} | b).get(n) for n in names) for b in buildings]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def write(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join("\t".join(map(str, r)) + "\n" for r in rows))


def stop_after(wanted):
    def watch(step, run_id):
        if step == wanted:
            raise RuntimeError("the job dies here")

    return watch


def versions(spark, base):
    rows = jobs.open_history(spark, base).read().collect()
    return sorted((r["egid"], r["gstat"], r["is_current"], r["dqa_deleted"]) for r in rows)


@pytest.mark.parametrize(
    ("step", "merge"), [("begun", True), ("published", False), ("noted", False), ("noted", True), ("merged", True)]
)
def test_a_bulk_load_that_dies_goes_on(spark, tmp_path, step, merge):
    base = scratch_path(spark, "base")
    write(tmp_path / "ag", "one.csv", (1, "AG", 1004, "2024-12-31"), (2, "AG", 1003, "2024-12-31"))
    with pytest.raises(StreamingQueryException, match="dies here"):
        jobs.bronze_bulk(
            spark, base, str(tmp_path), datetime(2025, 1, 1), "ag", merge=merge, run_id="first", on_step=stop_after(step)
        )
    out = jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 2, 2), "ag", merge=merge, run_id="second")
    # The run keeps the id and the time it was begun with.
    assert (out["run_id"], out["records"], out["runs"]) == ("first", 2, ["first"])
    log = jobs.open_bronze(spark, base).collect()
    assert sorted((r["egid"], r["_run_id"], r["_ingestion_date"]) for r in log) == [(1, "first", "2025-01-01"), (2, "first", "2025-01-01")]
    assert [(x.run_id, x.records, x.keyed) for x in jobs.open_runs(spark, base)] == [("first", 2, 2)]
    jobs.silver_pending(spark, base, datetime(2025, 3, 3))
    assert versions(spark, base) == [(1, 1004, True, False), (2, 1003, True, False)]
    write(tmp_path / "ag", "two.csv", (2, "AG", 1004, "2025-12-31"))
    more = jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 4, 4), "ag", merge=merge)
    assert more["records"] == 1
    jobs.silver_pending(spark, base, datetime(2025, 5, 5))
    assert versions(spark, base) == [(1, 1004, True, False), (2, 1003, False, False), (2, 1004, True, False)]
    assert jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 6, 6), "ag")["records"] == 0


def test_a_published_run_is_found_by_the_listing(spark, tmp_path):
    base = scratch_path(spark, "base")
    write(tmp_path / "zh", "one.csv", (1, "ZH", 1004, "2024-12-31"))
    with pytest.raises(StreamingQueryException):
        jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 1, 1), "zh", full_load=True, run_id="a", on_step=stop_after("published"))
    [load] = jobs.pending_runs(spark, base)
    assert (load.run_id, load.full_load, load.cantons, load.records) == ("a", True, ("ZH",), 1)
    jobs.silver_pending(spark, base, datetime(2025, 1, 2))
    # The batch is repeated, written again and found merged.
    jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 1, 3), "zh", full_load=True, merge=True)
    assert versions(spark, base) == [(1, 1004, True, False)]
    assert jobs.pending_runs(spark, base) == [] and jobs.open_bronze(spark, base).count() == 1


def test_a_batch_load_that_dies_before_its_note(spark, monkeypatch):
    base = scratch_path(spark, "base")
    rows = registry(spark, dict(egid=1, gdat="2024-01-10"), dict(egid=2, gdat="2024-01-11", gdekt="ZH"))
    note = jobs._note_run

    def die(spark, base, load, done):
        if done:
            raise RuntimeError("dies here")
        note(spark, base, load, done)

    monkeypatch.setattr(jobs, "_note_run", die)
    with pytest.raises(RuntimeError, match="dies here"):
        jobs.bronze_ingest(spark, base, rows, datetime(2024, 2, 1), full_load=True, run_id="a")
    monkeypatch.setattr(jobs, "_note_run", note)
    # Begun only: nothing was published.
    jobs._note_run(spark, base, jobs.Load("b", datetime(2024, 2, 2), "x", True, (), ("egid",)), False)
    assert [x.run_id for x in jobs.pending_runs(spark, base)] == ["a"]
    [load] = jobs.open_runs(spark, base)
    assert (load.cantons, load.records, load.keyed) == (("AG", "ZH"), 2, 2)
    jobs.silver_pending(spark, base, datetime(2024, 3, 1))
    assert [r[0] for r in versions(spark, base)] == [1, 2]
    # The same run written again replaces itself.
    jobs.bronze_ingest(spark, base, rows.filter("egid = 1"), datetime(2024, 2, 1), full_load=True, run_id="a")
    assert [r["egid"] for r in jobs.open_bronze(spark, base).collect()] == [1]


def test_a_note_that_was_cut_off_begins_nothing(spark, tmp_path):
    first, second = Run("a", datetime(2024, 1, 1)), Run("b", datetime(2024, 1, 2))
    assert run_of_batch(spark, str(tmp_path), 0, first) == first
    assert run_of_batch(spark, str(tmp_path), 0, second) == first
    (tmp_path / "runs" / ".0.crc").unlink()
    (tmp_path / "runs" / "0").write_text('{"run_id": "a')
    assert run_of_batch(spark, str(tmp_path), 0, second) == second
    assert json.loads((tmp_path / "runs" / "0").read_text())["run_id"] == "b"


def test_a_log_of_a_file_sink_is_refused(spark, tmp_path):
    (tmp_path / "log" / "_spark_metadata").mkdir(parents=True)
    write(tmp_path / "ag", "one.csv", (1, "AG", 1004, "2024-12-31"))
    with pytest.raises(ValueError, match="file sink"):
        load_files_once(spark, f"{tmp_path}/ag", f"{tmp_path}/log", f"{tmp_path}/checkpoint", datetime(2024, 1, 1))


# ---- marks per canton -----------------------------------------------------------------------


def test_each_canton_goes_by_its_own_mark(spark):
    rows = registry(
        spark, dict(egid=1, gdat="2024-01-05"), dict(egid=2, gdat="2024-01-15"), dict(egid=3, gdat="2024-01-05", gdekt="ZH"),
        dict(egid=4, gdat="2024-01-15", gdekt="ZH"), dict(egid=5, gdekt="ZH"), dict(egid=6, gdat="2024-01-15", gdekt="??"),
        dict(egid=7, gdat="2024-01-05", gdekt=None),
    )
    log = spark.createDataFrame(
        [("gwr_buildings", datetime(2024, 1, 1).date(), None), ("gwr_buildings/AG", datetime(2024, 1, 10).date(), None),
         ("gwr_buildings/AG", datetime(2024, 1, 2).date(), None), ("gwr_buildings/??", datetime(2024, 1, 31).date(), None)],
        WATERMARK_SCHEMA,
    )
    marks = M.canton_marks(log)
    assert [(r["gdekt"], str(r["watermark_date"])) for r in marks.collect()] == [("AG", "2024-01-10")]
    assert M.read_watermark(log) == "2024-01-01"
    changed = M.changed_since_marks(rows, marks, "2024-01-01")
    assert sorted(r["egid"] for r in changed.collect()) == [2, 3, 4, 5, 6, 7]
    assert changed.columns == rows.columns
    # Of all marks the earliest reaches the scan.
    path = scratch_path(spark, "rows")
    rows.write.parquet(path)
    plan = M.changed_since_marks(spark.read.parquet(path), marks, "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(gdat,2024-01-10)" in plan


def test_marks_move_forward_only_and_all_at_once(spark):
    log = spark.createDataFrame([("a", datetime(2024, 1, 10).date(), None)], WATERMARK_SCHEMA)
    newest = spark.createDataFrame(
        [("a", "2024-01-10"), ("b", "2024-01-10"), ("c", "1999-01-01"), ("d", "unbekannt"), ("e", None)], "source string, gdat string"
    )
    rows = M.advance_watermarks(log, newest, datetime(2024, 2, 1)).collect()
    assert [(r["source"], str(r["watermark_date"])) for r in rows] == [("b", "2024-01-09")]


def test_a_canton_load_followed_by_itself(spark):
    base = scratch_path(spark, "base")
    first = registry(spark, dict(egid=1, gdat="2024-01-10"), dict(egid=2, gdat="2024-01-10", gdekt="ZH"))
    options = {"marks": "canton"}
    jobs.bronze_ingest(spark, base, first, datetime(2024, 2, 1), full_load=True, **options)
    second = registry(
        spark, dict(egid=1, gdat="2024-04-20"), dict(egid=3, gdat="2024-04-10"), dict(egid=2, gdat="2024-03-10", gdekt="ZH")
    )
    taken = [
        jobs.bronze_ingest(spark, base, second, datetime(2024, 5, day), cantons=cantons, **options)["total_written"]
        for day, cantons in ((1, "ag"), (2, "ag"), (3, None), (4, None))
    ]
    # All of the canton; its last day; that and the other canton; the last days of both.
    assert taken == [2, 1, 2, 2]
    log = jobs.open_watermark(spark, base)
    assert M.read_watermark(log, "gwr_buildings/AG") == "2024-04-19" and M.read_watermark(log) == "2024-04-19"
    with pytest.raises(ValueError, match="marks"):
        jobs.bronze_ingest(spark, base, second, datetime(2024, 5, 5), marks="none")


# ---- damaged parts --------------------------------------------------------------------------


def test_damaged_parts_are_told_apart(spark, tmp_path):
    write(tmp_path / "ag", "a.csv", (1, "AG", 1004, "2024-12-31"), (2, "AG", "", "2024-12-31"))
    write(tmp_path / "be", "a.csv", (3, "BE", 1004, "2024-12-31"))
    with (tmp_path / "be" / "a.csv").open("a") as f:
        f.write("4\tB")
    (tmp_path / "ge").mkdir()
    (tmp_path / "ge" / "a.csv").write_text("EGID\tGDEKT\n5\tGE\n")
    write(tmp_path / "gr", "a.csv", (6, "GR", 1004, "2024-12-31"))
    (tmp_path / "gr" / "b.csv").write_text("EGID\tGSTAT\tGDEKT\tGEXPDAT\n7\t1004\tGR\t2024-12-31\n")
    write(tmp_path / "lu", "a.csv", (8, "LU", 1004, "2024-12-31", "a value too many"))
    write(tmp_path / "zh", "a.csv", *((10 + i, "ZH", 1004, "2024-12-31") for i in range(50)))
    (tmp_path / "vd").mkdir()
    packed = gzip.compress((HEADER + "9\tVD\t1004\t2024-12-31\n" * 5000).encode())
    (tmp_path / "vd" / "a.csv.gz").write_bytes(packed[: len(packed) // 2])
    paths = delimited.canton_paths(str(tmp_path), ["ag", "be", "ge", "gr", "lu", "vd", "zh", "xx"])
    sound, skipped = delimited.sound_parts(spark, paths)
    assert [p.rsplit("/", 1)[1] for p in sound] == ["ag", "ge", "lu", "zh"]
    assert {p.rsplit("/", 1)[1] for p in skipped} == {"be", "gr", "vd", "xx"}
    assert "1 rows with fewer values" in skipped[f"{tmp_path}/be"]
    assert delimited.sound_parts(spark, f"{tmp_path}/ag") == ([f"{tmp_path}/ag"], {})


def test_nothing_of_a_damaged_canton_is_closed(spark, tmp_path):
    base = scratch_path(spark, "base")
    for c, key in (("ag", 1), ("be", 3), ("zh", 5)):
        write(tmp_path / c, "a.csv", (key, c.upper(), 1004, "2024-12-31"), (key + 1, c.upper(), 1004, "2024-12-31"))
    jobs.bronze_from_tsv(spark, base, str(tmp_path), datetime(2024, 2, 1), ["ag", "be", "zh"])
    for c, key in (("ag", 1), ("be", 3), ("zh", 5)):
        write(tmp_path / c, "a.csv", (key, c.upper(), 1004, "2024-12-31"))
    with (tmp_path / "be" / "a.csv").open("a") as f:
        f.write("4")
    # A stray row of the damaged canton in another part does not make it complete.
    with (tmp_path / "zh" / "a.csv").open("a") as f:
        f.write("9\tBE\t1004\t2024-12-31\n")
    out = jobs.bronze_from_tsv(spark, base, str(tmp_path), datetime(2024, 3, 1), ["ag", "be", "zh"], run_id="b")
    assert out["total_written"] == 3 and list(out["skipped"]) == ["BE"]
    [row] = jobs.open_skipped(spark, base).collect()
    assert (row["run_id"], row["part"]) == ("b", f"{tmp_path}/be") and "fewer values" in row["reason"]
    jobs.silver_pending(spark, base, datetime(2024, 4, 1))
    assert versions(spark, base) == [
        (1, 1004, True, False), (2, 1004, False, True), (3, 1004, True, False), (4, 1004, True, False),
        (5, 1004, True, False), (6, 1004, False, True), (9, 1004, True, False),
    ]
    with pytest.raises(FileNotFoundError):
        jobs.bronze_from_tsv(spark, base, str(tmp_path), datetime(2024, 5, 1), ["be", "xx"])


# ---- files and counts of a write ------------------------------------------------------------


def log_rows(spark, n, run_id="r", parts=40):
    rows = spark.range(0, n, 1, parts).selectExpr("id AS egid", "'AG' AS gdekt", "repeat(cast(id AS string), 20) AS strname")
    return stamp_lineage(rows, run_id, datetime(2024, 1, 1), "test", True)


def test_files_of_a_run_follow_from_its_bytes(spark):
    def files(path):
        return len(spark.read.parquet(path).inputFiles())

    path = scratch_path(spark, "small")
    tables.append_bronze(log_rows(spark, 1000), path)
    assert files(path) == 1
    both = log_rows(spark, 500, "a").unionByName(log_rows(spark, 500, "b"))
    path = scratch_path(spark, "both")
    tables.append_bronze(both, path)
    assert files(path) == 2
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "256k")
    try:
        path, small = scratch_path(spark, "large"), log_rows(spark, 10, "c")
        tables.append_bronze(log_rows(spark, 40_000).unionByName(small), path)
        large = spark.read.parquet(path).filter("_run_id = 'r'")
        assert 2 <= len({r[0] for r in large.select(F.input_file_name()).distinct().collect()}) <= 40
        assert spark.read.parquet(path).count() == 40_010
    finally:
        spark.conf.set(advisory, before)


def test_counts_of_a_write_with_a_repeated_task():
    """A task that fails once and is repeated counts its rows once."""
    code = """
import sys
sys.path.insert(0, sys.argv[1])
from datetime import datetime
from pyspark import TaskContext
from pyspark.sql import functions as F
from regchron.functions.lineage import stamp_lineage
from regchron.session import build_session, scratch_path
from regchron.sources import tables
spark = build_session("retry", "local[2,3]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false")
spark.sparkContext.setLogLevel("OFF")
from pyspark.sql.functions import udf
@udf("bigint")
def once(x):
    if x == 77 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")
    return x
rows = spark.range(0, 100, 1, 4).select(once("id").alias("egid"), F.lit("AG").alias("gdekt"))
stamped = stamp_lineage(rows, "r", datetime(2024, 1, 1), "t", True, 10, mark_batches="first")
path = scratch_path(spark, "retry")
print("COUNTS", sorted(tables.publish_run(stamped, path, [F.count_if("first").alias("batches")], ["first"]).items()), spark.read.parquet(path).count())
from regchron.sources.store import HistoryStore
from regchron.operators.staging import build_staging
from regchron.operators.history import merge_measures
store = HistoryStore(spark, scratch_path(spark, "silver"), buckets=2)
log = tables.read_bronze(spark, path)
staged = build_staging(log).withColumn("record_hash", F.concat(F.col("record_hash"), once("egid").cast("string")))
print("MERGED", store.merge(staged.repartition(3), datetime(2024, 1, 2), staging_rows=100)["records_inserted"], store.current().count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, timeout=300)
    assert "COUNTS [('batches', 12), ('keyed', 100), ('written', 100)] 100" in done.stdout, done.stderr[-2000:]
    assert "MERGED 100 100" in done.stdout, done.stderr[-2000:]


def test_a_partial_increment_reads_its_buckets_only(spark):
    base = scratch_path(spark, "base")
    full = registry(spark, *(dict(egid=i, gdat="2024-01-01", gvol=float(i)) for i in range(1, 500)))
    jobs.refresh(spark, base, full, datetime(2024, 2, 1), full_load=True)
    store = jobs.open_history(spark, base)
    few = full.filter("egid IN (7, 8)").drop("gvol").withColumn("gstat", F.lit(1007)).withColumn("gdat", F.lit("2024-03-01"))
    bucket = F.pmod(F.hash(F.col("egid").cast("bigint")), F.lit(8))
    wanted = {r[0] for r in few.select(bucket).collect()}
    assert store.touched(few, 2) == wanted
    jobs.refresh(spark, base, few, datetime(2024, 4, 1))
    after = store.head()["current_at"]
    assert {int(b) for b, v in after.items() if v == 1} == wanted and len(after) == 8
    rows = {r["egid"]: (r["gstat"], r["gvol"]) for r in store.current().filter("egid < 10").collect()}
    assert rows[7] == (1007, 7.0) and rows[9] == (1004, 9.0)
    # The scan behind such a read opens the touched buckets' files and no others.
    read = store.current(wanted).select("egid", "gvol")
    assert read.count() < 499
    files = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files} == wanted and all("v=1" in f for f in files)
