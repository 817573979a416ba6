"""Watermark and the jobs from end to end."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from regchron.operators import quality as Q, watermark as M
from regchron.plans import gold, jobs
from regchron.schema import REGISTRY_SCHEMA, WATERMARK_SCHEMA
from regchron.session import scratch_path
from regchron.sources import tables


def marks(spark, *rows):
    return spark.createDataFrame(list(rows), WATERMARK_SCHEMA)


def test_watermark_moves_only_forward(spark):
    path, now = scratch_path(spark, "marks"), datetime(2024, 10, 1)
    tables.ensure_table(spark, path, WATERMARK_SCHEMA)

    def log():
        return spark.read.schema(WATERMARK_SCHEMA).parquet(path)

    def move(day):
        tables.write_table(M.advance_watermark(log(), day, now), path)

    assert M.read_watermark(log()) == "2000-01-01"
    for day, expected in (("2024-06-01", "2024-06-01"), ("2024-01-01", "2024-06-01"), ("2024-06-01", "2024-06-01"),
                          ("2024-09-15", "2024-09-15")):
        new = M.advance_watermark(log(), day, now).collect()
        if new:
            tables.write_table(spark.createDataFrame(new, WATERMARK_SCHEMA), path)
        assert M.read_watermark(log()) == expected
    assert log().count() == 2
    assert M.read_watermark(log(), "another source") == "2000-01-01"


@pytest.mark.parametrize(
    "dates, expected",
    [(["2024-08-20", "2024-08-22", "2024-08-21"], date(2024, 8, 21)), ([], date(2000, 1, 1)),
     ([None, ""], date(2000, 1, 1)), (["2024-08-22", "unbekannt"], date(2000, 1, 1))],
)
def test_safe_watermark(spark, dates, expected):
    df = spark.createDataFrame([(d,) for d in dates], "gdat string")
    assert M.safe_watermark(df).first()["watermark_date"] == expected


def test_changed_since_reaches_the_scan(spark):
    path = scratch_path(spark, "rows")
    spark.createDataFrame([("2024-01-01",), ("2024-06-02",), (None,)], "gdat string").write.parquet(path)
    changed = M.changed_since(spark.read.parquet(path), "2024-06-01")
    # A row without a date is new for all one knows.
    assert sorted(map(str, (r[0] for r in changed.collect()))) == ["2024-06-02", "None"]
    assert "GreaterThan(gdat,2024-06-01)" in changed._jdf.queryExecution().executedPlan().toString()
    assert M.changed_since(spark.read.parquet(path), None).count() == 3


def registry(spark, *buildings):
    names = REGISTRY_SCHEMA.fieldNames()
    rows = [tuple(({"gdekt": "AG", "gstat": 1004, "plz4": "5000", "strname": "Weg", "ggdenr": 4001} | b).get(n) for n in names)
            for b in buildings]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def test_refresh_full_then_incremental(spark):
    base = scratch_path(spark, "base")
    first = registry(
        spark, dict(egid=1, gdat="2024-01-10"), dict(egid=2, gdat="2024-02-10", gdekt="ZH"),
        dict(egid=3, gdat="2024-03-10"),
    )
    out = jobs.refresh(spark, base, first, datetime(2024, 4, 1), full_load=True)
    assert out["bronze"]["total_written"] == 3 and out["bronze"]["batch_count"] >= 1
    assert out["silver"]["records_inserted"] == 3
    assert out["gold"]["total_buildings"] == 3 and out["gold"]["kantone"] == 2
    assert M.read_watermark(jobs.open_watermark(spark, base)) == "2024-03-09"

    second = registry(
        spark, dict(egid=1, gdat="2024-01-10"), dict(egid=3, gdat="2024-03-10", gstat=1003),
        dict(egid=4, gdat="2024-04-02"),
    )
    out = jobs.refresh(spark, base, second, datetime(2024, 5, 1))
    assert out["bronze"]["since_date"] == "2024-03-09" and out["bronze"]["total_written"] == 2
    assert (out["silver"]["records_closed"], out["silver"]["records_inserted"], out["silver"]["records_deleted"]) == (1, 2, 0)
    assert spark.table("gold_gwr_current").count() == 4
    assert spark.table("gold_gwr_history").count() == 5
    assert [r["egid"] for r in spark.table("gold_gwr_changes").collect()] == [3]
    assert M.read_watermark(jobs.open_watermark(spark, base)) == "2024-04-01"

    # A full load of one canton closes what is gone there, and only there.
    third = registry(spark, dict(egid=1, gdat="2024-01-10"), dict(egid=4, gdat="2024-04-02"))
    out = jobs.refresh(spark, base, third, datetime(2024, 6, 1), full_load=True)
    assert out["silver"]["records_deleted"] == 1
    current = jobs.open_history(spark, base).current()
    assert sorted(r["egid"] for r in current.collect()) == [1, 2, 4]
    reports = jobs.explore(spark, base)
    assert {name: df.count() for name, df in reports.items()}["runs"] == 3
    assert jobs.max_gdat(spark, base, out["bronze"]["run_id"]) == "2024-04-02"


def test_dry_run_writes_nothing(spark):
    base = scratch_path(spark, "base")
    rows = registry(spark, dict(egid=1, gdat="2024-01-10"), dict(egid=2, gdat="2024-01-11", gdekt="ZH"))
    out = jobs.refresh(spark, base, rows, datetime(2024, 4, 1), dry_run=True, cantons="ag")
    assert out["bronze"]["total_written"] == 1 and out["silver"] == {} and out["gold"] == {}
    assert jobs.open_bronze(spark, base).count() == 0
    assert M.read_watermark(jobs.open_watermark(spark, base)) == "2000-01-01"


def test_pending_runs_are_merged_in_order(spark):
    base = scratch_path(spark, "base")
    for month, status in ((1, 1001), (2, 1003), (3, 1004)):
        rows = registry(spark, dict(egid=1, gdat=f"2024-0{month}-01", gstat=status))
        jobs.bronze_ingest(spark, base, rows, datetime(2024, month, 5), full_load=True)
    merged = jobs.silver_pending(spark, base, datetime(2024, 4, 1))
    assert [m["records_inserted"] for m in merged] == [1, 1, 1]
    spans = jobs.open_history(spark, base).read().orderBy("valid_from").collect()
    assert [(r["gstat"], r["valid_from"].month) for r in spans] == [(1001, 1), (1003, 2), (1004, 4)]
    assert jobs.silver_pending(spark, base, datetime(2024, 5, 1)) == []

    rebuilt = scratch_path(spark, "rebuilt")
    log = jobs.open_bronze(spark, base)
    tables.append_bronze(log, f"{rebuilt}/bronze")
    jobs.rebuild_history(spark, rebuilt, datetime(2024, 4, 1))
    again = gold.change_view(jobs.open_history(spark, rebuilt).read()).first()
    assert again["gstat_history"] == [1001, 1003, 1004]
    assert jobs.silver_pending(spark, rebuilt, datetime(2024, 5, 1)) == []


def test_dqa_job(spark, tmp_path):
    base = scratch_path(spark, "base")
    rows = registry(spark, dict(egid=1, gbauj=1985, ganzwhg=4), dict(egid=2, gstat=1003))
    jobs.refresh(spark, base, rows, datetime(2024, 4, 1), full_load=True)
    records = tmp_path / "r.csv"
    records.write_text("egid,plz,strasse,baujahr,nutzungsart\n1,5000,WEG,1985,leer\n2,8000,Weg,,vermietet\n9,,,1990,\n")
    out = jobs.dqa(spark, base, str(records), date(2024, 5, 1), f"{tmp_path}/out", "ImmoApp", "abc")
    assert (out["total_checks"], out["failed"], out["critical_fails"]) == (15, 4, 2)
    assert out["pass_rate"] == 73.3 and out["source_system"] == "ImmoApp"
    assert {c["check"]: (c["passed"], c["failed"]) for c in out["by_check"]}["[GWR-01] EGID im GWR vorhanden"] == (2, 1)
    [part] = [p for p in (tmp_path / "out" / "summary").iterdir() if p.suffix == ".json" and p.stat().st_size]
    assert json.loads(part.read_text())["run_id"] == "abc"


def _some_results(spark):
    rows = [("A", "eins", i % 3 != 0, "critical" if i % 2 else "warning", i) for i in range(40)]
    rows += [("B", None, i % 5 == 0, "info", i) for i in range(7)] + [("B", "zwei", None, None, 1)]
    return spark.createDataFrame(rows, "check_id string, check_name string, passed boolean, severity string, egid bigint")


def test_written_results_are_compressed(spark, tmp_path):
    results = _some_results(spark)
    totals = jobs.write_report(results, f"{tmp_path}/out", "x", "r", datetime(2024, 5, 1)).first()
    assert (totals["total_checks"], totals["passed"], totals["failed"], totals["critical_fails"]) == (48, 28, 19, 7)
    parts = [p for p in (tmp_path / "out" / "results").iterdir() if p.name.startswith("part-")]
    assert parts and all(p.name.endswith(".json.gz") for p in parts)
    read = spark.read.schema(results.schema).json(f"{tmp_path}/out/results")
    assert sorted(map(str, read.collect())) == sorted(map(str, results.collect()))


def test_reports_from_a_tally_equal_those_from_the_results(spark):
    for results in (_some_results(spark), _some_results(spark).limit(0)):
        counted = Q.tally(results)
        assert counted.count() <= 8
        assert Q.report(counted, "x", "r", weight="n").collect() == Q.report(results, "x", "r").collect()
        one, two = (sorted(map(str, d.collect())) for d in (Q.report_by_check(counted, weight="n"), Q.report_by_check(results)))
        assert one == two


def test_dqa_reads_the_written_results_once(spark, tmp_path, monkeypatch):
    base = scratch_path(spark, "base")
    jobs.refresh(spark, base, registry(spark, dict(egid=1, gbauj=1985)), datetime(2024, 4, 1), full_load=True)
    records = spark.createDataFrame([(1, 1985), (9, 1990)], "egid bigint, baujahr int")
    read = []
    real = type(spark.read).json

    def json_(self, path, *args, **kwargs):
        read.append(str(path))
        return real(self, path, *args, **kwargs)

    monkeypatch.setattr(type(spark.read), "json", json_)
    out = jobs.dqa(spark, base, records, date(2024, 5, 1), f"{tmp_path}/out")
    assert sum(path.endswith("/results") for path in read) == 1 and out["total_checks"] == 10


def test_bulk_and_tsv_jobs(spark, tmp_path):
    base = scratch_path(spark, "base")
    header = "EGID\tGDEKT\tGSTAT\tGDAT\tGEXPDAT\n"
    (tmp_path / "ag").mkdir()
    (tmp_path / "ag" / "gebaeude.csv").write_text(header + "1\tAG\t1004\t2024-01-01\t2024-12-31\n2\tAG\t1004\t2024-01-02\t2024-12-31\n")
    tsv = jobs.bronze_from_tsv(spark, base, str(tmp_path), datetime(2024, 2, 1), "ag")
    assert tsv["total_written"] == 2 and tsv["since_date"] is None
    bulk = jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 1, 1), "AG")
    again = jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 1, 2), "AG")
    assert (bulk["records"], again["records"], bulk["kanton"]) == (2, 0, "AG")
    log = jobs.open_bronze(spark, base)
    assert sorted((r["_source"], r["gdat"]) for r in log.filter("egid = 1").collect()) == [
        ("gwr_zip", "2024-01-01"), ("gwr_zip", "2024-12-31")
    ]
    assert len(jobs.silver_pending(spark, base, datetime(2025, 2, 1))) == 2
    assert jobs.status(spark, base)["total_buildings"] == 2
    assert jobs.status(spark, scratch_path(spark, "nothing")) == {}


def test_published_views_can_be_extended(spark):
    base = scratch_path(spark, "base")
    jobs.refresh(spark, base, registry(spark, dict(egid=1)), datetime(2024, 4, 1), full_load=True)
    history = jobs.open_history(spark, base).read()
    names = gold.publish_views(history, gold.VIEWS | {"own_view": lambda h: h.select(F.count("*").alias("n"))})
    assert "own_view" in names and spark.table("own_view").first()["n"] == 1


def test_a_canton_load_leaves_the_mark(spark):
    base = scratch_path(spark, "base")
    first = registry(spark, dict(egid=1, gdat="2024-01-10"), dict(egid=2, gdat="2024-01-10", gdekt="ZH"))
    jobs.refresh(spark, base, first, datetime(2024, 2, 1), full_load=True)
    second = registry(
        spark, dict(egid=1, gdat="2024-04-20", gstat=1003), dict(egid=2, gdat="2024-03-10", gdekt="ZH", gstat=1003)
    )
    jobs.refresh(spark, base, second, datetime(2024, 5, 1), cantons="ag")
    assert M.read_watermark(jobs.open_watermark(spark, base)) == "2024-01-09"
    jobs.refresh(spark, base, second, datetime(2024, 5, 2))
    assert {r["egid"]: r["gstat"] for r in jobs.open_history(spark, base).current().collect()} == {1: 1003, 2: 1003}


def test_the_latest_state_of_a_run_wins(spark):
    for older in (1001, 1003, 1004, 1007):
        base = scratch_path(spark, "base")
        rows = registry(
            spark, dict(egid=1, gdat="2024-01-01", gstat=older), dict(egid=1, gdat="2024-03-01", gstat=1002), dict(egid=1, gstat=1006)
        )
        jobs.refresh(spark, base, rows, datetime(2024, 4, 1), full_load=True)
        assert jobs.open_history(spark, base).current().first()["gstat"] == 1002


def test_a_source_with_fewer_columns_keeps_the_others(spark):
    base = scratch_path(spark, "base")
    jobs.refresh(spark, base, registry(spark, dict(egid=1, gdat="2024-01-01", gvol=10.0, gazzi=3)), datetime(2024, 2, 1), full_load=True)
    fewer = registry(spark, dict(egid=1, gdat="2024-01-01"), dict(egid=2, gdat="2024-03-01")).drop("gvol", "gazzi")
    out = jobs.refresh(spark, base, fewer, datetime(2024, 4, 1))
    assert (out["silver"]["records_closed"], out["silver"]["records_inserted"]) == (0, 1)
    moved = registry(spark, dict(egid=1, gdat="2024-05-01", gstat=1007)).drop("gvol", "gazzi")
    jobs.refresh(spark, base, moved, datetime(2024, 6, 1))
    row = jobs.open_history(spark, base).current().filter("egid = 1").first()
    assert (row["gstat"], row["gvol"], row["gazzi"]) == (1007, 10.0, 3)
    # The one-pass rebuild falls back to merging for such a log and gives the same.
    again = scratch_path(spark, "again")
    spark.read.parquet(f"{base}/bronze").write.partitionBy("_ingestion_date", "_run_id").parquet(f"{again}/bronze")
    spark.read.parquet(f"{base}/runs").write.parquet(f"{again}/runs")
    jobs.rebuild_history(spark, again, datetime(2024, 6, 1))
    columns = ["egid", "gstat", "gvol", "record_hash", "is_current"]
    one, two = (sorted(map(tuple, jobs.open_history(spark, b).read().select(*columns).collect()), key=str) for b in (base, again))
    assert one == two


def test_a_second_bulk_file_deletes_nothing(spark, tmp_path):
    base = scratch_path(spark, "base")
    header = "EGID\tGDEKT\tGSTAT\tGEXPDAT\n"
    (tmp_path / "ag").mkdir()
    (tmp_path / "ag" / "one.csv").write_text(header + "1\tAG\t1004\t2024-12-31\n2\tAG\t1004\t2024-12-31\n")
    jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 1, 1), "AG")
    (tmp_path / "ag" / "two.csv").write_text(header + "3\tAG\t1004\t2024-12-31\n")
    jobs.bronze_bulk(spark, base, str(tmp_path), datetime(2025, 2, 1), "AG")
    jobs.silver_pending(spark, base, datetime(2025, 3, 1))
    assert sorted(r["egid"] for r in jobs.open_history(spark, base).current().collect()) == [1, 2, 3]


def test_rebuild_equals_merging_one_by_one(spark):
    base = scratch_path(spark, "base")
    loads = [
        ([dict(egid=i, gdat="2024-01-01", gdekt="AG" if i < 3 else "ZH") for i in (1, 2, 3, 4)], True, None),
        ([dict(egid=2, gdat="2024-02-01", gstat=1003)], False, None),
        ([dict(egid=3, gdat="2024-02-02", gdekt="ZH")], True, "zh"),
        ([dict(egid=4, gdat="2024-04-01", gdekt="ZH"), dict(egid=1, gdat="2024-04-01", gstat=1007)], False, None),
        ([dict(egid=1, gdat="2024-05-01", gstat=1007)], True, "ag"),
    ]
    for month, (rows, full, cantons) in enumerate(loads, 1):
        jobs.bronze_ingest(spark, base, registry(spark, *rows), datetime(2024, month, 9), full_load=full, cantons=cantons)
    again = scratch_path(spark, "again")
    spark.read.parquet(f"{base}/bronze").write.partitionBy("_ingestion_date", "_run_id").parquet(f"{again}/bronze")
    spark.read.parquet(f"{base}/runs").write.parquet(f"{again}/runs")
    jobs.silver_pending(spark, base, datetime(2024, 5, 9))
    jobs.rebuild_history(spark, again, datetime(2024, 5, 9))
    one, two = (
        sorted((tuple(r) for r in jobs.open_history(spark, b).read().drop("_silver_loaded").collect()), key=str)
        for b in (base, again)
    )
    assert one == two and any(r[-1] for r in one)


def test_a_merge_cannot_go_back_in_time(spark):
    base = scratch_path(spark, "base")
    jobs.refresh(spark, base, registry(spark, dict(egid=1)), datetime(2024, 4, 1), full_load=True)
    with pytest.raises(ValueError, match="after"):
        jobs.refresh(spark, base, registry(spark, dict(egid=1, gstat=1001)), datetime(2024, 3, 1), full_load=True)


def test_one_bad_date_can_be_left_out_of_the_mark(spark):
    df = spark.createDataFrame([("2024-08-22",), ("unbekannt",)], "gdat string")
    assert M.safe_watermark(df, skip_unreadable=True).first()["watermark_date"] == date(2024, 8, 21)
