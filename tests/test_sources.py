"""Readers, sinks, and the file-once loader."""

from __future__ import annotations

import codecs
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from regchron.operators.watermark import changed_since
from regchron.plans import profile
from regchron.schema import BRONZE_SCHEMA, CANTONS, REGISTRY_COLUMNS, REGISTRY_SCHEMA, bulk_columns, tsv_name
from regchron.session import scratch_path
from regchron.sources import delimited, tables, xml
from regchron.streaming.load_once import load_files_once

NS = 'xmlns="http://www.ech.ch/xmlns/eCH-0206/2"'
GOOD = f"""<?xml version="1.0" encoding="UTF-8"?>
<maddResponse {NS}>
  <status><code>100</code></status>
  <buildingList><buildingItem>
    <EGID>123456</EGID>
    <municipality><municipalityId>4001</municipalityId><municipalityName>Aarau</municipalityName>
      <cantonAbbreviation>AG</cantonAbbreviation></municipality>
    <realestateIdentificationList><realestateIdentificationItem><EGRID>CH123456789012</EGRID>
      </realestateIdentificationItem></realestateIdentificationList>
    <building><buildingStatus>1004</buildingStatus><buildingCategory>1021</buildingCategory>
      <buildingClass>1110</buildingClass>
      <dateOfConstruction><dateOfConstruction>1985</dateOfConstruction>
        <periodOfConstruction>8017</periodOfConstruction></dateOfConstruction>
      <surfaceAreaOfBuilding>240.5</surfaceAreaOfBuilding>
      <coordinates><east>2646123.5</east><north>1249876.0</north></coordinates>
      <recordModification><updateDate>2024-06-20</updateDate><createDate>2005-03-15</createDate>
      </recordModification></building>
    <buildingEntranceList>
      <buildingEntranceItem><buildingEntrance><buildingEntranceNo>12</buildingEntranceNo></buildingEntrance>
        <dwellingList><dwellingItem><EWID>1</EWID></dwellingItem></dwellingList></buildingEntranceItem>
      <buildingEntranceItem><buildingEntrance><buildingEntranceNo>14</buildingEntranceNo>
        <street><streetNameList>
          <streetNameItem><language>9903</language><descriptionLong>Rue de la Gare</descriptionLong></streetNameItem>
          <streetNameItem><language>9901</language><descriptionLong>Bahnhofstrasse</descriptionLong></streetNameItem>
        </streetNameList></street>
        <locality><swissZipCode>5000</swissZipCode><placeName>Aarau</placeName></locality></buildingEntrance>
        <dwellingItem><EWID>1</EWID></dwellingItem><dwellingItem><EWID>2</EWID></dwellingItem>
      </buildingEntranceItem>
    </buildingEntranceList>
  </buildingItem></buildingList>
</maddResponse>"""
PLAIN = (
    "<r><status><code>100</code></status><buildingItem><EGID>20</EGID>"
    "<realestateIdentificationItem><EGRID>CH20</EGRID></realestateIdentificationItem>"
    "<building><buildingStatus>x</buildingStatus></building>"
    "<buildingEntranceItem><buildingEntrance><street><streetNameItem><language>9901</language>"
    "<descriptionLong></descriptionLong></streetNameItem><streetNameItem><language>9902</language>"
    "<descriptionLong>Via Stazione</descriptionLong></streetNameItem></street></buildingEntrance>"
    "</buildingEntranceItem><dwellingItem/></buildingItem></r>"
)
BARE = "<r><status><code>100</code></status><buildingItem><EGID>21</EGID></buildingItem></r>"
NONE = [
    "<r><status><code>200</code></status><buildingItem><EGID>1</EGID></buildingItem></r>",
    "<r><status><code>100</code></status></r>",
    "<r><status><code>100</code></status><buildingItem><EGID>5</EGID>",
    "no document",
    "",
    None,
]


@pytest.fixture(scope="module")
def parsed(spark):
    docs = [(d,) for d in [GOOD, PLAIN, BARE, *NONE]]
    rows = xml.read_registry_xml(spark.createDataFrame(docs, "response string"))
    return {r["egid"]: r.asDict() for r in rows.collect()}


def test_xml_full_document(parsed):
    assert parsed[123456] == dict(
        egid=123456, egrid="CH123456789012", gdekt="AG", ggdenr=4001, ggdename="Aarau",
        strname="Bahnhofstrasse", deinr="12", plz4="5000", plzname="Aarau", gstat=1004, gkat=1021,
        gklas=1110, gbauj=1985, gbaup=8017, garea=240.5, ganzwhg=3, gkode=2646123.5,
        gkodn=1249876.0, gdatns="2005-03-15", gdat="2024-06-20",
    )


def test_xml_without_list_elements_and_with_gaps(parsed):
    assert parsed[20]["egrid"] == "CH20" and parsed[20]["gstat"] is None
    assert parsed[20]["strname"] in ("", "Via Stazione") and parsed[20]["ganzwhg"] == 1
    assert parsed[21]["ganzwhg"] == 0 and parsed[21]["plz4"] is None


def test_xml_documents_that_hold_no_building(parsed):
    assert set(parsed) == {123456, 20, 21}


def test_xml_is_parsed_once(spark):
    rows = xml.read_registry_xml(spark.createDataFrame([(GOOD,)], "response string").repartition(2))
    plan = xml.lookup_range(rows, 1, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 1


def _dated(*dates, status="100", where="buildingList", more=""):
    """A response with a building per date; ``None`` is one without a date."""
    items = "".join(
        f"<buildingItem><EGID>{i}</EGID><building><buildingStatus>1004</buildingStatus><recordModification>"
        f"{'' if d is None else f'<updateDate>{d}</updateDate>'}</recordModification></building>{more}</buildingItem>"
        for i, d in enumerate(dates, 1)
    )
    return f"<r><status><code>{status}</code></status><{where}>{items}</{where}></r>"


def test_older_responses_are_left_out_before_the_whole_parse(spark):
    """What a load since a date takes is the same, but older documents are not parsed as a whole."""
    needed = [
        GOOD, PLAIN, BARE, _dated("2024-05-02"), _dated(None), _dated("no date"), _dated("2024-05-02", "2024-01-01"),
        _dated("2024-01-01", "2024-06-01"), _dated("2024-01-01", None), _dated("2024-05-02T07:00:00"),
        _dated("<![CDATA[2024-05-02]]>"), _dated("2024-01-01", where="updateDate"), "<r><status/><buildingItem/></r>",
        "<r><status><code>100</code></status><buildingItem/></r>", _dated("2024-01-01")[:-5], _dated("2024-01-01", more="&x;"),
        *NONE[1:],
    ]
    older = [
        _dated("2024-05-01"), _dated("2024-05-01", "2023-01-01"), _dated("2024-04-30", more="<!-- 2025 -->text"), _dated("<!-- -->2024-01-01"),
        _dated("2024-01-01").replace("r>", "x:r>").replace("updateDate", "x:updateDate"), _dated("2025-01-01", status="200"),
        _dated("2024-01-01").replace("<buildingList>", "").replace("</buildingList>", ""), _dated("<![CDATA[2024-01-01]]>"), _dated(""),
    ]
    docs = spark.createDataFrame(list(enumerate([*needed, *older])), "n int, response string")
    assert {r["n"] for r in xml.newer_responses(docs, "2024-05-01").collect()} == set(range(len(needed)))
    whole, pushed = (
        sorted(map(str, changed_since(xml.read_registry_xml(docs, newer_than=d), "2024-05-01").collect())) for d in (None, "2024-05-01")
    )
    assert whole == pushed and len(whole) >= 9


def test_response_files_and_key_range(spark, tmp_path):
    for name, text in (("a.xml", GOOD), ("b.xml", PLAIN), ("c.xml", BARE), ("d.xml", NONE[0])):
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows = xml.read_registry_xml(xml.read_response_files(spark, str(tmp_path)))
    found = xml.lookup_range(rows, 19, 22)
    assert sorted(r["egid"] for r in found.collect()) == [20, 21]
    with_gaps = xml.lookup_range(rows, 19, 22, skip_missing=False)
    assert {r["egid"]: r["_not_found"] for r in with_gaps.collect()} == {
        19: True, 20: False, 21: False, 22: True
    }
    assert tuple(xml.range_counts(with_gaps).first()) == (2, 2)


def test_key_range_does_not_broadcast_the_documents(spark, tmp_path):
    (tmp_path / "a.xml").write_text(GOOD, encoding="utf-8")
    rows = xml.read_registry_xml(xml.read_response_files(spark, str(tmp_path)))
    with_gaps = xml.lookup_range(rows, 123450, 123460, skip_missing=False)
    # The estimate for one small file is far below any threshold, as it is for very many documents.
    plan = with_gaps._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert {r["egid"] for r in with_gaps.filter("not _not_found").collect()} == {123456}
    assert with_gaps.count() == 11


RAW = dict(
    egid="123456", egrid="CH123456789012", gdekt="AG", ggdenr="4001", ggdename="Aarau",
    strname=" Bahnhofstrasse ", deinr="12", plz4="5000", plzname="Aarau", gstat="4", gkat="1021",
    gklas="1110", gbauj="1985", gbaum="6", gbaup="8070", gabbj="", garea="240.5", gvol="850.0",
    ganzwhg="4", gazzi="x", gkode="2646123.5", gkodn="1249876.0", gschutzr="1",
    gdatns="2005-03-15", gdat="2024-06-20",
)


def write_tsv(path, rows, columns=tuple(REGISTRY_COLUMNS), extra=(), bom=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        if bom:
            out.write(codecs.BOM_UTF8)
        lines = ["\t".join([*[tsv_name(c) for c in columns], *extra])]
        lines += ["\t".join([*[r[c] for c in columns], *["2024-12-31" for _ in extra]]) for r in rows]
        out.write(("\n".join(lines) + "\n").encode("utf-8"))


def test_tsv_extracts_of_several_cantons(spark, tmp_path, caplog):
    write_tsv(f"{tmp_path}/ag/gebaeude.csv", [RAW, RAW | {"egid": ""}, RAW | {"egid": "0"}, RAW | {"egid": "abc"}])
    fewer = [c for c in reversed(REGISTRY_COLUMNS) if c != "gvol"]
    write_tsv(f"{tmp_path}/zh/gebaeude.csv", [RAW | {"egid": "7", "gdekt": "ZH"}], fewer, bom=False)
    with caplog.at_level("ERROR"):
        rows = delimited.read_registry_tsv(spark, delimited.canton_paths(str(tmp_path), ["AG", "zh", "be"]))
    assert rows.schema.simpleString() == REGISTRY_SCHEMA.simpleString()
    got = {r["egid"]: r for r in rows.collect()}
    assert set(got) == {123456, 7}
    assert got[123456]["strname"] == "Bahnhofstrasse" and got[123456]["gabbj"] is None
    assert got[123456]["gazzi"] is None and got[123456]["garea"] == 240.5
    assert got[7]["gvol"] is None and got[7]["gdekt"] == "ZH" and got[7]["plz4"] == "5000"
    assert "be" in caplog.text and "skipped" in caplog.text
    with pytest.raises(FileNotFoundError):
        delimited.read_registry_tsv(spark, [f"{tmp_path}/be"])
    assert len(delimited.canton_paths("x")) == len(CANTONS) == 26


def test_business_records(spark, tmp_path):
    path = tmp_path / "records.csv"
    path.write_text('egid,plz,baujahr,strasse\n1,05000,1985,"Weg, 3"\n2,,,\n,8001,x,y\n', encoding="utf-8")
    rows = delimited.read_records_csv(spark, str(path)).orderBy("plz").collect()
    by_key = {r["egid"]: r for r in rows}
    assert by_key[1]["plz"] == "05000" and by_key[1]["strasse"] == "Weg, 3" and by_key[1]["baujahr"] == 1985
    assert by_key[2]["plz"] is None and by_key[2]["baujahr"] is None
    assert by_key[None]["baujahr"] is None and by_key[1]["nutzungsart"] is None
    (tmp_path / "bad.csv").write_text("plz\n5000\n")
    with pytest.raises(ValueError):
        delimited.read_records_csv(spark, str(tmp_path / "bad.csv"))


def test_each_extract_file_is_loaded_once(spark, tmp_path):
    src, dst, checkpoint = f"{tmp_path}/src", f"{tmp_path}/log", f"{tmp_path}/checkpoint"
    clean = RAW | {"gazzi": "2"}

    def load(run_id):
        found = load_files_once(spark, src, dst, checkpoint, datetime(2025, 1, 1, 5), run_id=run_id)
        return found["records"]

    write_tsv(f"{src}/a.csv", [clean, clean | {"egid": "2"}], extra=["GEXPDAT"])
    assert load("one") == 2
    assert load("two") == 0
    write_tsv(f"{src}/b.csv", [clean | {"egid": "3"}], extra=["GEXPDAT"])
    assert load("three") == 1
    log = tables.read_bronze(spark, dst)
    got = {r["egid"]: r for r in log.collect()}
    assert set(got) == {123456, 2, 3} and log.count() == 3
    assert got[3]["_batch_id"] == "three_bulk" and got[3]["gdat"] == "2024-12-31"
    assert got[3]["strname"] is None and got[3]["_ingestion_date"] == "2025-01-01"
    write_tsv(f"{src}/c.csv", [RAW | {"egid": "4"}], extra=["GEXPDAT"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load("four")
    assert tables.read_bronze(spark, dst).count() == 3


def test_bulk_columns_leave_out_the_address():
    assert len(bulk_columns()) == 20 and bulk_columns()["gdat"] == "GEXPDAT"


def bronze_rows(spark, run_id, at, keys):
    rows = spark.createDataFrame([(k, "AG") for k in keys], "egid bigint, gdekt string")
    return rows.withColumns(
        {"_run_id": F.lit(run_id), "_ingestion_date": F.lit(at[:10]), "_ingested_at": F.lit(at),
         "_is_full_load": F.lit(True)}
    )


def test_bronze_log(spark):
    path = scratch_path(spark, "log")
    assert tables.read_bronze(spark, path).count() == 0
    tables.append_bronze(bronze_rows(spark, "1e5", "2024-01-01T01:00:00", [1, 2]), path)
    tables.append_bronze(bronze_rows(spark, "00000012", "2024-01-01T02:00:00", [3]), path)
    dry = tables.append_bronze(bronze_rows(spark, "dry", "2024-01-02T02:00:00", [4]), path, dry_run=True)
    assert dry.count() == 1
    log = tables.read_bronze(spark, path)
    assert log.schema.simpleString() == BRONZE_SCHEMA.simpleString()
    assert sorted((r["_run_id"], r["egid"]) for r in log.collect()) == [("00000012", 3), ("1e5", 1), ("1e5", 2)]
    one_run = log.filter(F.col("_run_id") == "1e5")
    assert "PartitionFilters: [isnotnull(_run_id" in one_run._jdf.queryExecution().executedPlan().toString()
    wider = bronze_rows(spark, "wide", "2024-01-03T00:00:00", [9]).withColumn("gwaerzh1", F.lit(7400))
    tables.append_bronze(wider, path)
    merged = {r["egid"]: r["gwaerzh1"] for r in tables.read_bronze(spark, path, merge=True).collect()}
    assert merged == {1: None, 2: None, 3: None, 9: 7400}


def test_the_newest_run_is_the_only_one_opened(spark):
    path = scratch_path(spark, "log")
    tables.append_bronze(bronze_rows(spark, "a", "2024-01-01T01:00:00", [1, 2]), path)
    tables.append_bronze(bronze_rows(spark, "b", "2024-01-02T01:00:00", [3, 4, 5]), path)
    counts = profile.latest_run_counts(tables.read_bronze(spark, path))
    assert [tuple(r) for r in counts.collect()] == [("AG", 3)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "(_run_id" in plan and "= Subquery" in plan.split("PartitionFilters")[1]


def test_write_table(spark):
    path = scratch_path(spark, "table")
    some, none = spark.range(3), spark.range(0)
    tables.write_table(some, path)
    tables.write_table(some, path)
    tables.write_table(none, path)
    assert spark.read.parquet(path).count() == 6
    tables.write_table(none, path, "overwrite")
    assert spark.read.parquet(path).count() == 0
    with pytest.raises(ValueError):
        tables.write_table(some, path, "ignore")


def test_ensure_tables_keeps_what_is_there(spark):
    base = scratch_path(spark, "base")
    paths = tables.ensure_tables(spark, base)
    tables.append_bronze(bronze_rows(spark, "a", "2024-01-01T01:00:00", [1]), paths["bronze"])
    tables.ensure_tables(spark, base)
    assert tables.read_bronze(spark, paths["bronze"]).count() == 1
