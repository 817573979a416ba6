"""Checks, case by case, and their report."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from regchron.functions import checks as K
from regchron.functions.checks import CHECKS, outcome
from regchron.operators import quality as Q
from regchron.operators.lookup import lookup_join, reduced_reference
from regchron.schema import CANTONS, HASH_COLUMNS, RECORD_SCHEMA, RESULT_SCHEMA, STATUS_LABELS, UNFINISHED_STATES
from regchron.session import scratch_path

AS_OF = date(2025, 6, 30)
REFERENCE = "egid bigint, plz4 string, strname string, gbauj int, gstat int, gstat_label string, ganzwhg int"
KNOWN = dict(
    egid=123456, plz4="5000", strname="Bahnhofstrasse", gbauj=1985, gstat=4,
    gstat_label="Bestehend", ganzwhg=4,
)
RECORD = dict(
    egid=123456, plz="5000", strasse="Bahnhofstrasse", baujahr=1985, anzahl_wohnungen=4,
    nutzungsart="vermietet",
)


CASES = [
    ("key_exists", {}, {}, True, True, "critical", ""),
    ("key_exists", {}, {}, False, False, "critical", "nicht im GWR gefunden"),
    ("address_matches", {}, {}, True, True, "warning", ""),
    ("address_matches", {"plz": "8001"}, {}, True, False, "warning", "PLZ: 8001 vs. GWR: 5000"),
    ("address_matches", {"strasse": "Hauptstrasse"}, {}, True, False, "warning", "Strasse: Hauptstrasse"),
    ("address_matches", {"strasse": "Zürichstr."}, {"strname": "zuerichstr"}, True, True, "warning", ""),
    ("address_matches", {"plz": " 5000\t"}, {}, True, True, "warning", ""),
    ("address_matches", {"plz": None}, {"plz4": None}, True, True, "warning", ""),
    ("address_matches", {"plz": None}, {}, True, False, "warning", "PLZ: None vs. GWR: 5000"),
    ("address_matches", {}, {}, False, True, "info", "übersprungen"),
    ("year_plausible", {}, {}, True, True, "warning", ""),
    ("year_plausible", {"baujahr": 1600}, {}, True, False, "warning", "ausserhalb Bereich (1700-2025)"),
    ("year_plausible", {"baujahr": 2099}, {}, True, False, "warning", "ausserhalb Bereich"),
    ("year_plausible", {"baujahr": None}, {}, True, False, "warning", "Kein Baujahr"),
    ("year_plausible", {"baujahr": 1990}, {}, True, False, "warning", "weicht von GWR ab (1985)"),
    ("year_plausible", {}, {"gbauj": None}, True, True, "warning", ""),
    ("year_plausible", {}, {}, False, True, "warning", ""),
    ("year_plausible", {"baujahr": 1699}, {}, False, False, "warning", "ausserhalb"),
    ("status_fits_use", {}, {}, True, True, "critical", ""),
    ("status_fits_use", {}, {"gstat": 3}, True, False, "critical", "GWR-Status 3 (Bestehend)"),
    ("status_fits_use", {}, {"gstat": 1003}, True, False, "critical", "'vermietet'"),
    ("status_fits_use", {"nutzungsart": "leer"}, {"gstat": 1}, True, True, "critical", ""),
    ("status_fits_use", {"nutzungsart": None}, {"gstat": 1}, True, True, "critical", ""),
    ("status_fits_use", {"nutzungsart": "Unvermietet"}, {"gstat": 2}, True, False, "critical", "Unvermietet"),
    ("status_fits_use", {}, {"gstat": None}, True, True, "critical", ""),
    ("status_fits_use", {}, {}, False, True, "info", "übersprungen"),
    ("dwellings_agree", {}, {}, True, True, "warning", ""),
    ("dwellings_agree", {"anzahl_wohnungen": 10}, {}, True, False, "warning", "Abweichung: 10 vs. GWR: 4 (150.0%)"),
    ("dwellings_agree", {"anzahl_wohnungen": 11}, {"ganzwhg": 10}, True, True, "warning", ""),
    ("dwellings_agree", {"anzahl_wohnungen": 1}, {"ganzwhg": 0}, True, False, "warning", "(100.0%)"),
    ("dwellings_agree", {"anzahl_wohnungen": None}, {}, True, True, "info", "nicht in beiden Quellen"),
    ("dwellings_agree", {}, {"ganzwhg": None}, True, True, "info", "nicht in beiden Quellen"),
    ("dwellings_agree", {}, {}, False, True, "info", "übersprungen"),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    """Results of all cases in one run, each case being a building of its own."""
    records, known = [], []
    for number, (_, record, reference, found, *_) in enumerate(CASES, start=1):
        mine = RECORD | record | {"egid": number}
        records.append(tuple(mine[f] for f in RECORD_SCHEMA.names))
        if found:
            known.append(tuple((KNOWN | reference | {"egid": number}).values()))
    results = Q.run_checks(
        spark.createDataFrame(records, RECORD_SCHEMA), spark.createDataFrame(known, REFERENCE), AS_OF
    )
    ids = dict(zip(CHECKS, [f"GWR-0{i}" for i in range(1, 6)]))
    by_id = {(r["egid"], r["check_id"]): r for r in results.collect()}
    return [by_id[number, ids[case[0]]] for number, case in enumerate(CASES, start=1)]


@pytest.mark.parametrize("number", range(len(CASES)))
def test_check(outcomes, number):
    got, (*_, passed, severity, detail) = outcomes[number], CASES[number]
    assert (got["passed"], got["severity"]) == (passed, severity)
    assert detail in got["detail"] if detail else got["detail"] == ""


def test_no_key_and_key_0_are_not_looked_up(spark):
    records = spark.createDataFrame([(None,), (0,), (5,)], "egid bigint")
    reference = spark.createDataFrame(
        [tuple((KNOWN | {"egid": k}).values()) for k in (0, 5)], REFERENCE
    )
    results = Q.run_checks(records, reference, AS_OF, checks=["key_exists"]).collect()
    assert {r["egid"]: r["passed"] for r in results} == {None: False, 0: False, 5: True}
    assert [r["detail"] for r in results if r["egid"] is None] == [
        "EGID None nicht im GWR gefunden oder gelöscht."
    ]


def test_all_checks_in_order_with_the_result_schema(spark):
    records = spark.createDataFrame([(123456,)], "egid bigint")
    reference = spark.createDataFrame([tuple(KNOWN.values())], REFERENCE)
    results = Q.run_checks(records, reference, AS_OF)
    assert results.dtypes == [(f.name, f.dataType.simpleString()) for f in RESULT_SCHEMA]
    assert [r["check_id"] for r in results.collect()] == [f"GWR-0{i}" for i in range(1, 6)]


def test_a_check_can_be_added(spark):
    def has_use(s):
        given = s.record("nutzungsart").isNotNull()
        return outcome("OWN-01", "Nutzungsart vorhanden", given, "info")

    records = spark.createDataFrame([(1, "leer"), (2, None)], "egid bigint, nutzungsart string")
    reference = spark.createDataFrame([], REFERENCE)
    results = Q.run_checks(records, reference, AS_OF, checks=CHECKS | {"own": has_use})
    own = {r["egid"]: r["passed"] for r in results.filter("check_id = 'OWN-01'").collect()}
    assert own == {1: True, 2: False}


def results_of(spark, rows):
    full = [(c, n, 1, p, s, "", None, None, "t") for c, n, p, s in rows]
    return spark.createDataFrame(full, RESULT_SCHEMA)


def test_report(spark):
    three = results_of(
        spark, [("C1", "a", True, "info"), ("C2", "b", True, "info"), ("C3", "c", False, "warning")]
    )
    row = Q.report(three, "test", "abc").first()
    assert (row["total_checks"], row["failed"], row["critical_fails"]) == (3, 1, 0)
    assert row["pass_rate"] == 66.7
    critical = Q.report(results_of(spark, [("C1", "a", False, "critical")])).first()
    assert critical["critical_fails"] == 1
    empty = Q.report(results_of(spark, [])).first()
    assert (empty["pass_rate"], empty["total_checks"]) == (0.0, 0)


def test_report_by_check_takes_the_most_severe_level(spark):
    rows = [("C1", "a", True, "info"), ("C1", "a", False, "critical"), ("C1", "a", True, "warning"),
            ("C1", "short", True, "info")]
    got = {r["check"]: tuple(r)[1:] for r in Q.report_by_check(results_of(spark, rows)).collect()}
    assert got == {"[C1] a": (2, 1, "critical"), "[C1] short": (1, 0, "info")}


def test_salted_lookup_gives_the_same_rows(spark):
    """One key holds most records, some of them copies; some records have no key."""
    keys = [7] * 600 + list(range(50)) + [None] * 40
    records = spark.createDataFrame([(k, i % 5) for i, k in enumerate(keys)], "k bigint, v int")
    reference = spark.createDataFrame([(k, f"r{k}") for k in range(0, 50, 2)] + [(7, "r7")], "rk bigint, name string")
    plain = lookup_join(records, reference, "k", "rk", salted=False)
    salted = lookup_join(records, reference, "k", "rk", rows_per_salt=10, salted=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))
    assert salted.count() == len(keys)


def test_a_reduced_reference_gives_the_same_rows(spark):
    """Few keys of a large reference: the others go before the shuffle, and no match is lost."""
    path = scratch_path(spark, "reference")
    spark.range(50_000).selectExpr("id AS rk", "concat('r', id) AS name").write.parquet(path)
    reference = spark.read.parquet(path)
    keys = [7] * 30 + list(range(0, 60_000, 500)) + [None, None, -3]
    records = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v int")
    plain = lookup_join(records, reference, "k", "rk", reduce=False)
    for salted in (False, True):
        reduced = lookup_join(records, reference, "k", "rk", salted=salted, reduce=True)
        assert sorted(map(str, reduced.collect())) == sorted(map(str, plain.collect()))
    few = reduced_reference(reference, "rk", records, "k")
    assert 101 <= few.count() <= 110
    # One slot for all keys lets everything through, and still nothing is lost.
    assert reduced_reference(reference, "rk", records, "k", slots=64).count() > 40_000
    assert reduced_reference(reference, "rk", records.filter("v < 0"), "k").count() == 0
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        joined = lookup_join(records, reference, "k", "rk", reduce=True)
        lines = joined._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set(threshold, before)
    # From the top: the join, its shuffle of the reference, below that the filter, then the scan.
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "rk#" in line)
    filtered = next(i for i, line in enumerate(lines) if "getbit" in line or "bit_get" in line)
    shuffle = max(i for i, line in enumerate(lines[:scan]) if "Exchange hashpartitioning(rk#" in line)
    assert shuffle < filtered < scan


def test_salt_spreads_a_frequent_key(spark):
    """Without run-time splitting the session gets the salted plan by itself."""
    records = spark.range(1000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("v"))
    reference = spark.createDataFrame([(7, "x")], "rk bigint, name string")
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plan = lookup_join(records, reference, "k", "rk")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)
    assert "_salt" in plan
    assert "_salt" not in lookup_join(records, reference, "k", "rk")._jdf.queryExecution().toString()


def test_a_key_with_a_third_of_the_records_is_split(spark):
    """With a stored reference both sides are shuffled for the join, so its hot partition is split."""
    path = scratch_path(spark, "reference")
    numbers = spark.range(1, 2001)
    numbers.selectExpr(
        "id as egid", "'5000' as plz4", "'Weg' as strname", "1985 as gbauj", "4 as gstat", "'Bestehend' as gstat_label", "4 as ganzwhg"
    ).write.parquet(path)
    records = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 7L, 1 + id % 2000) as egid", "'5000' as plz", "'Weg ' || id as strasse", "1985 as baujahr",
        "4 as anzahl_wohnungen", "'leer' as nutzungsart",
    )
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        results = Q.run_checks(records, spark.read.parquet(path), AS_OF)
        assert results.groupBy("check_id").count().agg(F.sum("count")).first()[0] == 300_000
        results.write.format("noop").mode("overwrite").save()
        joined = Q.lookup_join(records, spark.read.parquet(path).withColumnRenamed("egid", "ref"), "egid", "ref")
        assert len(joined.collect()) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_fixed_values():
    """Values that results have to show, spelt out once more."""
    assert (K.EXISTS_NAME, K.ADDRESS_NAME, K.YEAR_NAME, K.STATUS_NAME, K.DWELLINGS_NAME) == (
        "EGID im GWR vorhanden", "Adresse korrekt (PLZ + Strasse)", "Baujahr plausibel und GWR-konform",
        "Gebäudestatus konsistent mit Nutzung", "Anzahl Wohnungen konsistent (±10%)",
    )
    assert K.SKIPPED_TEXT == "Kein GWR-Record vorhanden — Check übersprungen."
    assert K.NOT_FOUND_TEXT % 7 == "EGID 7 nicht im GWR gefunden oder gelöscht."
    assert K.YEAR_RANGE_TEXT % (1600, 1700, 2025) == "Baujahr 1600 ausserhalb Bereich (1700-2025)"
    assert K.YEAR_DIFFERS_TEXT % (1990, 1985) == "Baujahr 1990 weicht von GWR ab (1985)"
    assert STATUS_LABELS[1001] == "Geplant" and STATUS_LABELS[1004] == "Bestehend" and len(STATUS_LABELS) == 7
    assert len(CANTONS) == 26 and HASH_COLUMNS[0] == "gstat" and HASH_COLUMNS[-1] == "gkodn" and len(HASH_COLUMNS) == 21
    assert UNFINISHED_STATES == [1, 2, 3, 1001, 1002, 1003]
