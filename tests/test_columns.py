"""Scalar expressions."""

from __future__ import annotations

import hashlib
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from regchron.functions import columns as C
from regchron.functions.lineage import stamp_lineage
from regchron.schema import HASH_COLUMNS, REGISTRY_SCHEMA


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, expected",
    [("123", 123), ("456", 456), (None, None), ("", None), ("abc", None), (" 12\t", 12),
     ("12.5", None), (" 7 ", 7), ("99999999999", None), ("-5", -5)],
)
def test_to_int(spark, text, expected):
    assert one(spark, text, C.to_int) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("1.5", 1.5), ("2", 2.0), (None, None), ("xyz", None), ("", None), ("1e3", 1000.0),
     ("1.5d", None), ("2f", None), ("0x1p3", None), ("inf", float("inf")), (" 3.25 ", 3.25)],
)
def test_to_double(spark, text, expected):
    assert one(spark, text, C.to_double) == expected


def test_strict_cast_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "12x", lambda c: C.to_type(c, "int", strict=True))
    assert one(spark, "", lambda c: C.to_type(c, "int", strict=True)) is None


@pytest.mark.parametrize(
    "a, b",
    [("Zürichstrasse", "Zuerichstrasse"), (" Bahnhof-Str. ", "bahnhof str"),
     ("\tÖlweg,", "oelweg"), ("ÄGERTEN", "aegerten")],
)
def test_norm_text_makes_spellings_equal(spark, a, b):
    assert one(spark, a, C.norm_text) == one(spark, b, C.norm_text)


def test_norm_text_strips_before_it_replaces(spark):
    assert one(spark, "-a-", C.norm_text) == " a "
    assert one(spark, None, C.norm_text) is None


def test_row_hash_is_the_joined_text(spark):
    row = spark.createDataFrame([(1004, None, "a")], "a int, b int, c string")
    got = row.select(C.row_hash(["a", "b", "c"]).alias("h")).first()["h"]
    assert got == hashlib.sha256(b"1004||a").hexdigest()


def test_strict_row_hash_tells_null_from_empty_and_shifted_values(spark):
    rows = spark.createDataFrame(
        [(None, "x"), ("", "x"), ("a|b", "c"), ("a", "b|c"), ("~", "x")], "a string, b string"
    )
    loose = [r[0] for r in rows.select(C.row_hash(["a", "b"])).collect()]
    strict = [r[0] for r in rows.select(C.row_hash(["a", "b"], strict=True)).collect()]
    assert loose[0] == loose[1] and loose[2] == loose[3]
    assert len(set(strict)) == 5


def test_hash_columns_are_registry_columns():
    names = set(REGISTRY_SCHEMA.fieldNames())
    assert len(HASH_COLUMNS) == 21
    assert names - set(HASH_COLUMNS) == {"egid", "egrid", "gdatns", "gdat"}


@pytest.mark.parametrize(
    "code, label",
    [(1001, "Geplant"), (1004, "Bestehend"), (1007, "Abgebrochen"), (8, "Nicht realisiert"),
     (1005, "Unbekannt"), (None, "Unbekannt")],
)
def test_status_label(spark, code, label):
    assert one(spark, code, C.status_label, "int") == label


def test_pct_diff(spark):
    df = spark.createDataFrame([(10, 4), (4, 4), (3, 0), (None, 2)], "a int, b int")
    got = [r[0] for r in df.select(C.pct_diff("a", "b")).collect()]
    assert got == [150.0, 0.0, 300.0, None]


def test_dates(spark):
    assert one(spark, "2024-08-22T10:00", C.day_before) == "2024-08-21"
    assert one(spark, "unbekannt", C.day_before) is None
    assert one(spark, "2024-03-01", C.mutation_year) == 2024
    assert one(spark, "kein Datum", C.mutation_year) is None


def test_days_valid(spark):
    df = spark.sql("select timestamp_ntz'2024-01-15' f, timestamp_ntz'9999-12-31 23:59:59' t")
    open_days, capped = df.select(
        C.days_valid("f", "t"), C.days_valid("f", "t", "2024-01-20")
    ).first()
    assert open_days == (datetime(9999, 12, 31) - datetime(2024, 1, 15)).days
    assert capped == 5


def test_lineage(spark):
    rows = spark.range(2500, numPartitions=1).withColumnRenamed("id", "egid")
    stamped = stamp_lineage(rows, "0a1b2c3d", datetime(2024, 5, 6, 7, 8), "gwr_api", True)
    batches = stamped.groupBy("_batch_id").count().orderBy("_batch_id").collect()
    assert [tuple(b) for b in batches] == [
        ("0a1b2c3d_0000", 1000), ("0a1b2c3d_0001", 1000), ("0a1b2c3d_0002", 500)
    ]
    first = stamped.first()
    assert first["_ingested_at"] == "2024-05-06T07:08:00"
    assert first["_ingestion_date"] == "2024-05-06"
    spread = stamp_lineage(rows.repartition(3), "r", datetime(2024, 1, 1), "s", False)
    assert spread.groupBy("_batch_id").count().agg(F.max("count")).first()[0] <= 1000


def test_times_with_a_zone_are_stored_as_utc(spark):
    zurich = timezone(timedelta(hours=2))
    at = spark.range(1).select(C.timestamp(datetime(2024, 6, 1, 12, tzinfo=zurich))).first()[0]
    assert at == datetime(2024, 6, 1, 10)
