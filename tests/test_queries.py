"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from regchron.plans import catalog, standin
from regchron.plans.catalog import QUERIES
from tools.compare import rows_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


def write_orders(spark, folder, n):
    orders = spark.range(n).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "id * 1.0D AS o_totalprice",
        "timestamp '2000-05-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    )
    orders.coalesce(1).write.parquet(f"{folder}/orders.parquet")


def test_landed_responses_are_compressed(spark, tmp_path, monkeypatch):
    write_orders(spark, tmp_path, 200)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    out = catalog.responses_job(spark, str(tmp_path)).first()
    answered = [i for i in range(200) if i % 20 and i % 21 and i % 22]
    assert (out["total_written"], out["watermark"]) == (len(answered), "2000-04-30")
    landed = [p for p in (tmp_path / "jobs" / "responses").iterdir() if p.name.startswith("part-")]
    assert landed and all(p.name.endswith(".txt.gz") for p in landed)


def test_responses_are_dealt_out_by_stored_bytes(spark, tmp_path, monkeypatch):
    write_orders(spark, tmp_path, 3000)
    [part] = [p for p in (tmp_path / "orders.parquet").iterdir() if p.suffix == ".parquet"]
    monkeypatch.setattr(standin, "RESPONSE_BYTES", part.stat().st_size // 20)
    texts = standin.responses(spark, str(tmp_path))
    sizes = [r["count"] for r in texts.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 20 and sum(sizes) == 3000 and max(sizes) <= 300
