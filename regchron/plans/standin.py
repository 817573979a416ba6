"""Registry-shaped data from the given tables, so that the operators run on all of their rows.

``orders`` is the change log: the customer is the building, an order is a new state of it, and
the orders of a year are one load. Further attributes follow from the customer number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regchron.operators.replay import list_runs, scd2_replay
from regchron.operators.staging import build_staging
from regchron.plans.gold import current_view
from regchron.schema import CANTONS, REGISTRY_COLUMNS, REGISTRY_SCHEMA, tsv_name
from regchron.session import scratch_path
from regchron.sources.tables import estimated_bytes


# Stored bytes of orders whose responses one task makes and reads: some 100,000 documents.
RESPONSE_BYTES = 2 << 20

_KINDS = {f.name: f.dataType.simpleString() for f in REGISTRY_SCHEMA}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_out(df: DataFrame, part_bytes: int | None = None) -> DataFrame:
    """Rows over all cores: the small tables lie in one row group, which is one task.

    With ``part_bytes`` also in parts of about so many stored bytes, for work that takes long per row.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if part_bytes:
        wanted = max(wanted, -(-estimated_bytes(df) // part_bytes))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def _key_mod(divisor: int) -> Column:
    return F.col("o_custkey") % divisor


def registry_rows(orders: DataFrame) -> DataFrame:
    """The 25 registry columns for every order; ``o_orderkey`` and ``o_orderdate`` stay."""
    cantons = ", ".join(f"'{c.upper()}'" for c in CANTONS)
    postcode = "if(o_custkey % 17 != 0, cast(1000 + o_custkey % 9000 as string), null)"
    values = {
        "egid": "o_custkey",
        "egrid": "'CH' || lpad(cast(o_custkey as string), 12, '0')",
        "gdekt": f"array({cantons})[cast(o_custkey % 26 as int)]",
        "ggdenr": "1 + o_custkey % 2000",
        "ggdename": "'Gemeinde ' || cast(1 + o_custkey % 2000 as string)",
        "strname": "o_orderpriority",
        "deinr": "1 + o_custkey % 120",
        "plz4": postcode,
        "plzname": f"'Ort ' || {postcode}",
        "gstat": "case o_orderstatus when 'O' then 1003 when 'F' then 1004 when 'P' then 1001 else 1006 end",
        "gkat": "1010 + 10 * (o_custkey % 5)",
        "gklas": "1110 + o_custkey % 10",
        "gbauj": "if(o_custkey % 11 != 0, 1850 + o_custkey % 170, null)",
        "gbaum": "1 + o_custkey % 12",
        "gbaup": "8011 + o_custkey % 13",
        "gabbj": "if(o_custkey % 19 = 0, 1990 + o_custkey % 30, null)",
        "garea": "o_custkey % 500 + 0.5D",
        "gvol": "if(o_custkey % 7 != 0, o_custkey % 900 * 2.0D, null)",
        "ganzwhg": "floor(o_totalprice / 250000)",
        "gazzi": "o_custkey % 3",
        "gkode": "if(o_custkey % 13 != 0, o_custkey % 50000 + 2600000.25D, null)",
        "gkodn": "if(o_custkey % 13 != 0, o_custkey % 50000 + 1200000.75D, null)",
        "gschutzr": "o_custkey % 2",
        "gdatns": "'2000-01-01'",
        "gdat": "cast(o_orderdate as date)",
    }
    return orders.selectExpr(
        *[f"cast({values[n]} as {kind}) as {n}" for n, kind in _KINDS.items()],
        "o_orderkey",
        "o_orderdate",
    )


def bronze_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log: all orders with lineage; run = year, loaded on the first day of the next one."""
    loaded = "cast(year(o_orderdate) + 1 as string) || '-01-01'"
    return registry_rows(dealt_out(table(spark, sf_dir, "orders"))).selectExpr(
        *REGISTRY_COLUMNS,
        f"{loaded} || 'T00:00:00' as _ingested_at",
        f"{loaded} as _ingestion_date",
        "cast(year(o_orderdate) as string) as _run_id",
        "lpad(cast(o_orderkey as string), 12, '0') as _batch_id",
        "'orders' as _source",
        "true as _is_full_load",
    )


def newest_first() -> list[Column]:
    """Order of the states of a building within a load."""
    return [F.col("gdat").desc(), F.col("_batch_id").desc()]


def staged_runs(log: DataFrame) -> DataFrame:
    """Newest row per building and run."""
    return build_staging(log, order_by=newest_first(), per_run=True)


def staged_run(log: DataFrame, run_id: str) -> DataFrame:
    """Newest row per building of one run."""
    return build_staging(log, run_id=run_id, order_by=newest_first())


def history(spark: SparkSession, sf_dir: str, delete_missing: bool = True) -> DataFrame:
    """The history after all runs."""
    log = bronze_log(spark, sf_dir)
    runs = list_runs(log)
    return scd2_replay(staged_runs(log), runs, delete_missing=delete_missing)


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current view after all runs."""
    return current_view(history(spark, sf_dir))


_STORED: dict[tuple[str, str], str] = {}


def stored_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current view as a stored table, which is how the checks meet it.

    On a plain scan both sides of the join with the records are shuffled for that join, so
    that adaptive execution can split a key with very many records. The table is built once per
    application and folder.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _STORED:
        path = scratch_path(spark, "current")
        current(spark, sf_dir).write.parquet(path)
        _STORED[place] = path
    return spark.read.parquet(_STORED[place])


def business_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One business record per order, with the usual flaws: gaps, other spellings, other values."""

    def every(n: int) -> Column:
        return F.col("o_orderkey") % n == 0

    status = F.col("o_orderstatus")
    priority = F.col("o_orderpriority")
    year = 1850 + _key_mod(170)
    dwellings = F.floor(F.col("o_totalprice") / 250000) + F.col("o_orderkey") % 3
    postcode = F.concat(F.lit(" "), (1000 + _key_mod(9000)).cast("string"), F.lit(" "))
    return dealt_out(table(spark, sf_dir, "orders")).select(
        "o_orderkey",
        F.when(~every(97), F.col("o_custkey")).alias("egid"),
        F.when(every(10), "9999").when((_key_mod(17) != 0) | ~every(2), postcode).alias("plz"),
        F.when(every(41), F.lit(None))
        .when(every(2), F.replace(F.lower(priority), F.lit("-"), F.lit(" ")))
        .otherwise(F.concat(priority, F.lit(".")))
        .alias("strasse"),
        F.when(every(9), F.lit(None))
        .when(every(50), F.lit(1600))
        .when(every(7), year + 1)
        .otherwise(year)
        .cast("int")
        .alias("baujahr"),
        F.when(~every(37), dwellings).cast("int").alias("anzahl_wohnungen"),
        F.when(every(31), F.lit(None))
        .when(status == "O", "Vermietet")
        .when(status == "F", "leer")
        .otherwise("unvermietet")
        .alias("nutzungsart"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log: run = day, canton = kind of event."""
    day = F.col("ts").cast("date").cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("egid"),
        F.col("event_type").alias("gdekt"),
        day.alias("_ingested_at"),
        day.alias("_ingestion_date"),
        F.replace(day, F.lit("-"), F.lit("")).alias("_run_id"),
        F.lit(False).alias("_is_full_load"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as the XML response to a request for its number.

    Every 20th answer says that there is no such building, every 21st holds none, and every
    22nd is broken off.
    """

    def every(n: int) -> Column:
        return F.col("o_orderkey") % n == 0

    def tag(name: str, *content: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), *content, F.lit(f"</{name}>"))

    def leaf(name: str, value: Column) -> Column:
        return F.coalesce(tag(name, value.cast("string")), F.lit(""))

    c = F.col
    name = lambda language, text: tag(
        "streetNameItem", leaf("language", F.lit(language)), leaf("descriptionLong", text)
    )
    dwelling = F.lit("<dwellingItem><EWID>1</EWID></dwellingItem>")
    entrance = tag(
        "buildingEntranceItem",
        tag(
            "buildingEntrance",
            leaf("buildingEntranceNo", c("deinr")),
            tag(
                "street",
                tag(
                    "streetNameList",
                    name("9903", F.concat(F.lit("Rue "), c("strname"))),
                    F.when(every(3), F.lit("")).otherwise(name("9901", c("strname"))),
                ),
            ),
            tag("locality", leaf("swissZipCode", c("plz4")), leaf("placeName", c("plzname"))),
        ),
        F.repeat(dwelling, c("ganzwhg") + 1),
    )
    building = tag(
        "building",
        leaf("buildingStatus", c("gstat")),
        leaf("buildingCategory", c("gkat")),
        leaf("buildingClass", c("gklas")),
        tag(
            "dateOfConstruction",
            leaf("dateOfConstruction", c("gbauj")),
            leaf("periodOfConstruction", c("gbaup")),
        ),
        leaf("surfaceAreaOfBuilding", c("garea")),
        tag("coordinates", leaf("east", c("gkode")), leaf("north", c("gkodn"))),
        tag("recordModification", leaf("updateDate", c("gdat")), leaf("createDate", c("gdatns"))),
    )
    item = tag(
        "buildingItem",
        leaf("EGID", c("o_orderkey")),
        tag(
            "municipality",
            leaf("municipalityId", c("ggdenr")),
            leaf("municipalityName", c("ggdename")),
            leaf("cantonAbbreviation", c("gdekt")),
        ),
        tag(
            "realestateIdentificationList",
            tag("realestateIdentificationItem", leaf("EGRID", c("egrid"))),
        ),
        building,
        tag("buildingEntranceList", entrance),
        F.when(every(2), dwelling).otherwise(F.lit("")),
    )
    head = F.lit('<m:maddResponse xmlns:m="http://www.ech.ch/xmlns/eCH-0206/2" xmlns="http://www.ech.ch/xmlns/eCH-0206/2">')
    code = lambda number: F.lit(f"<status><code>{number}</code></status>")
    tail = F.lit("</m:maddResponse>")
    text = (
        F.when(every(20), F.concat(head, code(300), item, tail))
        .when(every(21), F.concat(head, code(100), tail))
        .when(every(22), F.concat(head, code(100), F.lit("<buildingItem><EGID>")))
        .otherwise(F.concat(head, code(100), tag("buildingList", item), tail))
    )
    rows = registry_rows(dealt_out(table(spark, sf_dir, "orders"), RESPONSE_BYTES))
    return rows.select(F.col("o_orderkey").alias("requested"), text.alias("response"))


def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as raw extract text: blanks around values, empty values, unreadable numbers."""
    rows = registry_rows(dealt_out(table(spark, sf_dir, "orders")))
    columns = [F.lower("gdekt").alias("kanton")]
    for name in REGISTRY_COLUMNS:
        text = F.col(name).cast("string")
        if name == "gbauj":
            text = F.when(F.col("o_orderkey") % 23 == 0, F.lit("n/a")).otherwise(text)
        if name == "strname":
            text = F.concat(F.lit("  "), text, F.lit(" "))
        if name == "gvol":
            text = F.coalesce(text, F.lit("   "))
        if name == "egid":
            text = F.when(F.col("o_orderkey") % 101 == 0, F.lit("")).otherwise(text)
        columns.append(text.alias(tsv_name(name)))
    return rows.select(*columns, F.col("gdat").alias("GEXPDAT"))
