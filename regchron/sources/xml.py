"""Registry responses: a column of XML documents becomes flat registry rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regchron.functions.columns import to_double, to_int
from regchron.schema import KEY

# ---- fixed values: element names of a response --------------------------------------------
STATUS_OK = "100"
GERMAN = "9901"
# ---- end of fixed values ------------------------------------------------------------------


def _items(name: str, fields: str) -> str:
    """A repeated element, either directly below its parent or inside a ``...List`` element."""
    array = f"{name}Item:array<struct<{fields}>>"
    return f"{array},{name}List:struct<{array}>"


_STREET = f"struct<{_items('streetName', 'language:string,descriptionLong:string')}>"
_ENTRANCE = (
    f"struct<buildingEntranceNo:string,street:{_STREET},"
    "locality:struct<swissZipCode:string,placeName:string>,"
    f"{_items('dwelling', 'EWID:string')}>"
)
_BUILDING = (
    "struct<buildingStatus:string,buildingCategory:string,buildingClass:string,"
    "dateOfConstruction:struct<dateOfConstruction:string,periodOfConstruction:string>,"
    "surfaceAreaOfBuilding:string,coordinates:struct<east:string,north:string>,"
    "recordModification:struct<updateDate:string,createDate:string>>"
)
_BUILDING_ITEM = ",".join(
    [
        "EGID:string",
        "municipality:struct<municipalityId:string,municipalityName:string,cantonAbbreviation:string>",
        _items("realestateIdentification", "EGRID:string"),
        f"building:{_BUILDING}",
        _items("buildingEntrance", f"buildingEntrance:{_ENTRANCE},{_items('dwelling', 'EWID:string')}"),
        _items("dwelling", "EWID:string"),
    ]
)
RESPONSE_SCHEMA = f"struct<status:struct<code:string>,{_items('building', _BUILDING_ITEM)}>"
# Of the same documents only what says whether a load needs them.
_DATED = "building:struct<recordModification:struct<updateDate:string>>"
DATE_SCHEMA = f"struct<status:struct<code:string>,{_items('building', _DATED)}>"
_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}


def _all(parent: Column, name: str) -> Column:
    """All elements of a repeated child, from both of its places; empty if there is none."""
    places = [parent[f"{name}Item"], parent[f"{name}List"][f"{name}Item"]]
    return F.concat(*[F.coalesce(p, F.array()) for p in places])


def _first(parent: Column, name: str) -> Column:
    return F.get(_all(parent, name), 0)


def dwelling_count(item: Column) -> Column:
    """Number of dwelling elements anywhere below a building item."""

    def of_entrance(e: Column) -> Column:
        inner = F.coalesce(F.size(_all(e["buildingEntrance"], "dwelling")), F.lit(0))
        return F.size(_all(e, "dwelling")) + inner

    entrances = F.transform(_all(item, "buildingEntrance"), of_entrance)
    return F.size(_all(item, "dwelling")) + F.aggregate(
        entrances, F.lit(0), lambda total, n: total + n
    )


def street_name(names: Column) -> Column:
    """Of a street's name elements the first non-empty German one, else the first of all."""
    german = F.filter(names, lambda n: (n["language"] == GERMAN) & (n["descriptionLong"] != ""))
    described = F.filter(names, lambda n: n["descriptionLong"].isNotNull())
    return F.coalesce(
        F.get(german, 0)["descriptionLong"], F.get(described, 0)["descriptionLong"]
    )


def parse_responses(df: DataFrame, column: str = "response", schema: str = RESPONSE_SCHEMA) -> DataFrame:
    """``df`` without the document and with ``_item``, its first building item.

    Documents that cannot be read, whose status is not 100, or without a building item yield
    no row, as they hold no building.
    """
    others = [c for c in df.columns if c != column]
    # Unfolded from a one-element array, as the optimizer would copy a plain column, and with it
    # the parsing, into every filter that uses it.
    document = F.explode(F.array(F.from_xml(F.col(column), schema, _OPTIONS)))
    return (
        df.select(*others, document.alias("_parsed"))
        .filter(F.col("_parsed.status.code") == STATUS_OK)
        .withColumn("_item", _first(F.col("_parsed"), "building"))
        .filter(F.col("_item").isNotNull())
        .drop("_parsed")
    )


def newer_responses(df: DataFrame, newer_than: str, column: str = "response") -> DataFrame:
    """The responses that a load of what changed after a date may need.

    Left out are those with another status than 100, and those that date all of their buildings, none
    later than that. Only status and dates are parsed for this, which takes a third of the time of the whole
    document; a document that cannot be read stays, and the whole parse decides about it.
    """
    dates = F.transform(
        _all(F.col("_dated"), "building"), lambda b: b["building"]["recordModification"]["updateDate"]
    )
    older = F.forall(dates, lambda d: F.coalesce(d <= F.lit(newer_than), F.lit(False)))
    refused = F.coalesce(F.col("_dated.status.code") != STATUS_OK, F.lit(False))
    document = F.explode(F.array(F.from_xml(F.col(column), DATE_SCHEMA, _OPTIONS)))
    parsed = df.withColumn("_dated", document)
    return parsed.filter(~refused & ~((F.size(dates) > 0) & older)).drop("_dated")


def read_registry_xml(
    df: DataFrame, column: str = "response", schema: str = RESPONSE_SCHEMA, newer_than: str | None = None
) -> DataFrame:
    """Responses as registry rows (the 20 columns this source has); other columns stay.

    With ``newer_than`` documents whose buildings are all dated, none after that date, need not be parsed
    as a whole and may be missing; which rows are newer is still the caller's to decide.
    """
    if newer_than is not None:
        df = newer_responses(df, newer_than, column)
    others = [c for c in df.columns if c != column]
    item = F.col("_item")
    entrances = F.transform(_all(item, "buildingEntrance"), lambda e: e["buildingEntrance"])

    def first_with(part: str) -> Column:
        return F.get(F.filter("_entrances", lambda e: e[part].isNotNull()), 0)[part]

    rows = (
        parse_responses(df, column, schema)
        .withColumn("_entrances", entrances)
        .withColumns({"_street": first_with("street"), "_locality": first_with("locality")})
        .withColumn("_names", _all(F.col("_street"), "streetName"))
    )
    entrance = F.get(F.filter("_entrances", lambda e: e.isNotNull()), 0)
    locality = F.col("_locality")
    building, municipality = item["building"], item["municipality"]
    built, changed = building["dateOfConstruction"], building["recordModification"]
    values = {
        "egid": to_int(item["EGID"], "bigint"),
        "egrid": _first(item, "realestateIdentification")["EGRID"],
        "gdekt": municipality["cantonAbbreviation"],
        "ggdenr": to_int(municipality["municipalityId"]),
        "ggdename": municipality["municipalityName"],
        "strname": street_name(F.col("_names")),
        "deinr": entrance["buildingEntranceNo"],
        "plz4": locality["swissZipCode"],
        "plzname": locality["placeName"],
        "gstat": to_int(building["buildingStatus"]),
        "gkat": to_int(building["buildingCategory"]),
        "gklas": to_int(building["buildingClass"]),
        "gbauj": to_int(built["dateOfConstruction"]),
        "gbaup": to_int(built["periodOfConstruction"]),
        "garea": to_double(building["surfaceAreaOfBuilding"]),
        "ganzwhg": dwelling_count(item),
        "gkode": to_double(building["coordinates"]["east"]),
        "gkodn": to_double(building["coordinates"]["north"]),
        "gdatns": changed["createDate"],
        "gdat": changed["updateDate"],
    }
    return rows.select(*others, *[v.alias(name) for name, v in values.items()])


def read_response_files(
    spark: SparkSession, paths: str | list[str], by_line: bool = False
) -> DataFrame:
    """Landed responses as the column ``response``: one document per file, or one per line."""
    return (
        spark.read.option("ignoreMissingFiles", "true")
        .text(paths, wholetext=not by_line)
        .withColumnRenamed("value", "response")
    )


def lookup_range(
    parsed: DataFrame, lowest: int, highest: int, skip_missing: bool = True
) -> DataFrame:
    """Rows for the keys ``lowest``..``highest``; with ``skip_missing=False`` also the gaps.

    A gap is a row with only the key and ``_not_found``. Both sides are shuffled: Spark estimates
    parsed documents at a fraction of their size, and would broadcast any number of them.
    """
    in_range = parsed.filter(F.col(KEY).between(lowest, highest))
    if skip_missing:
        return in_range
    keys = parsed.sparkSession.range(lowest, highest + 1).withColumnRenamed("id", KEY)
    hits = in_range.withColumn("_found", F.lit(True)).hint("merge")
    return (
        keys.join(hits, KEY, "left")
        .withColumn("_not_found", F.col("_found").isNull())
        .drop("_found")
    )


def range_counts(looked_up: DataFrame) -> DataFrame:
    """One row: keys found and keys missing."""
    return looked_up.agg(
        F.count_if(~F.col("_not_found")).alias("found"),
        F.count_if(F.col("_not_found")).alias("missing"),
    )
