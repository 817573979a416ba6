"""Column sets, Spark schemas and code tables of the building registry preset."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(spec: str, required: tuple[str, ...] = ()) -> T.StructType:
    """Build a StructType from ``name type`` pairs separated by commas."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind], name not in required))
    return T.StructType(fields)


# ---- fixed values -------------------------------------------------------------------------
# Column names and types of the tables, code tables and the names that results have to show.
KEY = "egid"

REGISTRY_SCHEMA = _struct(
    "egid bigint, egrid string, gdekt string, ggdenr int, ggdename string, strname string, "
    "deinr string, plz4 string, plzname string, gstat int, gkat int, gklas int, gbauj int, "
    "gbaum int, gbaup int, gabbj int, garea double, gvol double, ganzwhg int, gazzi int, "
    "gkode double, gkodn double, gschutzr int, gdatns string, gdat string"
)
REGISTRY_COLUMNS = REGISTRY_SCHEMA.fieldNames()
INT_COLUMNS = [f.name for f in REGISTRY_SCHEMA if isinstance(f.dataType, T.IntegerType)]
DOUBLE_COLUMNS = [f.name for f in REGISTRY_SCHEMA if isinstance(f.dataType, T.DoubleType)]

LINEAGE_SCHEMA = _struct(
    "_ingested_at string, _ingestion_date string, _run_id string, _batch_id string, "
    "_source string, _is_full_load boolean"
)
LINEAGE_COLUMNS = LINEAGE_SCHEMA.fieldNames()
BRONZE_SCHEMA = T.StructType(REGISTRY_SCHEMA.fields + LINEAGE_SCHEMA.fields)

SCD2_SCHEMA = _struct(
    "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean, record_hash string, "
    "dqa_deleted boolean, _silver_loaded timestamp_ntz",
    required=("valid_from", "valid_to", "is_current", "record_hash", "dqa_deleted", "_silver_loaded"),
)
SCD2_COLUMNS = SCD2_SCHEMA.fieldNames()
SILVER_SCHEMA = T.StructType(REGISTRY_SCHEMA.fields + SCD2_SCHEMA.fields)

WATERMARK_SCHEMA = _struct("source string, watermark_date date, recorded_at timestamp_ntz")

RUN_SCHEMA = _struct(
    "run_id string, loaded_at string, source string, full_load boolean, cantons string, columns string, "
    "records bigint, keyed bigint, done boolean"
)

SKIPPED_SCHEMA = _struct("run_id string, part string, reason string, seen_at timestamp_ntz")

RECORD_SCHEMA = _struct(
    "egid bigint, plz string, strasse string, baujahr int, anzahl_wohnungen int, nutzungsart string"
)

RESULT_SCHEMA = _struct(
    "check_id string, check_name string, egid bigint, passed boolean, severity string, "
    "detail string, expected string, actual string, checked_at string"
)

# Columns whose change opens a new version, in hashing order.
HASH_COLUMNS = [
    "gstat", "gkat", "gklas", "gbauj", "gbaum", "gbaup", "gabbj", "garea", "gvol", "ganzwhg",
    "gazzi", "gschutzr", "gdekt", "ggdenr", "ggdename", "strname", "deinr", "plz4", "plzname",
    "gkode", "gkodn",
]

# Extract column name where it is not simply the registry name in upper case.
TSV_NAMES = {"plz4": "DPLZ4", "plzname": "DPLZNAME"}

# Columns of the bulk load and their header names; its gdat is the export date.
BULK_COLUMNS = {
    "egid": "EGID", "egrid": "EGRID", "gdekt": "GDEKT", "ggdenr": "GGDENR", "ggdename": "GGDENAME",
    "gstat": "GSTAT", "gkat": "GKAT", "gklas": "GKLAS", "gbauj": "GBAUJ", "gbaum": "GBAUM",
    "gbaup": "GBAUP", "gabbj": "GABBJ", "garea": "GAREA", "gvol": "GVOL", "ganzwhg": "GANZWHG",
    "gazzi": "GAZZI", "gkode": "GKODE", "gkodn": "GKODN", "gschutzr": "GSCHUTZR", "gdat": "GEXPDAT",
}

CANTONS = [
    "ag", "ai", "ar", "be", "bl", "bs", "fr", "ge", "gl", "gr", "ju", "lu", "ne",
    "nw", "ow", "sg", "sh", "so", "sz", "tg", "ti", "ur", "vd", "vs", "zg", "zh",
]

STATUS_LABELS = {
    1001: "Geplant",
    1002: "Bewilligt",
    1003: "Im Bau",
    1004: "Bestehend",
    1006: "Nicht nutzbar",
    1007: "Abgebrochen",
    8: "Nicht realisiert",
}
STATUS_LABEL_DEFAULT = "Unbekannt"

# Planned, approved, under construction - in the short and in the four-digit code list.
UNFINISHED_STATES = [1, 2, 3, 1001, 1002, 1003]

# How street names are compared.
NORMAL_FORMS = {"ä": "ae", "ö": "oe", "ü": "ue", "-": " ", ".": "", ",": ""}

OPEN_END = "9999-12-31 23:59:59"
INITIAL_WATERMARK = "2000-01-01"
WATERMARK_SOURCE = "gwr_buildings"

# What str.strip() removes in Python: the Unicode white space characters.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# ---- end of fixed values ------------------------------------------------------------------


def tsv_name(column: str) -> str:
    """Header name of a registry column in the tab-separated extract."""
    return TSV_NAMES.get(column, column.upper())


def bulk_columns() -> dict[str, str]:
    """Registry column -> header name for the bulk load."""
    return dict(BULK_COLUMNS)
