"""Tab-separated registry extracts and comma-separated business records."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regchron.functions.columns import to_int, to_type
from regchron.schema import CANTONS, KEY, RECORD_SCHEMA, REGISTRY_SCHEMA, tsv_name

log = logging.getLogger(__name__)

TSV_OPTIONS = {
    "sep": "\t",
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
}


def coerce_registry(
    raw: DataFrame, names: Mapping[str, str] | None = None, strict: bool = False
) -> DataFrame:
    """Raw text columns as typed registry columns; a column the extract lacks is NULL.

    Rows without a usable key (none, unreadable, or 0) are dropped.
    """
    have = set(raw.columns)
    columns = []
    for f in REGISTRY_SCHEMA:
        header = names.get(f.name) if names is not None else tsv_name(f.name)
        kind = f.dataType.simpleString()
        if header in have:
            columns.append(to_type(F.col(f"`{header}`"), kind, strict).alias(f.name))
        else:
            columns.append(F.lit(None).cast(kind).alias(f.name))
    return raw.select(*columns).filter(F.col(KEY) != 0)


def canton_paths(
    base: str, cantons: str | Sequence[str] = "all", layout: str = "{canton}"
) -> list[str]:
    """Folder of each canton's extract; ``"all"`` stands for all of them.

    ``layout="kanton={canton}"`` fits extracts that were written partitioned.
    """
    if isinstance(cantons, str):
        cantons = CANTONS if cantons.lower() == "all" else [cantons]
    return [f"{base.rstrip('/')}/{layout.format(canton=c.lower())}" for c in cantons]


def _headers(
    spark: SparkSession, paths: Sequence[str], skip_failing: bool, skipped: dict[str, str] | None = None
) -> dict[str, list[str]]:
    """Column names of each part, from the first line of one of its files."""

    def header(path: str) -> tuple[str, list[str] | None]:
        try:
            return path, spark.read.options(**TSV_OPTIONS).csv(path).columns
        except AnalysisException as error:
            if not skip_failing:
                raise
            log.error("extract %s skipped: %s", path, error)
            if skipped is not None:
                skipped[path] = _reason(error)
            return path, None

    with ThreadPoolExecutor(max_workers=8) as pool:
        found = dict(pool.map(header, paths))
    return {path: names for path, names in found.items() if names is not None}


def _reason(error: Exception) -> str:
    """First line of an error's message, which is enough to find the file."""
    return (str(error).strip().splitlines() or [type(error).__name__])[0][:500]


def _same_place(path: str) -> str:
    """A path as the file metadata has it, without scheme and escapes."""
    return unquote(urlparse(path).path).rstrip("/")


_DAMAGED = "_damaged"


def _short_rows(
    spark: SparkSession, names: Sequence[str], members: Sequence[str], multi_line: bool
) -> dict[str, str]:
    """Parts that cannot be used, among those with one header, and why.

    One pass over all of them counts, per folder, the rows with fewer values than the header
    has. If the pass itself fails, its parts are looked at one by one.
    """
    fields = [*names, _DAMAGED]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    reader = spark.read.options(
        **TSV_OPTIONS, enforceSchema=False, multiLine=multi_line, columnNameOfCorruptRecord=_DAMAGED, columnPruning=False
    )
    rows = reader.schema(schema).csv(list(members))
    file = F.col("_metadata.file_path")
    short = F.size(F.split(F.col(_DAMAGED), "\t")) < len(names)
    counts = rows.groupBy(file.alias("file")).agg(F.count_if(short).alias("short"), F.count(f"`{names[0]}`").alias("n"))
    folders = counts.groupBy(F.regexp_replace("file", "/[^/]*$", "").alias("folder"))
    first = F.min(F.when(F.col("short") > 0, F.col("file")))
    try:
        found = folders.agg(F.sum("short").alias("short"), F.sum("n").alias("n"), first.alias("file"))
        bad = [r for r in found.collect() if r["short"]]
    except AnalysisException:
        raise
    except Exception as error:  # a part may fail in any way, and only that part is to be left out
        if len(members) == 1:
            return {members[0]: _reason(error)}
        with ThreadPoolExecutor(max_workers=8) as pool:
            found = pool.map(lambda m: _short_rows(spark, names, [m], multi_line), members)
        return {part: reason for one in found for part, reason in one.items()}
    damaged = {}
    for r in bad:
        place = _same_place(r["file"])
        part = next(m for m in members if place == _same_place(m) or place.startswith(_same_place(m) + "/"))
        damaged[part] = f"{r['short']} rows with fewer values than the header in {place}"
    return damaged


def sound_parts(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> tuple[list[str], dict[str, str]]:
    """The parts that can be read whole, and the others with what is wrong with them.

    A part is left out as a whole: if it is not there, if a file of it cannot be read or has
    another header, or if a row has fewer values than the header, as a file that broke off has.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    skipped: dict[str, str] = {}
    headers = _headers(spark, paths, True, skipped)
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, names in headers.items():
        groups.setdefault(tuple(names), []).append(path)
    for names, members in groups.items():
        if not names:
            skipped |= {m: "no header" for m in members}
            continue
        skipped |= _short_rows(spark, names, members, multi_line)
    for path in skipped:
        log.error("extract %s skipped: %s", path, skipped[path])
    return [p for p in paths if p not in skipped], skipped


def read_registry_tsv(
    spark: SparkSession,
    paths: str | Sequence[str],
    strict: bool = False,
    skip_failing: bool = True,
    skip_corrupt: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Extract files as registry rows.

    Each path is one part (a canton's folder or file). Parts with the same header are one scan,
    others are united by column name; a file whose header differs from its part's fails the
    job. A part that is not there is logged and left out if others are, so a later merge must
    limit its deletions to the parts loaded. ``skip_corrupt`` leaves out what cannot be read of
    damaged files. Values with line breaks need ``multi_line``, at the price of files that
    cannot be split.
    """
    headers = _headers(spark, [paths] if isinstance(paths, str) else paths, skip_failing)
    if not headers:
        raise FileNotFoundError(f"none of the extracts could be read: {paths}")
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, names in headers.items():
        groups.setdefault(tuple(names), []).append(path)
    reader = spark.read.options(
        **TSV_OPTIONS, enforceSchema=False, multiLine=multi_line, ignoreCorruptFiles=skip_corrupt
    )
    parts = []
    for names, members in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        parts.append(reader.schema(schema).csv(members))
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return coerce_registry(raw, strict=strict)


def read_records_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Business records: ``egid`` is required, the other columns of the schema are optional.

    Read as text by header name and then typed, so that ``plz`` keeps its form and a missing
    number is NULL.
    """
    raw = spark.read.csv(
        path, sep=sep, header=True, quote='"', escape='"', encoding="UTF-8", mode="PERMISSIVE"
    )
    if KEY not in raw.columns:
        raise ValueError(f"the column {KEY} is required, found {raw.columns}")
    columns = []
    for f in RECORD_SCHEMA:
        kind = f.dataType.simpleString()
        if f.name not in raw.columns:
            columns.append(F.lit(None).cast(kind).alias(f.name))
        elif kind == "string":
            columns.append(F.col(f.name))
        else:
            columns.append(to_int(f.name, kind).alias(f.name))
    return raw.select(*columns)
