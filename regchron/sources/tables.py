"""The bronze log and other plain Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from regchron.schema import BRONZE_SCHEMA, KEY, SILVER_SCHEMA, WATERMARK_SCHEMA

BRONZE_PARTITIONS = ("_ingestion_date", "_run_id")
# From here on Spark's estimate says that it has none.
_UNKNOWN_BYTES = 1 << 60


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark reaches."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def estimated_bytes(rows: DataFrame) -> int:
    """Spark's estimate from the size of the files read; if there is none, a text cell's size per column and row."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _UNKNOWN_BYTES else rows.count() * 16 * len(rows.columns)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether a table or view of that name is in the catalog."""
    return spark.catalog.tableExists(name)


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``; those it lacks are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def _log_rows(df: DataFrame, helpers: Sequence[str] = ()) -> DataFrame:
    """Stamped rows with the log's columns, those it does not know yet, and helper columns."""
    extra = [df.schema[c] for c in df.columns if c not in BRONZE_SCHEMA.fieldNames() and c not in helpers]
    return aligned(df, T.StructType(BRONZE_SCHEMA.fields + extra + [df.schema[c] for c in helpers]))


def append_bronze(df: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """Append stamped rows to the log and return them; a dry run writes nothing.

    Partitioned by load date and, below it, by run, so that staging a run reads only that run.
    Before they are written the rows of a run are brought together in parts of the session's
    advisory partition size, a large run in several and small ones joined, so that the number of
    files follows from the bytes and not from the number of tasks. Columns the log does not know
    yet are written as well (``read_bronze(merge=True)``).
    """
    rows = _log_rows(df)
    if not dry_run:
        dealt = rows.hint("rebalance", *[F.col(c) for c in BRONZE_PARTITIONS])
        dealt.write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(path)
    return rows


def publish_run(df: DataFrame, path: str, measures: Sequence[Column] = (), helpers: Sequence[str] = ()) -> dict:
    """Write the stamped rows of one run as its partition of the log, and return what was written.

    The partition is replaced as a whole, so a run that is written again is there once. The
    counts (``written``, ``keyed`` and the ``measures``) are observed by the writing tasks, above
    the last shuffle: Spark takes them from one successful attempt of each task. ``helpers`` are
    columns that only the measures need.
    """
    rows = _log_rows(df, helpers).hint("rebalance")
    seen = Observation()
    observed = rows.observe(seen, F.count("*").alias("written"), F.count(KEY).alias("keyed"), *measures)
    writer = observed.drop(*helpers).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*BRONZE_PARTITIONS).parquet(path)
    return seen.get


def read_bronze(spark: SparkSession, *paths: str, merge: bool = False) -> DataFrame:
    """The log, or several logs as one; those that do not exist yet count as empty.

    With ``merge`` columns added later are read too (this looks into all files).
    """
    types = {f.name: f.dataType for f in BRONZE_SCHEMA}
    logs = []
    for path in paths:
        if not path_exists(spark, path):
            continue
        if merge:
            rows = spark.read.option("mergeSchema", "true").parquet(path)
            logs.append(rows.withColumns({c: F.col(c).cast(types[c]) for c in BRONZE_PARTITIONS}))
        else:
            rows = spark.read.schema(BRONZE_SCHEMA).parquet(path)
            logs.append(rows.select(*BRONZE_SCHEMA.fieldNames()))
    if not logs:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a plain Parquet table; ``overwrite`` clears it even if there is nothing to write."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode is append or overwrite, not {mode}")
    df.write.mode(mode).parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table at ``path`` if there is none."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def ensure_tables(spark: SparkSession, base: str, database: str | None = None) -> dict[str, str]:
    """Paths of the base's tables, the plain ones created if missing; also the database."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    paths = {name: f"{base.rstrip('/')}/{name}" for name in ("bronze", "silver", "watermark")}
    ensure_table(spark, paths["bronze"], BRONZE_SCHEMA)
    ensure_table(spark, paths["watermark"], WATERMARK_SCHEMA)
    return paths


def require_not_null(df: DataFrame, schema: T.StructType = SILVER_SCHEMA) -> DataFrame:
    """Fail the job on a NULL in a required column, as a NOT NULL constraint does."""
    checked = {
        f.name: F.expr(
            f"if(`{f.name}` is null, raise_error('NULL in required column {f.name}'), `{f.name}`)"
        )
        for f in schema
        if not f.nullable
    }
    return df.withColumns(checked)
