"""The history on disk: bucketed Parquet folders, one pair per merge, and a commit file per merge.

``<base>/data/is_current=true/v=<n>/bucket=<b>``   current rows of the buckets merge n touched
``<base>/data/is_current=false/v=<n>/bucket=<b>``  only the rows that merge n closed
``<base>/commits/<n>``                             written last; without it there is no merge n

Rows are dealt into buckets by Spark's own bucketing on the key, so a merge joins the current rows where they
lie: only the staged rows are shuffled, by bucket, and that one shuffle serves join and write, which leaves
one file per bucket. The bucket is a partition folder as well, and a commit says which merge holds each
bucket's current rows. A merge reads and writes only the buckets that its staged keys fall into (all of them if
it may delete). Closed rows are written once. A merge that dies before its commit leaves the table as it was;
the next one clears what it left. One writer at a time is assumed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Collection, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from regchron.functions.columns import utc
from regchron.operators.history import deletes, merge_measures, scd2_merge
from regchron.schema import KEY, SILVER_SCHEMA
from regchron.sources.tables import estimated_bytes, path_exists, require_not_null

# Staged rows per bucket from which on all buckets count as touched, without looking.
_MANY_PER_BUCKET = 1_000
# A new table gets a bucket for about so many bytes of current rows, and these numbers at least and at most.
BUCKET_BYTES = 128 << 20
_FEWEST, _MOST = 8, 1 << 16
_MANAGED = "spark.sql.hive.manageFilesourcePartitions"

COMMIT_SCHEMA = (
    "version bigint, now string, runs array<string>, buckets int, current_at map<string,bigint>, "
    "closed bigint, deleted bigint, inserted bigint"
)


def buckets_for(size: int) -> int:
    """Number of buckets of a table that begins with so many bytes: a power of two."""
    wanted = -(-size // BUCKET_BYTES)
    return min(_MOST, max(_FEWEST, 1 << max(0, wanted - 1).bit_length()))


class HistoryStore:
    """A history table below ``base`` with the columns of ``schema``.

    ``buckets`` holds for a new table, which otherwise chooses by the size of its first merge; a
    table keeps the number it began with.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        schema: T.StructType = SILVER_SCHEMA,
        keys: Sequence[str] = (KEY,),
        buckets: int | None = None,
    ):
        self.spark = spark
        self.schema = schema
        self.keys = list(keys)
        self.buckets = buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark._jsc.hadoopConfiguration())
        # A relative path would mean one folder to the file system and another one to the catalog.
        self.base = self._fs.makeQualified(self._path(base.rstrip("/"))).toString()
        self._name = f"regchron_{hashlib.sha256(self.base.encode()).hexdigest()[:24]}"

    # -- commits: small files, one per merge --------------------------------------------------

    def head(self) -> dict | None:
        """The last commit."""
        folder = self._path(f"{self.base}/commits")
        if not self._fs.exists(folder):
            return None
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        numbers = [int(name) for name in names if name.isdigit()]
        if not numbers:
            return None
        # A small file, read on the driver: a Spark job for it would take longer than the rest.
        file = self._fs.open(self._path(f"{self.base}/commits/{max(numbers)}"))
        try:
            return json.loads(bytes(file.readAllBytes()).decode("utf-8"))
        finally:
            file.close()

    def commits(self) -> DataFrame:
        """All commits, as a table."""
        if not path_exists(self.spark, f"{self.base}/commits"):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.base}/commits")

    def merged_runs(self) -> DataFrame:
        """(run_id) of the runs that are in the history."""
        return self.commits().select(F.explode("runs").alias("run_id")).distinct()

    def _commit(self, entry: dict) -> None:
        # Created, never replaced: of two writers of one version the second one fails, also on
        # object stores, which have no rename of that kind.
        final = self._path(f"{self.base}/commits/{entry['version']}")
        if self._fs.exists(final):
            raise RuntimeError(f"version {entry['version']} of {self.base} exists already")
        out = self._fs.create(final, False)
        try:
            out.write(bytearray(json.dumps(entry).encode("utf-8")))
        finally:
            out.close()

    # -- reading ------------------------------------------------------------------------------

    def _table(self, count: int, current: bool) -> str:
        """Name of the bucketed table over the whole data folder, or over its current rows."""
        places = ["v", "bucket"] if current else ["is_current", "v", "bucket"]
        kinds = {"is_current": "boolean", "v": "bigint", "bucket": "int"}
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema if f.name != "is_current"]
        columns += [f"{p} {kinds[p]}" for p in places]
        name = f"{self._name}_{'current' if current else 'all'}"
        folder = f"{self.base}/data" + ("/is_current=true" if current else "")
        if self.spark.catalog.tableExists(name):
            self.spark.catalog.refreshTable(name)
            return name
        # The folders say which partitions there are, whichever session wrote them.
        managed = self.spark.conf.get(_MANAGED)
        self.spark.conf.set(_MANAGED, "false")
        try:
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet"
                f" PARTITIONED BY ({', '.join(places)}) CLUSTERED BY ({keys}) INTO {count} BUCKETS"
                f" LOCATION '{folder}'"
            )
        finally:
            self.spark.conf.set(_MANAGED, managed)
        return name

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _current(self, head: dict | None, buckets: Collection[int] | None) -> DataFrame:
        if head is None:
            return self._none()
        held: dict[int, list[int]] = {}
        for bucket, version in head["current_at"].items():
            if buckets is None or int(bucket) in buckets:
                held.setdefault(version, []).append(int(bucket))
        wanted = F.lit(False)
        for version, own in sorted(held.items()):
            wanted = wanted | ((F.col("v") == version) & F.col("bucket").isin(sorted(own)))
        rows = self.spark.table(self._table(head["buckets"], True)).filter(wanted)
        return rows.withColumn("is_current", F.lit(True)).select(*self.schema.fieldNames())

    def _closed(self, head: dict | None) -> DataFrame:
        folder = f"{self.base}/data/is_current=false"
        if head is None or not path_exists(self.spark, folder):
            return self._none()
        places = [T.StructField("v", T.LongType()), T.StructField("bucket", T.IntegerType())]
        rows = self.spark.read.schema(T.StructType(self.schema.fields + places)).parquet(folder)
        rows = rows.filter(F.col("v") <= head["version"])
        return rows.withColumn("is_current", F.lit(False)).select(*self.schema.fieldNames())

    def read(self) -> DataFrame:
        """The whole history as of the last commit."""
        head = self.head()
        return self._closed(head).unionByName(self._current(head, None))

    def current(self, buckets: Collection[int] | None = None) -> DataFrame:
        """Only the current rows, of all buckets or of some."""
        return self._current(self.head(), buckets)

    def closed(self) -> DataFrame:
        """Only the closed rows."""
        return self._closed(self.head())

    # -- writing ------------------------------------------------------------------------------

    def _bucket(self, count: int) -> Column:
        """The number of the file Spark's bucketing puts a row into."""
        return F.pmod(F.hash(*self.keys), F.lit(count)).cast("int")

    def _count(self, head: dict | None, first: DataFrame) -> int:
        """Number of buckets: the table's, or for a new one that of the rows it begins with."""
        if head:
            return head["buckets"]
        return self.buckets or buckets_for(estimated_bytes(first))

    def touched(self, keys: DataFrame, staging_rows: int | None = None) -> set[int] | None:
        """Buckets that a merge of these keys reads and writes, ``None`` for all of them.

        Only the key column of the rows is read; the result has at most one entry per bucket.
        """
        head = self.head()
        if head is None or (staging_rows is not None and staging_rows > _MANY_PER_BUCKET * head["buckets"]):
            return None
        rows = keys.select(self._bucket(head["buckets"]).alias("bucket")).distinct().collect()
        return {r["bucket"] for r in rows}

    def dealt(self, staging: DataFrame) -> DataFrame:
        """Staged rows shuffled by bucket, as the current rows lie: joins with them need no other shuffle."""
        return staging.repartition(self._count(self.head(), staging), *self.keys)

    def _write(self, rows: DataFrame, version: int, count: int, measures: Sequence[Column]) -> dict:
        """Write a version and return the measures.

        Rows come by bucket, so every task writes the file of one bucket. The measures are
        observed in the writing tasks themselves, above the last shuffle: Spark takes them from
        one successful attempt of each task, so a repeated task does not count twice.
        """
        for flag in ("true", "false"):
            self._fs.delete(self._path(f"{self.base}/data/is_current={flag}/v={version}"), True)
        seen = Observation()
        placed = require_not_null(rows, self.schema).withColumns(
            {"v": F.lit(version).cast("bigint"), "bucket": self._bucket(count)}
        )
        columns = [c for c in self.schema.fieldNames() if c != "is_current"] + ["is_current", "v", "bucket"]
        placed.observe(seen, *measures).select(*columns).write.insertInto(self._table(count, False))
        return {c: n or 0 for c, n in seen.get.items()}

    def merge(
        self,
        staging: DataFrame,
        now: datetime,
        delete_scope: str | Column | None = None,
        compare: Sequence[str] | None = None,
        staging_empty: bool | None = None,
        staging_rows: int | None = None,
        run_id: str | None = None,
        touched: Collection[int] | None = None,
        dealt: bool = False,
    ) -> dict:
        """Merge staged rows, publish the result as a new version and return the counts.

        ``touched`` are the buckets of the staged keys, if the caller knows them; a merge that
        may delete works on all. ``staging_rows`` is an upper bound of the staged rows: with very
        many the buckets are not looked up. With ``dealt`` they are shuffled by bucket already.
        """
        if deletes(delete_scope):
            if staging_empty is None:
                staging_empty = staging.isEmpty()
            if staging_empty:
                delete_scope = None
        head = self.head()
        if head and utc(now) < datetime.fromisoformat(head["now"]):
            raise ValueError(f"the last merge was as of {head['now']}, after {now}")
        count = self._count(head, staging)
        if deletes(delete_scope) or head is None:
            touched = None
        elif touched is None:
            touched = self.touched(staging, staging_rows)
        version = head["version"] + 1 if head else 0
        if not dealt:
            staging = staging.repartition(count, *self.keys)
        merged = scd2_merge(self._current(head, touched), staging, now, self.keys, delete_scope, compare)
        found = self._write(merged, version, count, merge_measures(now))
        held = head["current_at"] if head else {}
        mine = range(count) if touched is None else touched
        self._commit(
            {
                "version": version,
                "now": utc(now).isoformat(),
                "runs": [run_id] if run_id else [],
                "buckets": count,
                "current_at": held | {str(b): version for b in mine},
                "closed": found["records_closed"],
                "deleted": found["records_deleted"],
                "inserted": found["records_inserted"],
            }
        )
        return found

    def replace(self, history: DataFrame, now: datetime, runs: Sequence[str] = ()) -> None:
        """Publish a complete history (of a replay) as the first version of an empty table."""
        if self.head():
            raise RuntimeError(f"{self.base} holds a history already")
        closed = ~F.col("is_current")
        measures = [
            F.count_if(closed & ~F.col("dqa_deleted")).alias("closed"),
            F.count_if("dqa_deleted").alias("deleted"),
            F.count("*").alias("inserted"),
        ]
        count = self._count(None, history)
        dealt = history.select(*self.schema.fieldNames()).repartition(count, *self.keys)
        totals = self._write(dealt, 0, count, measures)
        held = {str(b): 0 for b in range(count)}
        entry = {"version": 0, "now": utc(now).isoformat(), "runs": list(runs), "buckets": count}
        self._commit(entry | {"current_at": held} | totals)

    def drop_old_currents(self, keep: int = 2) -> list[str]:
        """Remove the folders of current rows that none of the newest ``keep`` commits refers to."""
        newest = self.commits().orderBy(F.desc("version")).limit(max(keep, 1)).collect()
        needed = {(v, int(b)) for c in newest for b, v in c["current_at"].items()}
        last = max((c["version"] for c in newest), default=-1)
        dropped = []
        for folder in self._fs.globStatus(self._path(f"{self.base}/data/is_current=true/v=*/bucket=*")) or ():
            path = folder.getPath()
            place = (int(path.getParent().getName()[2:]), int(path.getName()[7:]))
            if place not in needed and place[0] <= last and self._fs.delete(path, True):
                dropped.append(path.toString())
        return dropped
