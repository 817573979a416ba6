"""Helpers shared by the text operators: stored tables, words of Arrow batches, connected components.

Tokenising works on the bytes of a whole Arrow batch at a time: a table of 256 entries says which
bytes belong to a word, and a rolling polynomial modulo 2**64 gives every word its hash without a
Python object per word. UTF-8 keeps this exact, since all bytes of a non-ASCII character are >= 0x80.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regchron.session import scratch_path

# Bytes of text handled at a time in a task; a single longer text is handled alone. Arrays of words and
# bytes take some fifty times as much, in every Python worker of an executor.
CHUNK_BYTES = 1 << 20
U = np.uint64
BASE = 0x9E3779B97F4A7C17
BASE_INVERSE = pow(BASE, -1, 2**64)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows written once to the shared folder and read back: lineage ends here.

    A lost executor costs no more than the tasks it ran; the folder goes when the driver ends.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_values(seed: int) -> np.ndarray:
    """A random 64-bit value per byte; A-Z share those of a-z."""
    values = mix(np.arange(256, dtype=U) + U(1 + 1000 * seed))
    values[65:91] = values[97:123]
    return values


def byte_set(keep) -> np.ndarray:
    return np.array([bool(keep(b)) for b in range(256)])


# Word bytes: digits, letters, and every byte of a non-ASCII character.
WORD_BYTES = byte_set(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
# Token bytes: all but blanks, 0x20 and 0x09 to 0x0D.
TOKEN_BYTES = byte_set(lambda b: b != 32 and not 9 <= b <= 13)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=U)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that each holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        at = 0
        while at < len(size):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, ...]:
    """Start, end and row of every word; words never cross rows."""
    n = len(data)
    inside = kept[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets[:-1]] = True
    first[n] = True
    before = np.empty(n, dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    total = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(values[data] * powers(BASE, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(BASE_INVERSE, len(data) + 1)[starts])


BYTE_VALUES = byte_values(0)
BYTE_VALUES_2 = byte_values(1)


class Words:
    """The words of the rows of a batch: hash, row, and where each row's words begin (n + 1 entries)."""

    def __init__(self, column: pa.Array, kept: np.ndarray = WORD_BYTES, values: np.ndarray = BYTE_VALUES):
        self.data, self.offsets = text_bytes(column)
        self.starts, self.ends, self.rows = word_spans(self.data, self.offsets, kept)
        self.hashes = span_hashes(self.data, self.starts, self.ends, values)
        self.first = np.searchsorted(self.rows, np.arange(len(self.offsets)))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and index of each run of ``k`` words of a row; a row of fewer words, but not none, is one run."""
        n = len(self.hashes)
        total = np.zeros(n, dtype=U)
        left = self.first[self.rows + 1] - np.arange(n)
        for j in range(k):
            take = left > j
            total[take] += self.hashes[np.flatnonzero(take) + j] * powers(BASE, k)[j]
        at_start = np.arange(n) == self.first[self.rows]
        whole = (left >= k) | at_start
        index = np.flatnonzero(whole)
        return mix(total[index]), index


def hex_of(*parts_: np.ndarray) -> list[bytes]:
    """Fixed-length binary keys from columns of 64-bit hashes."""
    rows = np.ascontiguousarray(np.stack(parts_, axis=1).astype(">u8"))
    return [r.tobytes() for r in rows]


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Connected components of undirected edges: one row (node, component) per node with an edge.

    The component is its smallest node. Alternates large-star and small-star steps, which link every
    node to the least node of its neighbourhood until only stars around the least node are left; the
    number of rounds grows with the logarithm of the size. A step groups with partial aggregation
    and joins on the node, so that a node with very many neighbours is neither collected nor held
    in one task. Null ends and loops are left out.
    """
    edges = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    edges = edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
    current = stored(
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges"
    )
    seen = _fingerprint(current)
    while seen[0]:
        both = current.union(current.select("dst", "src"))
        least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = (
            both.join(least, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        ).distinct()
        large = stored(large, "edges")
        least = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (
            large.join(least, "src")
            .select(F.explode(F.array(F.struct(F.col("dst").alias("src"), F.col("m").alias("dst")), F.struct("src", F.col("m").alias("dst")))).alias("e"))
            .select("e.*")
            .where("src <> dst")
            .distinct()
        )
        current = stored(small, "edges")
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    nodes = current.groupBy("src").agg(F.min("dst").alias("component")).select(F.col("src").alias("node"), "component")
    roots = current.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return nodes.union(roots)


def groups(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal integer keys as one table each; rows come ordered by the keys."""
    pending: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
        cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if last is not None and tuple(marks[a]) != last:
                yield pa.Table.from_batches(pending)
                pending = []
            pending.append(batch.slice(a, b - a))
            last = tuple(marks[a])
    if pending:
        yield pa.Table.from_batches(pending)


def _bucket_numbers(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` buckets a number that Spark's bucketing puts there."""
    span = 16 * n
    while True:
        bucket = F.pmod(F.hash("id"), F.lit(n)).alias("bucket")
        found = {r["bucket"]: r["id"] for r in spark.range(span).groupBy(bucket).agg(F.min("id").alias("id")).collect()}
        if len(found) == n:
            return [found[b] for b in range(n)]
        span *= 2


@contextmanager
def partitioned_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Joins on bucket and text leave the texts in their buckets, and bring the other side there."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def in_task_buckets(rows: DataFrame, n: int, label: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], str]:
    """The rows stored as they are read, with a number ``doc`` and the bucket ``b`` of the task that stored them.

    Rows are not shuffled; what is found out about them is brought to them by joins on (b, doc). Also
    returned are the function that adds ``b`` to rows with ``doc``, and the table's name: the caller drops it
    when it is no longer read. Input of fewer partitions than cores is dealt out.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores)
    slots = F.array(*[F.lit(x).cast("bigint") for x in _bucket_numbers(spark, n)])

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("b", F.get(slots, F.pmod(F.shiftright("doc", 33), F.lit(n)).cast("int")))

    name = f"{label}_{uuid4().hex}"
    writer = placed(rows.withColumn("doc", F.monotonically_increasing_id())).write.bucketBy(n, "b")
    writer.option("compression", "zstd").option("path", scratch_path(spark, label)).saveAsTable(name)
    return spark.table(name), placed, name
