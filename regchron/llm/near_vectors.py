"""Near-duplicate embeddings through a pivot-permutation index.

A bounded sample of the vectors serves as reference points (pivots). Every vector is described by its
``PREFIX`` nearest pivots in order. The inverted lists are kept by pairs of pivots: a vector stands in
the list of every pair from its prefix, so that two vectors meet in a list exactly if they share at
least two pivots, and in s(s-1)/2 lists if they share s. Pairs that meet are verified by their cosine;
a pair counts in the first list it shares, which both sides know, so no candidate pair is ever written,
shuffled or counted twice.

Lists are short, since pairs of pivots are many. A list longer than ``BLOCK`` is cut into blocks by a
hash of the id and every two blocks meet in one group, so no task holds more than two blocks and nothing
is capped. Groups give back a count per vector and one edge per vector to the least vector of its local
component, not their pairs.

The index is approximate: a link is missed if the two vectors share fewer than two pivots. Recall on the
given tables is measured in the tests. ``PIVOTS`` and ``PREFIX`` are parameters; more pivots make
shorter lists for larger tables.

Defined results: vectors link only if their labels are equal and not null and their lengths agree;
vectors that are null, empty, zero or hold null or non-finite components link with nothing and are
classes of their own; rows that share an id are one vector, the least by label and embedding; rows
without an id are not compared (component null, kept); no rows give no rows. Only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import components, groups, parts, read_table, stored

THRESHOLD = 0.98
PIVOTS = 256
PREFIX = 5
BLOCK = 1500
APART = 0.5
_PAIRS = np.array(list(combinations(range(PREFIX), 2)))

_KEYED = "vec_id bigint, label int, size int, unit array<double>, keys array<int>"


def usable(embedding: str) -> Column:
    """Whether a vector can have a cosine."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def _units(column: pa.ListArray, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    # Scaling by the largest component first keeps very small and very large vectors exact enough.
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _apart(units: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` vectors of which no two are closer than a cosine of ``APART``.

    Pivots out of one dense group would all be nearest to its members, in an order that is noise.
    """
    kept: list[np.ndarray] = []
    for unit in units:
        if len(kept) < most and (not kept or (np.stack(kept) @ unit).max() < APART):
            kept.append(unit)
    return np.stack(kept)


def pivot_keys(units: np.ndarray, pivots: np.ndarray | None, prefix: int = PREFIX) -> np.ndarray:
    """Per vector one key for each pair among its nearest pivots, ascending; key 0 without pivots."""
    if pivots is None or len(pivots) < prefix:
        return np.zeros((len(units), 1), dtype=np.int32)
    near = units @ pivots.T
    order = np.argsort(-near, axis=1, kind="stable")[:, :prefix]
    pairs = _PAIRS if prefix == PREFIX else np.array(list(combinations(range(prefix), 2)))
    one, two = order[:, pairs[:, 0]], order[:, pairs[:, 1]]
    keys = np.minimum(one, two) * len(pivots) + np.maximum(one, two) + 1
    return np.sort(keys, axis=1).astype(np.int32)


def _describe(shared, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == size))
                units = _units(batch.column("embedding").take(at), int(size))
                keys = pivot_keys(units, pivots.get(int(size)), prefix)
                n = len(units)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(at),
                        batch.column("label").take(at),
                        batch.column("size").take(at),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * int(size), pa.int32()), pa.array(units.ravel())),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel())),
                    ],
                    names=["vec_id", "label", "size", "unit", "keys"],
                )

    return run


def _local_least(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id each member reaches through the links a-b of its group."""
    least = ids.copy()
    while True:
        before = least.copy()
        both = np.minimum(least[a], least[b])
        np.minimum.at(least, a, both)
        np.minimum.at(least, b, both)
        if (least == before).all():
            return least


def _group_links(key: int, one: int, two: int, batch: pa.RecordBatch, threshold: float) -> tuple[np.ndarray, ...]:
    """(ids, links, least): counts of links first met in this list, and the least id reached."""
    ids = batch.column("vec_id").to_numpy()
    units = batch.column("unit").flatten().to_numpy().reshape(len(ids), -1)
    keys = batch.column("keys").flatten().to_numpy().reshape(len(ids), -1)
    block = batch.column("block").to_numpy()
    near = units @ units.T >= threshold
    a, b = np.nonzero(np.triu(near, 1))
    if one != two:
        across = block[a] != block[b]
        a, b = a[across], b[across]
    links = np.zeros(len(ids), dtype=np.int64)
    for i in range(0, len(a), 100_000):
        x, y = a[i : i + 100_000], b[i : i + 100_000]
        same = keys[x][:, :, None] == keys[y][:, None, :]
        first = np.where(same.any(axis=2), keys[x], np.iinfo(np.int32).max).min(axis=1) == key
        links += np.bincount(x[first], minlength=len(ids)) + np.bincount(y[first], minlength=len(ids))
    return ids, links, _local_least(a, b, ids)


def _join_lists(threshold: float):
    names = ["label", "size", "key", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            ids, links, least = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
            some = (links > 0) | (least != ids)
            return pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (ids, links, least)], names=["vec_id", "links", "least"])

        def solve(group: pa.Table) -> tuple[np.ndarray, ...]:
            batch = group.combine_chunks().to_batches()[0]
            key, one, two = (batch.column(c)[0].as_py() for c in ("key", "one", "two"))
            return _group_links(key, one, two, batch, threshold)

        for group in groups(batches, names):
            if group.num_rows > 1:
                yield out([solve(group)])

    return run


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("int").alias("label"),
        F.col(embedding).cast("array<double>").alias("embedding"),
    )
    named = rows.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v"))
    named = named.select("vec_id", "v.label", "v.embedding")
    good = named.where(F.col("label").isNotNull() & usable("embedding")).withColumn("size", F.size("embedding"))
    # Candidates for reference points: the vectors with the least hash of their id, a bounded number.
    chosen = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).select("size", "embedding").collect()
    by_size: dict[int, list] = {}
    for row in chosen:
        by_size.setdefault(row.size, []).append(row.embedding)
    points = {
        size: _apart(_units(pa.array(found, pa.list_(pa.float64())), size), pivots) for size, found in by_size.items()
    }
    described = good.mapInArrow(_describe(spark.sparkContext.broadcast(points), prefix), _KEYED)
    described = stored(described, "pivots")
    listed = described.select("vec_id", "label", "size", F.explode("keys").alias("key"))
    lengths = listed.groupBy("label", "size", "key").agg(F.count("*").alias("n")).where("n > 1")
    lengths = lengths.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).drop("n")
    placed = described.withColumn("key", F.explode("keys")).join(lengths, ["label", "size", "key"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    placed = placed.select(
        "label", "size", "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block",
        "vec_id", "unit", "keys",
    )
    order = ["label", "size", "key", "one", "two"]
    met = placed.repartition(parts(spark), *order).sortWithinPartitions(*order)
    met = stored(met.mapInArrow(_join_lists(threshold), "vec_id bigint, links bigint, least bigint"), "links")
    counts = met.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    found = components(met, "vec_id", "least").select(F.col("node").alias("vec_id"), "component")
    ids = named.select("vec_id")
    out = ids.join(counts, "vec_id", "left").join(found, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    out = out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept")
    )
    nameless = rows.where("vec_id IS NULL").selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id", "true AS kept")
    return out.union(nameless)


def op5(spark, sf_dir: str) -> DataFrame:
    """All embeddings."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), degree AS (SELECT x, count(*) AS n FROM links GROUP BY x),
least AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, l.m AS component_id, e.vec_id = l.m AS kept
FROM embeddings e LEFT JOIN degree d ON d.x = e.vec_id LEFT JOIN least l ON l.x = e.vec_id
"""
