"""Removal of repeated word sequences by recompression.

A word goes if it lies in a window of ``WINDOW`` words that also starts in a document with a smaller id.

Recompression shortens every text in rounds. A round first replaces each maximal run of one symbol by a
symbol for (symbol, length), then deals the symbols to two sides by their hash and replaces each left one that
is followed by a right one by a symbol for the pair. Names are global: a name is a 64-bit hash of what it
stands for, so all tasks give the same run or pair the same name, with no dictionary to be passed around, and
Spark's shuffles find out which names are shared. Every symbol carries the range of words that its being there
depends on, and a window *sees* the symbols whose range lies inside it; equal windows see the same symbols at
the same places, wherever they stand.

1. A window's anchor is, of the symbols it sees at the highest level, the one of least hash (the first of
   equals). A window without one falls back by levels, at last to its words. The anchor's name and the half
   window of words after it, or before it if more of the window lies there, make a key that equal windows
   share. Consecutive windows with one anchor and one side are one row.
2. The rows of a key meet, sorted by text; only keys of two texts can hold a repetition, and their rows go back
   to the texts.
3. There each row gets the hashes of its windows, the rows of a key meet again, sorted by id, and a window whose
   hash occurs under a smaller id goes. Key and window hash have independent words' hashes, 128 bits together.

Texts of equal words are examined once, under their least id: in the others all windows repeat. What bounds
memory: texts are read 4 MB at a time (a longer text alone); the rows of a key are dealt into pieces of
``PIECE``, each piece is compared in itself, and what is left of keys with several pieces is compared across them
by partial aggregation on the windows' hashes. Whether a key is shared is found out while its rows stream past.

Texts are not shuffled: they are stored as they are read, each task's in a bucket of its own, and what is
found out about them is brought there. Intermediate tables lie in the shared folder.

Defined results: null and empty texts have no words, and texts shorter than a window stay whole. Documents with
equal ids are not smaller than each other; each of their texts is judged. A null id is neither smaller nor
greater than any: such a text stays whole and counts for no other. Repeated rows have a result each. Further
columns are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import (
    BASE,
    BASE_INVERSE,
    TOKEN_BYTES,
    U,
    Words,
    chunks,
    in_task_buckets,
    mix,
    partitioned_by_bucket,
    parts,
    powers,
    read_table,
    span_hashes,
    stored,
)

WINDOW = 13
ROUNDS = 2
PIECE = 4096
BLOCK_WINDOWS = 1 << 18

# Words are compared as they are: capitals count.
_VALUES = mix(np.arange(256, dtype=U) + U(1501))
_VALUES_2 = mix(np.arange(256, dtype=U) + U(1901))

_ROWS = "key bigint, doc bigint, first int"
_SHARED = "doc bigint, first int, salt int"
_CONTEXTS = "key bigint, salt int, id bigint, doc bigint, first int, hashes array<bigint>"
_RUNS = "doc bigint, id bigint, start int, end int, one bigint, two bigint"


class Symbols(NamedTuple):
    """The symbols of one level: name, text, first word, and the words [low, high) each depends on.

    A symbol that depends on where its text begins or ends depends on a word outside of it.
    """

    name: np.ndarray
    row: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _neighbours(s: Symbols, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a symbol follows one of its text; what depends on the symbol before, and on the one after."""
    n = len(s.name)
    follows = np.zeros(n + 1, dtype=bool)
    follows[1:n] = s.row[1:] == s.row[:-1]
    before = np.where(follows[:-1], np.concatenate([s.low[:1], s.low[:-1]]), bounds[s.row] - 1)
    after = np.where(follows[1:], np.concatenate([s.high[1:], s.high[-1:]]), bounds[s.row + 1] + 1)
    return follows[:-1], before, after


def name_runs(s: Symbols, bounds: np.ndarray) -> Symbols:
    """Each maximal run of a symbol as one symbol; it depends on both neighbours' being different."""
    follows, before, after = _neighbours(s, bounds)
    head = np.ones(len(s.name), dtype=bool)
    head[1:] = ~follows[1:] | (s.name[1:] != s.name[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(head)) - 1
    length = (last - first + 1).astype(U)
    name = s.name[first]
    named = mix(name * U(0x9E3779B97F4A7C15) + length * U(0xD6E8FEB86659FD93) + U(1))
    return Symbols(np.where(length > U(1), named, name), s.row[first], s.start[first], before[first], after[last])


def name_pairs(s: Symbols, bounds: np.ndarray, level: int) -> Symbols:
    """Each left symbol followed by a right one as one symbol.

    A pair depends on nothing else; a left symbol that stays alone depends on the one after it, a right one on
    the one before.
    """
    follows, before, after = _neighbours(s, bounds)
    left = (mix(s.name + U(1000 * level + 11)) >> U(17)) & U(1) == U(1)
    second = np.zeros(len(s.name), dtype=bool)
    second[1:] = follows[1:] & left[:-1] & ~left[1:]
    first = np.flatnonzero(~second)
    last = np.append(first[1:], len(second)) - 1
    pair = last > first
    named = mix(s.name[first] * U(0xC2B2AE3D27D4EB4F) + mix(s.name[last] + U(7)))
    low = np.where(pair | left[first], s.low[first], before[first])
    high = np.where(pair | ~left[first], s.high[last], after[last])
    return Symbols(np.where(pair, named, s.name[first]), s.row[first], s.start[first], low, high)


def levels(words: Words, rounds: int) -> list[Symbols]:
    """The words, and the symbols after each round."""
    place = np.arange(len(words.hashes))
    found = [Symbols(words.hashes, words.rows, place, place, place + 1)]
    for level in range(rounds):
        found.append(name_pairs(name_runs(found[-1], words.first), words.first, level))
    return found


class Rows(NamedTuple):
    """Consecutive windows with one key: key, first window, number of windows."""

    key: np.ndarray
    first: np.ndarray
    size: np.ndarray


def _gram_sums(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(hashes) + 1, dtype=U)
    np.cumsum(hashes * powers(BASE, len(hashes)), out=total[1:])
    return total


def _grams(total: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from the given places on."""
    return mix((total[at + size] - total[at]) * powers(BASE_INVERSE, len(total))[at])


def _least(keys: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of ``keys[first:last]`` for every pair, from the minima of 1, 2, 4, ... keys."""
    size = last - first
    out = np.empty(len(first), dtype=keys.dtype)
    width, table = 1, keys
    while len(out):
        own = np.flatnonzero((size >= width) & (size < 2 * width))
        out[own] = np.minimum(table[first[own]], table[last[own] - width])
        if not (size >= 2 * width).any():
            break
        table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def anchored(words: Words, window: int, rounds: int) -> Rows:
    """All windows of a batch, by anchor."""
    n = len(words.hashes)
    windows = np.flatnonzero(np.arange(n) + window <= words.first[words.rows + 1]) if n else np.zeros(0, np.int64)
    if not len(windows):
        none = np.zeros(0, dtype=np.int64)
        return Rows(none.astype(U), none, none)
    name = np.empty(n, dtype=U)
    at = np.empty(n, dtype=np.int64)
    height = np.empty(n, dtype=np.int64)
    todo = windows
    found = levels(words, rounds)
    for level in range(rounds, -1, -1):
        s = found[level]
        first = np.searchsorted(s.low, todo, side="left")
        last = np.searchsorted(s.high, todo + window, side="right")
        sees = last > first
        own = todo[sees]
        # 32 bits of the hash, then the place: both decide alike in equal windows.
        keys = (mix(s.name + U(99)) >> U(32) << U(32)) | np.arange(len(s.name), dtype=U)
        index = (_least(keys, first[sees], last[sees]) & U(0xFFFFFFFF)).astype(np.int64)
        name[own], at[own], height[own] = s.name[index], s.start[index], level
        todo = todo[~sees]
        if not len(todo):
            break
    half = (window + 1) // 2
    name, at, height = name[windows], at[windows], height[windows]
    behind = at - windows > window - half
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (
        (windows[1:] != windows[:-1] + 1) | (at[1:] != at[:-1])
        | (height[1:] != height[:-1]) | (behind[1:] != behind[:-1])
    )
    heads = np.flatnonzero(new)
    total = _gram_sums(words.hashes)
    side = behind[heads].astype(U)
    gram = _grams(total, np.where(behind[heads], at[heads] - half, at[heads]), half)
    key = mix(name[heads] + gram * U(0xC2B2AE3D27D4EB4F) + side + (height[heads].astype(U) << U(8)))
    return Rows(key, windows[heads], np.diff(np.append(heads, len(windows))))


def _words(batch: pa.RecordBatch) -> Words:
    return Words(batch.column("text"), TOKEN_BYTES, _VALUES)


def _emit_rows(window: int, rounds: int):
    """Key, text and first window of all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = _words(batch)
            rows = anchored(words, window, rounds)
            text = words.rows[rows.first]
            doc = pa.array(batch.column("doc").to_numpy()[text])
            first = pa.array(rows.first - words.first[text], pa.int32())
            key = pa.array(rows.key.view(np.int64))
            yield pa.RecordBatch.from_arrays([key, doc, first], names=["key", "doc", "first"])

    return run


def _shared(piece: int):
    """The rows whose key two texts have, numbered in pieces; rows come ordered by key and text.

    Only the rows of one text wait until it is known whether another one follows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = begun = None
        number, known = 0, False
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, docs = batch.column("key").to_numpy(), batch.column("doc").to_numpy()
            heads = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            ends = np.append(heads[1:], n)
            group = np.repeat(np.arange(len(heads)), ends - heads)
            first = docs[heads].copy()
            index = np.arange(n) - heads[group]
            goes_on = key is not None and keys[0] == key
            if goes_on:
                first[0] = begun
                index[: ends[0]] += number
            several = first != docs[ends - 1]
            if goes_on and known:
                several[0] = True
            salt = pa.array(index // piece, pa.int32())
            columns = [batch.column("doc"), batch.column("first"), salt]
            rows = pa.RecordBatch.from_arrays(columns, names=["doc", "first", "salt"])
            if goes_on and several[0]:
                yield from held
            if several[0] or not goes_on or len(heads) > 1:
                held = []
            yield rows.filter(pa.array(several[group]))
            if not several[-1]:
                held.append(rows.slice(heads[-1]))
            key, begun, number, known = keys[-1], first[-1], int(index[-1]) + 1, bool(several[-1])

    return run


def _emit_contexts(window: int, rounds: int):
    """The windows' hashes of the rows that the texts' lists ask for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = _words(batch)
            rows = anchored(words, window, rounds)
            wanted = batch.column("found")
            flat = wanted.flatten()
            asked = words.first[wanted.value_parent_indices().to_numpy()] + flat.field("first").to_numpy()
            order = np.argsort(asked, kind="stable")
            mine = np.searchsorted(rows.first, asked[order])
            first, size = rows.first[mine], rows.size[mine]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            at = np.repeat(first - (ends - size), size) + np.arange(total)
            second = span_hashes(words.data, words.starts, words.ends, _VALUES_2)
            hashes = _grams(_gram_sums(second), at, window).view(np.int64)
            text = words.rows[first]
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows.key[mine].view(np.int64)), flat.field("salt").take(pa.array(order)),
                    pa.array(batch.column("id").to_numpy()[text]), pa.array(batch.column("doc").to_numpy()[text]),
                    pa.array(first - words.first[text], pa.int32()),
                    pa.ListArray.from_arrays(offsets, pa.array(hashes)),
                ],
                names=["key", "salt", "id", "doc", "first", "hashes"],
            )

    return run


def _compare(window: int, limit: int):
    """Runs of removed words of whole pieces, and the windows to be compared across pieces."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        key, salt, ids, doc, first = (table[c].to_numpy() for c in table.column_names[:-1])
        lists = table["hashes"].combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        hashes = lists.flatten().to_numpy()
        own = np.repeat(np.arange(len(key)), size)
        start = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
        number = np.cumsum(fresh) - 1
        # A first piece that is not full is the only one of its key.
        several = (salt > 0) | (np.bincount(number) >= limit)[number]
        piece = number[own]
        # Rows come ordered by id, and the sort is stable: the first of a class has its least id.
        order = np.lexsort([hashes, piece])
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (piece[order][1:] != piece[order][:-1])
        heads = np.flatnonzero(new)
        sorted_ids = ids[own[order]]
        least = np.repeat(sorted_ids[heads], np.diff(np.append(heads, len(order))))
        gone = np.zeros(len(order), dtype=bool)
        gone[order] = sorted_ids > least
        edge = np.ones(len(own), dtype=bool)
        edge[1:] = own[1:] != own[:-1]
        begins = np.flatnonzero(gone & (edge | ~np.append(False, gone[:-1])))
        stops = np.flatnonzero(gone & (np.append(edge[1:], True) | ~np.append(gone[1:], False)))
        open_ = np.flatnonzero(~gone & several[own])
        who = np.concatenate([own[begins], own[open_]])
        empty = pa.nulls(len(begins), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc[who]), pa.array(ids[who]),
                pa.array(np.concatenate([start[begins], start[open_]]), pa.int32()),
                pa.array(np.concatenate([start[stops], start[open_]]) + window, pa.int32()),
                pa.concat_arrays([empty, pa.array(key[own[open_]])]),
                pa.concat_arrays([empty, pa.array(hashes[open_])]),
            ],
            names=["doc", "id", "start", "end", "one", "two"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        weight = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            pending.append(batch)
            weight += len(batch.column("hashes").flatten())
            if weight < BLOCK_WINDOWS:
                continue
            # All but the last piece, which may go on in the next batch.
            table = pa.Table.from_batches(pending).combine_chunks()
            key, salt = table["key"].to_numpy(), table["salt"].to_numpy()
            others = np.flatnonzero((key != key[-1]) | (salt != salt[-1]))
            if len(others):
                cut = int(others[-1]) + 1
                yield solve(table.slice(0, cut))
                table = table.slice(cut)
            pending = table.to_batches()
            weight = sum(len(b.column("hashes").flatten()) for b in pending)
        if pending:
            yield solve(pa.Table.from_batches(pending))

    return run


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and number of each text's words."""
    for batch in chunks(batches, "text"):
        digest, count = [], []
        for text in batch.column("text"):
            # bytes.split() cuts at exactly the blanks 0x20 and 0x09 to 0x0D.
            words = (text.as_py() or "").encode().split()
            digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
            count.append(len(words))
        out = [batch.column("doc"), batch.column("id"), pa.array(digest, pa.string()), pa.array(count, pa.int64())]
        yield pa.RecordBatch.from_arrays(out, names=["doc", "id", "sha", "n_words"])


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        removed, digest, spans = [], [], []
        for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist(), strict=True):
            words = text.as_py().encode().split()
            merged: list[list[int]] = []
            for a, b in sorted((r["start"], r["end"]) for r in runs):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept += words[at:a]
                at = b
            kept += words[at:]
            removed.append(len(words) - len(kept))
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            spans.append([{"start": a, "end": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"), pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            names=["doc", "n_removed", "kept_sha256", "spans"],
        )


def repeated_words(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    rounds: int = ROUNDS,
    piece: int = PIECE,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans) for every row; spans count words."""
    spark = documents.sparkSession
    n = parts(spark)
    rows = documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    texts, placed, name = in_task_buckets(rows, n, "substrings")
    measures = "doc bigint, id bigint, sha string, n_words bigint"
    info = stored(texts.select("doc", "id", "text").mapInArrow(_measure, measures), "info")
    long_ = info.where((F.col("n_words") >= window) & F.col("id").isNotNull())
    least = long_.groupBy("sha").agg(F.min(F.struct("id", "doc")).alias("own"))
    least = stored(least.select("sha", "own.id", "own.doc"), "least")

    with partitioned_by_bucket(spark):
        examined = texts.join(placed(least.select("doc")), ["b", "doc"]).select("doc", "text")
        found = examined.mapInArrow(_emit_rows(window, rounds), _ROWS).repartition(n, "key")
        found = found.sortWithinPartitions("key", "doc").mapInArrow(_shared(piece), _SHARED)
        found = placed(found).groupBy("b", "doc").agg(F.collect_list(F.struct("first", "salt")).alias("found"))
        found = stored(found, "found")
        contexts = texts.join(found, ["b", "doc"]).select("doc", "id", "text", "found")
        contexts = contexts.mapInArrow(_emit_contexts(window, rounds), _CONTEXTS).repartition(n, "key", "salt")
        compared = contexts.sortWithinPartitions("key", "salt", "id").mapInArrow(_compare(window, piece), _RUNS)
        compared = stored(compared, "compared")

    left = compared.where("one IS NOT NULL")
    first = left.groupBy("one", "two").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    across = left.join(first, ["one", "two"]).where("id > low").select("doc", "start", "end")
    runs = compared.where("one IS NULL").select("doc", "start", "end").union(across)
    with partitioned_by_bucket(spark):
        runs = placed(runs).groupBy("b", "doc").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
        runs = stored(runs, "removed")
        judged = texts.join(runs, ["b", "doc"]).select("doc", "text", "runs")
        spans = "array<struct<start:int,end:int>>"
        judged = judged.mapInArrow(_digest, f"doc bigint, n_removed bigint, kept_sha256 string, spans {spans}")
        judged = stored(judged.join(least.select("doc", "sha"), "doc").drop("doc"), "judged")
    # All that follows reads stored rows; the texts' files go with the session.
    spark.sql(f"DROP TABLE {name}")

    out = info.drop("doc").join(least.select("sha", F.col("id").alias("least")), "sha", "left")
    out = out.join(judged, "sha", "left")
    copy = F.coalesce(F.col("least") < F.col("id"), F.lit(False))
    mine = F.coalesce(F.col("least") == F.col("id"), F.lit(False))
    empty = F.sha2(F.lit(""), 256)
    all_ = F.expr("array(struct(0 AS start, cast(n_words AS int) AS end))")
    none = F.expr("cast(array() AS array<struct<start:int,end:int>>)")

    def result(of_copy, of_judged, otherwise):
        return F.when(copy, of_copy).when(mine, F.coalesce(of_judged, otherwise)).otherwise(otherwise)

    return out.select(
        F.col("id").alias("doc_id"),
        "n_words",
        result(F.col("n_words"), F.col("n_removed"), F.lit(0).cast("bigint")).alias("n_removed"),
        result(empty, F.col("kept_sha256"), F.col("sha")).alias("kept_sha256"),
        result(all_, F.col("spans"), none).alias("spans"),
    )


def op11(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return repeated_words(read_table(spark, sf_dir, "documents")).drop("spans")


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
earliest AS (SELECT s, min(doc_id) AS low FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT x.doc_id, list(DISTINCT i + j) AS places
  FROM windows x JOIN earliest e ON e.s = x.s AND e.low < x.doc_id, range(0, 13) t(j) GROUP BY x.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(
         CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(places, k)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""
