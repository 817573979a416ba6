"""Benchmark decontamination by a prefix-filtered set join.

A window is ten consecutive words of a benchmark item; an item of fewer words, but not none, is one
window. Word frequencies over all documents order the words of each window by rarity. A document that
contains a window contains the window's rarest word, so that word (the prefix, of length one for
containment) is what the join matches. Its place in the window fixes where the window would lie in
the document, which gives the positional bound (not before the first word) and the length bound (not
past the last word). What is left is verified word by word.

The windows are a stated query set: they are taken in blocks of at most about ``block`` windows, and
every block runs over all documents, which therefore need no shuffle. A block's tables are the only
thing that is broadcast, and its size is bounded by ``block`` whatever the size of the benchmark.

Defined results: a null text or item has no words; an item without words has no window; equal rows
give equal results, one per input row; an empty benchmark leaves every document clean; input columns
named like a result are replaced by it, all others are passed on. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import U, Words, chunks, read_table, stored

WINDOW = 10
BLOCK = 50_000
RESULTS = ("n_words", "hits", "items")
# Candidate places expanded at a time.
EXPAND = 1 << 18

_WINDOWS = "item string, words array<bigint>"
_COUNTS = "word bigint, n bigint"


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, words): each distinct window of each item, as word hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = Words(batch.column("text"))
            ids = batch.column("item").to_pylist()
            names, runs = [], []
            for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                hashes = words.hashes[a:b].view(np.int64).tolist()
                for i in range(max(1, len(hashes) - window + 1) if hashes else 0):
                    names.append(ids[row])
                    runs.append(hashes[i : i + window])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(runs, pa.list_(pa.int64()))], names=["item", "words"]
            )

    named = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(cut, _WINDOWS).distinct()


def _counter(vocabulary):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        totals = np.zeros(len(known), dtype=np.int64)
        for batch in chunks(batches, "text"):
            hashes = Words(batch.column("text")).hashes
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            totals += np.bincount(at[known[at] == hashes], minlength=len(known))
        some = totals > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(known[some].view(np.int64)), pa.array(totals[some])], names=["word", "n"]
        )

    return count


class _Block:
    """The windows of a block by their rarest word, as flat arrays."""

    def __init__(self, windows: list[tuple[str, list[int]]], frequency: dict[int, int], window: int):
        self.items = [item for item, _ in windows]
        n = len(windows)
        self.length = np.array([len(w) for _, w in windows], dtype=np.int64)
        self.words = np.zeros((n, window), dtype=np.int64)
        place = np.zeros(n, dtype=np.int64)
        for i, (_, w) in enumerate(windows):
            self.words[i, : len(w)] = w
            place[i] = min(range(len(w)), key=lambda j: (frequency.get(w[j], 0), j))
        self.words = self.words.view(U)
        prefix = self.words[np.arange(n), place]
        order = np.argsort(prefix, kind="stable")
        self.window, self.place = order, place[order]
        self.tokens, first = np.unique(prefix[order], return_index=True)
        self.first = np.append(first, n)
        self.maybe = np.zeros(1 << 18, dtype=bool)
        self.maybe[(self.tokens >> U(46)).astype(np.int64)] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, window) of every occurrence."""
        hashes = words.hashes
        at = np.flatnonzero(self.maybe[(hashes >> U(46)).astype(np.int64)])
        token = np.minimum(np.searchsorted(self.tokens, hashes[at]), len(self.tokens) - 1)
        same = self.tokens[token] == hashes[at]
        at, token = at[same], token[same]
        each = self.first[token + 1] - self.first[token]
        places, found = [], []
        ends = np.cumsum(each)
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + EXPAND, side="right")))
            n = each[i:j]
            entry = np.repeat(self.first[token[i:j]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            start = np.repeat(at[i:j], n) - self.place[entry]
            window = self.window[entry]
            row = np.repeat(words.rows[at[i:j]], n)
            fits = (start >= words.first[row]) & (start + self.length[window] <= words.first[row + 1])
            start, window = start[fits], window[fits]
            for k in range(self.words.shape[1]):
                inside = self.length[window] > k
                equal = ~inside
                equal[inside] = hashes[start[inside] + k] == self.words[window[inside], k]
                start, window = start[equal], window[equal]
            places.append(start)
            found.append(window)
            i = j
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(found)


def _runs(words: Words, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each run of covered words, counted from the row's first word."""
    n = len(covered)
    first = np.zeros(n + 1, dtype=bool)
    first[words.first] = True
    before = np.concatenate([[False], covered[:-1]])[:n]
    after = np.concatenate([covered[1:], [False]])[:n]
    starts = np.flatnonzero(covered & (~before | first[:-1]))
    ends = np.flatnonzero(covered & (~after | first[1:])) + 1
    rows = words.rows[starts]
    return rows, starts - words.first[rows], ends - words.first[rows]


def _marker(block, names: list[str], text: str):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        for batch in chunks(batches, text):
            words = Words(batch.column(text))
            n, total = batch.num_rows, len(words.hashes)
            start, window = own.find(words)
            change = np.zeros(total + 1, dtype=np.int64)
            np.add.at(change, start, 1)
            np.add.at(change, start + own.length[window], -1)
            pairs = {(int(r), own.items[w]) for r, w in zip(words.rows[start], window, strict=True)}
            hits = batch.column("hits")
            flat = hits.flatten()
            rows = hits.value_parent_indices().to_numpy(zero_copy_only=False)
            if len(flat):
                base = words.first[rows]
                np.add.at(change, base + flat.field(0).to_numpy(), 1)
                np.add.at(change, base + flat.field(1).to_numpy(), -1)
            known = batch.column("items")
            if len(known.flatten()):
                pairs |= set(zip(known.value_parent_indices().to_pylist(), known.flatten().to_pylist(), strict=True))
            rows, a, b = _runs(words, np.cumsum(change[:-1]) > 0)
            spans = pa.StructArray.from_arrays(
                [pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["start", "end"]
            )
            ordered = sorted(pairs, key=lambda p: (p[0], p[1] is None, p[1] or ""))
            new = {
                "n_words": pa.array(words.counts, pa.int64()),
                "hits": pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), spans),
                "items": pa.ListArray.from_arrays(
                    pa.array(np.searchsorted([p[0] for p in ordered], np.arange(n + 1)), pa.int32()),
                    pa.array([p[1] for p in ordered], pa.string()),
                ),
            }
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names=names)

    return mark


def decontaminate(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """The documents with ``n_words``, ``hits`` (merged spans of hit words) and ``items`` (ids as text, sorted)."""
    spark = documents.sparkSession
    out = documents.drop(*[c for c in RESULTS if c != text]).withColumn(text, F.col(text).cast("string"))
    out = out.selectExpr(
        "*", "0L AS n_words", "cast(array() AS array<struct<start:int,end:int>>) AS hits", "cast(array() AS array<string>) AS items"
    )
    windows = stored(item_windows(items, item_id, item_text, window), "windows")
    count = windows.count()
    blocks = max(1, math.ceil(count / block))
    windows = windows.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))
    names = out.columns
    for k in range(blocks):
        part = windows.where(F.col("block") == k).select("item", "words")
        # At most about ``block`` windows of ``window`` words each.
        own = [(r.item, list(r.words)) for r in part.toLocalIterator()]
        own.sort(key=lambda x: (x[0] is None, x[0] or "", x[1]))
        if own:
            vocabulary = np.unique(np.array([w for _, ws in own for w in ws], dtype=np.int64).view(U))
            shared = spark.sparkContext.broadcast(vocabulary)
            texts = documents.select(F.col(text).cast("string").alias("text"))
            counted = texts.mapInArrow(_counter(shared), _COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
            frequency = {r.word: r.n for r in counted.collect()}
            made = _Block(own, frequency, window)
        else:
            made = _Block([("", [0])], {}, window)
            made.length[:] = 1 << 40
        out = out.mapInArrow(_marker(spark.sparkContext.broadcast(made), names, text), out.schema)
    return out


def op8(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate(documents, read_table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("aggregate(hits, 0L, (n, h) -> n + h.end - h.start)")
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), hit AS (SELECT dw.r, dw.i, dw.size, bw.item FROM dw JOIN bw USING (win, size)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hit) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN found USING (r)
"""


def pipeline_stage(spark, documents: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of a benchmark item."""
    marked = decontaminate(documents, read_table(spark, sf_dir, "benchmark"))
    return marked.where(F.size("hits") == 0).select("doc_id", "text", "lang", "source", "n_chars")
