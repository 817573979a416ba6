"""Removal of repeated passages by blockwise suffix sorting with a difference cover.

Every byte that lies in a string of ``LENGTH`` bytes which also starts earlier goes. Two such strings
are equal exactly if they are adjacent, up to that depth, in the sorted order of all suffixes. That
order is built for one suffix bucket at a time, and only for buckets that can hold a repetition:

1. Of texts that are equal as a whole only the one with the least id is examined; in the others all
   bytes repeat.
2. A suffix belongs to the bucket of the anchor of its first ``LENGTH`` bytes, the ``GRAM``-byte gram of
   least hash among them (the first of equals). Equal strings have equal anchors, at the same place. Only
   anchors that occur at least twice are kept.
3. The suffixes of those buckets are brought together, each anchor with the bytes that its suffixes
   need, and blocks of whole buckets are concatenated, every anchor at a multiple of ``COVER``.
4. In a block the positions whose remainder lies in a difference cover modulo ``COVER`` are the cover
   sample. Their ranks to a depth of 32 bytes come from sorting, to 64 by doubling (a sample 32 bytes
   further is a sample again). Of equal contexts only the first is sorted. Buckets of suffixes are then sorted one at a time by their first eight
   bytes; longer ties are resolved by the ranks of the samples inside them and the last bytes. Within
   a class of equal strings all but the first go.

Memory is bounded by the block, not by the text or the bucket: a bucket with more than ``PIECE`` anchors
is cut into pieces, each reduced to the first occurrence of every string, and what is left is compared
across pieces by partial aggregation on the strings' hashes.

Texts are not shuffled: they are stored as they are read, each task's in a bucket of its own, and what is
found out about them is brought there.

Documents are ordered by id, then by start. Defined results: null and empty texts have no bytes; texts
of fewer than ``LENGTH`` bytes stay whole; rows with equal id and text are one document and get one
result each; rows that share an id but not the text are documents of their own, ordered by a hash of the text;
a null id comes before all others; no rows give no rows. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import (
    BASE,
    BASE_INVERSE,
    U,
    chunks,
    in_task_buckets,
    mix,
    partitioned_by_bucket,
    parts,
    powers,
    read_table,
    stored,
    text_bytes,
)

LENGTH = 100
GRAM = 32
COVER = 32
ROOT = 6
PIECE = 4096
BLOCK_BYTES = 1 << 20
BUCKET = 1 << 17
_FIRST = -(2**63)

# Bytes are compared as they are: capitals count.
_VALUES = mix(np.arange(256, dtype=U) + U(501))
_VALUES_2 = mix(np.arange(256, dtype=U) + U(901))

# All remainders below the root and all its multiples: every difference below COVER is one of a
# multiple and a small remainder.
SAMPLE = sorted(set(range(ROOT)) | set(range(0, COVER, ROOT)))

_ANCHORS = "gram bigint, doc bigint, at int"
_REPEATED = "gram bigint, doc bigint, at int, salt int"
_CONTEXTS = "gram bigint, salt int, id bigint, part bigint, doc bigint, start int, lead int, bytes binary"
_RUNS = "doc bigint, id bigint, part bigint, start int, end int, one bigint, two bigint"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=values.dtype)
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, hash, first, last): every anchor and the starts of the strings that have it."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none.astype(U), none, none
    total = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(_VALUES[data] * powers(BASE, len(data)), out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * powers(BASE_INVERSE, len(data) - GRAM + 1))
    # The place in the low bits makes the first of equal hashes the least.
    bits = U(max(1, int(len(grams)).bit_length()))
    keyed = ((grams >> bits) << bits) | np.arange(len(grams), dtype=U)
    least = sliding_least(keyed, LENGTH - GRAM + 1)
    place = (least & ((U(1) << bits) - U(1))).astype(np.int64)
    start = np.arange(len(place))
    row_end = np.repeat(offsets[1:], np.diff(offsets))[: len(place)]
    start = start[start + LENGTH <= row_end]
    place = place[start]
    if not len(start):
        return none, none.astype(U), none, none
    new = np.ones(len(start), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return place[first], grams[place[first]], start[first], start[last]


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        place, gram, _, _ = anchors(data, offsets)
        row = np.searchsorted(offsets, place, side="right") - 1
        docs = batch.column("doc").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array(docs[row]), pa.array(place - offsets[row], pa.int32())],
            names=["gram", "doc", "at"],
        )


def _repeated(piece: int):
    """Rows whose gram occurs more than once, numbered in pieces; rows come ordered by gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, number, held = None, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            grams = batch.column("gram").to_numpy()
            n = len(grams)
            new = np.ones(n, dtype=bool)
            new[1:] = grams[1:] != grams[:-1]
            new[0] = gram is None or grams[0] != gram
            first = np.flatnonzero(new)
            base = np.zeros(n, dtype=np.int64)
            if len(first):
                base[first] = first
                base = np.maximum.accumulate(base)
            index = np.arange(n) - base
            if not new[0]:
                until = first[0] if len(first) else n
                index[:until] = number + 1 + np.arange(until)
            alone = np.zeros(n, dtype=bool)
            alone[:-1] = new[:-1] & new[1:]
            # The last row waits for its successor if it is the first of its gram.
            last_waits = index[-1] == 0
            keep = ~alone
            keep[-1] &= not last_waits
            table = batch.append_column("salt", pa.array(index // piece, pa.int32()))
            out = [table.take(pa.array(np.flatnonzero(keep)))]
            if held is not None and not new[0]:
                out.insert(0, held)
            held = table.slice(n - 1, 1) if last_waits else None
            gram, number = grams[-1], int(index[-1])
            yield from out

    return run


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each repeated anchor the bytes of the strings that have it."""
    for batch in chunks(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        place, gram, first, last = anchors(data, offsets)
        wanted = batch.column("found")
        rows = wanted.value_parent_indices().to_numpy()
        flat = wanted.flatten()
        at = offsets[rows] + flat.field("at").to_numpy()
        order = np.argsort(at, kind="stable")
        at = at[order]
        index = np.minimum(np.searchsorted(at, place), max(len(at) - 1, 0))
        some = np.flatnonzero(at[index] == place) if len(at) else np.zeros(0, np.int64)
        salt = flat.field("salt").to_numpy()[order][index[some]]
        place, gram, first, last = place[some], gram[some], first[some], last[some]
        row = np.searchsorted(offsets, place, side="right") - 1
        size = last - first + LENGTH
        ends = np.cumsum(size)
        taken = data[np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.concatenate([[0], ends]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(gram.view(np.int64)), pa.array(salt, pa.int32()),
                *[pa.array(batch.column(c).to_numpy()[row]) for c in ("id", "part", "doc")],
                pa.array(first - offsets[row], pa.int32()), pa.array(place - first, pa.int32()),
                pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(taken)]),
            ],
            names=["gram", "salt", "id", "part", "doc", "start", "lead", "bytes"],
        )


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows of keys, first key first."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=np.int64)
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return rank


class CoverSample:
    """Ranks of the cover sample of a block to 32 and 64 bytes."""

    def __init__(self, block: np.ndarray):
        self.size = len(block)
        padded = np.concatenate([block, np.zeros(2 * COVER + 8, dtype=np.uint8)])
        word = np.zeros(len(padded) - 7, dtype=U)
        for j in range(8):
            word = (word << U(8)) | padded[j : len(padded) - 7 + j]
        self.word = word
        inside = np.isin(np.arange(COVER), SAMPLE)
        self.index = np.full(COVER, -1, dtype=np.int64)
        self.index[SAMPLE] = np.arange(len(SAMPLE))
        # Distance to the next sample, and back to the last one, by remainder.
        self.ahead = np.array([next(d for d in range(COVER) if inside[(r + d) % COVER]) for r in range(COVER)])
        self.back = np.array([next(d for d in range(COVER) if inside[(r - d) % COVER]) for r in range(COVER)])
        groups = -(-len(block) // COVER) + 2
        self.at = (np.arange(groups)[:, None] * COVER + np.array(SAMPLE)[None, :]).ravel()
        self.at = self.at[self.at + 24 < len(word)]
        self.rank32 = _ranks([word[self.at + 8 * j] for j in range(4)])
        later = np.minimum(np.arange(len(self.at)) + len(SAMPLE), len(self.at) - 1)
        self.rank64 = _ranks([self.rank32, self.rank32[later]])

    def _number(self, at: np.ndarray) -> np.ndarray:
        return at // COVER * len(SAMPLE) + self.index[at % COVER]

    def keys(self, at: np.ndarray) -> list[np.ndarray]:
        """Keys that order the strings of LENGTH bytes at the given places among strings with aligned anchors."""
        near = at + self.ahead[at % COVER]
        limit = np.minimum(near + 64, at + LENGTH - COVER)
        far = limit - self.back[limit % COVER]
        return [
            self.word[at], self.rank64[self._number(near)], self.rank32[self._number(far)],
            self.word[at + LENGTH - 16], self.word[at + LENGTH - 8],
        ]


def later_copies(block: np.ndarray, at: np.ndarray, bucket: int = BUCKET) -> np.ndarray:
    """Whether each string of LENGTH bytes equals one at an earlier place of the list ``at`` (ascending)."""
    sample = CoverSample(block)
    out = np.zeros(len(at), dtype=bool)
    head = sample.word[at]
    pieces = -(-len(at) // bucket)
    edges = np.unique(np.quantile(head, np.arange(1, pieces) / pieces, method="lower")) if pieces > 1 else np.zeros(0, U)
    which = np.searchsorted(edges, head, side="right")
    for b in range(len(edges) + 1):
        own = np.flatnonzero(which == b)
        keys = [*sample.keys(at[own]), at[own] % COVER]
        order = np.lexsort(keys[::-1])
        same = np.ones(len(order), dtype=bool)
        same[:1] = False
        for key in keys:
            k = key[order]
            same[1:] &= k[1:] == k[:-1]
        # The sort is stable, so the first of a class is the earliest.
        out[own[order[same]]] = True
    return out


def _sort_blocks(piece_size: int):
    """Removed runs of the contexts of whole pieces, and the strings to be compared across pieces."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        gram, salt = table["gram"].to_numpy(), table["salt"].to_numpy()
        piece = np.ones(len(gram), dtype=bool)
        piece[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])
        number = np.cumsum(piece) - 1
        several = (salt > 0) | (np.bincount(number) >= piece_size)[number]
        if (salt > 0).any():
            # Pieces of one bucket in one block are compared together, so their rows are brought into one order.
            order = np.lexsort([table[c].to_numpy() for c in ("start", "part", "id", "gram")])
            table, several = table.take(pa.array(order)).combine_chunks(), several[order]
            gram = gram[order]
        bucket = np.ones(len(gram), dtype=bool)
        bucket[1:] = gram[1:] != gram[:-1]
        number = np.cumsum(bucket)
        start, lead = table["start"].to_numpy().astype(np.int64), table["lead"].to_numpy().astype(np.int64)
        column = table["bytes"].chunk(0)
        bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        bounds = bounds.astype(np.int64)
        data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        size = np.diff(bounds)

        # Of equal contexts only the first is sorted: all strings of the others repeat its own.
        total = np.zeros(len(data) + 1, dtype=U)
        np.cumsum(_VALUES[data] * powers(BASE, len(data)), out=total[1:])
        whole = mix((total[bounds[1:]] - total[bounds[:-1]]) * powers(BASE_INVERSE, len(data) + 1)[bounds[:-1]])
        order = np.lexsort([whole, size, lead, number])
        new = np.ones(len(order), dtype=bool)
        new[1:] = False
        for c in (whole, size, lead, number):
            new[1:] |= c[order][1:] != c[order][:-1]
        kept = np.zeros(len(order), dtype=bool)
        kept[order[new]] = True
        copies, rows = np.flatnonzero(~kept), np.flatnonzero(kept)

        pad = -lead[rows] % COVER
        mine = size[rows]
        slot = -(-(pad + mine) // COVER) * COVER
        begin = np.cumsum(slot) - slot + pad
        block = np.zeros(int(slot.sum()), dtype=np.uint8)
        inner = np.arange(int(mine.sum())) - np.repeat(np.cumsum(mine) - mine, mine)
        block[np.repeat(begin, mine) + inner] = data[np.repeat(bounds[rows], mine) + inner]
        windows = mine - LENGTH + 1
        local = np.repeat(np.arange(len(rows)), windows)
        step = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        at = begin[local] + step
        own = rows[local]
        gone = later_copies(block, at)
        new = np.ones(len(own), dtype=bool)
        new[1:] = ~gone[:-1] | (own[1:] != own[:-1])
        heads = np.flatnonzero(gone & new)
        tail = np.ones(len(own), dtype=bool)
        tail[:-1] = ~gone[1:] | (own[1:] != own[:-1])
        tails = np.flatnonzero(gone & tail)
        open_ = np.flatnonzero(~gone & several[own])
        place = at[open_]
        hashes = []
        for values in (_VALUES, _VALUES_2) if len(open_) else ():
            total = np.zeros(len(block) + 1, dtype=U)
            np.cumsum(values[block] * powers(BASE, len(block)), out=total[1:])
            hashes.append(mix((total[place + LENGTH] - total[place]) * powers(BASE_INVERSE, len(block) + 1)[place]).view(np.int64))
        empty = pa.nulls(len(copies) + len(heads), pa.int64())
        who = np.concatenate([copies, own[heads], own[open_]])
        first = np.concatenate([start[copies], start[own[heads]] + step[heads], start[own[open_]] + step[open_]])
        end = np.concatenate(
            [start[copies] + size[copies], start[own[tails]] + step[tails] + LENGTH, start[own[open_]] + step[open_] + LENGTH]
        )
        one, two = (pa.concat_arrays([empty, pa.array(h)]) for h in hashes) if hashes else (empty, empty)
        names = [table[c].combine_chunks().take(pa.array(who)) for c in ("doc", "id", "part")]
        return pa.RecordBatch.from_arrays(
            [*names, pa.array(first, pa.int32()), pa.array(end, pa.int32()), one, two],
            names=["doc", "id", "part", "start", "end", "one", "two"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        weight = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, salt = batch.column("gram").to_numpy(), batch.column("salt").to_numpy()
            size = np.diff(np.frombuffer(batch.column("bytes").buffers()[1], np.int32)[batch.column("bytes").offset :][: len(gram) + 1])
            edge = np.ones(len(gram), dtype=bool)
            edge[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])
            if pending:
                last = pending[-1]
                edge[0] = (gram[0], salt[0]) != (last.column("gram")[-1].as_py(), last.column("salt")[-1].as_py())
            cuts = [*np.flatnonzero(edge).tolist(), len(gram)]
            total = np.concatenate([[0], np.cumsum(size)])
            at = 0
            for cut in cuts:
                # A block ends only where a piece ends.
                if weight + total[cut] - total[at] >= BLOCK_BYTES and cut < len(gram):
                    if cut > at:
                        pending.append(batch.slice(at, cut - at))
                    yield solve(pa.Table.from_batches(pending))
                    pending, weight, at = [], 0, cut
            if at < len(gram):
                pending.append(batch.slice(at))
                weight += int(total[-1] - total[at])
        if pending:
            yield solve(pa.Table.from_batches(pending))

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        removed, count, digest, spans = [], [], [], []
        texts = batch.column("text")
        for text, runs in zip(texts, batch.column("runs").to_pylist(), strict=True):
            data = (text.as_py() or "").encode()
            merged: list[list[int]] = []
            for run in sorted((r["start"], r["end"]) for r in runs or ()):
                if merged and run[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], run[1])
                else:
                    merged.append(list(run))
            kept, at = hashlib.sha256(), 0
            for a, b in merged:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            removed.append(sum(b - a for a, b in merged))
            count.append(len(merged))
            digest.append(kept.hexdigest())
            spans.append([{"start": a, "end": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            names=["doc", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def repeated_passages(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", piece: int = PIECE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row; spans count bytes."""
    spark = documents.sparkSession
    n = parts(spark)
    rows = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_FIRST)).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    texts, placed, name = in_task_buckets(rows, n, "repeats")
    measures = [F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("bigint").alias("n_bytes")]
    info = stored(texts.select("doc", "doc_id", "id", *measures), "info")
    least = info.where(f"n_bytes >= {LENGTH}").groupBy("sha").agg(F.min(F.struct("id", "doc")).alias("own"))
    least = stored(least.select("sha", "own.id", "own.doc"), "least")
    # Several texts of one id are ordered by a hash of the text.
    twins = stored(least.groupBy("id").agg(F.count("*").alias("texts")).where("texts > 1"), "twins")
    part = F.when(F.col("texts").isNotNull(), F.xxhash64("sha")).otherwise(F.lit(0)).cast("bigint")
    wanted = stored(placed(least.join(twins, "id", "left").select("doc", part.alias("part"))), "wanted")

    with partitioned_by_bucket(spark):
        examined = texts.join(wanted, ["b", "doc"]).select("doc", "text")
        found = examined.mapInArrow(_emit_anchors, _ANCHORS).repartition(n, "gram")
        found = found.sortWithinPartitions("gram", "doc", "at").mapInArrow(_repeated(piece), _REPEATED)
        found = placed(found).groupBy("b", "doc").agg(F.collect_list(F.struct("at", "salt")).alias("found"))
        found = stored(found.join(wanted, ["b", "doc"]), "anchors")
        contexts = texts.join(found, ["b", "doc"]).select("doc", "id", "part", "text", "found")
        contexts = contexts.mapInArrow(_contexts, _CONTEXTS).repartition(n, "gram", "salt")
        contexts = contexts.sortWithinPartitions("gram", "salt", "id", "part", "start")
        sorted_ = stored(contexts.mapInArrow(_sort_blocks(piece), _RUNS), "runs")

    pieces = sorted_.where("one IS NOT NULL")
    place = F.struct("id", "part", "start")
    first = pieces.groupBy("one", "two").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    across = pieces.join(first, ["one", "two"]).where(place > F.col("first")).select("doc", "start", "end")
    runs = sorted_.where("one IS NULL").select("doc", "start", "end").union(across)
    spans = "array<struct<start:int,end:int>>"
    with partitioned_by_bucket(spark):
        runs = placed(runs).groupBy("b", "doc").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
        runs = stored(runs, "removed")
        judged = texts.join(runs, ["b", "doc"]).select("doc", "text", "runs")
        judged = judged.mapInArrow(
            _digest, f"doc bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans {spans}"
        )
        judged = stored(judged.join(least.select("doc", "sha"), "doc").drop("doc"), "judged")
    # All that follows reads stored rows; the texts' files go with the session.
    spark.sql(f"DROP TABLE {name}")

    out = info.drop("doc").join(least.select("sha", F.col("id").alias("least")), "sha", "left")
    copy = F.coalesce(F.col("least") < F.col("id"), F.lit(False))
    out = out.join(judged, "sha", "left")
    empty = F.sha2(F.lit(""), 256)
    all_ = F.expr("array(struct(0 AS start, cast(n_bytes AS int) AS end))")
    none = F.expr("cast(array() AS array<struct<start:int,end:int>>)")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, all_).otherwise(F.coalesce("spans", none)).alias("spans"),
    )


def op9(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return repeated_passages(read_table(spark, sf_dir, "documents")).drop("spans")


SQL = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
w AS (SELECT doc_id, i, array_slice(t, i + 1, i + 100) AS s
      FROM (SELECT doc_id, t, unnest(range(0, octet_length(t) - 99)) AS i FROM d WHERE octet_length(t) >= 100)),
e AS (SELECT s, min(doc_id::HUGEINT * 4294967296 + i) AS first FROM w GROUP BY s HAVING count(*) > 1),
gone AS (SELECT w.doc_id, w.i FROM w JOIN e ON e.s = w.s AND w.doc_id::HUGEINT * 4294967296 + w.i > e.first),
marked AS (
  SELECT doc_id, i, coalesce(i > 100 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS new FROM gone),
numbered AS (SELECT doc_id, i, count(*) FILTER (new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run),
kept AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
parts AS (
  SELECT k.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(hex(array_slice(t, before + 1, a)), '' ORDER BY a) AS head
  FROM kept k JOIN d ON d.doc_id = k.doc_id GROUP BY k.doc_id)
SELECT d.doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || hex(array_slice(t, coalesce(last, 0) + 1, octet_length(t))))) AS kept_sha256
FROM d LEFT JOIN parts p ON p.doc_id = d.doc_id
"""
