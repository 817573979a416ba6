"""Near-duplicate texts by Order MinHash and banded alignment.

A text is the sequence of its runs of five words. Texts with the same sequence form a class at once,
represented by the least document id. For each of ``SKETCHES`` hash functions a class keeps its
``TUPLE`` runs of least hash, each labelled with its occurrence number, and retains their order in the
text; equal tuples are candidates. Similarity is verified on the sequences: with L the longest common
subsequence of runs, it is L / (n1 + n2 - L), the Jaccard similarity of what an alignment in order can
match, and pairs of ``THRESHOLD`` or more are links. The alignment is bit-parallel and restricted to
the band that a pair of that similarity cannot leave, so it decides exactly.

A pair of similarity 0.8 shares a tuple with probability 0.33 per hash function, so one of 32 fails to
bring it together with probability 3e-6 (texts of at most 25 runs use tuples of two).

Buckets are never expanded into all pairs. First each member is verified against the most popular
member of its buckets (the one whose buckets are fullest), which joins a family to its original. What
remains are bucket members in different components; only these are compared, members of the largest
component of a bucket with all others: in buckets of up to ``WIDE`` members as pairs, in wider ones
inside blocks, where a matrix of common runs decides which pairs are worth an alignment and only links
that join components are given back. Blocks hold a bounded number of texts and runs, and every two
blocks of a bucket meet. Nothing is capped.

Defined results: null texts and texts without words link with nothing; a text of fewer words than five
is one run; a document without an id is its own class, of id null; rows that share an id are one
document; no rows give no rows. Only the two named columns are read. Runs are compared by 64-bit
hashes, classes by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import BYTE_VALUES_2, U, Words, chunks, components, groups, mix, parts, powers, read_table, span_hashes, stored

RUN = 5
THRESHOLD = 0.8
SKETCHES = 32
TUPLE = 5
SHORT_TUPLE = 2
# Texts up to SHORT_TO runs have short tuples, texts from LONG_FROM on long ones; the overlap is wide
# enough that two texts of a length ratio of 0.8 always have one kind in common.
LONG_FROM, SHORT_TO = 20, 25
# Members of a bucket that are still paired as rows; texts and runs of a block of a wider one.
WIDE = 32
BLOCK_TEXTS, BLOCK_RUNS = 3000, 1_500_000

_SIGNATURES = "doc_id bigint, k1 bigint, k2 bigint, n bigint, sketch array<bigint>"
_FACTORS = mix(np.arange(SKETCHES, dtype=U) + U(31)) | U(1)
_OFFSETS = mix(np.arange(SKETCHES, dtype=U) + U(131))


def labelled_runs(words: Words, k: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run with its occurrence number in the row, and where each row's runs begin."""
    runs, at = words.grams(k)
    rows = words.rows[at]
    own = mix(runs + rows.astype(U) * U(0xD6E8FEB86659FD93))
    order = np.argsort(own, kind="stable")
    ordered = own[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(order)]
    number = np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    occurrence = np.empty(len(order), dtype=U)
    occurrence[order] = number
    first = np.searchsorted(rows, np.arange(len(words.offsets)))
    return mix(runs + occurrence * U(0xA0761D6478BD642F)), first


def _tuples(labels: np.ndarray, size: int) -> np.ndarray:
    """One hash per hash function: its ``size`` least runs, in text order."""
    hashes = (labels[None, :] ^ _OFFSETS[:, None]) * _FACTORS[:, None]
    if len(labels) > size:
        least = np.sort(np.argpartition(hashes, size - 1, axis=1)[:, :size], axis=1)
    else:
        least = np.broadcast_to(np.arange(len(labels)), (SKETCHES, len(labels)))
    total = (labels[least] * powers(0xC2B2AE3D27D4EB4F, least.shape[1])[None, :]).sum(axis=1, dtype=U)
    return mix(total ^ mix(np.arange(SKETCHES, dtype=U) + U(1000 * size)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        words = Words(batch.column("text"))
        second = span_hashes(words.data, words.starts, words.ends, BYTE_VALUES_2)
        place = np.arange(len(words.hashes)) - words.first[words.rows]
        weight = powers(0x9FB21C651E98DF25, int(place.max()) + 1)[place] if len(place) else np.zeros(0, U)

        def key(hashes: np.ndarray, weight=weight, words=words) -> np.ndarray:
            total = np.concatenate([np.zeros(1, U), np.cumsum(hashes * weight, dtype=U)])
            return mix((total[words.first[1:]] - total[words.first[:-1]]) ^ words.counts.astype(U)).view(np.int64)

        labels, first = labelled_runs(words)
        sketches, sizes = [], []
        for a, b in zip(first[:-1], first[1:], strict=True):
            own = labels[a:b]
            found = []
            if 0 < len(own) <= SHORT_TO:
                found.append(_tuples(own, SHORT_TUPLE))
            if len(own) >= LONG_FROM:
                found.append(_tuples(own, TUPLE))
            sketches += found
            sizes.append(sum(map(len, found)))
        flat = np.concatenate(sketches) if sketches else np.zeros(0, U)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(key(words.hashes)),
                pa.array(key(second)),
                pa.array(np.diff(first), pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64))),
            ],
            names=["doc_id", "k1", "k2", "n", "sketch"],
        )


def aligned(a: list[int], b: list[int], threshold: float = THRESHOLD) -> bool:
    """Whether the longest common subsequence reaches the threshold.

    Rows of the alignment are processed as bit vectors. A pair that reaches it leaves at most ``band``
    elements of either side unmatched, so only matches at most ``band`` off the diagonal count.
    """
    n, m = len(a), len(b)
    need = int(np.ceil(threshold * (n + m) / (1 + threshold) - 1e-9))
    if min(n, m) < need:
        return False
    head = 0
    while head < min(n, m) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    a, b = a[head : n - tail], b[head : m - tail]
    need -= head + tail
    if need <= 0:
        return True
    if min(len(a), len(b)) < need:
        return False
    band = max(n, m) - need - head - tail
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    masks = {x: sum(1 << j for j in at) for x, at in places.items() if len(at) > 8}
    full = (1 << len(b)) - 1
    window = (1 << (2 * band + 1)) - 1
    free = full
    for i, x in enumerate(a):
        at = places.get(x)
        if at is None:
            continue
        if len(at) > 8:
            low = i - band
            mask = masks[x] & (window << low if low >= 0 else window >> -low)
        else:
            mask = 0
            for j in at:
                if -band <= j - i <= band:
                    mask |= 1 << j
        hit = free & mask
        if hit:
            free = ((free + hit) | (free - hit)) & full
    return len(b) - free.bit_count() >= need


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(chunks(batches, "text_a"), "text_b"):
        sides = []
        for name in ("text_a", "text_b"):
            words = Words(batch.column(name))
            runs, at = words.grams(RUN)
            labels, first = labelled_runs(words)
            sides.append((runs, labels, first))
        (runs_a, labels_a, first_a), (runs_b, labels_b, first_b) = sides
        good = np.zeros(batch.num_rows, dtype=bool)
        for i in range(batch.num_rows):
            a, b = slice(first_a[i], first_a[i + 1]), slice(first_b[i], first_b[i + 1])
            n, m = a.stop - a.start, b.stop - b.start
            if min(n, m) < THRESHOLD * max(n, m) - 1e-9:
                continue
            # No alignment matches more than the runs that both have, with their numbers.
            common = len(np.intersect1d(labels_a[a], labels_b[b], assume_unique=True))
            if common < THRESHOLD * (n + m - common) - 1e-9:
                continue
            good[i] = aligned(runs_a[a].tolist(), runs_b[b].tolist())
        kept = pa.array(np.flatnonzero(good))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(kept) for c in ("a", "b")], names=["a", "b"])


def common_runs(labels: np.ndarray, rows: np.ndarray, n: int, heavy: int = 32) -> np.ndarray:
    """Number of labels that each two rows share; a label occurs at most once in a row."""
    order = np.argsort(labels, kind="stable")
    labels, rows = labels[order], rows[order]
    _, first, count = np.unique(labels, return_index=True, return_counts=True)
    out = np.zeros((n, n), dtype=np.float32)
    dense = np.flatnonzero(count > heavy)
    for i in range(0, len(dense), 512):
        part = dense[i : i + 512]
        table = np.zeros((n, len(part)), dtype=np.float32)
        for j, k in enumerate(part):
            table[rows[first[k] : first[k] + count[k]], j] = 1
        out += table @ table.T
    small = np.repeat((count > 1) & (count <= heavy), count)
    own = np.repeat(np.arange(len(count)), count)
    for shift in range(1, heavy):
        a = np.flatnonzero(small[:-shift] & (own[:-shift] == own[shift:])) if len(own) > shift else np.zeros(0, int)
        if not len(a):
            break
        np.add.at(out, (rows[a], rows[a + shift]), 1)
        np.add.at(out, (rows[a + shift], rows[a]), 1)
    return out


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between different components in the blocks of wide buckets, as many as join them."""
    for table in groups(batches, ["bucket", "one", "two"]):
        table = table.combine_chunks()
        node, component = table["node"].to_numpy(), table["component"].to_numpy()
        block, one, two = table["block"].to_numpy(), table["one"][0].as_py(), table["two"][0].as_py()
        words = Words(table["text"])
        runs, _ = words.grams(RUN)
        labels, first = labelled_runs(words)
        size = np.diff(first)
        n = len(node)
        common = common_runs(labels, np.repeat(np.arange(n), size), n)
        both = size[:, None] + size[None, :]
        likely = common >= THRESHOLD * (both - common) - 1e-6
        likely &= component[:, None] != component[None, :]
        if one != two:
            likely &= block[:, None] != block[None, :]
        parent = {c: c for c in component.tolist()}

        def root(c: int, parent: dict = parent) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        found = []
        for i, j in zip(*np.nonzero(np.triu(likely)), strict=True):
            a, b = root(component[i].item()), root(component[j].item())
            if a != b and aligned(runs[first[i] : first[i + 1]].tolist(), runs[first[j] : first[j + 1]].tolist()):
                parent[max(a, b)] = min(a, b)
                found.append((min(node[i], node[j]), max(node[i], node[j])))
        a, b = ([int(f[k]) for f in found] for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the threshold."""
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    joined = joined.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    found = joined.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a bigint, b bigint")
    return stored(found.distinct(), "links")


def near_classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, kept, n_runs): the least id of each document's class of near duplicates."""
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = stored(rows.mapInArrow(_sign, _SIGNATURES), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND n > 0")
    same = stored(
        usable.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "classes",
    )
    members = same.select("node", "n", F.explode("sketch").alias("bucket"))
    full = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(full, "bucket"), "buckets")
    close = 0.8 - 1e-9

    # Each member with the most popular one of its buckets.
    popular = members.groupBy("node").agg(F.sum("size").alias("popularity"))
    ranked = members.join(popular, "node")
    centres = ranked.groupBy("bucket").agg(F.max(F.struct("popularity", F.col("node").alias("centre"), F.col("n").alias("cn"))).alias("c"))
    stars = members.join(centres.select("bucket", "c.centre", "c.cn"), "bucket").where(
        (F.col("node") != F.col("centre")) & (F.least("n", "cn") >= close * F.greatest("n", "cn"))
    )
    stars = stored(
        stars.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), "pairs"
    )
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    texts = stored(rows.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text").dropDuplicates(["node"]), "texts")
    links = _links(stars, texts)
    found = stored(components(links, "a", "b"), "components")

    # Bucket members still in different components.
    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = placed.groupBy("bucket", "component").agg(F.count("*").alias("c"))
    spread = spread.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.sum("c").alias("members"), F.max(F.struct("c", "component")).alias("m")
    )
    open_ = spread.where("parts > 1").select("bucket", "members", F.col("m.component").alias("major"))
    opened = stored(placed.join(open_, "bucket").select("bucket", "node", "n", "component", "major", "members"), "open")
    placed = opened.where(F.col("members") <= WIDE)
    minor = placed.where("component <> major").select("bucket", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "component")])
    rest = minor.join(placed, "bucket").where(
        (F.col("x_component") != F.col("component"))
        & ((F.col("component") == F.col("major")) | (F.col("x_node") < F.col("node")))
        & (F.least("n", "x_n") >= close * F.greatest("n", "x_n"))
    )
    rest = rest.select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b")).distinct()
    more = _links(rest.join(stars, ["a", "b"], "left_anti"), texts)

    wide = opened.where(F.col("members") > WIDE)
    blocks = wide.groupBy("bucket").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("n") / BLOCK_RUNS)).cast("int").alias("blocks")
    )
    wide = wide.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    wide = wide.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    wide = wide.select(
        "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "component"
    )
    order = ["bucket", "one", "two"]
    wide = wide.join(texts, "node").repartition(parts(documents.sparkSession), *order).sortWithinPartitions(*order)
    across = stored(wide.mapInArrow(_block_links, "a bigint, b bigint").distinct(), "links")
    found = stored(components(links.union(more).union(across), "a", "b"), "components")

    nodes = same.select("k1", "k2", "node").join(found, "node", "left")
    nodes = stored(nodes.select("k1", "k2", F.coalesce("component", "node").alias("class_id")), "nodes")
    out = signed.join(nodes, ["k1", "k2"], "left").select(
        "doc_id",
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.col("n").alias("n_runs"),
    )
    return out.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"), "n_runs")


def op4(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return near_classes(read_table(spark, sf_dir, "documents"))


def pipeline_stage(spark, documents: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the least id; documents without an id stay."""
    kept = near_classes(documents).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    known = documents.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    return known.select(columns).union(documents.where("doc_id IS NULL").select(columns))
