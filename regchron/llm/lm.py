"""Language-model scoring with an Elias-Fano bigram trie.

Training counts words and bigrams of all documents outside the held-out fold. The model is a smoothed
bigram model with a prior of ``PRIOR`` observations per context a:

    p(b | a) = c(a, b) / (c(a) + PRIOR)                     if (a, b) was seen in training
             = PRIOR / (c(a) + PRIOR) * p(b)                else,   p(b) = (c(b) + 1) / (N + V + 1)

which never sums to more than one before rounding. Contexts are dealt over shards of about ``SHARD_TOKENS``
tokens. A shard keeps its packed rows and works through them in slices of neighbouring contexts, ``SLICE``
bigrams at a time: a slice is unpacked and counted, its part of the trie is built, read and dropped. It has
two levels in flat arrays: the contexts, and their successors. Both levels, the pointers from the first into
the second and the contexts' counts (as running sums) are monotone sequences in Elias-Fano code. The
successors of context i are stored as i * width + rank of the word, relative to their context, which makes the
whole level one monotone sequence; a lookup is a successor search for that value between the context's two
pointers. Logarithms of probabilities are rounded to multiples of 1 / STEPS and kept as 16-bit codes, none of
which is clamped: counts below 2**63 need codes below 32 * 19.

A batch of documents is reduced to its distinct bigrams before it is shuffled, packed into one row per batch
and shard; a shard counts, builds its trie and looks up every distinct bigram once. Its answer is a code of two
bytes for each bigram of a batch and the count of each context, whatever the number of documents, so that
answers grow with the bigrams alone and not with documents times shards. The documents are read once more to say
in which of them the bigrams of a batch stand; with the batch's answers this gives the sums per document. Every
word of a batch is a context there, so the answers also hold the counts of the words after unseen bigrams. Words
that are a large share of all tokens (a bounded number, by definition of the share) are spread over several shards
by their successors. Rows that do not come from files as they are read are stored first, since all readings must
bring the same rows in the same order; a batch whose contexts are not those that were answered is an error.

Defined results: null and empty texts have the end token alone; equal rows get equal scores, one result
per row; a null id counts as the empty text in the choice of held-out rows; without training documents
N and V are 0. Only the two named columns are read. Words are compared by 64-bit hashes, successors
within a context by 48 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import TOKEN_BYTES, U, Words, chunks, groups, mix, parts, read_table, stored

FOLDS, HELD_OUT = 7, 2
PRIOR = 2.0
BATCH_BYTES = 4 << 20
# Code c stands for a log10 probability of -c / STEPS.
STEPS = 32
# Bigrams of a shard that are unpacked at a time, and tokens of a shard.
SLICE = 1 << 18
SHARD_TOKENS = 4 << 20
START = int(mix(np.array([0xA11CE], dtype=U))[0])
END = int(mix(np.array([0xB0B], dtype=U))[0])
SHORT = U((1 << 48) - 1)

# The code of a bigram that was not seen in training.
UNSEEN = 0xFFFF
CHANGED = "the documents were not the same at both readings"

# Numbers that are mostly small go in two columns, their lowest bytes in the first, as shuffled blocks shrink by that.
_PACKED = "shard int, task int, batch int, context binary, width binary, next binary, train binary, train2 binary"
# Answers of the shards, and the layout of a batch: the row that precedes them, of shard -1.
_ANSWERS = (
    "task int, batch int, shard int, code binary, code2 binary, total binary, total2 binary, unseen binary, mark bigint"
)
_LAYOUT = (
    "task int, batch int, shard int, ids array<bigint>, tokens binary, held binary,"
    " context binary, width binary, times binary, doc binary"
)
_DOCUMENTS = (
    "task int, batch int, doc int, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


class EliasFano:
    """A monotone sequence of unsigned integers: low bits packed, high bits in unary."""

    def __init__(self, values: np.ndarray, largest: int):
        n = len(values)
        self.n = n
        self.low_bits = max(0, min(56, int(largest // max(n, 1)).bit_length() - 1))
        low = values & U((1 << self.low_bits) - 1)
        high = (values >> U(self.low_bits)).astype(np.int64)
        self.low = self._pack(low, self.low_bits)
        total = (int(high[-1]) if n else 0) + n + 64
        bits = np.zeros(-(-total // 64) * 64, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        self.high = np.packbits(bits, bitorder="little").view(U)
        # Zeros before each 64-bit word, and ones before it.
        ones = np.bitwise_count(self.high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        self.last_high = int(high[-1]) if n else -1

    @staticmethod
    def _pack(values: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros(len(values) * width // 8 + 16, dtype=np.uint8)
        if width:
            for i in range(0, len(values), 1 << 16):  # a multiple of 8 values fills whole bytes
                part = values[i : i + (1 << 16)]
                bits = ((part[:, None] >> np.arange(width, dtype=U)) & U(1)).astype(np.uint8)
                packed = np.packbits(bits.ravel(), bitorder="little")
                out[i * width // 8 : i * width // 8 + len(packed)] = packed
        return out

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), dtype=U)
        at = index * self.low_bits
        byte = at >> 3
        word = np.zeros(len(index), dtype=U)
        for k in range(8):
            word |= self.low[byte + k].astype(U) << U(8 * k)
        return (word >> (at & 7).astype(U)) & U((1 << self.low_bits) - 1)

    def _place(self, k: np.ndarray, before: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero."""
        word = np.searchsorted(before, k, side="right") - 1
        left = (k - before[word]).astype(np.int64)
        bits = self.high[word] if ones else ~self.high[word]
        place = word * 64
        for width in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(bits & U((1 << width) - 1)).astype(np.int64)
            go = left >= here
            left = left - here * go
            place = place + width * go
            bits = np.where(go, bits >> U(width), bits)
        return place

    def get(self, index: np.ndarray) -> np.ndarray:
        high = self._place(index, self.ones, True) - index
        return (high.astype(U) << U(self.low_bits)) | self._low(index)

    def successor(self, values: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Index of the first element in [begin, end) that is not less than the value; ``end`` if there is none."""
        end = self.n if end is None else end
        high = (values >> U(self.low_bits)).astype(np.int64)
        inside = np.minimum(high, self.last_high + 1)
        low_end = np.where(inside > 0, self._place(np.maximum(inside - 1, 0), self.zeros, False) - (inside - 1), 0)
        high_end = np.where(inside <= self.last_high, self._place(inside, self.zeros, False) - inside, self.n)
        low_end, high_end = np.clip(low_end, begin, end), np.clip(high_end, begin, end)
        wanted = values & U((1 << self.low_bits) - 1)
        while True:
            open_ = np.flatnonzero(low_end < high_end)
            if not len(open_):
                return low_end
            middle = (low_end[open_] + high_end[open_]) // 2
            below = self._low(middle) < wanted[open_]
            low_end[open_] = np.where(below, middle + 1, low_end[open_])
            high_end[open_] = np.where(below, high_end[open_], middle)

    def find(self, values: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Index of each value, -1 where it is missing."""
        at = self.successor(values, begin, end)
        limit = np.broadcast_to(self.n if end is None else end, at.shape)
        out = np.full(len(values), -1, dtype=np.int64)
        some = np.flatnonzero(at < limit)
        same = self.get(at[some]) == values[some]
        out[some[same]] = at[some[same]]
        return out


class Trie:
    """Contexts and their successors with quantised probabilities."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, totals: dict[int, int] | None = None):
        """From distinct bigrams sorted by context and word, with positive counts."""
        contexts, first = np.unique(context, return_index=True)
        words = np.unique(word)
        self.width = max(1, len(words))
        own = np.repeat(np.arange(len(contexts)), np.diff(np.append(first, len(context))))
        self.words = EliasFano(words, int(SHORT))
        self.contexts = EliasFano(contexts, 2**64 - 1)
        self.pointers = EliasFano(np.append(first, len(context)).astype(U), max(1, len(context)))
        inner = own.astype(U) * U(self.width) + np.searchsorted(words, word).astype(U)
        self.successors = EliasFano(inner, max(1, len(contexts)) * self.width)
        sums = np.add.reduceat(count, first) if len(count) else np.zeros(0, np.int64)
        for i in range(len(contexts)) if totals else ():
            sums[i] = totals.get(int(contexts[i]), sums[i])
        running = np.concatenate([[0], np.cumsum(sums)]).astype(U)
        self.totals = EliasFano(running, max(1, int(running[-1])))
        log = np.log10(count / (sums[own] + PRIOR)) if len(count) else np.zeros(0)
        self.codes = np.round(-log * STEPS).astype(np.uint16)

    def total(self, context: np.ndarray) -> np.ndarray:
        """Training count of each context."""
        at = self.contexts.find(context)
        out = np.zeros(len(context), dtype=np.int64)
        some = np.flatnonzero(at >= 0)
        out[some] = (self.totals.get(at[some] + 1) - self.totals.get(at[some])).astype(np.int64)
        return out

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 probability of each seen bigram, not-a-number for others."""
        out = np.full(len(context), np.nan)
        at, rank = self.contexts.find(context), self.words.find(word)
        some = np.flatnonzero((at >= 0) & (rank >= 0))
        at = at[some]
        begin, end = self.pointers.get(at).astype(np.int64), self.pointers.get(at + 1).astype(np.int64)
        found = self.successors.find(at.astype(U) * U(self.width) + rank[some].astype(U), begin, end)
        seen = found >= 0
        out[some[seen]] = self.codes[found[seen]].astype(np.float64) / -STEPS
        return out


def _tokens(column: pa.Array) -> Words:
    return Words(column, TOKEN_BYTES)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", BATCH_BYTES):
        words, n = np.unique(_tokens(batch.column("text")).hashes, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])


def _bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values from an array cut at its ``ends``, the last of which is its length."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * values.itemsize
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def _flat(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column one after the other, and their number in each row."""
    found, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for chunk in column.cast(pa.large_binary()).chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        sizes.append(np.diff(offsets))
        if offsets[-1] > offsets[0]:
            found.append(np.frombuffer(chunk.buffers()[2], np.uint8)[offsets[0] : offsets[-1]])
    return np.concatenate(found).view(kind), np.concatenate(sizes) // np.dtype(kind).itemsize


def _pressed(values: np.ndarray) -> bytes:
    """The number of values, and their lowest bytes, next bytes and so on in zstd."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.ravel(), codec="zstd", asbytes=True)


def _unpressed(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def _wide(short: np.ndarray) -> np.ndarray:
    """Words of six bytes as integers."""
    wide = np.zeros((len(short), 8), dtype=np.uint8)
    wide[:, :6] = short
    return wide.view("<u8").ravel().astype(U)


def _marks(names: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each row's contexts; no row is empty."""
    return np.add.reduceat(names, np.cumsum(sizes) - sizes).view(np.int64) if len(sizes) else np.zeros(0, np.int64)


def _pack(shards: int, spread: dict[int, int], layout: bool = False) -> Callable:
    """One row per shard with the distinct bigrams of a batch; or one row that says in which documents they stand."""
    hot = np.array(sorted(spread), dtype=U)
    ways = np.array([spread[int(h)] for h in hot], dtype=U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for whole in chunks(batches, "text", BATCH_BYTES):
            for at in range(0, whole.num_rows, 1 << 16):
                batch = whole.slice(at, 1 << 16)
                task = batch.column("task")[0].as_py()
                words = _tokens(batch.column("text"))
                n = batch.num_rows
                held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
                # START before the first word and END after the last.
                size = words.counts + 1
                ends = np.cumsum(size)
                context = np.empty(int(ends[-1]), dtype=U)
                following = np.empty(len(context), dtype=U)
                place = np.arange(len(words.hashes)) + words.rows
                context[place + 1] = words.hashes
                context[ends - size] = START
                following[place] = words.hashes
                following[ends - 1] = END
                doc = np.repeat(np.arange(n), size)
                del words, place
                shard = mix(context)
                if len(hot):
                    where = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
                    some = hot[where] == context
                    shard[some] += following[some] % ways[where[some]]
                shard = (shard % U(shards)).astype(np.int64)
                order = np.lexsort((following, context, shard))
                shard, context, following, doc = shard[order], context[order], following[order], doc[order]
                new = np.ones(len(context), dtype=bool)
                new[1:] = (context[1:] != context[:-1]) | (following[1:] != following[:-1])
                first = np.flatnonzero(new)
                newc = np.ones(len(first), dtype=bool)
                newc[1:] = (context[first][1:] != context[first][:-1]) | (shard[first][1:] != shard[first][:-1])
                firstc = np.flatnonzero(newc)
                widths = np.diff(np.append(firstc, len(first))).astype(np.uint32)
                names = context[first][firstc]
                if layout:
                    times = np.diff(np.append(first, len(context))).astype(np.uint32)
                    row = [task, number, -1, batch.column("doc_id").to_pylist()]
                    row += [_pressed(x) for x in (size.astype(np.int64), held, names, widths, times, doc.astype(np.uint16))]
                    kinds = [pa.int32()] * 3 + [pa.list_(pa.int64())] + [pa.binary()] * 6
                    columns = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=_names(_LAYOUT))
                else:
                    train = np.add.reduceat((~held[doc]).astype(np.int64), first)
                    short = np.ascontiguousarray((following[first] & SHORT).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
                    cut_pair = np.flatnonzero(np.append(np.diff(shard[first]) != 0, True)) + 1
                    cut_context = np.searchsorted(firstc, cut_pair)
                    own = shard[first][cut_pair - 1].astype(np.int32)
                    numbers = [pa.array(np.full(len(own), x, np.int32)) for x in (task, number)]
                    columns = [pa.array(own), *numbers, _bytes(names, cut_context), _bytes(widths, cut_context)]
                    columns += [_bytes(short.ravel(), cut_pair * 6), _bytes(train.astype(np.uint8), cut_pair)]
                    columns += [_bytes((train >> 8).astype(np.uint32), cut_pair)]
                    yield pa.RecordBatch.from_arrays(columns, names=_names(_PACKED))
                number += 1

    return run


def _shard(totals: dict[int, int], slice_size: int) -> Callable:
    """Count, build the trie and look up every distinct bigram of each batch."""
    hot = np.array(sorted(totals), dtype=U)
    hot_total = np.array([totals[int(h)] for h in hot], dtype=np.int64)

    def answered(context: np.ndarray, word: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, ...]:
        """The code of every bigram of a slice, its contexts and their counts."""
        order = np.lexsort((word, context))
        new = np.ones(len(order), dtype=bool)
        c, w = context[order], word[order]
        new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
        pair = np.empty(len(order), dtype=np.int64)
        pair[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        c, w = c[first], w[first]
        count = np.add.reduceat(train[order], first)
        trained = count > 0
        trie = Trie(c[trained], w[trained], count[trained], totals)
        found = trie.lookup(c, w)
        names = np.unique(c)
        total = trie.total(names)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
            total = np.where(hot[at] == names, hot_total[at], total)
        code = np.where(np.isnan(found), UNSEEN, np.round(found * -STEPS)).astype(np.uint16)
        return code[pair], names, total

    def solve(rows: pa.Table) -> pa.RecordBatch:
        """One shard: its packed rows stay, and a slice of contexts at a time is unpacked, counted and looked up."""
        names, n_names = _flat(rows["context"], U)
        width, short = _flat(rows["width"], np.uint32)[0].astype(np.int64), _flat(rows["next"], np.uint8)[0].reshape(-1, 6)
        train, n_pairs = _flat(rows["train"], np.uint8)
        train = train + (_flat(rows["train2"], np.uint32)[0].astype(np.int64) << 8)
        starts = np.cumsum(width) - width
        code, total = np.empty(len(train), dtype=np.uint16), np.empty(len(names), dtype=np.int64)
        order = np.argsort(names, kind="stable")
        # Contexts and bigrams up to the last row of each distinct context.
        last = np.flatnonzero(np.append(names[order][1:] != names[order][:-1], True))
        upto = np.cumsum(width[order])[last]
        at = done = 0
        while at < len(order):
            to = max(int(np.searchsorted(upto, done + slice_size, side="right")) - 1, int(np.searchsorted(last, at)))
            own, at, done = order[at : last[to] + 1], int(last[to]) + 1, int(upto[to])
            wide = width[own]
            pairs = np.repeat(starts[own] - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
            found, known, counts = answered(np.repeat(names[own], wide), _wide(short[pairs]), train[pairs])
            code[pairs] = found
            total[own] = counts[np.searchsorted(known, names[own])]
        end_names, end_pairs = np.cumsum(n_names), np.cumsum(n_pairs)
        missed = code == UNSEEN
        end_missed = np.concatenate([[0], np.cumsum(missed)])[end_pairs]
        columns = [rows[c].combine_chunks() for c in ("task", "batch", "shard")]
        columns += [_bytes(code.astype(np.uint8), end_pairs), _bytes((code >> 8).astype(np.uint8), end_pairs)]
        columns += [_bytes(total.astype(np.uint16), end_names), _bytes(total >> 16, end_names)]
        columns += [_bytes(short[missed].ravel(), end_missed * 6)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(_marks(names, n_names))], names=_names(_ANSWERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come ordered by shard.
        for rows in groups(batches, ["shard"]):
            yield solve(rows)

    return run


def _sum(endings: int, log_all: float) -> Callable:
    """The sums of the documents of each batch; its layout comes first, then its answers in the order of the shards."""

    def summed(rows: pa.Table) -> pa.RecordBatch:
        layout, answers = rows.slice(0, 1), rows.slice(1)
        if layout["tokens"].null_count:
            raise ValueError(CHANGED)
        tokens, held, names, width, times, doc = (
            _unpressed(layout[c][0].as_py(), k)
            for c, k in (("tokens", np.int64), ("held", bool), ("context", U), ("width", np.uint32), ("times", np.uint32), ("doc", np.uint16))
        )
        code = _flat(answers["code"], np.uint8)[0] + (_flat(answers["code2"], np.uint8)[0].astype(np.uint16) << 8)
        total, n_names = _flat(answers["total"], np.uint16)
        total = total + (_flat(answers["total2"], np.int64)[0] << 16)
        same = len(names) == len(total) and len(times) == len(code)
        if not same or (_marks(names, n_names) != answers["mark"].to_numpy()).any():
            raise ValueError(CHANGED)
        n = len(tokens)
        own = np.repeat(np.arange(len(names)), width)
        value = code / -STEPS
        missed = np.flatnonzero(code == UNSEEN)
        # Counts of the words after unseen bigrams, from their own entries as contexts.
        word = _wide(_flat(answers["unseen"], np.uint8)[0].reshape(-1, 6))
        short = names & SHORT
        order = np.flatnonzero(names != U(START))
        order = order[np.argsort(short[order], kind="stable")]
        count = np.full(len(word), endings, dtype=np.int64)
        inner = word != U(END) & SHORT
        count[inner] = total[order[np.searchsorted(short[order], word[inner])]]
        value[missed] = np.log10(PRIOR / (total[own[missed]] + PRIOR)) + (np.log10(count + 1.0) - log_all)
        is_word = names != U(START)
        base = np.where(is_word, np.log10(total + 1.0), 0.0)
        known = (is_word & (total > 0)).astype(np.float64)
        doc = doc.astype(np.int64)
        sums = [np.bincount(doc, weights=np.repeat(x, times), minlength=n) for x in (value, base[own], known[own])]
        key = [np.full(n, layout[c][0].as_py(), np.int32) for c in ("task", "batch")]
        columns = [
            pa.array(key[0]), pa.array(key[1]), pa.array(np.arange(n, dtype=np.int32)), layout["ids"].chunk(0).flatten(),
            pa.array(held), pa.array(tokens), pa.array(sums[2].astype(np.int64)), pa.array(sums[1]), pa.array(sums[0]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_names(_DOCUMENTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come ordered by task, batch and shard.
        for rows in groups(batches, ["task", "batch"]):
            yield summed(rows)

    return run


def _from_files(rows: DataFrame) -> bool:
    """Whether the rows are those of files, without a shuffle."""
    plans = [rows._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName() not in ("Project", "Filter", "Union") and "LogicalRelation" not in plan.getClass().getName():
            return False
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return True


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with the number of their partition; files are read by splits that are decided once, here."""
    jvm, spark = rows._jdf, rows.sparkSession
    fixed = spark._jsparkSession.internalCreateDataFrame(jvm.queryExecution().toRdd(), jvm.schema(), False)
    return DataFrame(fixed, spark).withColumn("task", F.spark_partition_id())


def score_texts(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
    slice_size: int = SLICE,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    spark = documents.sparkSession
    held = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT
    rows = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), held.alias("held")
    )
    if not _from_files(rows):
        rows = stored(rows, "documents")
    counted = rows.where(~F.col("held")).select("text").mapInArrow(_count_words, "word bigint, n bigint")
    vocabulary = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    whole = vocabulary.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    endings = rows.where(~F.col("held")).count()
    tokens, distinct = whole.n + endings, whole.v + (1 if endings else 0)
    # As many shards as the counted tokens need, so that a shard's packed rows are bounded.
    shards = shards or max(parts(spark), -(-tokens // SHARD_TOKENS))
    # A word with more than this many tokens is spread; there are at most 2 * shards of them.
    share = max(1, tokens // (2 * shards))
    frequent = {int(np.int64(r.word).view(U)): r.n for r in vocabulary.where(F.col("n") > share).collect()}
    if endings > share:
        frequent[START] = endings
    spread = {h: -(-n // share) for h, n in frequent.items()}

    numbered = _numbered(rows)
    packed = numbered.mapInArrow(_pack(shards, spread), _PACKED).repartitionById(shards, F.col("shard"))
    answers = packed.sortWithinPartitions("shard").mapInArrow(_shard(frequent, slice_size), _ANSWERS)
    layout = numbered.mapInArrow(_pack(shards, spread, layout=True), _LAYOUT)
    by_batch = layout.unionByName(answers, allowMissingColumns=True).repartition(shards, "task", "batch")
    by_batch = by_batch.sortWithinPartitions("task", "batch", "shard")

    log_all = float(np.log10(tokens + distinct + 1.0))
    found = by_batch.mapInArrow(_sum(endings, log_all), _DOCUMENTS)
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + (1 if endings else 0)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + float(np.log10(endings + 1.0)) - F.col("n_tokens") * log_all).alias("base_score"),
        "score",
    )


def op10(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return score_texts(read_table(spark, sf_dir, "documents"))
