"""SentencePiece encoding and decoding by suffix-array matching.

For the BPE models of the library, with byte fallback. The texts of an Arrow batch are cut where a run
of blanks begins; no piece has a blank after another character, so these segments are encoded
independently, and each distinct segment once per batch. The distinct segments are concatenated and
indexed by a suffix array (sorted to the length of the longest piece). Every piece of the vocabulary is
then searched in it by binary search; its range holds all its occurrences. The occurrences are the
edges of a lattice. They are sorted by where they end and relaxed from left to right, for all segments
at once.

Relaxing is exact for BPE: a piece b may follow piece a exactly if encoding the characters of both gives
(a, b) again, and every prefix has exactly one encoding, so that each position keeps the one edge whose
predecessor it may follow. Which pairs may meet is found by running the merges on the pair and
remembered per worker in a table of fixed size.

Defined results: null and empty texts have no pieces, and decode to an empty text; characters outside
the vocabulary become byte pieces; the sign U+2581 stands for a blank and decodes to one, which is
the only loss (``lossless`` is false there); equal rows give equal results; input columns named like a
result are replaced by it, all others are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import BYTE_VALUES_2, U, chunks, mix, read_table, span_hashes, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RESULTS = ("n_pieces", "ids", "decoded", "lossless")
BLANK = "▁"
# Values of bytes for segments: here case counts.
_EXACT = mix(np.arange(256, dtype=U) + U(77))
# Ends a segment in the index; no byte of UTF-8.
_STOP = 255
# Slots of the table of pairs.
_SLOTS = 1 << 21
# Bytes of text indexed at a time: its edges take about a hundred times as much memory.
INDEXED_BYTES = 2 << 20


class Model:
    """Pieces, merges and byte pieces of a model, as arrays."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = np.zeros(256, dtype=np.int32)
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        bytes_ = []
        for i, name in enumerate(names):
            if sp.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_id[value] = i
                bytes_.append(bytes([value]))
            elif sp.is_unknown(i):
                bytes_.append(" ⁇ ".encode())
            else:
                bytes_.append(name.replace(BLANK, " ").encode() if plain[i] else b"")
        self.bytes = pa.array(bytes_, pa.binary())
        self.length = np.array([len(b) for b in bytes_], dtype=np.int64)
        scores = -np.array([sp.get_score(i) for i in range(n)])
        order = np.unique(scores, return_inverse=True)[1]
        known = {names[i].replace(BLANK, " "): i for i in range(n) if plain[i]}
        pairs = {}
        for piece, i in known.items():
            for cut in range(1, len(piece)):
                left, right = known.get(piece[:cut]), known.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * n + right] = i
        self.pair = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.pair.tolist()], dtype=np.int32)
        self.rank = order[self.merged]
        self.never = int(order.max()) + 1
        self.chars = {p: i for p, i in known.items() if len(p) == 1}
        self.symbols: list[list[int]] = [[]] * n
        for piece, i in known.items():
            if all(c in self.chars for c in piece):
                self.symbols[i] = [self.chars[c] for c in piece]
        # Pieces the merges reach; others never occur in an encoding.
        ids = [i for i in known.values() if self.symbols[i]]
        reached = [out == [i] for i, out in zip(ids, self.merge([self.symbols[i] for i in ids]), strict=True)]
        self.usable = np.array([i for i, r in zip(ids, reached, strict=True) if r], dtype=np.int32)
        self.words = -(-int(self.length[self.usable].max()) // 8)
        self.low, self.high = self._bounds()
        self.slot_key = np.full(_SLOTS, -1, dtype=np.int64)
        self.slot_value = np.zeros(_SLOTS, dtype=bool)

    def _bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Each usable piece as the least and the greatest suffix that begins with it."""
        raw = self.bytes.take(pa.array(self.usable)).to_pylist()
        width = 8 * self.words

        def keys(fill: bytes) -> np.ndarray:
            return np.frombuffer(b"".join(b.ljust(width, fill) for b in raw), dtype=">u8").astype(U).reshape(len(raw), -1)

        return keys(b"\x00"), keys(b"\xff")

    def merge(self, rows: list[list[int]]) -> list[list[int]]:
        """The merges run on rows of symbols: always the best pair, leftmost first."""
        width = max(map(len, rows), default=0)
        table = np.full((len(rows), width + 1), -1, dtype=np.int64)
        for i, row in enumerate(rows):
            table[i, : len(row)] = row
        return [r[r >= 0].tolist() for r in self.merge_table(table)]

    def merge_table(self, table: np.ndarray) -> np.ndarray:
        active = np.arange(len(table))
        columns = np.arange(table.shape[1])
        while len(active):
            own = table[active]
            key = np.where((own[:, :-1] >= 0) & (own[:, 1:] >= 0), own[:, :-1] * self.size + own[:, 1:], -1)
            at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            rank = np.where(self.pair[at] == key, self.rank[at], self.never)
            best = rank.argmin(axis=1)
            row = np.arange(len(own))
            go = rank[row, best] < self.never
            active, own, best, at = active[go], own[go], best[go], at[go]
            if not len(active):
                break
            new = self.merged[at[np.arange(len(own)), best]]
            source = np.minimum(columns[None, :] + (columns[None, :] > best[:, None]), table.shape[1] - 1)
            own = np.take_along_axis(own, source, axis=1)
            own[:, -1] = -1
            own[np.arange(len(own)), best] = new
            table[active] = own
        return table

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the characters of pieces a and b are encoded as (a, b)."""
        key = a.astype(np.int64) * self.size + b
        slot = (mix(key.view(U)) >> U(43)).astype(np.int64)
        known = self.slot_key[slot] == key
        out = self.slot_value[slot]
        if not known.all():
            new, inverse = np.unique(key[~known], return_inverse=True)
            value = np.zeros(len(new), dtype=bool)
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                pairs = list(zip((part // self.size).tolist(), (part % self.size).tolist(), strict=True))
                merged = self.merge([self.symbols[x] + self.symbols[y] for x, y in pairs])
                value[i : i + 20_000] = [m == [x, y] for m, (x, y) in zip(merged, pairs, strict=True)]
            at = (mix(new.view(U)) >> U(43)).astype(np.int64)
            self.slot_key[at], self.slot_value[at] = new, value
            # Of keys that share a slot the last one stays, with its own value.
            self.slot_value[at] = value[np.searchsorted(new, self.slot_key[at])]
            out[~known] = value[inverse]
        return out


_models: dict[str, Model] = {}


def model_at(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _lower_bound(suffixes: list[np.ndarray], keys: np.ndarray, strict: bool) -> np.ndarray:
    """For each key the number of sorted suffixes below it (or not above it)."""
    low = np.zeros(len(keys), dtype=np.int64)
    high = np.full(len(keys), len(suffixes[0]), dtype=np.int64)
    for _ in range(int(len(suffixes[0])).bit_length()):
        middle = (low + high) // 2
        open_ = low < high
        at = np.minimum(middle, len(suffixes[0]) - 1)
        below = np.zeros(len(keys), dtype=bool)
        equal = np.ones(len(keys), dtype=bool)
        for j, column in enumerate(suffixes):
            value = column[at]
            below |= equal & (value < keys[:, j])
            equal &= value == keys[:, j]
        if not strict:
            below |= equal
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def _suffix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order of suffixes by their leading words; the later words are looked at within ties only."""
    order = np.argsort(keys[0])
    first = keys[0][order]
    same = np.concatenate([[False], first[1:] == first[:-1]])
    tied = same.copy()
    tied[:-1] |= same[1:]
    at = np.flatnonzero(tied)
    group = np.cumsum(~same)[at]
    inner = order[at]
    order[at] = inner[np.lexsort([*(k[inner] for k in keys[:0:-1]), group])]
    return order


def _edges(model: Model, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, piece) of every occurrence of every usable piece at the given places of the index."""
    padded = np.concatenate([data, np.full(8 * model.words + 8, _STOP, dtype=np.uint8)])
    word = np.zeros(len(padded) - 7, dtype=U)
    for j in range(8):
        word = (word << U(8)) | padded[j : len(padded) - 7 + j]
    keys = [word[places + 8 * j] for j in range(model.words)]
    order = _suffix_order(keys)
    suffixes = [k[order] for k in keys]
    first = _lower_bound(suffixes, model.low, True)
    last = _lower_bound(suffixes, model.high, False)
    n = np.maximum(last - first, 0)
    entry = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return places[order[entry]], np.repeat(model.usable, n)


def _encode_segments(model: Model, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each segment, flat, and their offsets. ``data`` holds the segments with a stop after each."""
    n = len(data)
    ends = starts + sizes
    lead = (data & 0xC0) != 0x80
    lead[ends] = False
    places = np.flatnonzero(lead)
    start, piece = _edges(model, data, places)
    end = start + model.length[piece]
    # Characters without a piece of their own are edges with the negative byte count as their piece.
    char_end = np.append(places[1:], n)
    begin_of, end_of = np.repeat(starts, sizes + 1), np.repeat(ends, sizes + 1)
    char_end = np.minimum(char_end, end_of[places])
    single = np.zeros(n, dtype=bool)
    covers = np.zeros(n, dtype=np.int64)
    covers[places] = char_end
    single[start[end == covers[start]]] = True
    raw = places[~single[places]]
    start = np.concatenate([start, raw])
    piece = np.concatenate([piece, raw - covers[raw]])
    end = np.concatenate([end, covers[raw]])
    segment_start = begin_of[start]
    depth = end - segment_start
    order = np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 1 << 16 else depth, kind="stable")
    start, piece, end, segment_start, depth = (x[order] for x in (start, piece, end, segment_start, depth))
    last = np.zeros(n + 1, dtype=np.int64)
    origin = np.full(n + 1, -1, dtype=np.int64)
    cuts = np.flatnonzero(np.diff(depth)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(depth)), strict=True):
        if a == b:
            continue
        s, p = start[a:b], piece[a:b]
        before = last[s]
        good = (s == segment_start[a:b]) | (p < 0) | (before < 0)
        ask = np.flatnonzero(~good & (origin[s] >= 0))
        if len(ask):
            good[ask] = model.may_follow(before[ask], p[ask])
        good &= (s == segment_start[a:b]) | (origin[s] >= 0)
        e = end[a:b][good]
        last[e], origin[e] = p[good], s[good]
    # Walk back from the ends of all segments at once.
    at, segment = ends.copy(), np.arange(len(starts))
    found_segment, found_start, found_piece = [], [], []
    while True:
        going = at > starts[segment]
        at, segment = at[going], segment[going]
        if not len(at):
            break
        if (origin[at] < 0).any():
            raise ValueError("a segment cannot be encoded with this model")
        found_segment.append(segment)
        found_start.append(origin[at])
        found_piece.append(last[at])
        at = origin[at]
    if not found_piece:
        return np.zeros(0, np.int32), np.zeros(len(starts) + 1, np.int64)
    segment, begin, piece = (np.concatenate(x) for x in (found_segment, found_start, found_piece))
    order = np.argsort(begin, kind="stable")
    segment, begin, piece = segment[order], begin[order], piece[order]
    width = np.where(piece < 0, -piece, 1)
    ids = np.repeat(piece, width)
    inner = np.arange(len(ids)) - np.repeat(np.cumsum(width) - width, width)
    raw = ids < 0
    ids[raw] = model.byte_id[data[np.repeat(begin, width)[raw] + inner[raw]]]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(segment, weights=width, minlength=len(starts)))]).astype(np.int64)
    return ids.astype(np.int32), offsets


def encode_column(model: Model, texts: pa.Array) -> pa.ListArray:
    """Ids of all rows of a text column."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if pc.any(pc.match_substring(texts, BLANK)).as_py():
        texts = pc.replace_substring(texts, pattern=BLANK, replacement=" ")
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    data, offsets = text_bytes(texts)
    blank = data == 32
    before = np.concatenate([[False], blank[:-1]])[: len(blank)]
    begins = blank & ~before
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    n = len(starts)
    row_first = np.searchsorted(starts, offsets)
    if not n:
        return pa.ListArray.from_arrays(pa.array(np.zeros(len(texts) + 1, np.int32)), pa.array([], pa.int32()))
    ends = np.append(starts[1:], len(data))
    one = span_hashes(data, starts, ends, _EXACT)
    two = span_hashes(data, starts, ends, BYTE_VALUES_2 ^ _EXACT)
    _, first, inverse = np.unique(one, return_index=True, return_inverse=True)
    if (two != two[first][inverse]).any():  # two segments with one hash
        _, first, inverse = np.unique(np.stack([one, two], axis=1), axis=0, return_index=True, return_inverse=True)
        inverse = inverse.ravel()
    size = (ends - starts)[first]
    at = np.cumsum(size + 1) - size - 1
    joined = np.full(int((size + 1).sum()), _STOP, dtype=np.uint8)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    joined[np.repeat(at, size) + inner] = data[np.repeat(starts[first], size) + inner]
    ids, bounds = _encode_segments(model, joined, at, size)
    count = np.diff(bounds)[inverse]
    total = np.concatenate([[0], np.cumsum(count)])
    take = np.repeat(bounds[:-1][inverse] - total[:-1], count) + np.arange(total[-1])
    return pa.ListArray.from_arrays(pa.array(total[row_first], pa.int32()), pa.array(ids[take]))


def decode_column(model: Model, ids: pa.ListArray) -> pa.Array:
    """Texts of all rows of an id column."""
    flat = ids.flatten()
    raw = model.bytes.take(flat)
    data, _ = text_bytes_binary(raw)
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(model.length[flat.to_numpy(zero_copy_only=False)])])
    offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
    first = offsets[:-1][np.diff(offsets) > 0]
    # The blank put before each text goes.
    drop = np.zeros(len(data), dtype=bool)
    drop[first[data[first] == 32]] = True
    kept = data[~drop]
    offsets = offsets - np.concatenate([[0], np.cumsum(drop)])[offsets]
    out = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept))
    try:
        out.validate(full=True)
        return out.cast(pa.string())
    except pa.ArrowInvalid:  # ids that no encoder made
        return pa.array([kept[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())


def text_bytes_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and len(column) else np.zeros(0, np.uint8)
    return (data[offsets[0] : offsets[-1]], offsets) if len(column) else (data, np.zeros(1, np.int32))


def encode(documents: DataFrame, text: str = "text", model_path: str = MODEL, chunk_bytes: int = INDEXED_BYTES) -> DataFrame:
    """The documents with ``n_pieces``, ``ids``, ``decoded`` and ``lossless`` (decoded equals the text)."""
    kept = documents.drop(*[c for c in RESULTS if c != text]).withColumn(text, F.col(text).cast("string"))
    schema = kept.selectExpr("*", "0L AS n_pieces", "cast(array() AS array<int>) AS ids", "'' AS decoded", "true AS lossless").schema
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        for batch in chunks(batches, text, chunk_bytes):
            texts = batch.column(text)
            ids = encode_column(model, texts)
            decoded = decode_column(model, ids)
            same = pc.equal(decoded, pc.fill_null(texts, "").cast(pa.string()))
            count = pc.list_value_length(ids).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], count, ids, decoded, same], names=[*names, *RESULTS]
            )

    return kept.mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    done = encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_pieces", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "lossless")


def pipeline_stage(spark, documents: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids; the text read back from the ids has to be the text."""
    done = encode(documents.select("doc_id", "text", "lang", "source"))
    return done.select("doc_id", "lang", "source", "n_pieces", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "lossless")
