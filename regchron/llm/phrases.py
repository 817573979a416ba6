"""Phrase mining with stripes: an associative counter of next words for every prefix.

A stripe belongs to a prefix of words and counts what follows it. Tasks build partial stripes of their rows,
Spark brings the partial stripes of a prefix together, and they are merged elementwise. All figures come
out of merged stripes: an entry is the frequency of the prefix extended by that word, the sum of all entries
is the frequency of the prefix (what follows a prefix at the end of its piece, or cannot matter, is counted
under ``OTHER``), and the greatest entry is the strongest phrase the prefix lies in on its right; turned round, the
entries of all prefixes give the strongest phrase on the left.

The empty prefix comes first and gives the words, then prefixes of one word, and so on. A phrase that occurs
``least`` times is made of shorter ones that do, and no figure of a rarer phrase is ever asked for. So a stripe
is built only for such prefixes, and only such extensions have an entry of their own. Which ones these are is
sent to the tasks as a bit map of ``SLOTS`` bits over the hashes of the frequent shorter phrases: its size is
fixed, it misses none, and what it lets through beyond them is dropped after merging.

What bounds memory: texts are read ``CHUNK`` bytes at a time (a longer text alone), and a task sends its partial
stripes on whenever it holds ``HELD`` counts. Stripes travel in buckets: a row holds a task's partial stripes of
all prefixes of one bucket, and the rows of a bucket are merged as they arrive, ``HELD`` entries at a time however
many a batch brings, so that it takes no more room than its distinct entries. There are enough buckets for about ``ENTRIES`` entries in each. A stripe has no more entries
than its prefix has occurrences; the prefixes with more than 1 / HOT of all words, of which there are at most
HOT, are dealt to many buckets by the next word. All counting happens before the shuffle, so a frequent
prefix sends one stripe per ``HELD`` counts.

Words are told apart by 64-bit hashes; when the stripe of the empty prefix is merged, two words with one hash
are an error rather than a wrong count (another ``seed`` cures it). Scores are exact in decimals of 38 digits,
for frequencies below 10**15.

Defined results: a null text has no words; a null language is ``und``; repeated rows count each; null or
repeated ids do not matter, as ids are not read; an empty table gives an empty result; among equal scores the
more frequent phrase comes first, then bytewise order decides. Further columns are not read. A long text is
tokenised whole, in memory proportional to it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regchron.llm.common import BASE, U, Words, byte_set, byte_values, chunks, mix, parts, powers, read_table, stored

LONGEST = 3
LEAST = 10
TOP = 2000
SUBSUMED = 50

HELD = 3 << 18
CHUNK = 1 << 20
SLOTS = 1 << 25
HOT = 4096
HOT_BUCKETS = 16
ENTRIES = 1 << 20
BUCKETS = 1024
OTHER = 0
_SALTS = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
# What ends a piece, and what belongs to a word.
BREAK_BYTES = byte_set(lambda b: b in _BREAKS)
PHRASE_BYTES = byte_set(lambda b: b not in _BREAKS and b not in b" \t")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_WORDS = "bucket bigint, lang string, next array<bigint>, counts array<bigint>, texts array<string>"
_STRIPES = "bucket bigint, lang string, {}next array<bigint>, counts array<bigint>"
_MERGED_WORDS = "lang string, total bigint, next array<bigint>, counts array<bigint>, texts array<string>"
_MERGED = "lang string, {}total bigint, next array<bigint>, counts array<bigint>"


class Pieces(Words):
    """The words of a batch with their language, and how many words follow each in its piece."""

    def __init__(self, batch: pa.RecordBatch, seed: int, reach: int):
        super().__init__(batch.column("text"), PHRASE_BYTES, byte_values(seed))
        self.hashes = np.where(self.hashes == U(OTHER), U(1), self.hashes)
        coded = pc.dictionary_encode(batch.column("lang"))
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        self.langs = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.rows]
        self.marks = np.array([zlib.crc32(x.encode()) for x in self.langs] or [0], dtype=U)
        breaks = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum(BREAK_BYTES[self.data], out=breaks[1:])
        n = len(self.hashes)
        linked = np.zeros(n, dtype=bool)
        linked[:-1] = (self.rows[1:] == self.rows[:-1]) & (breaks[self.starts[1:]] == breaks[self.ends[:-1]])
        # ahead: the number of words that follow in the piece, as far as reach.
        self.ahead = np.zeros(n, dtype=np.int64)
        run = linked
        for _ in range(reach):
            self.ahead += run
            run = run & np.append(run[1:], False) if n else run

    def at(self, index: np.ndarray, step: int) -> np.ndarray:
        return self.hashes[np.minimum(index + step, len(self.hashes) - 1)]

    def texts(self, index: np.ndarray) -> pa.Array:
        """The words at the given places as lower-cased strings."""
        size = self.ends[index] - self.starts[index]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        taken = LOWER[self.data[np.repeat(self.starts[index] - (ends - size), size) + np.arange(total)]]
        bounds = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(len(index), pa.py_buffer(bounds), pa.py_buffer(taken))


def phrase_slots(hashes: list[np.ndarray], marks: np.ndarray) -> np.ndarray:
    """The place of a phrase in the bit map, from its words' hashes and its language's mark."""
    total = marks * U(0xD6E8FEB86659FD93)
    for j, h in enumerate(hashes):
        total = total + h * powers(BASE, len(hashes) + 1)[j + 1]
    return (mix(total) & U(SLOTS - 1)).astype(np.int64)


def known(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 6] >> (slots & 63).astype(U)) & U(1) == U(1)


def counted(columns: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts equal rows next to each other, and where each distinct row begins in it.

    The last column is the next word; rows with the same other columns come together. Hashes of 32 bits
    order them; should two prefixes share one, a stripe may come in two parts, which merging puts together.
    """
    high = np.zeros(len(counts), dtype=U)
    for c in columns[:-1]:
        high = mix(high * U(31) + c.astype(U) + U(1))
    key = ((high >> U(32)) << U(32)) | (mix(columns[-1].astype(U)) >> U(32))
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = False
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _place(words: list[np.ndarray], marks: np.ndarray) -> np.ndarray:
    """Where a prefix's stripe goes, from its words and its language's mark."""
    total = marks
    for j, w in enumerate(words):
        total = total + w * powers(BASE, len(words) + 1)[j + 1]
    return mix(total)


def partial_stripes(k: int, seed: int, buckets: int, bits=None, hot=None):
    """Partial stripes of the frequent prefixes of ``k`` words, in buckets; with ``k`` = 0 of the empty one.

    ``bits`` is the bit map of the frequent phrases of ``k`` words, ``hot`` the places of the prefixes
    whose stripes are dealt to several buckets.
    """
    names = [*prefix_names(k), "next", "counts", *([] if k else ["texts"])]

    def of(p: Pieces, frequent: np.ndarray | None, crowded: np.ndarray | None) -> tuple:
        """Where a prefix begins, its words and the next word; language and bucket."""
        if k == 0:
            index = np.arange(len(p.hashes))
            return index, [p.hashes], p.codes, (mix(p.hashes) % U(buckets)).astype(np.int64)
        index = np.flatnonzero(p.ahead >= k - 1)
        words = [p.at(index, j) for j in range(k + 1)]
        marks = p.marks[p.codes[index]]
        mine = known(frequent, phrase_slots(words[:k], marks))
        index, marks, words = index[mine], marks[mine], [w[mine] for w in words]
        extended = (p.ahead[index] >= k) & known(frequent, phrase_slots(words[1:], marks))
        following = np.where(extended, words[k], U(OTHER))
        place = _place(words[:k], marks)
        part = np.where(np.isin(place, crowded), mix(following) % U(HOT_BUCKETS), U(0))
        bucket = (mix(place + part) % U(buckets)).astype(np.int64)
        return index, [*words[:k], following], p.codes[index], bucket

    def flush(held: list[tuple]) -> pa.RecordBatch:
        langs = sorted({x for names, *_ in held for x in names})
        code = np.concatenate([np.array([langs.index(x) for x in names])[c] for names, c, *_ in held])
        bucket, count = (np.concatenate([h[i] for h in held]) for i in (2, 4))
        words = [np.concatenate([h[3][j] for h in held]) for j in range(k + 1)]
        order, first = counted([code, bucket, *words], count)
        count = np.add.reduceat(count[order], first)
        index = order[first]
        # By bucket and language; what is equal lies together already.
        index_order = np.lexsort([code[index], bucket[index]])
        index, count = index[index_order], count[index_order]
        code, bucket = code[index], bucket[index]
        new = np.ones(len(index), dtype=bool)
        new[1:] = (code[1:] != code[:-1]) | (bucket[1:] != bucket[:-1])
        heads = np.flatnonzero(new)
        offsets = np.append(heads, len(index))
        out = [pa.array(bucket[heads]), pa.array(langs).take(pa.array(code[heads]))]
        out += [_lists(offsets, _signed(w[index])) for w in words] + [_lists(offsets, pa.array(count))]
        if k == 0:
            texts = pa.concat_arrays([h[5] for h in held])
            out.append(_lists(offsets, texts.take(pa.array(index))))
        return pa.RecordBatch.from_arrays(out, names=["bucket", "lang", *names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(bits.value, dtype=U) if k else None
        crowded = np.frombuffer(hot.value, dtype=U) if k else None
        held: list[tuple] = []
        size = 0
        for batch in chunks(batches, "text", CHUNK):
            p = Pieces(batch, seed, k)
            index, words, code, bucket = of(p, frequent, crowded) if len(p.hashes) else (p.hashes, [], None, None)
            if not len(index):
                continue
            order, first = counted([code, bucket, *words], code)
            count = np.diff(np.append(first, len(order)))
            one = order[first]
            texts = None if k else p.texts(index[one])
            held.append((p.langs, code[one], bucket[one], [w[one] for w in words], count, texts))
            size += len(one)
            if size >= HELD:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def prefix_names(k: int) -> list[str]:
    return [f"w{j}" for j in range(1, k + 1)]


def _new_keys(table: pa.Table) -> np.ndarray:
    """Whether each row's bucket or language differs from that of the row before it."""
    new = np.ones(table.num_rows, dtype=bool)
    new[1:] = False
    for c in ("bucket", "lang"):
        column = table[c].combine_chunks()
        if len(column) > 1:
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return new


def by_entries(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that each holds at most ``limit`` entries of stripes, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("next")).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _summed(table: pa.Table, k: int) -> tuple[np.ndarray, ...]:
    """The distinct entries of rows that lie next to each other by bucket and language: first row of the group,
    the words, the count and the texts of each, ordered by group, prefix and next word."""
    table = table.combine_chunks()
    new = _new_keys(table)
    heads = np.flatnonzero(new)
    following = table["next"].combine_chunks()
    own = np.repeat(np.cumsum(new) - 1, np.diff(following.offsets.to_numpy()))
    words = [table[c].combine_chunks().flatten().to_numpy() for c in (*prefix_names(k), "next")]
    count = table["counts"].combine_chunks().flatten().to_numpy()
    prefix = own.astype(U)
    for w in words[:-1]:
        prefix = mix(prefix * U(31) + w.view(U) + U(1))
    order = np.lexsort([words[-1], prefix, own])
    own, count, words = own[order], count[order], [w[order] for w in words]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = own[1:] != own[:-1]
    for w in words:
        fresh[1:] |= w[1:] != w[:-1]
    first = np.flatnonzero(fresh)
    texts = None
    if k == 0:
        texts = table["texts"].combine_chunks().flatten().take(pa.array(order))
        if len(texts) > 1:
            differs = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
            if (differs & ~fresh[1:]).any():
                raise ValueError("two words have the same hash: choose another seed")
        texts = texts.take(pa.array(first))
    sums = np.add.reduceat(count, first) if len(first) else count
    return heads[own[first]], [w[first] for w in words], sums, texts


def merged(k: int, least: int):
    """Stripes merged elementwise; rows come ordered by bucket and language.

    Of each stripe the sum of all entries is returned, and the entries of ``least`` and more but OTHER.
    """

    def collapsed(table: pa.Table) -> pa.Table:
        """The rows of one bucket and language as one, nothing left out."""
        _, words, sums, texts = _summed(table, k)
        ends = np.array([0, len(sums)])
        out = {c: table[c].slice(0, 1).combine_chunks() for c in ("bucket", "lang")}
        out |= {c: _lists(ends, pa.array(w)) for c, w in zip((*prefix_names(k), "next"), words, strict=True)}
        out["counts"] = _lists(ends, pa.array(sums))
        return pa.table(out | ({"texts": _lists(ends, texts)} if k == 0 else {}))

    def solve(table: pa.Table) -> pa.RecordBatch:
        group, words, sums, texts = _summed(table, k)
        new = np.ones(len(sums), dtype=bool)
        new[1:] = group[1:] != group[:-1]
        for w in words[:-1]:
            new[1:] |= w[1:] != w[:-1]
        heads = np.flatnonzero(new)
        stripe = np.cumsum(new) - 1
        kept = np.flatnonzero((sums >= least) & (words[-1] != OTHER))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(stripe[kept], minlength=len(heads)))])
        out = [table["lang"].combine_chunks().take(pa.array(group[heads]))]
        out += [pa.array(w[heads]) for w in words[:-1]]
        out.append(pa.array(np.add.reduceat(sums, heads) if len(heads) else sums))
        out += [_lists(offsets, pa.array(words[-1][kept])), _lists(offsets, pa.array(sums[kept]))]
        if k == 0:
            out.append(_lists(offsets, texts.take(pa.array(kept))))
        names = ["lang", *prefix_names(k), "total", "next", "counts", *([] if k else ["texts"])]
        return pa.RecordBatch.from_arrays(out, names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        size, limit = 0, HELD
        for batch in by_entries(batches, HELD):
            pending.append(batch)
            size += len(batch.column("next").flatten())
            if size < limit:
                continue
            # The last bucket's rows may go on: they stay, merged to their distinct entries.
            table = pa.Table.from_batches(pending)
            cut = int(np.flatnonzero(_new_keys(table))[-1])
            if cut:
                yield solve(table.slice(0, cut))
            rest = collapsed(table.slice(cut))
            pending = rest.to_batches()
            size = len(rest["next"].combine_chunks().flatten())
            limit = max(HELD, 2 * size)
        if pending:
            yield solve(pa.Table.from_batches(pending))

    return run


def bit_map(phrases: DataFrame, k: int) -> bytes:
    """The bits of all phrases of ``k`` words: SLOTS bits, whatever the number of phrases."""

    def slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = np.array([zlib.crc32(x.encode()) for x in b.column("lang").to_pylist()], dtype=U)
            hashes = [b.column(c).to_numpy().view(U) for c in prefix_names(k)]
            yield pa.RecordBatch.from_arrays([pa.array(phrase_slots(hashes, marks))], names=["slot"])

    found = phrases.select("lang", *prefix_names(k)).mapInArrow(slots, "slot bigint")
    words = found.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")
    )
    got = words.toArrow()
    bits = np.zeros(SLOTS >> 6, dtype=np.int64)
    bits[got["word"].to_numpy()] = got["bits"].to_numpy()
    return bits.tobytes()


def hot_places(phrases: DataFrame, k: int, n: int) -> bytes:
    """The places of the prefixes with more than 1 / HOT of all words: at most HOT of them."""
    rows = phrases.where(F.col("a") > n // HOT).select("lang", *prefix_names(k)).collect()
    marks = np.array([zlib.crc32(r["lang"].encode()) for r in rows], dtype=U)
    words = [np.array([r[c] for r in rows], dtype=np.int64).view(U) for c in prefix_names(k)]
    return _place(words, marks).tobytes()


def phrases(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    subsumed: int = SUBSUMED,
    seed: int = 11,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Phrases have 2 to ``longest`` words and occur ``least`` times or more; one that lies in a longer one
    with at least ``subsumed`` hundredths of its occurrences is left out.
    """
    spark = documents.sparkSession
    tasks = parts(spark)
    texts = documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")
    )

    def together(partial: DataFrame, k: int, schema: str, label: str) -> DataFrame:
        dealt = partial.repartition(tasks, "bucket", "lang").sortWithinPartitions("bucket", "lang")
        return stored(dealt.mapInArrow(merged(k, least), schema), label)

    word_rows = together(texts.mapInArrow(partial_stripes(0, seed, BUCKETS), _WORDS), 0, _MERGED_WORDS, "words")
    sums = word_rows.groupBy("lang").agg(F.sum("total").cast("bigint").alias("n"))
    n = sums.agg(F.sum("n")).first()[0] or 0
    entries = word_rows.select("lang", F.explode(F.arrays_zip("next", "counts", "texts")).alias("e"))
    vocabulary = entries.select("lang", F.col("e.next").alias("w1"), F.col("e.texts").alias("word"))
    known_by = {1: entries.select("lang", F.col("e.next").alias("w1"), F.col("e.counts").alias("a"))}
    buckets = max(BUCKETS, n // ENTRIES)
    totals: dict[int, DataFrame] = {}
    widest: dict[int, DataFrame] = {}
    for k in range(1, longest):
        bits = spark.sparkContext.broadcast(bit_map(known_by[k], k))
        hot = spark.sparkContext.broadcast(hot_places(known_by[k], k, n))
        names = prefix_names(k)
        schema = _STRIPES.format("".join(f"{w} array<bigint>, " for w in names))
        rows = texts.mapInArrow(partial_stripes(k, seed, buckets, bits, hot), schema)
        rows = together(rows, k, _MERGED.format("".join(f"{w} bigint, " for w in names)), f"stripes{k}")
        totals[k] = rows.groupBy("lang", *names).agg(F.sum("total").cast("bigint").alias("f"))
        widest[k] = rows.groupBy("lang", *names).agg(F.max(F.array_max("counts")).alias("longer"))
        found = rows.select("lang", *names, F.explode(F.arrays_zip("next", "counts")).alias("e"))
        known_by[k + 1] = found.select("lang", *names, F.col("e.next").alias(f"w{k + 1}"), F.col("e.counts").alias("a"))

    def frequency(k: int, first: int, alias: str) -> DataFrame:
        """How often the k words from the given place on occur: the sum of their stripe."""
        names = [F.col(w).alias(f"w{first + j}") for j, w in enumerate(prefix_names(k))]
        return totals[k].select("lang", *names, F.col("f").alias(alias))

    parts_of = []
    for m in range(2, longest + 1):
        names = prefix_names(m)
        rows = known_by[m]
        if m < longest:
            # The strongest longer phrase: the prefix's greatest entry, and the same seen from its other end.
            left = known_by[m + 1].groupBy("lang", *[F.col(f"w{j + 1}").alias(f"w{j}") for j in range(1, m + 1)])
            rows = rows.join(widest[m], ["lang", *names], "left").join(
                left.agg(F.max("a").alias("before")), ["lang", *names], "left"
            )
            strongest = F.greatest(F.coalesce("longer", F.lit(0)), F.coalesce("before", F.lit(0)))
            rows = rows.where(100 * strongest < subsumed * F.col("a")).drop("longer", "before")
        cuts = []
        for k in range(1, m):
            first, rest = [f"w{j}" for j in range(1, k + 1)], [f"w{j}" for j in range(k + 1, m + 1)]
            rows = rows.join(frequency(k, 1, f"l{k}"), ["lang", *first])
            rows = rows.join(frequency(m - k, k + 1, f"r{k}"), ["lang", *rest])
            score = F.expr(
                "(1000000BD * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0)))"
                f" div (cast(l{k} AS decimal(19,0)) * cast(r{k} AS decimal(19,0)))"
            )
            cut = (score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
            cuts.append(F.struct(*cut))
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        for j, w in enumerate(names):
            word = vocabulary.select("lang", F.col("w1").alias(w), F.col("word").alias(f"t{j}"))
            rows = rows.join(word, ["lang", w])
        phrase = F.concat_ws(" ", *[F.col(f"t{j}") for j in range(m)])
        parts_of.append(rows.select("lang", phrase.alias("phrase"), "a", "cut.l", "cut.r", "cut.score"))
    every = parts_of[0]
    for more in parts_of[1:]:
        every = every.union(more)

    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # Ranked in parts first, so that a language's candidates never meet in one task.
    every = every.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    place = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))
    some = every.withColumn("rank", place).where(F.col("rank") <= top)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")
    ranked = some.withColumn("rank", place).where(F.col("rank") <= top).join(sums, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12(spark, sf_dir: str) -> DataFrame:
    """All documents, phrases of two and three words."""
    return phrases(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH cut AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM cut),
f1 AS (SELECT lang, p, count(*) AS f FROM (SELECT lang, unnest(w) AS p FROM w) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang),
g2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y
       FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) > 1)),
f2 AS (SELECT lang, x, y, count(*) AS f FROM g2 GROUP BY ALL HAVING count(*) >= 10),
g3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z
       FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM g3 GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, x, y, max(f) AS longer FROM (
    SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
two AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, p.f AS l, q.f AS r,
         (1000000::HUGEINT * t.f * t.f) // (p.f::HUGEINT * q.f) AS score
  FROM f2 t JOIN f1 p ON p.lang = t.lang AND p.p = t.x JOIN f1 q ON q.lang = t.lang AND q.p = t.y
  LEFT JOIN longer o ON o.lang = t.lang AND o.x = t.x AND o.y = t.y
  WHERE 100 * coalesce(o.longer, 0) < 50 * t.f),
cuts AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, p.f AS l1, q.f AS r1, s.f AS l2, u.f AS r2,
         (1000000::HUGEINT * t.f * t.f) // (p.f::HUGEINT * q.f) AS s1,
         (1000000::HUGEINT * t.f * t.f) // (s.f::HUGEINT * u.f) AS s2
  FROM f3 t JOIN f1 p ON p.lang = t.lang AND p.p = t.x
  JOIN f2 q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  JOIN f2 s ON s.lang = t.lang AND s.x = t.x AND s.y = t.y
  JOIN f1 u ON u.lang = t.lang AND u.p = t.z),
three AS (
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END AS l,
         CASE WHEN s1 <= s2 THEN r1 ELSE r2 END AS r, least(s1, s2) AS score FROM cuts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM (SELECT * FROM two UNION ALL SELECT * FROM three))
SELECT r.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n.n::BIGINT AS n, score::BIGINT AS score
FROM ranked r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""
