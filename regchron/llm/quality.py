"""Quality classifier as a sparse ensemble of rules.

Statistics of a text (shares of character classes, word lengths, repetition) are computed from its
bytes, whole batches at a time. A forest of shallow trees is grown on labelled texts; every path from a
root to a node is a rule, a conjunction of comparisons. A logistic regression with a lasso penalty on
the rules keeps few of them, and those become one Spark column expression.

Fitting uses at most ``sample`` labelled rows, the ones with the least hash of their id, so it is
bounded whatever the size of the corpus; statistics and scores cover all documents. Identity, language
and source are not among the statistics.

Defined results: null and empty texts have statistics of zero and get a score; labels that are null
are not used; a label without a document is not used; without usable labels of both kinds the score is
the share of label 1 (0.5 without any); equal texts get equal scores; a null id counts as the empty
text in the choice of held-out rows. Input columns named like a result are replaced by it, all others
are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import U, Words, byte_set, chunks, mix, read_table

FOLDS = 5
SAMPLE = 20_000
CUT = 0.3
SEED = 7
TREES = 40
DEPTH = 3
BINS = 32
PENALTY = 1e-3
STEPS = 400

_CLASSES = {
    "upper": byte_set(lambda b: 65 <= b <= 90),
    "lower": byte_set(lambda b: 97 <= b <= 122),
    "digit": byte_set(lambda b: 48 <= b <= 57),
    "blank": byte_set(lambda b: b in (9, 11, 12, 13, 32)),
    "newline": byte_set(lambda b: b == 10),
    "stop": byte_set(lambda b: b in b".,;:'\"-()"),
    "loud": byte_set(lambda b: b in b"!?"),
    "symbol": byte_set(lambda b: b in b"#$%&*@^~+=<>_\\"),
    "rule": byte_set(lambda b: b in b"|/[]{}"),
    "control": byte_set(lambda b: b < 9 or 14 <= b < 32 or b == 127),
    "wide": byte_set(lambda b: b >= 128),
}
STATISTICS = (
    "n_bytes", "n_words", *(f"share_{c}" for c in _CLASSES),
    "word_length", "longest_word", "short_words", "long_words", "words_per_line", "distinct_words", "distinct_runs",
)
_PREFIX = "__stat_"


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches, zero for empty ones."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    own = mix(hashes + rows.astype(U) * U(0x9E3779B97F4A7C15))
    first = np.unique(own, return_index=True)[1]
    return np.bincount(rows[first], minlength=n)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    words = Words(texts)
    n = len(texts)
    size = np.diff(words.offsets).astype(np.float64)
    some = np.maximum(size, 1)
    counts = words.counts.astype(np.float64)
    any_ = np.maximum(counts, 1)
    length = (words.ends - words.starts).astype(np.float64)
    longest = np.zeros(n)
    np.maximum.at(longest, words.rows, length)
    runs, at = words.grams(3)
    run_rows = words.rows[at]
    n_runs = np.maximum(np.bincount(run_rows, minlength=n), 1)
    shares = {c: _sums(kept[words.data], words.offsets) / some for c, kept in _CLASSES.items()}
    columns = [
        size,
        counts,
        *shares.values(),
        _sums(length, words.first) / any_,
        longest,
        _sums(length <= 3, words.first) / any_,
        _sums(length > 15, words.first) / any_,
        counts / (shares["newline"] * some + 1),
        _distinct(words.hashes, words.rows, n) / any_,
        _distinct(runs, run_rows, n) / n_runs,
    ]
    return np.stack(columns, axis=1)


def with_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    names = documents.columns
    stats = [f"{_PREFIX}{s}" for s in STATISTICS]
    schema = documents.selectExpr("*", *[f"0D AS {s}" for s in stats]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            found = statistics(batch.column(text))
            columns = [pa.array(np.ascontiguousarray(found[:, i])) for i in range(len(STATISTICS))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *columns], names=[*names, *stats])

    return documents.mapInArrow(run, schema)


class Condition(NamedTuple):
    """statistic > cut, or statistic <= cut."""

    statistic: int
    above: bool
    cut: float


Rule = tuple[Condition, ...]


class Ensemble(NamedTuple):
    """Rules with their weights; the score is the logistic function of the weighted sum."""

    bias: float
    rules: list[tuple[float, Rule]]

    def score(self) -> Column:
        """The score as an expression over the statistics' columns."""

        def holds(c: Condition) -> Column:
            value = F.col(_PREFIX + STATISTICS[c.statistic])
            return value > c.cut if c.above else value <= c.cut

        total = F.lit(self.bias)
        for weight, rule in self.rules:
            both = holds(rule[0])
            for c in rule[1:]:
                both = both & holds(c)
            total = total + F.when(both, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _grow(binned: np.ndarray, y: np.ndarray, rows: np.ndarray, rng: np.random.Generator, path: tuple, out: set) -> None:
    """Grow one tree on binned statistics and add the path to each of its nodes."""
    if path:
        out.add(tuple(sorted(path)))
    if len(path) == DEPTH or len(rows) < 20 or not 0 < y[rows].sum() < len(rows):
        return
    best, gain = None, 1e-9
    total, ones = len(rows), y[rows].sum()
    for f in rng.choice(binned.shape[1], size=max(1, binned.shape[1] // 3), replace=False):
        n = np.cumsum(np.bincount(binned[rows, f], minlength=BINS))[:-1].astype(float)
        k = np.cumsum(np.bincount(binned[rows, f], weights=y[rows], minlength=BINS))[:-1]
        ok = (n >= 5) & (total - n >= 5)
        if ok.any():
            left, right = np.maximum(n, 1), np.maximum(total - n, 1)
            drop = k**2 / left + (ones - k) ** 2 / right - ones**2 / total
            drop[~ok] = -1
            at = int(drop.argmax())
            if drop[at] > gain:
                best, gain = (int(f), at), drop[at]
    if best is None:
        return
    f, at = best
    above = binned[rows, f] > at
    _grow(binned, y, rows[above], rng, (*path, (f, True, at)), out)
    _grow(binned, y, rows[~above], rng, (*path, (f, False, at)), out)


def _lasso(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression with an absolute penalty on all weights but the bias, by accelerated proximal steps."""
    n, m = x.shape
    p = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w, bias = np.zeros(m), float(np.log(p / (1 - p)))
    v, c, t = w, bias, 1.0
    step = 4 * n / (np.linalg.norm(np.column_stack([x, np.ones(n)]), 2) ** 2)
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(x @ v + c))) - y
        moved = v - step * (x.T @ error) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        new_bias = c - step * error.mean()
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / later * (new - w), new_bias + (t - 1) / later * (new_bias - bias)
        w, bias, t = new, new_bias, later
    return float(bias), w


def fit_ensemble(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """Rules and weights from statistics and 0/1 labels."""
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()) if len(y) else 0.5, 0.01), 0.99)
        return Ensemble(float(np.log(p / (1 - p))), [])
    rng = np.random.default_rng(SEED)
    cuts = [np.quantile(x[:, f], np.arange(1, BINS) / BINS, method="lower") for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    paths: set = set()
    for _ in range(TREES):
        _grow(binned, y, rng.integers(0, len(y), len(y)), rng, (), paths)
    rules: dict[bytes, tuple[Rule, np.ndarray]] = {}
    for path in sorted(paths, key=lambda p: (len(p), p)):
        held = np.ones(len(y), dtype=bool)
        for f, above, at in path:
            held &= (binned[:, f] > at) == above
        rule = tuple(Condition(f, above, float(cuts[f][at])) for f, above, at in path)
        rules.setdefault(held.tobytes(), (rule, held))
    if not rules:
        return fit_ensemble(x[:0], y[:0])
    kept = list(rules.values())
    bias, weights = _lasso(np.stack([h for _, h in kept], axis=1).astype(float), y.astype(float))
    return Ensemble(bias, [(float(w), r) for w, (r, _) in zip(weights, kept, strict=True) if w != 0])


def fold(doc_id: str, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def fit(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Ensemble:
    """The ensemble fitted on at most ``sample`` labelled rows outside the held-out fold."""
    usable = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    usable = usable.where("id IS NOT NULL AND label IN (0, 1)").where(fold("id") != 0)
    chosen = usable.orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    # At most ``sample`` ids; repeated ids in the documents are met by the second limit.
    rows = rows.join(F.broadcast(chosen), "id").select("id", "text", "label")
    found = with_statistics(rows).drop("text").orderBy(F.xxhash64("id"), *[f"{_PREFIX}{s}" for s in STATISTICS], "label").limit(sample)
    table = found.toArrow()
    x = np.stack([table[f"{_PREFIX}{s}"].to_numpy() for s in STATISTICS], axis=1) if len(table) else np.zeros((0, len(STATISTICS)))
    return fit_ensemble(x, table["label"].to_numpy().astype(np.int64))


def classify(documents: DataFrame, model: Ensemble, doc_id: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """The documents with ``held_out``, ``score`` and ``predicted``."""
    kept = documents.drop(*[c for c in ("held_out", "score", "predicted") if c not in (doc_id, text)])
    scored = with_statistics(kept.withColumn(text, F.col(text).cast("string")), text)
    return scored.select(
        *kept.columns, (fold(doc_id) == 0).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))


def op7(spark, sf_dir: str) -> DataFrame:
    """All documents, with rules learnt from the labels."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, read_table(spark, sf_dir, "labels"))
    return classify(documents, model).select("doc_id", "held_out", "score", "predicted")


def pipeline_stage(spark, documents: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject."""
    model = fit(documents, read_table(spark, sf_dir, "labels"))
    return classify(documents, model).where("predicted = 1").select("doc_id", "text", "lang", "source", "n_chars")
