"""The quality classifier against plain Python: statistics, rules and the penalised fit."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa

from regchron.llm import quality

CLASSES = {
    "upper": rb"[A-Z]", "lower": rb"[a-z]", "digit": rb"[0-9]", "blank": rb"[\t\x0b\x0c\r ]", "newline": rb"\n",
    "stop": rb"[.,;:'\"()-]", "loud": rb"[!?]", "symbol": rb"[#$%&*@^~+=<>_\\]", "rule": rb"[|/\[\]{}]",
    "control": rb"[\x00-\x08\x0e-\x1f\x7f]", "wide": rb"[\x80-\xff]",
}


def plain_statistics(text):
    data = (text or "").encode()
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", data)
    lower = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words]
    runs = [tuple(lower[i : i + 3]) for i in range(max(1, len(lower) - 2))] if lower else []
    size, count = max(1, len(data)), max(1, len(words))
    found = {"n_bytes": len(data), "n_words": len(words)}
    found |= {f"share_{c}": len(re.findall(p, data)) / size for c, p in CLASSES.items()}
    found |= {
        "word_length": sum(map(len, words)) / count, "longest_word": max(map(len, words), default=0),
        "short_words": sum(len(w) <= 3 for w in words) / count, "long_words": sum(len(w) > 15 for w in words) / count,
        "words_per_line": len(words) / (data.count(b"\n") + 1), "distinct_words": len(set(lower)) / count,
        "distinct_runs": len(set(runs)) / max(1, len(runs)),
    }
    return [found[s] for s in quality.STATISTICS]


def some_texts():
    rng = random.Random(9)
    alphabet = "abc ABC 019 éß𝛀 \t\n\r\x0b .,;:'\"-() !? #$%&*@^~+=<>_\\ |/[]{} \x00\x07\x1f\x7f"
    texts = ["", None, "word", "One two", "one ONE One two", "a\nb\n\nc", "x" * 500, "é" * 40, "...", " \n "]
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(60)]


def test_statistics_against_plain_counts():
    texts = some_texts()
    found = quality.statistics(pa.array(texts, pa.string()))
    np.testing.assert_allclose(found, np.array([plain_statistics(t) for t in texts]), rtol=1e-12, atol=1e-12)
    assert quality.statistics(pa.array([], pa.string())).shape == (0, len(quality.STATISTICS))


def test_scores_are_those_of_the_rules(spark):
    """The compiled column gives the weighted sum of the rules that hold, evaluated one by one."""
    texts = some_texts()
    x = np.array([plain_statistics(t) for t in texts])
    y = np.array([int((t or "").count("a") > 3) for t in texts])
    model = quality.fit_ensemble(np.repeat(x, 4, axis=0), np.repeat(y, 4))
    assert model.rules and any(len(rule) > 1 for _, rule in model.rules)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in quality.classify(rows, model).collect()}
    for i, own in enumerate(x):
        total = model.bias
        for weight, rule in model.rules:
            if all((own[c.statistic] > c.cut) == c.above for c in rule):
                total += weight
        score = 1 / (1 + math.exp(-total))
        assert abs(found[i].score - score) < 1e-9 and found[i].predicted == int(score >= 0.3)


def test_weights_meet_the_conditions_of_the_lasso():
    """At the optimum the loss's slope is the penalty where a weight is not zero, and below it elsewhere."""
    rng = np.random.default_rng(3)
    x = (rng.random((400, 25)) < rng.random(25)).astype(float)
    truth = np.where(np.arange(25) < 4, rng.normal(size=25) * 2, 0.0)
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ truth - 0.5)))).astype(float)
    bias, w = quality._lasso(x, y)
    error = 1 / (1 + np.exp(-(x @ w + bias))) - y
    slope = x.T @ error / len(y)
    kept = w != 0
    assert 0 < kept.sum() and abs(error.mean()) < 1e-3
    np.testing.assert_allclose(slope[kept], -np.sign(w[kept]) * quality.PENALTY, atol=5e-4)
    assert (np.abs(slope[~kept]) <= quality.PENALTY + 5e-4).all()
    # No nearby weights are better.
    def loss(b, v):
        z = x @ v + b
        return (np.logaddexp(0, z) - y * z).mean() + quality.PENALTY * np.abs(v).sum()

    best = loss(bias, w)
    for _ in range(50):
        assert loss(bias + rng.normal() * 0.05, w + rng.normal(size=25) * 0.05 * (rng.random(25) < 0.3)) > best - 1e-6
