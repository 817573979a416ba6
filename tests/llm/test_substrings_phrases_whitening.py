"""Repeated word sequences, phrases and whitening against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from regchron.llm import phrases, substrings, whitening
from regchron.llm.common import TOKEN_BYTES, Words

CLASHING = "doc_id bigint, text string, lang string, n_words string, doc int, key string, sha string, found int, salt int, rank int"
VECTORS = "vec_id bigint, embedding array<float>, label int, index string, n string, x int, off double"


def documents(spark, rows):
    """Documents from (doc_id, text, lang), with further columns whose names operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 1, 2, 3) for r in rows], CLASHING)


def prose(rng, n, size=30):
    return " ".join(f"w{rng.randrange(size)}é" for _ in range(n))


# ---- repeated word sequences ----------------------------------------------------------------


def plain_removal(rows, window):
    """doc_id, number of words, removed places, digest of the kept words, by comparing all windows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text, *_ in rows]
    least = {}
    for (doc, *_), w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1):
            s = tuple(w[i : i + window])
            if doc is not None:
                least[s] = min(least.get(s, doc), doc)
    out = []
    for (doc, *_), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and least[tuple(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def repeated_rows(seed):
    rng = random.Random(seed)
    shared = [prose(rng, rng.randint(8, 60), 400) for _ in range(6)]
    rows = []
    for i in range(60):
        middle = " ".join(rng.choice([prose(rng, rng.randint(0, 25), 400), rng.choice(shared), "a a  a\ta"]) for _ in range(6))
        rows.append((rng.randrange(50), middle, "en"))
    rows += [(7, shared[0] + " " + shared[1], "en"), (7, shared[1], "en"), (7, shared[1], "en"), (3, shared[0], "en")]
    rows += [(None, shared[0], "en"), (None, shared[0], "en"), (None, shared[2], None), (60, None, "en"), (61, "", "en")]
    rows += [(62, "b " * 40, "en"), (63, "b " * 30 + "c", "en"), (64, "c " + "b\n" * 14, "en"), (65, "c b", "en")]
    # Two words by turns and runs of two words: little for the rounds to hold on to.
    rows += [(66, "c d " * 30, "en"), (67, "x " + "d c " * 20, "en"), (68, "e " * 7 + "f " * 9, "en"), (69, "e " * 9 + "f " * 9, "en")]
    rows += [(70, "  " + shared[3].replace(" ", "\n"), "en"), (71, shared[3].upper(), "en"), (-5, shared[4], "en")]
    return rows


@pytest.mark.parametrize(("window", "rounds", "piece"), [(13, 2, 4096), (13, 2, 2), (5, 1, 3), (4, 3, 4096), (13, 0, 4096)])
def test_removed_words_against_all_windows(spark, window, rounds, piece):
    rows = repeated_rows(window + rounds)
    found = substrings.repeated_words(documents(spark, rows), window=window, rounds=rounds, piece=piece).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str)
    assert got == plain_removal(rows, window)
    assert sum(r.n_removed for r in found) > 100
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in found)


def test_equal_windows_have_equal_keys():
    """Wherever a sequence stands, its windows get the same keys."""
    rng = random.Random(5)
    for trial in range(20):
        passage = rng.choice([prose(rng, 40, 5), prose(rng, 40, 300), "a " * 20 + "b " * 20, "a b " * 20])
        texts = [prose(rng, rng.randint(0, 9), 5) + " " + passage + " " + prose(rng, rng.randint(0, 9), 5), passage]
        words = Words(pa.array(texts), TOKEN_BYTES, substrings._VALUES)
        for rounds in range(4):
            rows = substrings.anchored(words, 13, rounds)
            keys = np.repeat(rows.key, rows.size)
            at = np.concatenate([f + np.arange(s) for f, s in zip(rows.first, rows.size, strict=True)])
            by = defaultdict(set)
            for a, k in zip(at.tolist(), keys.tolist(), strict=True):
                by[tuple(words.hashes[a : a + 13].tolist())].add(k)
            assert all(len(k) == 1 for k in by.values()), trial
            assert len(at) == sum(max(0, len(t.split()) - 12) for t in texts)


def test_removal_of_a_long_text_and_of_nothing(spark):
    assert substrings.repeated_words(documents(spark, [])).count() == 0
    rng = random.Random(1)
    long_ = prose(rng, 300_000, 100_000)
    rows = [(1, long_, "en"), (2, "new " + long_, "en"), (3, "only this", "en")]
    found = {r.doc_id: r for r in substrings.repeated_words(documents(spark, rows)).collect()}
    assert (found[1].n_removed, found[2].n_removed, found[3].n_removed) == (0, 300_000, 0)
    assert [tuple(s) for s in found[2].spans] == [(1, 300_001)]


# ---- phrases --------------------------------------------------------------------------------


def plain_phrases(rows, longest, least, top, subsumed):
    count, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                count[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in count.items():
        longer = Counter()
        for p, a in f.items():
            if len(p) > 2 and a >= least:
                for inner in {p[i : i + m] for m in range(2, len(p)) for i in range(len(p) - m + 1)}:
                    longer[inner] = max(longer[inner], a)
        best = []
        for p, a in f.items():
            if 2 <= len(p) and a >= least and 100 * longer[p] < subsumed * a:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def phrase_rows():
    rng = random.Random(3)
    marks = [" ", " ", "  ", "\t", ", ", ". ", "\n", "!", "\r\n", " - "]
    rows = []
    for i in range(150):
        words = [rng.choice(["New", "york", "CITY", "é", "São", "paulo", "ÄB", "a", "b"]) for _ in range(60)]
        text = "".join(w + rng.choice(marks) for w in words) + " ".join(["very common pair"] * rng.randrange(4))
        rows.append((i, text, rng.choice(["en", "en", None, "und", "de"])))
    return [*rows, (1, None, "en"), (1, "", "fr"), (None, "x y. " * 12 + "z " * 30, "fr"), *rows[:5]]


@pytest.mark.parametrize(("longest", "least", "top", "crowded"), [(3, 10, 2000, False), (3, 3, 7, True), (4, 5, 50, False), (2, 1, 2000, True)])
def test_phrases_against_plain_counts(spark, monkeypatch, longest, least, top, crowded):
    if crowded:
        # Stripes of frequent prefixes are dealt to several buckets.
        monkeypatch.setattr(phrases, "HOT", 200)
    rows = phrase_rows()
    found = phrases.phrases(documents(spark, rows), longest=longest, least=least, top=top).collect()
    assert sorted(tuple(r) for r in found) == plain_phrases(rows, longest, least, top, 50)
    assert len(found) > 10


def test_stripes_merge_in_small_steps(monkeypatch):
    """Buckets that go on over many batches, and buckets larger than what a task holds."""
    rng = random.Random(8)
    monkeypatch.setattr(phrases, "HELD", 20)
    rows = sorted(
        (rng.randrange(4), "en", [(rng.randrange(3), rng.randrange(-20, 20), rng.randrange(1, 5)) for _ in range(rng.randrange(1, 9))])
        for _ in range(300)
    )
    wanted = defaultdict(Counter)
    for key, _, entries in rows:
        for prefix, word, n in entries:
            wanted[key, prefix][word] += n

    def batch(part):
        columns = {"bucket": [r[0] for r in part], "lang": [r[1] for r in part]}
        for i, name in enumerate(("w1", "next", "counts")):
            columns[name] = pa.array([[e[i] for e in r[2]] for r in part], pa.list_(pa.int64()))
        return pa.RecordBatch.from_pydict(columns)

    out = list(phrases.merged(1, 15)(batch(rows[i : i + 7]) for i in range(0, len(rows), 7)))
    got = [r for b in out for r in b.to_pylist()]
    assert len(got) == len(wanted)
    kept = Counter()
    for (_, prefix), words in wanted.items():
        kept[prefix, sum(words.values()), tuple(sorted((w, n) for w, n in words.items() if n >= 15 and w != phrases.OTHER))] += 1
    assert kept == Counter((r["w1"], r["total"], tuple(sorted(zip(r["next"], r["counts"], strict=True)))) for r in got)


def test_a_batch_of_many_entries_is_merged_in_parts(monkeypatch):
    """One batch with far more entries than a task may hold never reaches a merge as a whole."""
    monkeypatch.setattr(phrases, "HELD", 40)
    seen, summed = [], phrases._summed

    def watched(table, k):
        seen.append(len(table["next"].combine_chunks().flatten()))
        return summed(table, k)

    monkeypatch.setattr(phrases, "_summed", watched)
    lists = {c: pa.array([v] * 200, pa.list_(pa.int64())) for c, v in (("w1", [1] * 9), ("next", [*range(2, 11)]), ("counts", [1] * 9))}
    batch = pa.RecordBatch.from_pydict({"bucket": [i // 50 for i in range(200)], "lang": ["en"] * 200} | lists)
    assert [b.num_rows for b in phrases.by_entries([batch, batch.slice(0, 0), batch.slice(0, 1)], 40)] == [4] * 50 + [1]
    out = [r for b in phrases.merged(1, 1)([batch]) for r in b.to_pylist()]
    assert [(r["w1"], r["total"], r["counts"]) for r in out] == [(1, 450, [50] * 9)] * 4
    assert max(seen) <= 2 * 40


def test_two_words_with_one_hash_are_an_error():
    batch = pa.RecordBatch.from_pydict({"bucket": [0, 0], "lang": ["en", "en"], "next": [[5], [5]], "counts": [[1], [1]], "texts": [["a"], ["b"]]})
    with pytest.raises(ValueError, match="same hash"):
        list(phrases.merged(0, 1)([batch]))


def test_phrases_of_nothing_and_of_a_long_text(spark):
    assert phrases.phrases(documents(spark, [])).count() == 0
    assert phrases.phrases(documents(spark, [(1, None, None), (2, "", "en"), (3, ". , \n", "en")])).count() == 0
    text = "ab cd " * 200_000
    found = [tuple(r) for r in phrases.phrases(documents(spark, [(1, text, None)])).collect()]
    assert found == plain_phrases([(1, text, None)], 3, 10, 2000, 50)


# ---- whitening ------------------------------------------------------------------------------


def plain_whitening(vectors, components=8):
    x = np.floor(1024 * np.asarray(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    off = [[n * int(v) - int(t) for v, t in zip(row, s, strict=True)] for row in x]
    centred = x - s / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1][:, :components]
    with np.errstate(divide="ignore", invalid="ignore"):
        white = centred @ directions / np.sqrt(values[:components])
    return [sum(v * v for v in row) for row in off], white, values[:components] / values.sum()


def vectors_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "p", "q", 2, 0.5) for i, v in rows], VECTORS)


@pytest.mark.parametrize("slab", [1 << 30, 37])
def test_whitening_against_numpy(spark, slab):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(200, 12)) @ rng.normal(size=(12, 12)) - 2).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    found = whitening.whiten(vectors_table(spark, rows), slab=slab).collect()
    deviation, white, explained = plain_whitening(vectors)
    assert len(found) == 200 * 8 and {r.n for r in found} == {200}
    assert all(r.deviation == deviation[r.vec_id] for r in found)
    for k in range(8):
        mine = np.array([r.whitened for r in sorted(found, key=lambda r: r.vec_id) if r.component == k + 1])
        assert min(abs(mine - white[:, k]).max(), abs(mine + white[:, k]).max()) < 1e-9
    assert all(abs(r.explained / explained[r.component - 1] - 1) < 1e-9 for r in found)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_whitening_edge_cases(spark):
    assert whitening.whiten(vectors_table(spark, [])).count() == 0
    nan, inf = float("nan"), float("inf")
    dropped = [(4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    assert whitening.whiten(vectors_table(spark, dropped[:5])).count() == 0
    # Equal and null ids stay; one dimension does not vary, so its component has no scale.
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, 2.0]), *dropped]
    found = sorted((str(r.vec_id), r.component, r.n, r.deviation, r.whitened is None, r.explained) for r in whitening.whiten(vectors_table(spark, rows)).collect())
    one = [("1", 1, 3, 1024**2, False, 1.0), ("1", 2, 3, 1024**2, True, 0.0)]
    assert found == sorted([*one, *one, ("None", 1, 3, 4 * 1024**2, False, 1.0), ("None", 2, 3, 4 * 1024**2, True, 0.0)])
    alone = whitening.whiten(vectors_table(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 0, None, None, None), (2, 0, None, None, None)]
    # Squares beyond 64 bits: the deviation does not fit.
    far = whitening.whiten(vectors_table(spark, [(1, [1e9, 0.0]), (2, [-1e9, 0.0])])).collect()
    assert {r.deviation for r in far} == {None} and abs(abs(far[0].whitened) - 1) < 1e-9


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_rows_of_shared_keys_are_numbered_while_they_stream(size):
    rng = random.Random(size)
    rows = sorted((rng.randrange(30), rng.randrange(12) if k else 5, i) for i, k in enumerate([0, 1, 1] * 60))
    rows += [(50, 1, i) for i in range(20)] + [(51, 1, 0), (52, 1, 0), (52, 2, 0), (53, 9, 0)]
    wanted = []
    for key in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == key]
        if len({r[1] for r in mine}) > 1:
            wanted += [(doc, first, i // 3) for i, (_, doc, first) in enumerate(mine)]
    batches = [
        pa.RecordBatch.from_pydict({"key": [r[0] for r in part], "doc": [r[1] for r in part], "first": pa.array([r[2] for r in part], pa.int32())})
        for part in (rows[i : i + size] for i in range(0, len(rows), size))
    ]
    got = [tuple(r.values()) for b in substrings._shared(3)(batches) for r in b.to_pylist()]
    assert got == wanted
