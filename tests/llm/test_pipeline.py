"""The pipeline against its stages' brute-force rules on a small fixture."""

from __future__ import annotations

import os
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from regchron.llm import decontaminate, near_text, sentencepieces
from regchron.llm.common import Words
from regchron.session import scratch_path

pytestmark = pytest.mark.skipif(not os.path.exists(sentencepieces.MODEL), reason="the model is not here")


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 7))) for _ in range(n)).capitalize() + "."


def test_stages_take_effect(spark):
    import sentencepiece

    good = {i: sentence(i, 60) for i in range(60)}
    junk = {100 + i: "$$$ ### " + "!! ".join(sentence(500 + i, 40).upper().split()) for i in range(30)}
    item = sentence(9000, 20)
    copies = {200: good[7], 201: good[8].replace(good[8].split()[30], "changed", 1)}
    capitals = item.translate(str.maketrans("abcdefgh", "ABCDEFGH"))
    leaks = {300: sentence(9001, 30) + " " + capitals}
    private = {400: sentence(9002, 30) + " write to ann@mail.example.org or 10.1.2.3 " + sentence(9003, 10)}
    rows = good | junk | copies | leaks | private
    base = scratch_path(spark, "tables")
    spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in rows.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(
        [(i, int(i < 100)) for i in [*range(50), *range(100, 128)]], "doc_id bigint, quality int"
    ).write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, base).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "encoding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert seen[0] == set(rows) - set(junk)
    assert seen[1] == seen[0] - set(copies)
    assert seen[2] == seen[1] - set(leaks)
    assert seen[3] == seen[4] == seen[2]
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    texts = {r.doc_id: sp.decode(r.ids) for r in docs.collect()}
    assert texts[400] == private[400].replace("ann@mail.example.org", "[EMAIL]").replace("10.1.2.3", "[IP]")
    assert all(texts[i] == good[i] for i in good)
    whole = corpus_pipeline.run(spark, base)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_text_is_handled_in_small_parts():
    # Some fifty bytes per byte of a part: 4 MB at a time took over 150 MB in each Python worker.
    texts = [" ".join(f"wort{(i * 7919 + j * 104729) % 100003}" for j in range(250)) for i in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    words = np.sort(Words(batch.column("text").slice(0, 50)).hashes)
    for handle in (near_text._sign, decontaminate._counter(SimpleNamespace(value=words))):
        tracemalloc.start()
        try:
            assert sum(b.num_rows for b in handle(iter([batch]))) >= len(texts)
            assert tracemalloc.get_traced_memory()[1] < 100e6
        finally:
            tracemalloc.stop()
