"""The text operators against brute force, their SQL and edge cases."""

from __future__ import annotations

import glob
import hashlib
import math
import os
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regchron.llm import chat, decontaminate, lm, near_text, near_vectors, pii, quality, queries, repeats, secrets, sentencepieces
from regchron.llm.common import Words, components
from regchron.llm.spans import matches
from regchron.session import scratch_path
from tools.compare import rows_of

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the tables are not here")
needs_model = pytest.mark.skipif(not os.path.exists(sentencepieces.MODEL), reason="the model is not here")

CLASHING = "doc_id bigint, text string, lang string, n_words string, hits string, spans int, score string, ids string, base string"


def documents(spark, rows):
    """Documents from (doc_id, text), with further columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "x", "y", 1, "z", "u", "v") for i, t in rows], CLASHING)


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def prose(seed, n, size=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 8))) for _ in range(size)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@needs_tables
@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, SF_DIR)
    result = con.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


def test_empty_tables(spark):
    none = documents(spark, [])
    items = spark.createDataFrame([], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert secrets.scan_secrets(none, scratch_path(spark, "ledger")).count() == 0
    assert pii.sanitise(none).count() == 0
    assert near_text.near_classes(none).count() == 0
    assert near_vectors.near_vectors(vectors).count() == 0
    assert chat.format_chats(turns).count() == 0
    model = quality.fit(none, labels)
    assert model.rules == [] and quality.classify(none, model).count() == 0
    assert decontaminate.decontaminate(none, items).count() == 0
    assert decontaminate.decontaminate(documents(spark, [(1, "a b")]), items).first()["hits"] == []
    assert repeats.repeated_passages(none).count() == 0
    assert lm.score_texts(none).count() == 0


# ---- secrets, personal data -----------------------------------------------------------------


def test_spans_count_code_points(spark):
    texts = ["", "x", "ab12 𝛀𝛀 345é6", "1" * 3, " ".join(f"n{i}é" for i in range(700))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in df.select("text", matches(F.col("text"), "[a-z]?([0-9]+)", 1).alias("m")).collect():
        wanted = [(m.start(), m.end(), m[1]) for m in re.finditer("[a-z]?([0-9]+)", row.text)]
        assert [tuple(m) for m in row.m] == wanted


def test_ledger_scans_what_is_new_only(spark):
    path = scratch_path(spark, "ledger")
    rows = [(1, "password = hunter2hunter2"), (2, "password = hunter2hunter2"), (3, None), (3, None), (None, "AKIA" + "A" * 16)]
    first = secrets.scan_secrets(documents(spark, rows), path).collect()
    assert len(first) == 5
    assert Counter((r.path, tuple(f.kind for f in r.findings)) for r in first) == {
        (1, ("assign",)): 1, (2, ("assign",)): 1, (3, ()): 2, (None, ("access",)): 1
    }
    ledger = spark.read.parquet(path)
    assert ledger.count() == 3
    more = documents(spark, [*rows, (4, "f" * 40)])
    secrets.scan_secrets(more, path).count()
    assert ledger.sparkSession.read.parquet(path).count() == 4
    newer = tuple(r._replace(version=2) if r.kind == "hex" else r for r in secrets.RULES)
    found = secrets.scan_secrets(more, path, newer).filter("path = 4").first()
    assert [f.rule for f in found.findings] == ["hex@2"]
    scans = spark.read.parquet(path).collect()
    assert len(scans) == 8 and Counter(tuple(r.rules) for r in scans)[("hex@2",)] == 4
    secrets.scan_secrets(more, path, newer).count()
    assert spark.read.parquet(path).count() == 8


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    found = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return sorted(found)


def test_personal_data_against_plain_patterns(spark):
    rng = random.Random(5)
    bits = ["a@b.c_d@e.f", "x@y.zz", "1.2.3.4.5", "999.1.1.1", "0000000255.1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+41 44 668 18 00", "+1 (2", "12", ".", "@", " ", "é", "𝛀", "_", "79927398713 1", "a.b%c+d@ex-am.ple.org."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    texts += [None, "", "1" * 50_000, "a" * 50_000 + "@", "+" + "1 " * 20_000, "1.2." * 20_000]
    rows = pii.sanitise(documents(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert [(s.start, s.rank, s.end, s.kind) for s in r.base] == base_spans(text)
        assert (r.clean is None) == (texts[r.doc_id] is None)
        if not r.spans:
            assert r.clean == texts[r.doc_id]


def test_terms_that_disclose_an_entity_go(spark):
    rows = [(i, f"common words here Zanzibar met tok3n9 ann@x.org common words {i}") for i in range(4)]
    rows += [(10 + i, f"common words here and more common words met number {i}") for i in range(60)]
    rows += [(3, rows[3][1]), (99, None), (100, "bob@x.org Zanzib common words")]
    found = {r.doc_id: r for r in pii.sanitise(documents(spark, rows)).collect()}
    assert found[0].terms == ["tok3n9", "zanzibar"]
    assert found[0].clean == "common words here [NAME] met  [EMAIL] common words 0"
    assert found[10].clean == found[10].text and found[10].spans == []
    assert found[100].clean == "[EMAIL] Zanzib common words"


def test_texts_without_an_id_keep_to_themselves(spark):
    """Terms of one text do not reach another one that shares its id, or has none either."""
    rows = [(None, f"Zanzibar met ann@x.org number {i}") for i in range(4)]
    rows += [(None, "Zanzibar island is nice"), (7, "Zanzibar met ann@x.org twice"), (7, "Zanzibar again")]
    rows += [(100 + i, f"other words {i}") for i in range(60)]
    found = {r.text: r.clean for r in pii.sanitise(documents(spark, rows), threshold=0.85).collect()}
    assert found["Zanzibar island is nice"] == "Zanzibar island is nice"
    assert found["Zanzibar again"] == "Zanzibar again"
    assert found["Zanzibar met ann@x.org twice"] == "[NAME] [NAME] [EMAIL] twice".replace("[NAME] [NAME]", "[NAME] [TERM]")


def test_many_spans_in_one_text(spark):
    """Twenty thousand addresses in a text, and overlapping spans."""
    texts = [" ".join(f"é ann{i}@x.org" for i in range(20_000)), "a@1.2.3.4 +41 44 668 18 00@x.org 1.2.3.4@b.org z" * 300, "1.2.3.4"]
    df = documents(spark, list(enumerate(texts)))
    pii.sanitise(df.filter("doc_id = 2")).collect()
    began = time.monotonic()
    found = {r.doc_id: r for r in pii.sanitise(df.filter("doc_id = 0")).collect()}
    assert time.monotonic() - began < 20
    assert found[0].clean == " ".join(["é [EMAIL]"] * 20_000) and len(found[0].spans) == 20_000
    row = pii.sanitise(df.filter("doc_id = 1")).first()
    spans = base_spans(texts[1])
    out, at = [], 0
    for start, _, end, kind in spans:
        if start >= at:
            out.append(texts[1][at:start] + f"[{kind.upper()}]")
        at = max(at, end)
    assert row.clean == "".join(out) + texts[1][at:] and len(spans) > 512


def plain_terms(texts, threshold=pii.THRESHOLD, support=pii.SUPPORT):
    own = []
    for text in texts:
        spans = base_spans(text)
        entities = set()
        for start, rank, end, kind in spans:
            entities.add((kind, re.sub("[^0-9]", "", text[start:end]) if rank > 1 else text[start:end].lower()))
        words = {
            m[0].lower() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
            if not any(s[0] < m.end() and m.start() < s[2] for s in spans)
        }
        own.append((entities, words))
    n_e, n_t, n_et = Counter(), Counter(), Counter()
    for entities, words in own:
        n_e.update(entities)
        n_t.update(words)
        n_et.update((e, t) for e in entities for t in words)
    n = len(texts)
    strong = {
        (e, t) for (e, t), c in n_et.items()
        if c >= support and n_e[e] < n and math.log2(c * n / (n_e[e] * n_t[t])) >= threshold * math.log2(n / n_e[e]) - 1e-12
    }
    return [sorted({t for e in entities for t in words if (e, t) in strong}) for entities, words in own]


def test_terms_against_plain_counts_at_any_distance(spark):
    far = prose(70, 60) + " "
    texts = [f"Quorl signs here. {far}{prose(i, 8)} ann@x.org" for i in range(4)]
    texts += [f"bob@x.org met Vendel{i % 2}. {far * (i % 3)} Vendel far Trellis{' +41 44 668 18 00' * (i % 2)}" for i in range(8)]
    texts += [f"x10.1.2.3 cut word{far}10.1.2.3é ann {far}z bob@x.org", "Trellis alone", "", "ann@x.org", "Vendel0 10.1.2.3ann@x.org"]
    texts += [f"{far}{prose(200 + i, 9)}" for i in range(40)]
    found = {r.doc_id: r for r in pii.sanitise(documents(spark, list(enumerate(texts)))).collect()}
    wanted = plain_terms(texts)
    assert [found[i].terms for i in range(len(texts))] == wanted
    assert "quorl" in wanted[0]
    assert "Quorl" not in found[0].clean and "[NAME]" in found[0].clean
    assert "vendel" in wanted[5]


# ---- pieces ---------------------------------------------------------------------------------


@needs_model
def test_pieces_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    rng = random.Random(3)
    letters = list("ab  the\n▁é€𝛀ing<>/s0179.,#\x00")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", " ", "   ", " " * 37 + "x", "<s> hi </s>", "<0x0A>", "abcdefghij" * 300, "the " * 5000, prose(1, 3000)]
    rows = sentencepieces.encode(documents(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == sp.encode(text) and r.n_pieces == len(r.ids)
        assert r.decoded == text.replace("▁", " ") and r.lossless == ("▁" not in text)


@needs_model
@needs_tables
def test_pieces_of_all_documents(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    for r in sentencepieces.op2(spark, SF_DIR).collect():
        assert r.ids == sp.encode(texts[r.doc_id] or "") and r.lossless
    model = sentencepieces.model_at(sentencepieces.MODEL)
    odd = pa.array([[255, 3, 2, 0], None, []], pa.list_(pa.int32()))
    assert len(sentencepieces.decode_column(model, odd)) == 3


# ---- near duplicates ------------------------------------------------------------------------


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_decides_as_the_whole_table():
    rng = random.Random(2)
    for _ in range(400):
        a = [rng.randint(0, 12) for _ in range(rng.randint(1, 40))]
        b = [x for x in a if rng.random() > 0.1] + [rng.randint(0, 12) for _ in range(rng.randint(0, 4))]
        length = common_length(a, b)
        assert near_text.aligned(a, b) == (length >= 0.8 * (len(a) + len(b) - length) - 1e-9)


def least_ids(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_links(texts):
    runs = {i: (lambda w: [tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))] if w else [])(words_of(t)) for i, t in texts.items()}
    ids = [i for i in runs if runs[i]]
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            n, m = len(runs[a]), len(runs[b])
            if min(n, m) >= 0.8 * max(n, m) and len(set(runs[a]) & set(runs[b])) > 0:
                length = common_length(runs[a], runs[b])
                if length >= 0.8 * (n + m - length) - 1e-9:
                    yield a, b


@pytest.mark.parametrize("wide", [32, 2])
def test_near_classes_against_all_pairs(spark, monkeypatch, wide):
    monkeypatch.setattr(near_text, "WIDE", wide)
    rng = random.Random(8)
    texts = {}
    for family in range(6):
        base = prose(family, rng.choice([4, 12, 40, 120]), 400).split()
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 99)}"
            texts[len(texts) + 1] = " ".join(copy)
    texts |= {200: "", 201: "", 202: None, 203: "!!! ???", 204: "one", 205: "One!", 206: "one two", 207: "line one two. " * 300}
    rows = [*texts.items(), (1, texts[1]), (None, "one"), (None, None)]
    found = near_text.near_classes(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    wanted = least_ids(texts, near_links(texts))
    for r in found:
        assert r.class_id == wanted.get(r.doc_id) and r.kept == (r.class_id == r.doc_id or r.doc_id is None)
    assert wanted[205] == 204 and wanted[201] == 201


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (None, 4)] + [(100, 100 + i) for i in range(1, 40)]
    found = dict(components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect())
    assert found == least_ids(found, [e for e in edges if e[0] and e[0] != e[1]])
    assert set(found.values()) == {1, 20, 100}


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows, dims = [], 32
    for group in range(40):
        centre = rng.normal(size=dims)
        for _ in range(8):
            rows.append((len(rows), (centre + rng.normal(size=dims) * 0.12).tolist(), group % 3))
    odd = [None, [], [0.0] * dims, [float("nan")] + [1.0] * (dims - 1), [float("inf")] * dims, [None] + [1.0] * (dims - 1), [1.0, 2.0]]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, rows[0][1], None), (2001, rows[0][1], 0), (2002, rows[0][1], 0)]
    rows += [rows[5], (None, rows[0][1], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, n_links string")
    found = near_vectors.near_vectors(frame, block=16).collect()
    assert len(found) == len(rows) - 1  # rows that share an id are one vector
    usable = {i: np.array(v) for i, v, lab in rows if i is not None and v and len(v) == dims and None not in v and lab is not None
              and np.isfinite(v).all() and np.any(v)}
    label = {i: lab for i, _, lab in rows}
    links = [(a, b) for a in usable for b in usable if a < b and label[a] == label[b]
             and usable[a] @ usable[b] / np.linalg.norm(usable[a]) / np.linalg.norm(usable[b]) >= 0.98]
    wanted = least_ids({i for i, _, _ in rows if i is not None}, links)
    degree = Counter(x for link in links for x in link)
    assert len(links) > 300
    got = sum(r.n_links for r in found)
    assert 0.9 * 2 * len(links) <= got <= 2 * len(links)
    for r in found:
        assert r.n_links <= degree[r.vec_id]
        if r.vec_id is None or r.vec_id not in usable:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
    assert sum(r.component_id == wanted[r.vec_id] for r in found if r.vec_id is not None) >= 0.9 * len(wanted)


# ---- chat -----------------------------------------------------------------------------------


def test_chats_read_back(spark):
    hard = ["", None, "\\", "#" * 7, "\\### x", "</turn>", "\n</turn>\n### user\n", "é𝛀 </turn", "a\\</turn>\\", "x" * 70_000]
    rows = [(conv, t, role, text) for conv in (1, 2, None) for t, (role, text) in enumerate(
        (r, x) for x in hard for r in ("user", "assistant", "we\nird\\###", None))]
    rows += [(3, None, "user", "b"), (3, None, "user", "a"), (3, None, "user", "a")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, part int")
    parts = chat.format_chats(frame)
    found = {}
    for r in sorted(parts.collect(), key=lambda r: (str(r.conv_id), r.part)):
        found.setdefault(r.conv_id, []).append(r)
    for conv, own in found.items():
        wanted = [(role or "", text or "") for c, t, role, text in
                  sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0, r[2] or "", r[3] or "")) ]
        assert [t for r in own for t in chat.read_turns(r.text)] == wanted
        masked = [chat.unescape(r.text[s.start : s.end]) for r in own for s in r.loss]
        assert masked == [text for role, text in wanted if role == "assistant"]
        assert sum(r.n_turns for r in own) == len(wanted)


# ---- quality, decontamination ---------------------------------------------------------------


@needs_tables
def test_quality_on_held_out_rows(spark):
    large = SF_DIR.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{large}/labels.parquet")
    found = quality.op7(spark, large).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 50 and sum(r.predicted == r.quality for r in found) >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_quality_edge_cases(spark):
    rows = [(i, prose(i, 30) if i % 3 else "###$$$ !!! " * (i + 1)) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(110)] + [(5, None), (None, 1), (999, 0)], "doc_id bigint, quality int")
    frame = documents(spark, [*rows, (500, None), (501, ""), (502, "x" * 100_000), (1, rows[1][1]), (None, "a b c")])
    model = quality.fit(frame, labels)
    assert model.rules and quality.fit(frame, labels) == model
    found = quality.classify(frame, model).collect()
    assert len(found) == len(rows) + 5 and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0) for r in found)
    by_id = {r.doc_id: r for r in found}
    assert by_id[111].score < 0.3 < by_id[112].score
    assert quality.fit(frame, labels.where("quality = 1")).rules == []


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 3])
def test_windows_against_plain_search(spark, block):
    items = [(1, prose(1, 14)), (2, "Only Three words"), (3, ""), (4, None), (5, prose(1, 14)), (6, "a b a b a b a b a b a b"), (7, "é")]
    rows = [(1, "x " + prose(1, 14) + " y"), (2, "only, three: WORDS only three words"), (3, None), (4, ""), (5, "b " + "a b " * 40),
            (6, " ".join(prose(1, 14).split()[:9])), (1, "É é"), (None, "three words only"), (9, prose(7, 5000) + " " + prose(1, 11))]
    found = decontaminate.decontaminate(
        documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"), block=block
    ).collect()
    wanted = []
    for _, text in rows:
        own, hit, names = words_of(text), set(), set()
        for item, words in ((i, words_of(t)) for i, t in items):
            size = min(10, len(words))
            windows = {tuple(words[k : k + size]) for k in range(max(1, len(words) - 9))} if words else ()
            for k in range(len(own) - size + 1 if windows else 0):
                if tuple(own[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    names.add(str(item))
        wanted.append((len(own), len(hit), sorted(names)))
    got = [(r.n_words, sum(h.end - h.start for h in r.hits), r.items) for r in found]
    assert sorted(got) == sorted(wanted)


# ---- repeated passages, language model ------------------------------------------------------


def plain_repeats(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            piece = data[k : k + 100]
            if piece in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("piece", [repeats.PIECE, 3])
def test_repeats_against_all_windows(spark, piece):
    rng = random.Random(6)
    shared = [prose(s, 25) for s in range(4)]
    rows = []
    for i in range(60):
        bits = [prose(100 + i, rng.randint(0, 40), 500)]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(shared)
            bits += [text[rng.randint(0, 30) : rng.randint(110, len(text))], prose(1000 + rng.randint(0, 10**6), 6, 500)]
        rows.append((i, " ".join(bits)))
    rows += [(100, rows[7][1]), (101, rows[7][1]), (-5, rows[9][1]), (102, "a" * 400), (103, "ab" * 150), (104, "a" * 99), (105, ""),
             (106, None), (107, "é" * 120), (108, "short"), (109, "short")]
    found = repeats.repeated_passages(documents(spark, [*rows, rows[3], (None, "short")]), piece=piece).collect()
    wanted = plain_repeats(rows)
    assert len(found) == len(rows) + 2
    for r in found:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == wanted[r.doc_id], r.doc_id


@pytest.mark.parametrize("piece", [2, 4096])
def test_every_text_of_an_id_is_judged(spark, piece):
    """Ids that several texts share, and texts without one: each is examined, and counts as earlier for others."""
    passage = prose(77, 40, 500)
    size = len(passage.encode())
    texts = [(i, f"{prose(50 + k, 9, 500)} {passage} {prose(80 + k, 9, 500)}") for k, i in enumerate([3, 3, None, None, 9])]
    found = repeats.repeated_passages(documents(spark, [*texts, (None, "short"), (3, "short")]), piece=piece).collect()
    long_ = [r for r in found if r.n_bytes > 100]
    whole = [r for r in long_ if r.n_removed == 0]
    assert [r.doc_id for r in whole] == [None] and len(long_) == 5
    assert all(size <= r.n_removed < size + 20 and r.n_spans == 1 for r in long_ if r.n_removed)


def test_sliding_least():
    values = np.array([5, 3, 8, 1, 9, 2, 7], dtype=np.uint64)
    assert repeats.sliding_least(values, 3).tolist() == [3, 1, 1, 1, 2]
    assert len(repeats.sliding_least(values, 9)) == 0


def test_elias_fano_finds_what_is_there():
    rng = np.random.default_rng(1)
    for n, top in ((0, 10), (1, 5), (50, 60), (1000, 10**6), (700, 2**64 - 1), (300, 3)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        coded = lm.EliasFano(values, top)
        assert coded.get(np.arange(n)).tolist() == values.tolist()
        asked = np.concatenate([values, rng.integers(0, top, 200, dtype=np.uint64)])
        assert coded.successor(asked).tolist() == np.searchsorted(values, asked).tolist()
        there = set(values.tolist())
        assert [(x >= 0) for x in coded.find(asked).tolist()] == [a in there for a in asked.tolist()]


def test_rare_successors_of_very_frequent_contexts():
    context, word = np.array([3, 3, 5], dtype=np.uint64), np.array([1, 2, 1], dtype=np.uint64)
    for total in (10**8, 1_600_000_000, 2**62):
        trie = lm.Trie(context, word, np.array([1, 70_000, 4]), {3: total})
        assert trie.total(context[:1]).tolist() == [total]
        wanted = [math.log10(c / (t + lm.PRIOR)) for c, t in ((1, total), (70_000, total), (4, 4))]
        assert np.abs(trie.lookup(context, word) - wanted).max() <= 0.5 / lm.STEPS + 1e-9


@pytest.mark.parametrize("slice_size", [lm.SLICE, 7])
def test_scores_against_plain_counts(spark, slice_size):
    rows = [(i, prose(i % 9, 5 + i % 30)) for i in range(80)]
    rows += [(200, ""), (201, None), (202, "NEW words\tonly\x0bhere"), (203, "Caps caps"), (5, rows[5][1]), (None, "a b"), (204, "the " * 4000)]
    found = lm.score_texts(documents(spark, rows), shards=5, slice_size=slice_size).collect()
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", lower(t)), zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2) for i, t in rows]
    words, pairs, starts = Counter(), Counter(), 0
    for _, own, held in texts:
        if not held:
            starts += 1
            words.update([*own, ""])
            pairs.update(zip([None, *own], [*own, ""], strict=True))
    n, v = sum(words.values()), len(words)
    wanted = []
    for i, own, held in texts:
        base = score = 0.0
        for a, b in zip([None, *own], [*own, ""], strict=True):
            total = starts if a is None else words[a]
            base += math.log10((words[b] + 1) / (n + v + 1))
            if pairs[a, b]:
                score -= round(-math.log10(pairs[a, b] / (total + lm.PRIOR)) * lm.STEPS) / lm.STEPS
            else:
                score += math.log10(lm.PRIOR / (total + lm.PRIOR) * (words[b] + 1) / (n + v + 1))
        known = sum(words[b] > 0 for b in [*own, ""])
        wanted.append((str(i), held, len(own) + 1, known, n, round(base, 6), round(score, 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found]
    assert sorted(got) == sorted(wanted)


def test_words_of_a_batch():
    texts = pa.array(["Ab, cé", None, "", "x", "--"])
    words = Words(texts)
    assert words.counts.tolist() == [2, 0, 0, 1, 0]
    assert words.hashes[0] == Words(pa.array(["aB"])).hashes[0]
    assert len(Words(pa.array([], pa.string())).hashes) == 0


@pytest.mark.parametrize("text", ["a b c d e f g h", "b a"])
def test_answers_of_shards_do_not_grow_with_documents_times_shards(spark, monkeypatch, text):
    """A spread context may end one shard and begin the next; what is brought back has a size of its own."""
    frame = type(spark.range(0))
    plain, sizes = frame.repartition, []

    def measured(self, n, *columns):
        if columns:
            binary = [F.coalesce(F.length(c), F.lit(0)) for c, kind in self.dtypes if kind == "binary"]
            sizes.append(self.agg(F.sum(sum(binary, F.lit(0)))).first()[0])
        return plain(self, n, *columns)

    rows = documents(spark, [(i, f"{text} w{i % 20}") for i in range(400)])
    scores = []
    for shards in (2, 200):
        monkeypatch.setattr(frame, "repartition", measured)
        found = lm.score_texts(rows, shards=shards)
        monkeypatch.setattr(frame, "repartition", plain)
        scores.append(sorted((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in found.collect()))
    assert scores[0] == scores[1]
    assert sizes[1] < 1.5 * sizes[0]


def test_documents_that_change_between_readings_are_an_error(spark, tmp_path):
    source = str(tmp_path / "documents")
    documents(spark, [(i, prose(i, 20)) for i in range(30)]).coalesce(1).write.parquet(source)
    found = lm.score_texts(spark.read.parquet(source))
    assert found.count() == 30
    mark = pa.array([0, 0], pa.int32())
    layout = {"task": mark, "batch": mark, "shard": pa.array([-1, 0], pa.int32())}
    names = [x.split()[0] for x in lm._LAYOUT.split(", ") + lm._ANSWERS.split(", ")[3:]]
    press = {"tokens": np.ones(1, np.int64), "held": np.zeros(1, bool), "context": np.array([7], np.uint64)}
    press |= {"width": np.ones(1, np.uint32), "times": np.ones(1, np.uint32), "doc": np.zeros(1, np.uint16)}
    answer = {"code": b"\1", "code2": b"\0", "total": b"\1\0", "total2": bytes(8), "unseen": b"", "mark": 7}
    columns = {**layout, "ids": pa.array([[5], None], pa.list_(pa.int64()))}
    columns |= {c: pa.array([lm._pressed(x), None], pa.binary()) for c, x in press.items()}
    for given, right in ((7, True), (8, False)):
        answer["mark"] = given
        columns |= {c: pa.array([None, x]) for c, x in answer.items()}
        batch = pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)
        if right:
            assert next(lm._sum(0, 0.0)([batch])).column("doc_id").to_pylist() == [5]
        else:
            with pytest.raises(ValueError):
                next(lm._sum(0, 0.0)([batch]))
