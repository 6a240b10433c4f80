import math
from zlib import crc32

import numpy as np
import pytest

from linkrank.llm import ppm, registry
from llm.conftest import EDGE

FOLDER = "/root/testdata/sf0.01"
SAMPLES = {"x": [b"abracadabra", b"abc", b""], "y": ["ééà".encode(), b"zebra zebra"]}


def plain_length(samples, text):
    """Code length by walking the tree of one language for each byte."""
    joined = b"".join(ppm.START + s for s in samples)
    counts: dict = {}
    for order in range(ppm.ORDER + 1):
        for k in range(order, len(joined)):
            node = counts.setdefault(joined[k - order : k], {})
            node[joined[k]] = node.get(joined[k], 0) + 1
    data, bits = ppm.START + text, 0.0
    for k in range(ppm.ORDER, len(data)):
        for order in range(ppm.ORDER, -1, -1):
            node = counts.get(data[k - order : k])
            if node is None:
                continue
            total = sum(node.values()) + len(node)
            if data[k] in node:
                bits -= math.log2(node[data[k]] / total)
                break
            bits -= math.log2(len(node) / total)
        else:
            bits += 8
    return bits


def test_code_lengths(monkeypatch):
    trees = ppm.Trees(SAMPLES)
    texts = [b"", b"a", b"abracadabra zebra", "éQ☃".encode(), bytes(range(256)), b"abra" * 50]
    expected = [[plain_length(SAMPLES[k], t) for k in ("x", "y")] for t in texts]
    np.testing.assert_allclose(trees.code_lengths(texts), expected, rtol=1e-5)
    monkeypatch.setattr(ppm, "SLICE", 7)  # pieces shorter than a text
    np.testing.assert_allclose(trees.code_lengths(texts), expected, rtol=1e-5)


@pytest.mark.parametrize("slots", [1 << 25, 0])
def test_no_context_is_dropped(monkeypatch, slots):
    """60 languages over all 256 bytes: every context of the samples is held, by table or by search."""
    monkeypatch.setattr(ppm, "MOST_SLOTS", slots)
    rng = np.random.default_rng(3)
    samples = {f"k{k:02}": [bytes(rng.integers(0, 256, 30).tolist()) for _ in range(2)] + [bytes(range(256))] * (k == 5) for k in range(60)}
    trees = ppm.Trees(samples)
    assert (trees.slots is None) == (slots == 0) and trees.size == 257
    joined = [b"".join(ppm.START + s for s in x) for x in samples.values()]
    contexts = {j[k - order : k] for j in joined for order in range(ppm.ORDER + 1) for k in range(order, len(j))}
    assert len(trees.parent) == len(contexts)
    texts = [samples["k07"][0] + b"x", samples["k41"][1][5:] + samples["k05"][2][9:70], b"plain text"]
    expected = [[plain_length(samples[k], t) for k in sorted(samples)] for t in texts]
    np.testing.assert_allclose(trees.code_lengths(texts), expected, rtol=1e-5)


def test_sample_is_bounded_in_bytes(spark, documents):
    rows = [(k, f"{k} " + "word " * 200, "en", "a") for k in range(300)]
    seen = []
    trees = ppm.Trees.__init__
    try:
        ppm.Trees.__init__ = lambda self, samples: (seen.append(sum(map(len, samples["en"]))), trees(self, samples))[1]
        ppm.learn(documents(rows), sample_bytes=30_000)
    finally:
        ppm.Trees.__init__ = trees
    assert 10_000 < seen[0] < 60_000


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    frame = registry.op9_ppm_language(spark, folder)
    assert frame.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = {r.doc_id: r for r in frame.collect()}
    samples = {}
    for i, r in rows.items():
        if r.lang is not None and r.text is not None and crc32(str(i).encode()) % 3 != 1:
            samples.setdefault(r.lang, []).append(r.text.encode())
    right = 0
    for i, r in rows.items():
        assert found[i].held_out == (crc32(str(i).encode()) % 3 == 1) and 0 <= found[i].score <= 1
        if len(r.text or "") < 300 and any(map(str.isalpha, r.text or "")):
            lengths = {k: plain_length(v, r.text.encode()) for k, v in samples.items()} if len(samples) and right < 5 else None
            if lengths:
                assert found[i].lang_pred == min(lengths, key=lengths.get)
                right += 1
    assert right == 5


def test_undetermined():
    trees = ppm.Trees(SAMPLES)
    language, score = trees.predict([None, "", "12 !? ²", "5abra"])
    assert language[:3] == ["und"] * 3 and score[:3].tolist() == [0, 0, 0] and language[3] == "x" and 0 < score[3] <= 1
    assert ppm._no_trees().predict(["abc"])[0] == ["und"]


def test_held_out_documents(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {r.doc_id: r for r in ppm.identify(frame, ppm.learn(frame, 100)).collect()}
    held = [r for r in frame.collect() if crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) > 0.99
    assert all(0 <= r.score <= 1 for r in found.values())


def test_only_the_text_counts(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(200)
    trees = ppm.learn(frame)
    other = frame.selectExpr("doc_id + 7 as doc_id", "text", "'zz' as lang", "null as source")
    a = sorted((r.doc_id + 7, r.lang_pred, r.score) for r in ppm.identify(frame, trees).collect())
    assert a == sorted((r.doc_id, r.lang_pred, r.score) for r in ppm.identify(other, trees).collect())


@pytest.mark.parametrize("rows", [EDGE, []])
def test_odd_documents(documents, rows):
    rows = rows + [(20 + i, t, k, "a") for i, (t, k) in enumerate([("the one and the other", "en"), ("der eine und die andere", "de")] * 6)] * bool(rows)
    frame = documents(rows)
    trees = ppm.learn(frame)
    found = ppm.identify(frame, trees).collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in rows)
    kept = ppm.keep_identified(frame, trees)
    assert kept.columns == frame.columns
    letters = [(i, t) for i, t, _, _ in rows if any(map(str.isalpha, t or ""))]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, letters))


def test_nothing_learned_keeps_texts_with_a_letter(documents):
    rows = documents([(1, "some text", None, "a"), (2, "12 34", None, "a"), (3, None, None, "a")])
    assert [r.doc_id for r in ppm.keep_identified(rows, ppm.learn(rows)).collect()] == [1]
