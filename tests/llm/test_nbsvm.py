import random
from zlib import crc32

import numpy as np
import pytest

from linkrank.llm import nbsvm
from llm.conftest import EDGE

FOLDER = "/root/testdata/sf0.1"


def test_indicators():
    held = np.zeros(nbsvm.SIZE, bool)
    for text in ["", None, "a", "ab", "aab aab aab", "é|x" * 10]:
        data = (text or "").encode()
        words = data.split()
        expected = {*data, *(256 + (a << 8 | b) for a, b in zip(data, data[1:], strict=False))}
        expected |= {65_792 + ((((a << 16 | b << 8 | c) * 2_654_435_761) % 2**32) >> 15) for a, b, c in zip(data, data[1:], data[2:], strict=False)}
        for k in (1, 2):
            share = sum(words[i] == words[i + k] for i in range(len(words) - k)) / max(len(words) - k, 1)
            expected |= {nbsvm.SIZE - 4 * k + i for i, x in enumerate(nbsvm.PAIR_SHARES) if share > x and len(words) > k}
        assert set(nbsvm.indicators(text, held).tolist()) == expected and not held.any()


def test_slices_change_nothing(monkeypatch):
    text, held = "".join(random.Random(2).choice("abc é") for _ in range(500)), np.zeros(nbsvm.SIZE, bool)
    whole = nbsvm.indicators(text, held)
    monkeypatch.setattr(nbsvm, "SLICE", 7)
    assert nbsvm.indicators(text, held).tolist() == whole.tolist()


def test_descent_reaches_the_optimum():
    """The duality gap of the hinge-loss problem closes."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(40, 8, replace=False)) for _ in range(60)]
    good = np.array([(r < 20).sum() + rng.normal() > 4 for r in rows])
    scale = np.ones(nbsvm.SIZE)
    w = nbsvm.dual_coordinate_descent(rows, scale, good, rounds=3000, tolerance=1e-9)
    weight = np.where(good, len(good) / (2 * good.sum()), len(good) / (2 * (~good).sum()))

    def loss(v):
        margin = np.array([v[r].sum() / np.sqrt(8) + v[-1] for r in rows]) * np.where(good, 1, -1)
        return v @ v / 2 + (weight * np.maximum(0, 1 - margin)).sum()

    best = loss(w)
    for _ in range(200):
        other = w.copy()
        other[np.r_[0:40, -1]] += rng.normal(0, 0.01, 41)
        assert loss(other) >= best - 1e-6


def test_logistic():
    rng = np.random.default_rng(3)
    margins = rng.normal(0, 2, 5000)
    good = rng.random(5000) < 1 / (1 + np.exp(-(1.5 * margins - 0.5)))
    a, b = nbsvm.logistic(margins, good)
    assert a == pytest.approx(1.5, abs=0.15) and b == pytest.approx(-0.5, abs=0.15)


def test_held_out_documents(spark):
    frame, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = nbsvm.fit(frame, labels, 1500)
    found = nbsvm.score(frame.join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 4 = 2"), model).join(labels, "doc_id").collect()
    assert all(crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in found)
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in found]) > 0.97


def test_odd_documents(spark, documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(2, 9)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    model = nbsvm.fit(documents(EDGE), labels)
    found = nbsvm.score(documents(EDGE), model).collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in EDGE) and all(0 <= r.score <= 1 for r in found)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert nbsvm.score(documents([]), nbsvm.fit(documents([]), none)).count() == 0
    assert {r.score for r in nbsvm.score(documents(EDGE), nbsvm.fit(documents(EDGE), none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(2, 9)], "doc_id long, quality int")
    assert {r.score for r in nbsvm.score(documents(EDGE), nbsvm.fit(documents(EDGE), one)).collect()} == {1.0}
