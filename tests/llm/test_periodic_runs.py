import hashlib
import re
import time
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from linkrank.llm import periodic_runs, registry
from linkrank.llm.periodic_runs import collapsed, runs_of
from llm.conftest import EDGE

FOLDER = "/root/testdata/sf0.001"


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def plain(words):
    """All maximal stretches of each period, kept where that is their smallest."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        start = 0
        for i in range(q, n + 1):
            if i == n or words[i] != words[i - q]:
                if i - start >= max(12, 2 * q) and smallest_period(words[start:i]) == q:
                    out.append((start, i - start, q))
                start = i - q + 1
    return sorted(out)


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), left)]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digest)


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_random_words(letters):
    rng = np.random.default_rng(letters)
    for _ in range(300):
        words = rng.integers(0, letters, rng.integers(0, 70)).tolist()
        for _ in range(rng.integers(0, 4)):
            root = rng.integers(0, letters + 1, rng.integers(1, 14)).tolist()
            cut = rng.integers(0, len(words) + 1)
            words[cut:cut] = root * int(rng.integers(2, 6)) + root[: rng.integers(0, len(root))]
        assert runs_of(words) == plain(words), words


@pytest.mark.parametrize("period", [1, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 100])
def test_runs_of_all_periods(period):
    root = list(range(period))
    for times in (2, 3, 7):
        for tail in (0, period // 2, period - 1):
            words = ["x", *(root * times + root[:tail]), "y", "z", *(root * times), *(root * times)]
            assert runs_of(words) == plain(words)


def test_nested_and_interrupted_runs():
    line = list(range(20)) + [9] * 14 + [3, 4] * 8
    for words in (line * 3, [0] * 60 + [1] + [0] * 60 + [1], ([0] * 40 + [1]) * 4, (["a", "b"] * 10 + ["c"]) * 3 + ["a", "b"] * 20):
        assert runs_of(words) == plain(words)


def test_long_texts_stay_cheap():
    """One word, one line and two long repetitions over and over: no more work than in proportion, but for a logarithm."""
    began = time.perf_counter()
    n = 400_000
    assert runs_of([b"a"] * n) == [(0, n, 1)]
    assert runs_of([b"%d" % (k % 10) for k in range(n)]) == [(0, n, 10)]
    assert runs_of([b"%d" % (k % 100_000) for k in range(n)]) == [(0, n, 100_000)]
    once = [b"the", *(b"%d" % k for k in range(9))]
    assert runs_of([x for k in range(n // 11) for x in (*once, b"x%d" % k)]) == []
    rng = np.random.default_rng(0)
    runs_of(rng.zipf(1.5, n).tolist())
    assert time.perf_counter() - began < 60


def test_collapsed():
    assert collapsed([b"x", *[b"a", b"b"] * 6, b"y"], [(1, 12, 2)]) == b"x a b y"
    assert collapsed([], []) == b""


@pytest.mark.parametrize("rows", [EDGE, [], [(i, "a b c " * i, None, None) for i in range(-5, 200)]])
def test_odd_documents(spark, documents, rows):
    frame = periodic_runs.find_runs(periodic_runs.with_planted_runs(documents(rows)))
    assert frame.columns == ["doc_id", "n_words", "runs", "collapsed"]
    digest = hashlib.sha256

    def row(i, text):
        return (i, *plain_row(i, text)[1:2], plain_row(i, text)[-1])

    found = sorted(repr((r.doc_id, len(r.runs), digest(r.collapsed.encode()).hexdigest())) for r in frame.collect())
    assert found == sorted(repr(row(i, t) if len(t or "") < 10_000 else (i, 1, digest("é ü ß".encode()).hexdigest())) for i, t, _, _ in rows)


def test_query(spark):
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    frame = registry.op12_periodic_runs(spark, FOLDER)
    assert frame.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = {r.doc_id: tuple(r) for r in frame.collect()}
    assert len(found) == len(table)
    checked = 0
    for r in table:
        if len(r["text"] or "") < 12_000:  # the plain version takes the square of the words
            assert found[r["doc_id"]] == plain_row(r["doc_id"], r["text"])
            checked += found[r["doc_id"]][1] > 0
    assert checked > 10
