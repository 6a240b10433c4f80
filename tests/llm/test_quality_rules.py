import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkrank.llm import quality_rules as rules
from linkrank.llm import registry
from llm.conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    within = {j for k, w in enumerate(windows) if windows.count(w) > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), sum(x in lines[:k] for k, x in enumerate(lines)), len(within)]


def samples():
    rng = random.Random(6)
    pool = ["a", "b", "a b c", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\x1c", "é", "\xa0", "#*", "|", "ABC", "🙂", "a b c\n"]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(80))) for _ in range(1500)]


def test_counts():
    for text in [*samples(), "", "a b c", "a b c a b c", "a a a a", "a a a", "x\ny\nx\n x", "\n \nx"]:
        assert rules.counts_of(text)[:5] == plain(text), repr(text)


def test_many_distinct_words():
    words = [str(k).encode() for k in range(300_000)]
    assert rules.repeated_words(words) == 0
    assert rules.repeated_words([*words, *words[5:8]]) == 6


def test_documents_and_threshold(spark, documents):
    rng = random.Random(8)
    rows = list(EDGE)
    for i in range(600):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(120)]
        junk = i % 8 == 0
        rows.append((100 + i, " ".join(w + rng.choice(["###", "$$$", "%%"]) for w in words) if junk else " ".join(words), "en", "a"))
    labels = spark.createDataFrame([(100 + i, int(i % 8 > 0), 0) for i in range(0, 600, 2)] + [(None, 1, 0), (100, None, 0), (99_999, 1, 0)], "doc_id long, quality int, toxic int")
    found = rules.judge(documents(rows), labels).collect()
    expected = [repr((i, *(plain(t) if len(t or "") < 10_000 else rules.counts_of(t)[:5]))) for i, t, _, _ in rows]
    assert sorted(repr((r.doc_id, *r[1:6])) for r in found) == sorted(expected)
    for r in found:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    right = [r.kept == (r.doc_id % 8 != 100 % 8) for r in found if r.doc_id is not None and r.doc_id >= 100]
    assert len(right) == 600 and np.mean(right) > 0.95
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.judge(documents([]), none).count() == 0
    assert rules.judge(documents(EDGE), none).count() == len(EDGE)


def test_odd_by_repeated_lines_or_words_alone(spark, documents):
    """Texts like the others but for a line that comes again and again, or for windows that do, pass the base rules and are not kept."""
    rng = random.Random(9)
    kinds, rows = {}, []
    for i in range(600):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(120)]
        lines = [" ".join(words[k : k + 8]) for k in range(0, 120, 8)]
        kinds[i] = ("lines", "words")[i // 16 % 2] if i % 16 == 0 else "good"
        text = "\n".join([*lines, *["the end"] * 30]) if kinds[i] == "lines" else "\n".join([*lines, " ".join(words[:40])]) if kinds[i] == "words" else "\n".join(lines)
        rows.append((i, text, "en", "a"))
    labels = spark.createDataFrame([(i, int(kinds[i] == "good")) for i in range(300)], "doc_id long, quality int")
    found = rules.judge(documents(rows), labels).collect()
    assert not any(r.base_failed for r in found)
    for kind, least in (("lines", 0.99), ("words", 0.6), ("good", 0.97)):
        right = [r.kept == (kind == "good") for r in found if kinds[r.doc_id] == kind and r.doc_id >= 300]
        assert len(right) > 5 and np.mean(right) > least, kind


def test_scores_are_those_of_a_walk_through_each_tree():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (300, rules.RATIOS)).round(1)
    forest = rules.IsolationForest(x, trees=20, subsample=64)
    expected = []
    for row in x:
        lengths = []
        for column, cut, low, path in forest.trees:
            node = 0
            while low[node] >= 0:
                node = low[node] + int(row[column[node]] > cut[node])
            lengths.append(path[node])
        expected.append(2 ** -(np.mean(lengths) / forest.unit))
    np.testing.assert_allclose(forest.score(x), expected)


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    frame = registry.op8_isolation_forest(spark, folder)
    assert frame.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    found = frame.collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        if len(texts[r.doc_id] or "") < 5_000:
            assert list(r)[1:6] == plain(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)


def test_threshold():
    assert rules.threshold(np.array([]), np.array([0.5])) == rules.THRESHOLD
    assert rules.threshold(np.array([0.3, 0.4]), np.array([0.6, 0.7])) == 0.5
    assert rules.threshold(np.array([0.3] * 99 + [0.65]), np.array([0.6, 0.7])) == pytest.approx(0.45)


def test_what_is_alone_is_odd():
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 1, (1000, 3)), [[9, 9, 9]]]
    score = rules.IsolationForest(x).score(x)
    assert score.argmax() == 1000 and score[1000] > 0.7 and np.median(score) < 0.5
    assert rules.IsolationForest(np.zeros((1, 2))).score(np.zeros((3, 2))).shape == (3,)


def _counts(spark, n, seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 40, (n, len(rules.COUNTS)))
    rows[:, 0] += 60
    frame = spark.createDataFrame([tuple(map(int, r)) for r in rows], ", ".join(f"{c} long" for c in rules.COUNTS))
    return rules.ratios(rows), frame


def test_trees_are_grown_on_all_rows(spark):
    x, frame = _counts(spark, 700, 3)
    forest = rules.IsolationForest.of_all(frame.repartition(5), trees=6, depth=4)
    again = rules.IsolationForest.of_all(frame.coalesce(1), trees=6, depth=4)
    assert forest.unit == again.unit == float(rules._mean_path(700))
    for (column, cut, low, path), other in zip(forest.trees, again.trees, strict=True):
        assert all(np.array_equal(a, b) for a, b in zip((column, cut, low, path), other, strict=True))
        todo, reached = [(0, x, 0)], 0
        while todo:  # each split lies within the range of all rows of its node, each leaf knows their number
            node, part, depth = todo.pop()
            reached += 1
            if low[node] < 0:
                assert path[node] == depth + float(rules._mean_path(len(part)))
                assert depth == 4 or len(part) < 2 or (part.max(0) == part.min(0)).all()
                continue
            values = part[:, column[node]]
            assert values.min() <= cut[node] <= values.max()
            todo += [(low[node], part[values <= cut[node]], depth + 1), (low[node] + 1, part[values > cut[node]], depth + 1)]
        assert reached == len(low)


def test_threshold_of_all(spark):
    rng = np.random.default_rng(4)
    for n, places in ((40, 1), (300, 2), (300, 4), (300, 17)):
        odd, good = rng.uniform(0.3, 0.8, n).round(places), rng.random(n) < 0.7
        odd[~good] = (odd[~good] + 0.15).round(places)
        scores = spark.createDataFrame([*zip(odd.tolist(), good.tolist(), strict=True)], "odd double, good boolean")
        assert rules.threshold_of_all(scores) == rules.threshold(odd[good], odd[~good])
        assert rules.threshold_of_all(scores.where("good")) == rules.THRESHOLD


def test_every_row_and_label_counts(spark, documents):
    """One odd document and one bad label among 9,000 rows, more than any sample held, move trees and threshold."""
    rows = [(i, " ".join(f"w{(i * 31 + k) % 997}" for k in range(60 + i % 7)), "en", "a") for i in range(9000)]
    labels = spark.createDataFrame([(i, 1) for i in range(9000)] + [(9001, 0)], "doc_id long, quality int")
    seen = []
    for odd in (9001, 9002, 9003):
        found = rules.judge(documents([*rows, (odd, " ".join(f"### w{k} $$$" for k in range(60)), "en", "a")]), labels.withColumn("doc_id", F.when(F.col("doc_id") == 9001, odd).otherwise(F.col("doc_id")))).collect()
        seen.append({r.doc_id: r.kept for r in found})
    for odd, kept in zip((9001, 9002, 9003), seen, strict=True):
        assert not kept[odd] and sum(kept.values()) > 8900
