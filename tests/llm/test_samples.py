"""Samples keep their bound where many rows have a null id or one id."""

from zlib import crc32

import pytest
from pyspark.sql import functions as F

from linkrank.llm import nbsvm, ppm, quality_rules


@pytest.fixture
def crowded(spark):
    """1,000 rows without an id and 1,000 with the id 4, of unlike texts, 500 copies of one row, and 1,000 other rows."""
    ids = F.when(F.col("id") < 1000, None).when(F.col("id") < 2000, 4).when(F.col("id") < 2500, 6).otherwise(F.col("id"))
    words = F.when(F.col("id").between(2000, 2499), F.lit("copy")).otherwise(F.repeat(F.lit("word "), F.col("id").cast("int") % 997 + 1))
    return spark.range(3500).select(ids.alias("doc_id"), F.concat(words, F.lit(" x"), F.when(F.col("id").between(2000, 2499), 0).otherwise(F.col("id"))).alias("text"), F.lit("en").alias("lang"))


def test_isolation_forest(spark, crowded, monkeypatch):
    grown, marked = [], []
    forest, failed = quality_rules.IsolationForest, quality_rules.base_failed
    monkeypatch.setattr(quality_rules, "IsolationForest", lambda x: grown.append(len(x)) or forest(x))
    monkeypatch.setattr(quality_rules, "base_failed", lambda x: marked.append(len(x)) or failed(x))
    quality_rules.judge(crowded, spark.createDataFrame([(4, 1)], "doc_id long, quality int"), 100)
    assert 0 < grown[0] < 200 and 0 < marked[0] < 200


def test_languages(crowded, monkeypatch):
    monkeypatch.setattr(ppm, "Trees", lambda samples: samples)
    # an id that is learned from
    ids = [i for i in range(2, 12) if crc32(str(i).encode()) % 3 != 1]
    chosen = ppm.learn(crowded.withColumn("doc_id", F.lit(ids[0]).cast("long")), 100)["en"]
    assert 0 < len(chosen) < 200 and len(set(chosen)) == len(chosen)


def test_classifier(spark, crowded, monkeypatch):
    monkeypatch.setattr(nbsvm, "Classifier", lambda texts, good: texts)
    ids = [i for i in range(2, 12) if crc32(str(i).encode()) % 4 != 2]
    labels = spark.createDataFrame([(ids[0], 1)], "doc_id long, quality int")
    chosen = nbsvm.fit(crowded.withColumn("doc_id", F.lit(ids[0]).cast("long")), labels, 100)
    assert 0 < len(chosen) < 200 and len(set(chosen)) == len(chosen)
