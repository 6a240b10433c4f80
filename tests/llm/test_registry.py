"""Registered queries that SQL cannot express, whole, against plain versions; and the SQL of the vectors where some do link."""

from hashlib import sha256
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from linkrank.llm import nbsvm, oracle, registry
from llm.test_embedding_forest import cloud
from llm.test_simhash import plain_classes, plain_print

FOLDER = "/root/testdata/sf0.001"


def table(name):
    return pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()


def test_simhash(spark):
    frame = registry.op4_simhash(spark, FOLDER)
    assert frame.columns == ["doc_id", "fingerprint", "component_id"]
    codes = {r["doc_id"]: plain_print(r["text"]) for r in table("documents")}
    classes = plain_classes(set(codes.values()), 2)
    first = {}
    for i in sorted(codes):
        first.setdefault(classes[codes[i]], i)
    assert sorted(map(tuple, frame.collect())) == sorted((i, f"{c:016x}", first[classes[c]]) for i, c in codes.items())


def test_bpe(spark):
    frame = registry.op7_bpe(spark, FOLDER)
    assert frame.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    expected = []
    for r in table("documents"):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        digests = (sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))
        expected.append((r["doc_id"], len(ids), *digests))
    assert sorted(map(tuple, frame.collect())) == sorted(expected)


def test_quality(spark):
    frame = registry.op10_nbsvm_quality(spark, FOLDER)
    assert frame.columns == ["doc_id", "held_out", "score", "predicted"]
    found = frame.collect()
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = nbsvm.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = {r.doc_id: r.score for r in nbsvm.score(documents, model).collect()}
    assert len(found) == len(scores)
    for r in found:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.score == scores[r.doc_id] and r.predicted == (r.score >= 0.7)


def test_vectors_that_link_against_sql(spark, tmp_path):
    vectors = [*cloud(), None, [], [0.0] * 16, [float("nan")] * 16, [None, *[1.0] * 15], [1.0] * 5, [2.0] * 5]
    rows = pa.table({"vec_id": pa.array([*range(len(vectors) - 1), None], pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array(np.zeros(len(vectors), np.int32))})
    pq.write_table(rows, str(tmp_path / "embeddings.parquet"))
    database = duckdb.connect()
    database.register("embeddings", rows)
    frame = registry.op5_embedding_forest(spark, str(tmp_path))
    expected = database.execute(f"SELECT {', '.join(frame.columns)} FROM ({oracle.near_vectors_sql()})").fetchall()
    found = list(map(tuple, frame.collect()))
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert sum(r[1] > 0 for r in found) > 100
