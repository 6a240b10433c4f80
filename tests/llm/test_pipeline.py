"""The pipeline, and every registered query of the subpackage, against plain versions or SQL on the smallest test tables."""

import re
from collections import Counter

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from linkrank.llm import oracle, ppm, registry
from llm.conftest import EDGE
from llm.test_secret_scan import plain as spans
from llm.test_simhash import plain_classes, plain_print

FOLDER = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "secrets", "mix", "encode"]
    names = set(registry.queries())
    assert names <= set(driver.queries()) and set(registry.oracle_sql()) <= names
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    frame = registry.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    expected = database.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, frame.select(*columns).collect()))) == sorted(map(repr, expected))


def redacted(text):
    at, out = 0, ""
    for kind, start, end in spans(text):
        out += text[at : max(start, at)] + (f"[{kind}]" if end > at else "")
        at = max(at, end)
    return out + text[at:]


@pytest.mark.parametrize("rows", [EDGE, []])
def test_every_stage_takes_odd_documents(spark, documents, rows, tmp_path):
    docs = documents(rows)
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, None).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert name == "encode" or docs.dtypes == before.dtypes
    assert (docs.count() > 0) == bool(rows)


def test_pipeline(spark, tmp_path):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(90_001, None, "en", "src0", 0), (90_002, "12 34", None, None, 5), (90_003, "", "en", "src1", 0), (90_004, "token = abcdefghijk and more words", "en", None, 34)], frame.schema)
    frame.unionByName(extra).write.parquet(str(tmp_path / "documents.parquet"))
    rows = [r.asDict() for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    trees = ppm.learn(spark.read.parquet(str(tmp_path / "documents.parquet")))
    rows = [r for r, k in zip(rows, trees.predict([r["text"] for r in rows])[0], strict=True) if k != "und"]
    assert {90_001, 90_002, 90_003}.isdisjoint(r["doc_id"] for r in rows)
    codes = {r["doc_id"]: plain_print(r["text"]) for r in rows}
    classes = plain_classes(set(codes.values()), 2)
    first = {}
    for i in sorted(codes):
        first.setdefault(classes[codes[i]], i)  # the smallest doc_id of each class
    rows = [r for r in rows if first[classes[codes[r["doc_id"]]]] == r["doc_id"]]
    assert len(rows) < len(codes)
    rows = [r | {"text": redacted(r["text"])} for r in rows]
    database = duckdb.connect()
    database.register("documents", pa.table({"doc_id": [r["doc_id"] for r in rows], "text": [r["text"] for r in rows], "source": [r["source"] for r in rows]}))
    taken = {i: t // n for i, n, t in database.execute(f"SELECT doc_id, size, taken FROM ({oracle.mixing_sql()})").fetchall()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected: Counter = Counter()
    for r in rows:
        if taken[r["doc_id"]]:
            ids = library.encode(r["text"], add_special_tokens=False).ids
            expected[r["doc_id"], len(ids), tuple(ids), library.decode(ids, skip_special_tokens=False)] += taken[r["doc_id"]]
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in found) == expected
    assert not any(re.search(r"token = [a-z0-9]{8}", r.decoded) for r in found)
