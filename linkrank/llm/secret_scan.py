"""Secret scan with a ledger of scanned blobs: each distinct text is read once for each version of each rule."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import strings, task, Work


class Rule(NamedTuple):
    """Spans are the leftmost matches that don't overlap, less those whose measured group is too short."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    #: A match holds one of these characters or strings; texts without any are passed over.
    needs: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: In the order in which kinds are listed at equal starts.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True, (":", "=")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, False, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)
LEDGER = "blob binary, rule string, starts array<long>, ends array<long>"


def spans_of(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Spans in code points, the end exclusive."""
    if rule.needs and not any(x in text for x in rule.needs):
        return []
    flags = re.ASCII | (re.IGNORECASE if rule.any_case else 0)
    return [m.span() for m in re.finditer(rule.pattern, text, flags) if len(m[rule.group]) >= rule.least]


def _scan(batches: Iterator[pa.RecordBatch], rules: dict[str, Rule]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("blob", pa.binary()), ("rule", pa.string()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
    for batch in batches:
        rows = []
        for blob, names, text in zip(batch.column("blob").to_pylist(), batch.column("unseen").to_pylist(), strings(batch, "text"), strict=True):
            for name in names:
                found = spans_of(text, rules[name])
                rows.append({"blob": blob, "rule": name, "starts": [x[0] for x in found], "ends": [x[1] for x in found]})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_ledger(work: Work, ledger: str) -> DataFrame:
    """The ledger's rows, none if it doesn't exist yet. A pair may occur twice after a repeated append."""
    try:
        return work.spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return work.spark.createDataFrame([], LEDGER)


def blob_id(text):
    """SHA-256 of a text in UTF-8, of the empty one for null."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def scan(versions: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES, path: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scans the texts that the ledger doesn't know and returns ``(paths, findings)``.

    ``versions`` has a row for each path and historical version; only the columns ``path`` and ``text`` are looked at.
    The ledger, a Parquet folder, has a row for each scanned pair of blob and rule version, with or without findings, and this
    run appends what it scans. Without a ledger a new one is used. paths: ``(path, blob)`` for each row of ``versions``. findings:
    ``(blob, spans)`` for blobs with findings under ``rules``, spans as an array of ``(start, place, kind, end)`` in
    order of start, then of the rules. A null text is scanned as empty, a null path stays null, repeated rows stay.

    One of many copies is scanned: the path to read is chosen from ids and hashes alone. Texts move once at most, by blob and path;
    rows alike in both are merged in each task before, so that neither a hot text nor a hot id fills a task.
    """
    work = Work(versions.sparkSession, "secrets")
    ledger = ledger or f"{work.path}/ledger"
    named = {r.name: r for r in rules}
    rows = versions.select(F.col(path).alias("path"), F.col(text).cast("string").alias("text")).withColumn("blob", blob_id(F.col("text")))
    paths = work.store(rows.select("path", "blob"), "paths")
    known = read_ledger(work, ledger).where(F.col("rule").isin(list(named))).groupBy("blob").agg(F.collect_set("rule").alias("known"))
    unseen = F.array_except(F.array(*map(F.lit, named)), F.coalesce("known", F.array().cast("array<string>")))
    todo = paths.groupBy("blob").agg(F.min("path").alias("at")).join(known, "blob", "left").select("blob", "at", unseen.alias("unseen"))
    todo = work.store(todo.where(F.size("unseen") > 0), "todo")
    # Keys without nulls, so that merging and joining share one exchange.
    keys = [F.isnull("at").alias("none"), F.coalesce(F.col("at").cast("string"), F.lit("")).alias("id")]
    todo = todo.select("blob", *keys, "unseen").hint("shuffle_hash")
    unlike = rows.withColumnRenamed("path", "at").select("blob", *keys, "text").dropDuplicates(["blob", "none", "id"])
    texts = unlike.join(todo, ["blob", "none", "id"]).select("blob", "unseen", "text")
    texts.mapInArrow(task(_scan, rules=named), LEDGER).write.mode("append").parquet(ledger)
    found = read_ledger(work, ledger).where(F.col("rule").isin(list(named)) & (F.size("starts") > 0)).dropDuplicates(["blob", "rule"])
    place = F.array_position(F.array(*map(F.lit, named)), F.col("rule"))
    pairs = F.transform(F.arrays_zip("starts", "ends"), lambda x: F.struct(x["starts"].alias("start"), place.alias("place"), F.split_part("rule", F.lit("@"), F.lit(1)).alias("kind"), x["ends"].alias("end")))
    findings = found.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(pairs))).alias("spans"))
    return paths, work.store(findings, "findings")


def spans_text(spans):
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def redact(documents: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``documents`` with ``[kind]`` in place of each secret; n_chars follows the text if there is such a column.

    Where spans overlap, the later one is cut at the end of the earlier. No row goes. The join is by blob, whose findings are
    unique, and a hot blob is split by adaptive execution.
    """
    _, findings = scan(documents, ledger, rules)
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")  # so that no column of the caller's can clash
    both = documents.select(row, blob_id(F.col("text")).alias("blob")).join(findings, "blob", "left")
    text = F.col("row.text").cast("string")

    def step(state, span):
        start = F.greatest(span["start"], state["at"])
        label = F.when(span["end"] > state["at"], F.concat(F.lit("["), span["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), (start - state["at"]).cast("int")), label).alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    clean = F.aggregate("spans", start, step, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    both = both.select("row", F.col("spans").isNull().alias("as_is"), F.when(F.col("spans").isNotNull(), clean).alias("clean"))

    def column(name: str):
        old = F.col("row")[name]
        new = F.col("clean") if name == "text" else F.length("clean") if name == "n_chars" else None
        return (old if new is None else F.when(F.col("as_is"), old).otherwise(new.cast(documents.schema[name].dataType))).alias(name)

    return both.select(*map(column, documents.columns))
