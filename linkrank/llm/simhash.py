"""Near-duplicates by SimHash, found with a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import batch_of, strings, task, Work
from linkrank.llm.components import connected_components

SEED = 42
#: Shingles hashed at a time, so that a very long text stays small in memory.
SLICE = 65_536
#: Children of a node of the index.
FAN = 8
#: Entries of a search front handled at a time.
FRONT = 500_000
FULL = np.uint64(0xFFFF_FFFF_FFFF_FFFF)


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bit b is set if it is set in over half of the shingles' hashes; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(shingle)), strict=False) if len(words) >= shingle else iter([words])
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, SLICE):
        size = min(SLICE, n - start)
        hashes = np.fromiter((xxh64_intdigest(b" ".join(next(grams)), SEED) for _ in range(size)), np.uint64, size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(t, shingle) for t in strings(batch, "text")), np.uint64, batch.num_rows)
        yield batch_of(schema, [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]])


def fingerprints(documents: DataFrame, shingle: int = 3, *kept: str) -> DataFrame:
    """``(doc_id, fp)`` for each row; fp holds the 64 bits as a long. Long columns named in ``kept`` follow."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "fp", *kept)])
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *kept)
    return rows.mapInArrow(task(_fingerprints, shingle=shingle, schema=schema), ", ".join(f"{c} long" for c in schema.names))


def gray_rank(fp: Column) -> Column:
    """Place of a code in Gray order, as a long whose signed order is that order."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-(2**63)))


def _gray_rank(codes: np.ndarray) -> np.ndarray:
    for k in (1, 2, 4, 8, 16, 32):
        codes = codes ^ (codes >> np.uint64(k))
    return codes


class GrayIndex:
    """Nodes over items in Gray order. An item is a code, or a group of codes given by the AND and the OR of its members.

    A node keeps the bits that all of its members share, without those that a node above it keeps. On the way down the
    differences to these bits add up, and a whole group is left as soon as they pass the limit.
    """

    def __init__(self, ones: np.ndarray, some: np.ndarray):
        levels = [(ones, some)]
        while len(levels[-1][0]) > FAN:
            starts = np.arange(0, len(levels[-1][0]), FAN)
            levels.append((np.bitwise_and.reduceat(levels[-1][0], starts), np.bitwise_or.reduceat(levels[-1][1], starts)))
        self.levels = []
        above = np.zeros(len(levels[-1][0]), np.uint64)
        for low, high in reversed(levels):
            shared = ~(low ^ high)
            parent = above if not self.levels else np.repeat(above, FAN)[: len(low)]
            self.levels.append((low, shared & ~parent))
            above = shared

    def search(self, codes: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of (index of a code, index of an item) that differ in at most ``limit`` of the shared bits."""
        top = len(self.levels[0][0])
        step = max(1, FRONT // max(1, top))
        todo = [(0, np.repeat(np.arange(i, min(i + step, len(codes))), top), np.tile(np.arange(top), min(step, len(codes) - i)), None) for i in range(0, len(codes), step)] if top else []
        while todo:
            level, code, node, sum_ = todo.pop()
            if len(code) > FRONT:
                half = len(code) // 2
                todo += [(level, code[s], node[s], None if sum_ is None else sum_[s]) for s in (slice(None, half), slice(half, None))]
                continue
            pattern, mask = self.levels[level]
            differ = np.bitwise_count((codes[code] ^ pattern[node]) & mask[node])
            if sum_ is not None:
                differ = differ + sum_
            keep = differ <= limit
            code, node, differ = code[keep], node[keep], differ[keep]
            if level + 1 == len(self.levels):
                if len(code):
                    yield code, node
                continue
            width = np.minimum(FAN, len(self.levels[level + 1][0]) - node * FAN)
            first = np.repeat(node * FAN - np.cumsum(width) + width, width)
            todo.append((level + 1, np.repeat(code, width), first + np.arange(len(first)), np.repeat(differ, width)))


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the classes of a[i] and b[i]; a class is labelled by its smallest member."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while ((up := label[label]) != label).any():
            label = up


def _leaf_of(batches: Iterator[pa.RecordBatch], cuts: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column(0).to_numpy().view(np.uint64)
        yield batch_of(schema, [batch.column(0), pa.array(np.searchsorted(cuts, _gray_rank(codes), side="right").astype(np.int32))])


def _routes(batches: Iterator[pa.RecordBatch], ones: np.ndarray, some: np.ndarray, limit: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each code to its own leaf, and to the leaves that may hold codes near it, one way for each pair of leaves."""
    index = GrayIndex(ones, some)
    for batch in batches:
        codes, own = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
        yield batch_of(schema, [batch.column(1), pa.array(np.zeros(len(codes), np.int8)), batch.column(0)])
        for code, leaf in index.search(codes, limit):
            home = own[code]
            send = np.where((home + leaf) % 2 == 0, home < leaf, home > leaf)
            yield batch_of(schema, [pa.array(leaf[send].astype(np.int32)), pa.array(np.ones(send.sum(), np.int8)), pa.array(codes[code[send]].view(np.int64))])


def _leaf_links(batches: Iterator[pa.RecordBatch], limit: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Links of each leaf, thinned to what connects: rows come by leaf, its own codes before those sent to it."""
    leaf, parts, index, codes, label = None, [], None, None, None

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return batch_of(schema, [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))])

    def close():
        """Builds the index of the leaf's own codes and links them."""
        nonlocal index, codes, label
        codes = np.concatenate(parts)
        codes = codes[np.argsort(_gray_rank(codes), kind="stable")]
        index, label = GrayIndex(codes, codes), np.arange(len(codes))
        for a, b in index.search(codes, limit):
            label = merge_labels(label, a, b)
        more = label != np.arange(len(codes))
        return edges(codes[more], codes[label[more]])

    for batch in batches:
        leaves, sent = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        values = batch.column(2).to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.r_[True, (leaves[1:] != leaves[:-1]) | (sent[1:] != sent[:-1])]) if len(leaves) else []
        for i, j in zip(starts, [*starts[1:], len(leaves)], strict=True):
            if leaves[i] != leaf:
                if leaf is not None and index is None and parts:
                    yield close()
                leaf, parts, index = leaves[i], [], None
            if not sent[i]:
                parts.append(values[i:j])
                continue
            if index is None:
                yield close()
            for code, item in index.search(values[i:j], limit):
                pair = np.unique(code * len(codes) + label[item])
                yield edges(values[i:j][pair // len(codes)], codes[pair % len(codes)])
    if leaf is not None and index is None and parts:
        yield close()


def near_links(prints: DataFrame, work: Work, limit: int = 2, leaf_rows: int = 2048, max_leaves: int = 4096) -> DataFrame:
    """Edges ``(a, b)`` between distinct codes of column ``fp``, enough to connect all codes that differ in at most ``limit`` bits.

    The codes are cut into leaves at quantiles of their Gray rank. The leaves, at most ``max_leaves``, form the upper part of
    the index: for each the bits shared by its codes, all that reaches the driver. Every code goes down that part, and
    is sent to the leaves that are not pruned. In its leaf it goes on through an index of the leaf's own codes. The search
    is exact. Within a leaf each code is linked to its class only, so links do not grow with the square of a group.
    """
    # Codes are distinct, so quantiles of their ranks always separate a crowded region into further leaves.
    total = prints.count()
    leaves = int(min(max_leaves, max(1, -(-total // leaf_rows))))
    cuts = []
    if leaves > 1:
        at = [k / leaves for k in range(1, leaves)]
        cuts = sorted(set(prints.agg(F.percentile_approx(gray_rank(F.col("fp")), at, max(10_000, 20 * leaves)).alias("q")).first()["q"]))
    cuts = np.array(cuts, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    placed = work.store(prints.select("fp").mapInArrow(task(_leaf_of, cuts=cuts, schema=pa.schema([("fp", pa.int64()), ("leaf", pa.int32())])), "fp long, leaf int"), "leaves")
    nodes = placed.groupBy("leaf").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("some")).collect()
    ones, some = np.full(len(cuts) + 1, FULL), np.zeros(len(cuts) + 1, np.uint64)  # an empty leaf shares nothing and holds nothing
    for node in nodes:
        ones[node["leaf"]], some[node["leaf"]] = np.array([node["ones"], node["some"]], np.int64).view(np.uint64)
    route = task(_routes, ones=ones, some=some, limit=limit, schema=pa.schema([("leaf", pa.int32()), ("sent", pa.int8()), ("fp", pa.int64())]))
    routed = placed.mapInArrow(route, "leaf int, sent byte, fp long")
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    routed = routed.repartition(parts, "leaf").sortWithinPartitions("leaf", "sent")
    links = task(_leaf_links, limit=limit, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    return routed.mapInArrow(links, "a long, b long")


def _code_classes(prints: DataFrame, work: Work, limit: int, **options) -> DataFrame:
    """``(fp, first_id, class)`` for each distinct code of ``prints (doc_id, fp)``."""
    codes = work.store(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "codes")
    classes = work.store(connected_components(near_links(codes, work, limit, **options), work), "classes")
    return work.store(codes.join(classes.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("class")), "named")


def near_duplicates(documents: DataFrame, limit: int = 2, shingle: int = 3, **options) -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row of ``documents (doc_id, text)``; other columns are not looked at.

    component_id is the smallest doc_id among the documents reachable over links of at most ``limit`` differing bits.
    A null text counts as empty; texts without words have fingerprint 0 and are linked like any other. Repeated rows are
    returned as often as they come. A null doc_id keeps its row; component_id is null if the whole class has no id.
    """
    work = Work(documents.sparkSession, "simhash")
    prints = work.store(fingerprints(documents, shingle), "prints")
    named = _code_classes(prints, work, limit, **options)
    smallest = work.store(named.groupBy("class").agg(F.min("first_id").alias("component_id")), "smallest")
    of_code = work.store(named.join(smallest, "class").select("fp", "component_id"), "of_code")
    return prints.join(of_code, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(documents: DataFrame, limit: int = 2, shingle: int = 3, **options) -> DataFrame:
    """One row of each class of near-duplicates, with all columns of ``documents`` as they are.

    Classes are those of ``near_duplicates``. The row with the smallest doc_id stays, of rows alike in it the one with the smallest hash of
    its text, and of rows alike in both one; in a class without any doc_id the hash decides. So ids may be null or repeated.
    """
    work = Work(documents.sparkSession, "simhash")
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    prints = work.store(fingerprints(rows.select("doc_id", F.col("row.text").alias("text"), "text_hash"), shingle, "text_hash"), "prints")
    named = _code_classes(prints, work, limit, **options).select("fp", "class")
    # A hot code or class is merged on the map side; what moves is one row for each code and task.
    of_code = prints.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash")).alias("best"))
    best = of_code.join(named, "fp").groupBy("class").agg(F.min("best").alias("best")).select("best.doc_id", "best.text_hash")
    best = work.store(best, "best").withColumnsRenamed({"doc_id": "best_id", "text_hash": "best_hash"})
    kept = rows.join(best, rows.doc_id.eqNullSafe(best.best_id) & (rows.text_hash == best.best_hash), "left_semi")
    return kept.dropDuplicates(["doc_id", "text_hash"]).select("row.*")
