"""Near-duplicate vectors by a forest of random-projection trees with spill."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import task, Work
from linkrank.llm.components import connected_components
from linkrank.llm.simhash import merge_labels

#: Vectors, at most about, on which the splits are fitted; all vectors are indexed.
SAMPLE_ROWS = 20_000
#: Rows of one side of a block of comparisons.
BLOCK = 1024
#: Rows of a block of a leaf; a leaf of over two of them is dealt out as pairs of blocks.
LEAF_BLOCK = 8192


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vector as bytes in double precision; null unless all components are finite and one isn't 0."""
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary())])
    for batch in batches:
        out = []
        for x in batch.column(1):
            v = np.array(x.as_py() if x.is_valid and len(x) and None not in x.as_py() else [], np.float64)
            out.append((v + 0.0).tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)
        yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], schema=schema)


def unit(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Tree:
    """Splits of one tree, fitted on a sample: a random direction, and a cut at the widest gap near the median.

    Vectors within the margin of a cut go to both sides. Where over half of a node's sample would, the cut lies where fewest do,
    away from the crowd; a node that no cut parts is a leaf, however many vectors it holds. Below the fitted splits come ``extra`` levels, each with one direction
    and the sample's median as cut for all nodes, so that leaves stay small however many vectors are indexed.
    """

    def __init__(self, sample: np.ndarray, leaf_rows: int, extra: int, margin: float, seed: int):
        rng, self.margin, self.splits = np.random.default_rng(seed), margin, []
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(sample)), -1, 0)]
        self.leaves = 0
        while todo:
            rows, parent, side = todo.pop()
            here = ~self.leaves
            if len(rows) > leaf_rows:
                direction = rng.standard_normal(sample.shape[1])
                direction /= np.linalg.norm(direction)
                along = np.sort(sample[rows] @ direction)
                a, b = int(len(rows) * 0.4), int(len(rows) * 0.6) + 1
                k = a + int(np.argmax(np.diff(along[a : b + 1])))
                cut, spilled = (along[k] + along[k + 1]) / 2, self._spilled(along)
                if 2 * spilled[k] > len(rows):
                    low, high = len(rows) // 16, len(rows) - 1 - len(rows) // 16
                    k = low + int(np.argmin(spilled[low:high]))
                    cut = (along[k] + along[k + 1]) / 2
                p = sample[rows] @ direction
                if 2 * spilled[k] <= len(rows) and (p <= cut).any() and (p > cut).any():
                    here = len(self.splits)
                    self.splits.append([direction, cut, None, None])
                    todo += [(rows[p > cut], here, 3), (rows[p <= cut], here, 2)]
            if here < 0:
                self.leaves += 1
            if parent >= 0:
                self.splits[parent][side] = here
        self.extra = rng.standard_normal((extra, sample.shape[1]))
        self.extra /= np.linalg.norm(self.extra, axis=1, keepdims=True)
        self.medians = np.median(sample @ self.extra.T, axis=0) if extra else np.zeros(0)

    def _spilled(self, along: np.ndarray) -> np.ndarray:
        """How many of the sorted values lie within the margin of a cut between each value and the next."""
        cuts = (along[:-1] + along[1:]) / 2
        return np.searchsorted(along, cuts + self.margin, side="right") - np.searchsorted(along, cuts - self.margin, side="left")

    def leaves_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that a row reaches."""
        found, todo = [], [(np.arange(len(x)), 0 if self.splits else ~0)]
        while todo:
            rows, node = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                found.append((rows, np.full(len(rows), ~node, np.int64)))
                continue
            direction, cut, low, high = self.splits[node]
            p = x[rows] @ direction
            todo += [(rows[p <= cut + self.margin], low), (rows[p >= cut - self.margin], high)]
        row, leaf = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)]), np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
        for direction, median in zip(self.extra, self.medians, strict=True):
            p = (x @ direction)[row]
            low, high = p <= median + self.margin, p >= median - self.margin
            row, leaf = np.r_[row[low], row[high]], np.r_[2 * leaf[low], 2 * leaf[high] + 1]
        return row, leaf


def _assign(batches: Iterator[pa.RecordBatch], forest, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row for each leaf of each tree that a vector reaches, with all of these leaves as a list."""
    trees, strides = forest
    for batch in batches:
        if not batch.num_rows:
            continue
        x = unit(batch.column("vector").to_pylist())
        rows, leaves = zip(*((row, leaf + at) for tree, at in zip(trees, strides, strict=True) for row, leaf in [tree.leaves_of(x)]), strict=True)
        row, leaf = np.concatenate(rows), np.concatenate(leaves)
        order = np.lexsort((leaf, row))
        row, leaf = row[order], leaf[order]
        ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(x)))]
        lists = [leaf[ends[i] : ends[i + 1]].tobytes() for i in range(len(x))]
        take = pa.array(row)
        yield pa.record_batch([pa.array(leaf), batch.column("node").take(take), batch.column("n").take(take), batch.column("vector").take(take), pa.array(lists, pa.binary()).take(take)], schema=schema)


def leaf_links(x: np.ndarray, n: np.ndarray, member: list[np.ndarray], leaf: int, least: float, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of one leaf: links of each vector that no earlier leaf holds as well, counted with copies, and class labels.

    With ``side``, only pairs of one side with the other are compared.
    """
    m = len(x)
    earlier = np.concatenate(member)
    keys, counts = np.unique(earlier[earlier < leaf], return_counts=True)
    keys = keys[counts > 1]
    row = np.repeat(np.arange(m), [len(a) for a in member])
    at = np.searchsorted(keys, earlier)
    hit = (at < len(keys)) & (earlier == keys[np.minimum(at, len(keys) - 1)]) if len(keys) else np.zeros(len(earlier), bool)
    met = np.zeros((m, max(1, len(keys))), np.float32)
    met[row[hit], at[hit]] = 1
    links, label = np.zeros(m, np.int64), np.arange(m)
    for i in range(0, m, BLOCK):
        for j in range(i, m, BLOCK):
            near = x[i : i + BLOCK] @ x[j : j + BLOCK].T >= least
            if i == j:
                near = np.triu(near, 1)
            if side is not None:
                near &= side[i : i + BLOCK, None] != side[j : j + BLOCK]
            a, b = np.nonzero(near)
            if not len(a):
                continue
            label = merge_labels(label, a + i, b + j)
            new = near & (met[i : i + BLOCK] @ met[j : j + BLOCK].T == 0)
            links[i : i + BLOCK] += new @ n[j : j + BLOCK]
            links[j : j + BLOCK] += new.T @ n[i : i + BLOCK]
    return links, label


def _compare(batches: Iterator[pa.RecordBatch], least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows come by leaf and pair of blocks. Gives (node, null, links) and edges (node, node, null)."""

    def close(parts: list[pa.RecordBatch], leaf: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        member = [np.frombuffer(b, np.int64) for b in table.column("leaves").to_pylist()]
        side = table.column("side").to_numpy() if table.column("side")[0].as_py() is not None else None
        links, label = leaf_links(unit(table.column("vector").to_pylist()), n, member, leaf, least, side)
        some, more = links > 0, label != np.arange(len(label))
        a, b = np.r_[node[some], node[more]], np.r_[node[some], node[label[more]]]
        links = np.r_[links[some], np.zeros(more.sum(), np.int64)]
        return pa.record_batch([pa.array(a), pa.array(b), pa.array(links)], schema=schema)

    parts, key = [], None
    for batch in batches:
        values = np.stack([batch.column("leaf").to_numpy(), batch.column("pair").to_numpy()], 1)
        starts = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(1)]) if len(values) else []
        for i, j in zip(starts, [*starts[1:], len(values)], strict=True):
            if key is not None and tuple(values[i]) != key:
                yield close(parts, key[0])
                parts = []
            key = tuple(values[i])
            parts.append(batch.slice(i, j - i))
    if parts:
        yield close(parts, key[0])


def dealt(placed: DataFrame, full: DataFrame) -> DataFrame:
    """Rows of the leaves in ``full (leaf, blocks)`` once for each pair of blocks with their own one; other rows with pair -1.

    side parts the two blocks of a pair, and is null within one block and in other leaves.
    """
    rows = placed.join(F.broadcast(full), "leaf", "left")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    side = F.when(F.col("block") != F.col("other"), F.col("block") > F.col("other"))
    return rows.select("leaf", F.coalesce(pair.cast("long"), F.lit(-1).cast("long")).alias("pair"), F.when(F.col("blocks").isNotNull(), side).alias("side"), "node", "n", "vector", "leaves")


def near_duplicates(embeddings: DataFrame, least: float = 0.95, trees: int = 8, leaf_rows: int = 1000, sample_rows: int = SAMPLE_ROWS, seed: int = 11, leaf_block: int = LEAF_BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``embeddings (vec_id, embedding)``; other columns are not looked at.

    Vectors are linked if a leaf of a tree holds both and their cosine in double precision is at least ``least``. Vectors that
    are null, empty, zero or hold a null or non-finite component link with nothing, nor do those of another length than most.
    n_links counts the other rows linked directly, equal vectors included. component_id is the smallest vec_id reachable; kept
    marks the row that has it. A row with a null id links with nothing and has neither component nor mark; rows
    with one vec_id count as one node. Equal vectors are merged first, so copies cost nothing.

    Splits are fitted on a sample of at most about ``sample_rows`` vectors, all that reaches the driver. Each pair is counted in the first leaf
    that both share, found from the lists of leaves that vectors carry, and a leaf gives links that connect its classes, so no pairs leave it.
    A leaf of over two blocks of ``leaf_block`` vectors is compared in pairs of blocks, each pair in a group of its own.
    """
    spark = embeddings.sparkSession
    work = Work(spark, "forest")
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(task(_vectors), "vec_id long, vector binary")
    rows = work.store(rows, "vectors")
    length = rows.where("vec_id is not null and vector is not null").groupBy(F.octet_length("vector").alias("bytes")).count().orderBy(F.desc("count"), "bytes").first()
    good = F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.octet_length("vector") == (length["bytes"] if length else 0))
    rows = rows.select("vec_id", "vector", F.when(good, F.unhex(F.sha2("vector", 256))).alias("key"))
    kinds = rows.where("key is not null").groupBy("key", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
    kinds = work.store(kinds, "kinds")
    total = kinds.count()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    every = max(1, -(-total // sample_rows))
    sample = unit([x["vector"] for x in kinds.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("vector").orderBy("vector").collect()] or [kinds.first()["vector"]])
    fitted = max(16, leaf_rows // every)
    extra = max(0, int(np.ceil(np.log2(max(1, fitted * every / leaf_rows) / 2))))
    margin = 0.5 * np.sqrt(2 - 2 * least) / np.sqrt(sample.shape[1])
    forest = [Tree(sample, fitted, extra, margin, seed + k) for k in range(trees)]
    strides = np.cumsum([0, *((t.leaves or 1) << extra for t in forest[:-1])])
    placed = kinds.mapInArrow(task(_assign, forest=(forest, strides), schema=pa.schema([("leaf", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("vector", pa.binary()), ("leaves", pa.binary())])), "leaf long, node long, n long, vector binary, leaves binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = placed.groupBy("leaf").count().where(F.col("count") > 2 * leaf_block).select("leaf", F.ceil(F.col("count") / leaf_block).cast("long").alias("blocks"))
    full = work.store(full, "full")
    if not full.isEmpty():
        placed = dealt(placed, full)
    else:
        placed = placed.select("leaf", F.lit(-1).cast("long").alias("pair"), F.lit(None).cast("boolean").alias("side"), "node", "n", "vector", "leaves")
    found = placed.repartition(parts, "leaf", "pair").sortWithinPartitions("leaf", "pair").mapInArrow(task(_compare, least=least, schema=pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])), "a long, b long, links long")
    found = work.store(found, "found")
    classes = work.store(connected_components(found, work), "classes")
    links = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    of_kind = kinds.select("key", "node", "n").join(links, "node", "left").join(classes, "node", "left")
    of_kind = work.store(of_kind.select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")), "of_kind")
    out = rows.select("vec_id", "key").join(of_kind, "key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
