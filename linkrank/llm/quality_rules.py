"""Quality rules: statistics of whole texts, hard rules on them, and an isolation forest over their ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches, strings, task, Work

TREES = 128
#: Splits from the root of a tree to its deepest leaf; what is left together there counts by its number.
DEPTH = 8
#: Documents of each tree where it is grown on a sample.
SUBSAMPLE = 256
#: Ranges of scores in which labelled documents are counted.
SCORE_RANGES = 4_096
#: What a good document beyond the threshold weighs against a bad one before it.
FALSE_ALARM = 10.0
#: Threshold where there are no labels of both kinds.
THRESHOLD = 0.6
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_bare", "n_lines")

RATIOS = 6


def _kind(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


IS_SPACE, IS_SYMBOL = _kind(b"\t\n\v\f\r "), _kind(SYMBOLS)
IS_UPPER, IS_LETTER = _kind(range(65, 91)), _kind([*range(65, 91), *range(97, 123), *range(0xC0, 0x100)])
STARTS = _kind([*range(0x80), *range(0xC0, 0x100)])


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window found twice or more in the text."""
    if len(words) <= width:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    n = len(ids) - width + 1
    key = ids[:n]
    for k in range(1, width):  # numbered anew each time, so that the products stay small
        key = np.unique(key, return_inverse=True)[1] * len(index) + ids[k : n + k]
    _, where, counts = np.unique(key, return_inverse=True, return_counts=True)
    often = counts[where] > 1
    within = np.zeros(len(ids), bool)
    for k in range(width):
        within[k : n + k] |= often
    return int(within.sum())


def counts_of(text: str) -> list[int]:
    """The counts named in COUNTS, of one whole text."""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    b = np.frombuffer(data, np.uint8)
    in_word, letters = ~IS_SPACE[b], IS_LETTER[b]
    first = np.flatnonzero(in_word & np.r_[True, ~in_word[:-1]]) if words else None
    bare = int((np.add.reduceat(letters, first, dtype=np.int64) == 0).sum()) if words else 0
    return [len(words), int((STARTS[b] & in_word).sum()), int(IS_SYMBOL[b].sum()), len(lines) - len(set(lines)), repeated_words(words),
            int(IS_UPPER[b].sum()), int(letters.sum()), bare, len(lines)]


def ratios(counts: np.ndarray) -> np.ndarray:
    """What the trees look at: symbols a word, capitals among letters, words without a letter, mean word length, lines that repeat an earlier one
    among all lines with a word, and words in repeated windows among all words."""
    c = dict(zip(COUNTS, counts.T.astype(np.float64), strict=True))
    words, letters = np.maximum(c["n_words"], 1), np.maximum(c["n_letters"], 1)
    lines = np.maximum(c["n_lines"], 1)
    return np.stack([c["n_symbols"] / words, c["n_upper"] / letters, c["n_bare"] / words, c["word_chars"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words], 1)


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeats = counts[:, 0], counts[:, COUNTS.index("n_repeat_words")]
    return (words < 50) | (100 * repeats > 50 * words)


def _mean_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n values."""
    n = np.maximum(np.asarray(n, np.float64), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def _walk(x: np.ndarray, column: np.ndarray, cut: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The last node of a tree that each row comes to."""
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    while (inner := low[node] >= 0).any():
        right = x[rows, column[node]] > cut[node]
        node = np.where(inner, low[node] + right, node)
    return node


class IsolationForest:
    """Trees of random splits of random columns; what is odd is alone after few splits."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.unit = float(_mean_path(min(subsample, len(sample))))
        self.trees = [self._grow(sample[rng.permutation(len(sample))[:subsample]], rng) for _ in range(trees)]

    @classmethod
    def of_all(cls, counts: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> IsolationForest:
        """Trees that are all grown on all rows of ``counts``, a level at a time, the same however the rows are dealt.

        Each job finds number and range of each column of all rows in each node of a level, merged in the tasks; the driver draws column and cut of the
        nodes and gets no more than their ranges.
        """
        rngs = [np.random.default_rng((seed, t)) for t in range(trees)]
        grown = [([0], [0.0], [-1], [0.0]) for _ in range(trees)]
        first, unit = [0] * trees, 0.0
        bounds = [f"{of}_{k}" for of in ("least", "most") for k in range(RATIOS)]
        merged = [F.sum("n").alias("n"), *((F.min if b < "m" else F.max)(b).alias(b) for b in bounds)]
        for level in range(depth + 1):
            so_far = [tuple(map(np.array, tree[:3])) for tree in grown]
            parts = counts.select(*COUNTS).mapInArrow(task(_ranges, trees=so_far, first=first), f"tree int, node int, n long, {', '.join(f'{b} double' for b in bounds)}")
            nodes = {(r["tree"], r["node"]): (r["n"], np.array(r[3 : 3 + RATIOS]), np.array(r[3 + RATIOS :])) for r in parts.groupBy("tree", "node").agg(*merged).collect()}
            if level == 0 and nodes:
                unit = float(_mean_path(nodes[0, 0][0]))
            split = False
            for t, (column, cut, low, path) in enumerate(grown):
                begin, first[t] = first[t], len(column)
                for node in range(begin, first[t]):
                    n, least, most = nodes.get((t, node), (0, None, None))
                    wide = np.flatnonzero(most > least) if n > 1 and level < depth else []
                    if not len(wide):
                        path[node] = level + float(_mean_path(n))
                        continue
                    k, split = int(rngs[t].choice(wide)), True
                    column[node], cut[node], low[node] = k, float(rngs[t].uniform(least[k], most[k])), len(column)
                    column += [0, 0]
                    cut += [0.0, 0.0]
                    low += [-1, -1]
                    path += [0.0, 0.0]
            if not split:
                break
        forest = cls.__new__(cls)
        forest.unit, forest.trees = unit, [tuple(map(np.array, tree)) for tree in grown]
        return forest

    @staticmethod
    def _grow(rows: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        column, cut, low, path = [], [], [], []
        limit = int(np.ceil(np.log2(max(2, len(rows)))))
        todo = [(rows, 0)]
        at = 0
        while at < len(todo):  # children stand side by side behind all nodes before them
            part, depth = todo[at]
            at += 1
            wide = np.flatnonzero(part.max(0) > part.min(0)) if len(part) > 1 and depth < limit else []
            if not len(wide):
                column.append(0), cut.append(0.0), low.append(-1), path.append(depth + float(_mean_path(len(part))))
                continue
            k = int(rng.choice(wide))
            x = float(rng.uniform(part[:, k].min(), part[:, k].max()))
            column.append(k), cut.append(x), low.append(len(todo)), path.append(0.0)
            todo += [(part[part[:, k] <= x], depth + 1), (part[part[:, k] > x], depth + 1)]
        return np.array(column), np.array(cut), np.array(low), np.array(path)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, the higher the odder: 2 to the power of -(mean path length / mean for the sample)."""
        total = np.zeros(len(x))
        for column, cut, low, path in self.trees:
            total += path[_walk(x, column, cut, low)]
        return np.exp2(-total / (max(len(self.trees), 1) * max(self.unit, 1e-9)))


def threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """Between two scores of labelled documents, where bad ones beyond it outweigh the good ones most; the highest of equal ones."""
    if not len(good) or not len(bad):
        return THRESHOLD
    at = np.unique(np.r_[good, bad])
    gain = (len(bad) - np.searchsorted(np.sort(bad), at, side="right")) / len(bad) - FALSE_ALARM * (len(good) - np.searchsorted(np.sort(good), at, side="right")) / len(good)
    k = len(at) - 1 - int(np.argmax(gain[::-1]))
    return float((at[k] + at[k + 1]) / 2) if k + 1 < len(at) else float(at[k])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([counts_of(t) for t in strings(batch, "text")], np.int64).reshape(-1, len(COUNTS))
        yield pa.record_batch([batch.column(0), *map(pa.array, rows.T)], names=["doc_id", *COUNTS])


def _columns(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in COUNTS], 1)


def _ranges(batches: Iterator[pa.RecordBatch], trees: list, first: list[int]) -> Iterator[pa.RecordBatch]:
    """Number and ranges of a task's rows in each node from ``first`` on of each tree, those of the newest level."""
    sizes = [len(low) - k for (_, _, low), k in zip(trees, first, strict=True)]
    n = [np.zeros(size, np.int64) for size in sizes]
    least, most = ([np.full((size, RATIOS), x) for size in sizes] for x in (np.inf, -np.inf))
    for batch in batches:
        x = ratios(_columns(batch))
        for t, tree in enumerate(trees):
            node = _walk(x, *tree) - first[t]
            order = np.argsort(np.maximum(node, -1).astype(np.int16 if sizes[t] < 2**15 else np.int64), kind="stable")  # 16 bits are sorted by digits
            order = order[np.searchsorted(node[order], 0) if (node < 0).any() else 0 :]
            if not len(order):
                continue
            at = node[order]
            starts = np.flatnonzero(np.r_[True, at[1:] > at[:-1]])
            held, y = at[starts], x[order]
            n[t][held] += np.diff(np.r_[starts, len(at)])
            least[t][held] = np.minimum(least[t][held], np.minimum.reduceat(y, starts))
            most[t][held] = np.maximum(most[t][held], np.maximum.reduceat(y, starts))
    held = [np.flatnonzero(x) for x in n]
    where = np.concatenate([np.full(len(h), t, np.int32) for t, h in enumerate(held)]), np.concatenate([h + k for h, k in zip(held, first, strict=True)]).astype(np.int32)
    bounds = [np.concatenate([x[h] for x, h in zip(of, held, strict=True)]) for of in (least, most)]
    columns = [*where, np.concatenate([x[h] for x, h in zip(n, held, strict=True)]), *bounds[0].T, *bounds[1].T]
    yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=["tree", "node", "n", *(f"{of}_{k}" for of in ("least", "most") for k in range(RATIOS))])


def _table(data) -> np.ndarray:
    return np.array([[r[c] for c in COUNTS] for r in data], np.int64).reshape(-1, len(COUNTS))


def _judge(batches: Iterator[pa.RecordBatch], forest, limit: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = _columns(batch)
        odd, failed = forest.score(ratios(counts)), base_failed(counts)
        yield pa.record_batch([*batch.columns, pa.array(failed), pa.array(odd), pa.array(~failed & (odd <= limit))], names=[*batch.schema.names, "base_failed", "oddness", "kept"])


def threshold_of_all(scores: DataFrame) -> float:
    """``threshold`` of all rows ``(odd, good)``: they are counted by score, and beyond a score by ranges of scores, of which there are few."""
    counted = scores.groupBy("odd").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).withColumn("range", F.floor(F.col("odd") * SCORE_RANGES))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = counted.groupBy("range").agg(F.sum("good").alias("of_good"), F.sum("bad").alias("of_bad"))
    all_good, all_bad = ranges.agg(F.sum("of_good"), F.sum("of_bad")).first()
    if not all_good or not all_bad:
        return THRESHOLD
    zero = F.lit(0).cast("long")
    beyond = ranges.select("range", *(F.coalesce(F.sum(f"of_{kind}").over(above), zero).alias(f"{kind}_above") for kind in ("good", "bad")))
    within = Window.partitionBy("range").orderBy(F.desc("odd")).rowsBetween(Window.unboundedPreceding, -1)
    good, bad = (F.col(f"{kind}_above") + F.coalesce(F.sum(kind).over(within), zero) for kind in ("good", "bad"))
    gain = bad / F.lit(all_bad) - F.lit(FALSE_ALARM) * good / F.lit(all_good)
    _, at = counted.join(F.broadcast(beyond), "range").select(gain.alias("gain"), "odd").agg(F.max(F.struct("gain", "odd"))).first()[0]
    following = scores.where(F.col("odd") > at).agg(F.min("odd")).first()[0]
    return at if following is None else (at + following) / 2


def judge(documents: DataFrame, labels: DataFrame, sample_documents: int | None = None) -> DataFrame:
    """``(doc_id, counts..., base_failed, oddness, kept)`` for each row of ``documents (doc_id, text)``; other columns are not looked at.

    Words lie between ASCII white space. Counts are of the whole text, 0 for null. A text fails the base rules with fewer than 50 words or if over half
    of them lie in repeated windows. Of the others those are kept that the forest finds no odder than the threshold, which is
    set on documents of ``labels (doc_id, quality)`` that pass the base rules. Every tree is grown on all rows, and the threshold is set on all labelled ones,
    after rows alike in doc_id and counts are merged, so that null and repeated ids weigh no more than others; with ``sample_documents`` both see at most about so many,
    chosen by a hash of doc_id and counts, and trees are grown on SUBSAMPLE of these. Without labels of both kinds the threshold is THRESHOLD.
    Null labels are left out; null ids and repeated rows of documents stay as they are.
    """
    bounded_batches(documents.sparkSession)
    work = Work(documents.sparkSession, "rules")
    columns = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    judged = columns + ", base_failed boolean, oddness double, kept boolean"
    counts = work.store(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task(_count), columns), "counts")
    unlike = work.store(counts.distinct(), "unlike")
    marks = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality").distinct()
    marked = work.store(unlike.join(marks, "doc_id"), "marked")
    if sample_documents is None:
        forest = IsolationForest.of_all(unlike)
        scored = marked.select("doc_id", *COUNTS, (F.col("quality") == 1).alias("good")).mapInArrow(task(_judge, forest=forest, limit=THRESHOLD), judged.replace(", base_failed", ", good boolean, base_failed"))
        limit = threshold_of_all(work.store(scored.where("not base_failed").select(F.col("oddness").alias("odd"), "good"), "scored"))
    else:
        forest, limit = _of_sample(unlike, marked, sample_documents)
    return counts.mapInArrow(task(_judge, forest=forest, limit=limit), judged)


def _of_sample(unlike: DataFrame, marked: DataFrame, sample_documents: int) -> tuple[IsolationForest, float]:
    def some(df: DataFrame) -> DataFrame:
        return df.where(F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(1_000_000)) < min(1.0, sample_documents / max(df.count(), 1)) * 1_000_000)

    grown = ratios(_table(some(unlike).orderBy("doc_id", *COUNTS).collect()))
    forest = IsolationForest(grown) if len(grown) else IsolationForest(np.zeros((1, RATIOS)))
    rows = some(marked).collect()
    table = _table(rows)
    passed, good = ~base_failed(table), np.array([r["quality"] == 1 for r in rows], bool)
    odd = forest.score(ratios(table))
    return forest, threshold(odd[passed & good], odd[passed & ~good])
