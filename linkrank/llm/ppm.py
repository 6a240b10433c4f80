"""Language identification by prediction by partial matching: byte context trees with frozen counts for each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches, crc_part, strings, task

ORDER = 3
#: Documents of a language, about, from which its tree is learned.
SAMPLE_DOCUMENTS = 600
#: Bytes of their texts, about, at most.
SAMPLE_BYTES = 8 << 20
#: Places of a table over all contexts and bytes; where there are more, bytes are looked up by search.
MOST_SLOTS = 1 << 25
#: Bytes costed at a time.
SLICE = 1 << 18
START = b"\n" * ORDER


class Trees:
    """Context trees of all languages over the same contexts, with the code length of each byte in each.

    A byte seen n times in a context with t bytes of d kinds costs -log2 n/(t+d); else an escape of -log2 d/(t+d) and
    what it costs in the context shorter by one. A context that a language hasn't seen is passed over for free, and beyond the
    empty context every byte costs 8 bits. Counts are frozen, so the cost of a byte depends on the bytes before it alone.

    Held are the bytes that some language has seen in a context, with their cost in each language, and one escape for each context
    and language. Every context of the samples is there, however many languages and symbols there are.
    """

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        data = [np.frombuffer(b"".join(START + x for x in samples[k]), np.uint8) for k in self.languages]
        seen = np.unique(np.concatenate([*data, np.frombuffer(START, np.uint8)]))
        self.size = a = len(seen) + 1  # the last symbol stands for all unseen bytes, whose costs are alike
        self.symbol = np.full(256, a - 1, np.int32)
        self.symbol[seen] = np.arange(len(seen))
        width, whole = len(self.languages), [self.symbol[x].astype(np.int64) for x in data]
        parents, escapes, keys, values = [], [], [], []
        longest = np.zeros(1, np.int64)  # state of the longest known context, by the code of the last bytes
        offset = 0
        for order in range(ORDER + 1):
            grams = []
            for s in whole:
                code = sum((s[k : len(s) - order + k] * a ** (order - k) for k in range(order + 1)), np.zeros(len(s) - order, np.int64))
                grams.append(np.unique(code, return_counts=True))
            every = np.unique(np.concatenate([g for g, _ in grams]))
            codes, context = np.unique(every // a, return_inverse=True)
            below = longest[codes % a ** max(order - 1, 0)] if order else np.full(len(codes), -1)  # the same context without its first byte
            escape, share = np.zeros((len(codes), width)), np.full((len(every), width), np.nan)
            for k, (gram, count) in enumerate(grams):
                at = np.searchsorted(every, gram)
                total, kinds = np.bincount(context[at], count, len(codes)), np.bincount(context[at], minlength=len(codes))
                met = total > 0
                escape[met, k] = -np.log2(kinds[met] / (total + kinds)[met])
                share[at, k] = -np.log2(count / (total + kinds)[context[at]])
            # A byte seen here was seen after the shorter context too.
            shorter = values[-1][np.searchsorted(keys[-1], below[context] * a + every % a)] if order else 8.0
            values.append(np.where(np.isnan(share), shorter + escape[context], share))
            parents.append(below)
            escapes.append(escape)
            keys.append((offset + context) * a + every % a)
            state = longest[np.arange(a**order) % a ** max(order - 1, 0)]
            state[codes] = offset + np.arange(len(codes))
            longest, offset = state, offset + len(codes)
        self.state, self.parent = longest.astype(np.int32), np.concatenate(parents).astype(np.int32)
        self.escape, self.costs = np.concatenate(escapes).astype(np.float32), np.concatenate(values).astype(np.float32)
        self.keys, self.slots = np.concatenate(keys), None
        if offset * a <= MOST_SLOTS:
            self.slots = np.full(offset * a, -1, np.int32)
            self.slots[self.keys] = np.arange(len(self.keys))

    def _places(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Where the costs of bytes after contexts stand, -1 for bytes that no language has seen there."""
        key = state * np.int64(self.size) + symbol
        if self.slots is not None:
            return self.slots[key]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits that each text takes under each language."""
        data = np.frombuffer(b"".join(START + x for x in texts), np.uint8)
        begin = np.cumsum([0, *(len(x) + ORDER for x in texts)])
        bits = np.zeros((len(texts), len(self.languages)))
        a = self.size
        for at in range(0, len(data), SLICE):
            end = min(at + SLICE, len(data))
            s = self.symbol[data[max(0, at - ORDER) : end]]
            s = np.r_[np.zeros(ORDER - min(at, ORDER), np.int32), s]
            n = len(s) - ORDER
            state = self.state[sum(s[k : n + k] * a ** (ORDER - 1 - k) for k in range(ORDER))]
            place = self._places(state, s[ORDER:])
            cost = self.costs[place]
            todo = np.flatnonzero(place < 0)
            cost[todo] = 0
            state = state[todo]
            while len(todo):  # down to shorter contexts, and below the empty one
                cost[todo] += self.escape[state]
                state = self.parent[state]
                cost[todo[state < 0]] += 8
                todo, state = todo[state >= 0], state[state >= 0]
                place = self._places(state, s[ORDER:][todo])
                cost[todo[place >= 0]] += self.costs[place[place >= 0]]
                todo, state = todo[place < 0], state[place < 0]
            first = np.searchsorted(begin, at, side="right") - 1
            last = np.searchsorted(begin, end, side="left")
            for i in range(ORDER):  # the bytes put before each text cost nothing
                put = begin[first:last] + i
                cost[put[(put >= at) & (put < end)] - at] = 0
            starts = np.maximum(begin[first:last], at) - at
            bits[first:last] += np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
        return bits

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language of the shortest code and its share among all languages; ``und`` and 0 for null or without a letter."""
        known = [bool(self.languages) and t is not None and any(map(str.isalpha, t)) for t in texts]
        language, score = ["und"] * len(texts), np.zeros(len(texts))
        rows = [i for i, k in enumerate(known) if k]
        if rows:
            bits = self.code_lengths([texts[i].encode() for i in rows])
            best = bits.argmin(1)
            score[rows] = 1 / np.exp2(-np.minimum(bits - bits.min(1, keepdims=True), 1000)).sum(1)
            for i, k in zip(rows, best, strict=True):
                language[i] = self.languages[k]
        return language, score


def learn(documents: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_bytes: int = SAMPLE_BYTES) -> Trees:
    """Trees from documents with a lang whose crc32 of doc_id, as text, isn't 1 modulo 3; a null doc_id isn't learned from.

    Whole texts of about ``sample_documents`` documents of each language, and of about ``sample_bytes`` at most, chosen by a hash of
    doc_id and text after rows alike in both are merged, reach the driver.
    """
    rows = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where((crc_part("doc_id", 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("hash", F.xxhash64("text"))
    unlike = rows.select("doc_id", "lang", "hash", F.octet_length("text").alias("bytes")).distinct()
    shares = {r["lang"]: min(1.0, sample_documents / r["n"], sample_bytes / max(r["bytes"], 1)) for r in unlike.groupBy("lang").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()}
    if not shares:
        return _no_trees()
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))[F.col("lang")]
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "hash"), F.lit(1_000_000)) < share * 1_000_000).dropDuplicates(["doc_id", "lang", "hash"]).select("lang", "text").collect()
    samples: dict[str, list[bytes]] = {}
    for r in chosen:
        samples.setdefault(r["lang"], []).append(r["text"].encode())
    return Trees({k: sorted(v) for k, v in samples.items()}) if samples else _no_trees()


def _no_trees() -> Trees:
    none = Trees.__new__(Trees)
    none.languages = []
    return none


def _as_plain(trees: Trees) -> dict:
    return vars(trees)


def _from_plain(values: dict) -> Trees:
    trees = Trees.__new__(Trees)
    vars(trees).update(values)
    return trees


def _identify(batches: Iterator[pa.RecordBatch], trees) -> Iterator[pa.RecordBatch]:
    model = _from_plain(trees.value)
    for batch in batches:
        language, score = model.predict(batch.column(1).to_pylist())
        yield pa.record_batch([batch.column(0), pa.array(language, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])


def identify(documents: DataFrame, trees: Trees) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for each row of ``documents (doc_id, text)``, from the text alone.

    The whole text counts, at one cost for each byte. lang_pred is ``und`` with score 0 if the text is null or has no letter, or
    if nothing was learned; of equal code lengths the first language wins. Null ids and repeated rows stay as they are.
    """
    bounded_batches(documents.sparkSession)
    model = documents.sparkSession.sparkContext.broadcast(_as_plain(trees))
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task(_identify, trees=model), "doc_id long, lang_pred string, score double")


def _keep(batches: Iterator[pa.RecordBatch], trees) -> Iterator[pa.RecordBatch]:
    model = _from_plain(trees.value)
    for batch in batches:
        texts = list(strings(batch, "text"))
        keep = [k != "und" for k in model.predict(texts)[0]] if model.languages else [any(map(str.isalpha, t)) for t in texts]
        yield batch.filter(pa.array(keep, pa.bool_()))


def keep_identified(documents: DataFrame, trees: Trees) -> DataFrame:
    """The rows of ``documents``, with all columns as they are, whose text has a language; the others go. If nothing was learned, those with a letter stay."""
    bounded_batches(documents.sparkSession)
    model = documents.sparkSession.sparkContext.broadcast(_as_plain(trees))
    return documents.mapInArrow(task(_keep, trees=model), documents.schema)
