"""Byte-pair encoding of whole texts with a public vocabulary, fragment by fragment between forced cuts, and decoding."""

from __future__ import annotations

import gc
import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches, strings, task

#: Words whose encoding a task remembers; it starts anew beyond that.
CACHE_WORDS = 120_000
#: Texts whose new words are encoded together.
TEXTS = 256
NONE = 1 << 62
#: Symbols from which on merging goes by a heap.
LONG = 48
#: Characters of the Unicode property White_Space.
SPACE = r"\t-\r\x20\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Separators that Python takes for white space and Unicode doesn't.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """A visible character for each byte: itself where it is visible in Latin-1, else the next one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in shown]
    place = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}
    return [chr(place[b]) for b in range(256)]


def _lower(text: str) -> str:
    """NFC, then each character in lower case by itself."""
    return text.lower() if text.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", text)))


def tokens_of(file: bytes) -> list[str]:
    """Token of each id of a vocabulary file, special ones included."""
    whole = json.loads(file)
    pairs = {x["id"]: x["content"] for x in whole["added_tokens"]} | {i: t for t, i in whole["model"]["vocab"].items()}
    return [pairs.get(i, "") for i in range(1 + max(pairs))]


class Encoder:
    """Encoder for a vocabulary file with word ends and byte letters.

    A pair of bytes that is within no token can't be merged over, so a word is cut between them for certain; the fragments are
    encoded on their own and their ids joined.
    """

    def __init__(self, file: bytes):
        import regex

        whole = json.loads(file)
        model = whole["model"]
        if model["type"] != "BPE" or [x["type"] for x in whole["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a vocabulary of the kind with word ends and lower case")
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in whole["added_tokens"]}
        split = whole["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", SPACE))
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.apart = regex.compile(f"[{SPACE}]+")
        letters = byte_letters()
        self.inner, self.last = np.array([vocab[c] for c in letters]), np.array([vocab[c + self.end] for c in letters])
        # rank and new id in one number, by pair of ids
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
        self.pair_keys = np.array(sorted(self.merges), np.int64)
        self.pair_ranks = np.array([self.merges[k] for k in self.pair_keys.tolist()], np.int64)
        of_letter = {c: b for b, c in enumerate(letters)}
        inside = {pair for token in vocab for body in [token.removesuffix(self.end)] for pair in zip(body, body[1:], strict=False)}
        self.joined = np.zeros((256, 256), bool)
        for a, b in inside:
            self.joined[of_letter[a], of_letter[b]] = True
        # ids in bytes, by word and by chunk of text; no word of the pattern is written like a special token
        self.special_parts = {k: np.int32(i).tobytes() for k, i in self.special.items()}
        self.parts: dict[str, bytes] = dict(self.special_parts)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as 32-bit integers in bytes; special tokens written out in a text count as such."""
        known, out = self.known, []
        for start in range(0, len(texts), TEXTS):
            part = [self.apart.split(t) if any(c in t for c in NOT_SPACE) else t.split() for t in texts[start : start + TEXTS]]
            if len(known) > CACHE_WORDS:
                known.clear()
            self._learn(list(set().union(*part) - known.keys()))
            out += [b"".join(map(known.__getitem__, words)) for words in part]
        return out

    def forget(self) -> None:
        """Gives back the memory of remembered words; the next text starts anew."""
        self.known, self.parts = {}, dict(self.special_parts)

    def _learn(self, chunks: list[str]) -> None:
        """Encodes what stands between white space: special tokens, and the words of the pattern, all new ones at a time."""
        find, special = self.words.findall, self.cut_special
        split = [find(_lower(c)) if "<" not in c or special is None else [w for x in special.split(c) for w in ([x] if x in self.special else find(_lower(x)))] for c in chunks]
        if len(self.parts) > CACHE_WORDS:
            self.parts = dict(self.special_parts)
        parts = self.parts
        fresh = list(set(chain.from_iterable(split)) - parts.keys())
        parts.update(zip(fresh, self._merge([w.encode() for w in fresh]), strict=True))
        self.known.update(zip(chunks, [parts[words[0]] if len(words) == 1 else b"".join([parts[w] for w in words]) for words in split], strict=True))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def _merge(self, words: list[bytes]) -> list[bytes]:
        """Cuts the words at forced boundaries, and merges in all fragments at once the pair of lowest rank, the leftmost of equal ones."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        ids = self.inner[data]
        ids[ends - 1] = self.last[data[ends - 1]]
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.joined[data[:-1], data[1:]]
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        sizes, number = np.diff(np.r_[starts, len(data)]), np.arange(len(starts))
        fragment_of_word = np.searchsorted(starts, np.r_[0, ends])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        long = np.flatnonzero(sizes > LONG)
        for k in long:
            merged = np.array(self._merge_long(ids[starts[k] : starts[k] + sizes[k]].tolist()))
            done.append((np.full(len(merged), k), merged))
        rank = np.full(len(ids), NONE)
        rank[:-1] = self._rank(ids[:-1], ids[1:])
        rank[starts + sizes - 1] = NONE
        open_ = sizes <= LONG
        while True:
            stays = np.repeat(open_, sizes)
            ids, rank, sizes, number = ids[stays], rank[stays], sizes[open_], number[open_]
            if not len(sizes):
                break
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank, starts)
            open_ = least < NONE
            if not open_.all():
                over = ~open_
                done.append((np.repeat(number[over], sizes[over]), ids[np.repeat(over, sizes)]))
                continue
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            owner = np.searchsorted(starts, at, side="right")
            at = at[np.r_[True, owner[1:] != owner[:-1]]]
            new = least & 0xFFFFF
            ids[at] = new
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            last = at + 1 == starts + sizes - 1  # the merged symbol ends its fragment
            after = np.minimum(at + 2, len(ids) - 1)
            rank[at] = np.where(last, NONE, self._rank(new, ids[after]))
            inner = at > starts
            rank[at[inner] - 1] = self._rank(ids[at[inner] - 1], new[inner])
            ids, rank, sizes = ids[keep], rank[keep], sizes - 1
            open_ = np.ones(len(sizes), bool)
        owner = np.concatenate([x for x, _ in done])
        order = np.argsort(owner, kind="stable")
        flat = np.concatenate([x for _, x in done])[order].astype(np.int32).tobytes()
        at = (4 * np.searchsorted(owner[order], fragment_of_word)).tolist()
        return [flat[a:b] for a, b in zip(at, at[1:], strict=False)]

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long fragments: candidates in a heap, symbols in a list linked both ways."""
        get, n = self.merges.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(v >> 20, k, ids[k], ids[k + 1], v & 0xFFFFF) for k in range(n - 1) if (v := get(ids[k] << 20 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, a, b, new = heapq.heappop(heap)
            j = after[k] if ids[k] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[k], ids[j], after[k] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = k
            for i, m in ((before[k], k), (k, after[k])):
                if i >= 0 and m < n and (v := get(ids[i] << 20 | ids[m])) is not None:
                    heapq.heappush(heap, (v >> 20, i, ids[i], ids[m], v & 0xFFFFF))
        return [i for i in ids if i >= 0]


def _held(file, kind):
    """One of a kind for each Python worker: it stays with the broadcast value, words that it remembers included."""
    held = file.value
    if kind.__name__ not in held:
        held[kind.__name__] = kind(held["file"])
    return held[kind.__name__]


def _encode(batches: Iterator[pa.RecordBatch], file, back: bool = False) -> Iterator[pa.RecordBatch]:
    encoder, tokens = _held(file, Encoder), pa.array(_held(file, tokens_of)) if back else None
    gc.disable()  # what is remembered holds no cycles, and there is much of it
    try:
        for batch in batches:
            ids = encoder.encode(list(strings(batch, "text")))
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            if back:
                yield pa.record_batch([batch.column(0), lists, decoded(lists, tokens)], names=["doc_id", "ids", "decoded"])
            else:
                yield pa.record_batch([batch.column(0), lists], names=["doc_id", "ids"])
    finally:
        encoder.forget()
        gc.enable()


def decoded(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """Tokens of each list joined by spaces; null as an empty list."""
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    ends = pa.array(np.cumsum(np.r_[0, sizes]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(ends, pc.take(tokens, ids.flatten())), " ")


def _decode(batches: Iterator[pa.RecordBatch], file) -> Iterator[pa.RecordBatch]:
    tokens = pa.array(_held(file, tokens_of))
    for batch in batches:
        yield pa.record_batch([batch.column(0), batch.column(1), decoded(batch.column(1), tokens)], names=["doc_id", "ids", "decoded"])


def encode(documents: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, ids)`` for each row of ``documents (doc_id, text)``; other columns are not looked at.

    ``vocabulary`` is the path of the vocabulary file on the driver; it goes to the tasks as a broadcast of a
    few MB. A null text counts as empty, and an empty one has no ids. Null ids and repeated rows stay as they are.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    file = spark.sparkContext.broadcast({"file": Path(vocabulary).read_bytes()})
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task(_encode, file=file), "doc_id long, ids array<int>")


def round_trip(documents: DataFrame, vocabulary: str) -> DataFrame:
    """``decode(encode(documents))`` in one pass: ``(doc_id, ids, decoded)``, decoded from the ids."""
    spark = documents.sparkSession
    bounded_batches(spark)
    file = spark.sparkContext.broadcast({"file": Path(vocabulary).read_bytes()})
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task(_encode, file=file, back=True), "doc_id long, ids array<int>, decoded string")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` from ``(doc_id, ids)``: the tokens, special ones included, joined by spaces."""
    file = encoded.sparkSession.sparkContext.broadcast({"file": Path(vocabulary).read_bytes()})
    return encoded.select("doc_id", "ids").mapInArrow(task(_decode, file=file), "doc_id long, ids array<int>, decoded string")
