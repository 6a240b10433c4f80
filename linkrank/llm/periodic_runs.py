"""Periodic runs of words: a sparse dynamic program over the diagonals of a text against itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions import with_once
from linkrank.llm.common import batch_of, task

#: A run has at least so many words, and two periods.
LEAST = 12
#: Lags below are followed over the whole text; longer ones from recurring windows only.
BAND = 8
#: Pairs of occurrences looked at together.
PAIRS = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
RUNS_DDL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _windows(ids: np.ndarray, width: int) -> np.ndarray:
    """Numbers of windows twice as wide, from those of ``width`` words at each start; equal windows have equal numbers."""
    pair = ids[:-width] * (ids.max() + 1) + ids[width:]
    return np.unique(pair, return_inverse=True)[1].astype(np.int64)


def _openings(w: np.ndarray, ids: np.ndarray, width: int, reach: np.ndarray) -> Iterator[tuple[int, int]]:
    """``(i, lag)`` for diagonals with lags from ``width`` to twice that which begin at word i and match for at least the lag.

    For each window the earlier occurrences in that band of lags; a diagonal begins where the words before differ. It
    matches for its lag if the windows at both ends of that stretch agree. Within a run of a shorter period d that has gone on for
    the lag and d words, no longer lag can be a smallest period, and ``reach`` passes those occurrences over.
    """
    n = len(w)
    often = np.flatnonzero(np.bincount(ids)[ids] > 1)
    order = often[np.argsort(ids[often], kind="stable")]
    keys = ids[order] * (n + 1) + order
    base, last = ids[often] * (n + 1), often + width - 1
    lo = np.searchsorted(keys, base + np.maximum(often - 2 * width + 1, 0))
    hi = np.searchsorted(keys, base + often - np.maximum(width, reach[last] + 1), side="right")
    held = np.flatnonzero(hi > lo)
    count = (hi - lo)[held]
    ends = np.cumsum(count)
    at = 0
    while at < len(held):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        c = count[at:to]
        i = np.repeat(often[held[at:to]], c)
        j = order[np.repeat(lo[held[at:to]] - np.cumsum(c) + c, c) + np.arange(c.sum())]
        lag = i - j
        good = ((j == 0) | (w[i - 1] != w[j - 1])) & (i + lag <= n)
        i, j, lag = i[good], j[good], lag[good]
        good = ids[i + lag - width] == ids[j + lag - width]
        yield from zip(i[good].tolist(), lag[good].tolist(), strict=True)
        at = to


def _end(w: np.ndarray, at: int, lag: int) -> int:
    """The first word from ``at`` on that differs from the one ``lag`` before."""
    step = 64
    while at < len(w):
        to = min(at + step, len(w))
        differ = np.flatnonzero(w[at:to] != w[at - lag : to - lag])
        if len(differ):
            return at + int(differ[0])
        at, step = to, 2 * step
    return at


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs, by start, then period.

    Lag q is a diagonal of the words against themselves; its match length grows by one with each word that equals the
    word q before. A diagonal that ends after max(q, 12 - q) matches at least is a run, unless a shorter lag has given the same stretch, whose
    smallest period that is. Bands of lags double, and windows with them: a lag of 8 or more needs as many matches, so only
    earlier occurrences of windows of that size can open it. So a frequent word costs nothing by itself, and texts of one word or one line over and
    over open a diagonal for the smallest period only.
    """
    n, number = len(words), {}
    if n < LEAST:
        return []
    w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, n)
    found: dict[tuple[int, int], int] = {}
    reach = np.zeros(n, np.int64)

    def emit(start: int, end: int, period: int) -> None:
        if found.setdefault((start, end), period) == period:
            grown = reach[start + period : end]
            np.maximum(grown, np.arange(1, len(grown) + 1), out=grown)

    for q in range(1, min(BAND, n // 2 + 1)):
        cuts = np.flatnonzero(np.r_[True, w[q:] != w[:-q], True])
        for k in np.flatnonzero(np.diff(cuts) > max(q, LEAST - q)).tolist():
            emit(int(cuts[k]), int(cuts[k + 1]) - 1 + q, q)
    ids, width = w, 1
    while 2 * width <= n // 2 and ids.max() + 1 < len(ids):
        ids = _windows(ids, width)
        width *= 2
        if width >= BAND and ids.max() + 1 < len(ids):
            for i, lag in list(_openings(w, ids, width, reach)):
                emit(i - lag, _end(w, i + lag, lag), lag)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, less those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0)])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, lists, texts = [], [], []
        for text in batch.column(1):
            words = (text.as_py() or b"").split()
            runs = runs_of(words)
            sizes.append(len(words))
            lists.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
            texts.append(collapsed(words, runs).decode())
        yield batch_of(RUNS, [batch.column(0), sizes, lists, texts])


def find_runs(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for each row of ``documents``; other columns are not looked at.

    Words lie between ASCII white space. A run is a stretch of at least 12 words and two periods, in which words one smallest period apart are
    identical and which no neighbouring word extends. runs holds (start, length, period) by start, then period; collapsed has the words less those
    after the first period of a run, joined by a space. A null text counts as empty: no words, no runs, an empty text.
    Null ids and repeated rows stay as they are. A map over rows: no exchange, and memory in proportion to the longest text.
    """
    rows = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(task(_runs), RUNS_DDL)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """``(doc_id, text)`` in which texts of ids with a crc32 divisible by ten repeat some words from a place on, up to their end.

    The place and the number of words repeated follow from that crc32. Rows without an id or without a word stay as they are.
    """
    code = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(code % 10 == 0, F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+", -1), lambda x: x != ""))
    rows = with_once(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "words", words)
    n, g = F.size("words"), F.floor(code / 10)
    place = F.when(n > 0, g % n)
    rows = rows.select("doc_id", "text", "words", place.alias("a"), (1 + F.floor((n - place) / (3 + g % 8))).alias("p"))
    repeated = F.transform("words", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.element_at("words", (F.col("a") + (i - F.col("a")) % F.col("p") + 1).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
