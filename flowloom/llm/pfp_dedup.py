"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash of ``trigger_bytes`` bytes cuts every text into phrases at its triggers (one in ``phrase_bytes`` on average).
Phrases with what follows them up to the length of a window are the suffixes of the parse. They are sorted, in the order of
hashes, first by the stretch that all windows starting in a phrase share, then by the whole stretch that these windows span:

* the shared stretch stands once in the corpus: no window of the phrase repeats;
* the whole stretch repeats: all of them repeat;
* otherwise the windows of the phrase are sorted themselves, beside those of phrases with the same shared stretch.

Triggers depend on the bytes in the window alone, so equal windows meet the same trigger at the same
distance. Windows without a trigger in their first ``reach`` bytes are sorted themselves. Only equality of
bounded suffixes is needed, so hash order replaces the alphabetical one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm import exchange as X
from flowloom.llm import textbytes as B

RESULT = "doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<start:int,bytes:int>>"
ALONE, REPEATED, OPEN, REPEATED_BESIDE_OPEN = 0, 1, 2, 3


class Parse:
    """Phrases of one batch of texts: windows start in [lo, hi] before a trigger; ``loose`` windows have none near."""

    def __init__(self, parts: list[bytes], window: int, trigger_bytes: int, phrase_bytes: int, reach: int):
        self.data, offsets = B.joined(parts)
        self.starts, self.ends = offsets[:-1], offsets[1:] - 1
        self.prefix = B.prefix_hash(self.data)
        self.window = window
        n = len(self.data)
        _, down = B.powers(n)
        rolling = (self.prefix[trigger_bytes:] - self.prefix[:-trigger_bytes]) * down[:n - trigger_bytes + 1] if n >= trigger_bytes else np.zeros(0, np.uint64)
        at = np.flatnonzero(rolling < np.uint64(2**64 // phrase_bytes))
        owner = np.searchsorted(self.starts, at, "right") - 1
        inside = at + trigger_bytes <= self.ends[owner]
        at, owner = at[inside], owner[inside]
        before = np.concatenate(([-1], at[:-1]))
        lo = np.maximum(np.maximum(before + 1, self.starts[owner]), at - reach)
        hi = np.minimum(at, self.ends[owner] - window)
        has = lo <= hi
        self.lo, self.hi, at, owner = lo[has], hi[has], at[has], owner[has]
        self.shared = B.stretch_hash(self.prefix, at, at + window - reach)
        self.whole = B.mix(B.stretch_hash(self.prefix, self.lo, np.minimum(at + window, self.ends[owner])) + (at - self.lo).astype(np.uint64))
        steps = np.zeros(n + 1, np.int64)
        real = self.ends - self.starts >= window
        np.add.at(steps, self.starts[real], 1)
        np.add.at(steps, self.ends[real] - window + 1, -1)
        np.add.at(steps, self.lo, -1)
        np.add.at(steps, self.hi + 1, 1)
        self.loose = np.flatnonzero(np.cumsum(steps[:-1]) > 0)

    def windows_in(self, chosen: np.ndarray) -> np.ndarray:
        """Starts of all windows of the chosen phrases."""
        lo, length = self.lo[chosen], self.hi[chosen] - self.lo[chosen] + 1
        return np.repeat(lo - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum()) if len(lo) else np.zeros(0, np.int64)

    def hashes(self, starts: np.ndarray) -> np.ndarray:
        return B.stretch_hash(self.prefix, starts, starts + self.window)


def _parses(texts: list, shape: tuple):
    for first, _, parts in B.batches(texts):
        yield first, parts, Parse(parts, *shape)


def _pairs(texts: list, shape: tuple):
    """(order, first of each run, run lengths, keys, whole stretches) of the phrases of a chunk, by shared then whole stretch."""
    found = [(p.shared, p.whole) for _, _, p in _parses(texts, shape)]
    shared = np.concatenate([s for s, _ in found]) if found else np.zeros(0, np.uint64)
    whole = np.concatenate([w for _, w in found]) if found else np.zeros(0, np.uint64)
    order, first, counts = _runs(shared, whole)
    return order, first, counts, shared[order][first], whole[order][first]


def _runs(shared: np.ndarray, whole: np.ndarray):
    order = np.lexsort((whole, shared))
    s, w = shared[order], whole[order]
    first = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (w[1:] != w[:-1])))) if len(s) else np.zeros(0, np.int64)
    return order, first, np.diff(np.append(first, len(s)))


def _ask_phrases(shape: tuple, buckets: int):
    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, counts, shared, whole = _pairs(list(pdf["text"]), shape)
        return X.questions(int(pdf["chunk"].iloc[0]), shared, np.column_stack((whole.view(np.int64), counts)), buckets)

    return make


def _judge_phrases(keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    whole, count = columns[0].view(np.uint64), columns[1]
    order, first, sizes = _runs(keys, whole)
    total = np.add.reduceat(count[order], first)
    shared = keys[order][first]
    group = np.flatnonzero(np.concatenate(([True], shared[1:] != shared[:-1])))
    lengths = np.diff(np.append(group, len(shared)))
    together = np.repeat(np.add.reduceat(total, group), lengths)
    settled = np.repeat(np.minimum.reduceat(total, group) > 1, lengths)
    answer = np.where(together == 1, ALONE, np.where(settled, REPEATED, np.where(total > 1, REPEATED_BESIDE_OPEN, OPEN)))
    return B.spread_back(answer, order, sizes)


def _judged(texts: list, shape: tuple, answers: np.ndarray):
    """Per batch: first document, texts, parse, the answer for each phrase."""
    order, _, counts, _, _ = _pairs(texts, shape)
    flags = B.spread_back(answers, order, counts)
    at = 0
    for first, parts, parse in _parses(texts, shape):
        yield first, parts, parse, flags[at:at + len(parse.lo)]
        at += len(parse.lo)


def _open_windows(parse: Parse, flags: np.ndarray) -> np.ndarray:
    return np.concatenate((parse.windows_in(flags >= OPEN), parse.loose))


def _ask_windows(shape: tuple, buckets: int):
    def make(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        hashes = [p.hashes(_open_windows(p, f)) for _, _, p, f in _judged(list(docs["text"]), shape, X.answers_of(answers))]
        keys, _, _, counts = B.unique_sorted(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64))
        return X.questions(int(docs["chunk"].iloc[0]), keys, counts, buckets)

    return make


def _judge_windows(keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    _, order, first, sizes = B.unique_sorted(keys)
    return B.spread_back((np.add.reduceat(columns[0][order], first) > 1).astype(np.int64), order, sizes)


def _remove(shape: tuple):
    window = shape[0]

    def remove(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts, ids = list(docs["text"]), list(docs["doc_id"])
        judged = list(_judged(texts, shape, X.answers_of(answers[answers["round"] == 1]))) if len(texts) else []
        hashes = [p.hashes(_open_windows(p, f)) for _, _, p, f in judged]
        _, order, _, counts = B.unique_sorted(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64))
        repeated = B.spread_back(X.answers_of(answers[answers["round"] == 2]), order, counts) > 0
        rows, at = [], 0
        for (first, parts, parse, flags), asked in zip(judged, hashes):
            starts = np.concatenate((parse.windows_in((flags == REPEATED) | (flags == REPEATED_BESIDE_OPEN)),
                                     _open_windows(parse, flags)[repeated[at:at + len(asked)]]))
            at += len(asked)
            gone = B.covered(starts, window, len(parse.data))
            for i, part in enumerate(parts):
                mine = gone[parse.starts[i]:parse.ends[i]]
                lo, hi = B.runs(mine)
                kept = parse.data[parse.starts[i]:parse.ends[i]][~mine].tobytes() if len(lo) else part
                rows.append((ids[first + i], len(part), int(mine.sum()), kept,
                             [{"start": a, "bytes": b - a} for a, b in zip(lo.tolist(), hi.tolist())]))
        return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "kept", "spans"]).astype({"doc_id": "Int64"})

    return remove


def repeated_bytes(docs: DataFrame, window: int = 400, trigger_bytes: int = 16, phrase_bytes: int = 32, reach: int = 128,
                   doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = X.CHUNK_BYTES,
                   bucket_bytes: int = X.BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs``: bytes, removed bytes, the kept bytes, the maximal removed runs.

    A byte goes if a window of ``window`` bytes over it also starts anywhere else: in another row, or elsewhere in its own
    (overlaps count). Every occurrence goes, the first as well. Windows never cross rows, and rows
    with equal ids are separate texts. Null and empty texts have 0 bytes; texts shorter than a window stay.
    Other columns are ignored. Empty table: no rows.
    """
    if trigger_bytes + reach > window:
        raise ValueError("a trigger within reach must lie inside the window")
    shape = (window, trigger_bytes, phrase_bytes, reach)
    total = X.text_bytes(docs, text)
    chunks = X.in_chunks(docs, doc_id, text, total, chunk_bytes)
    buckets = X.buckets_for(total, bucket_bytes)
    phrases = X.ask(chunks, _ask_phrases(shape, buckets), _judge_phrases)
    windows = X.ask_again(chunks, phrases, _ask_windows(shape, buckets), _judge_windows)
    answers = phrases.withColumn("round", F.lit(1)).unionByName(windows.withColumn("round", F.lit(2)))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_remove(shape), RESULT)
