"""Substring dedup by relative Lempel-Ziv parsing against an index of the whole corpus.

Every run of ``window`` words of every document is indexed with the smallest doc_id it starts in.
The index is dealt into reference blocks (buckets of ``exchange``). Each document is factored against every block:
a factor is a longest run of words in which each window starts in a smaller document. A
window that lies across the boundary of two factors is looked up like any other, so words are only joined
into one factor if every window at the boundary is a copy too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from flowloom.llm import exchange as X
from flowloom.llm import textbytes as B

NOBODY = np.iinfo(np.int64).max
RESULT = "doc_id long, n_words long, n_removed long, kept binary, factors array<struct<start:int,words:int>>"


def _sorted(pdf: pd.DataFrame) -> tuple[list, np.ndarray, list]:
    """Ids (None: null), ids as numbers with null last, texts; by id."""
    pdf = pdf.sort_values("doc_id", kind="stable", na_position="last")
    ids = [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]
    return ids, np.array([NOBODY if x is None else x for x in ids], np.int64), list(pdf["text"])


def _tables(texts: list, window: int):
    """Per batch: first document, texts, word count per document, start word and document of each window, its hash."""
    for first, _, parts in B.batches(texts):
        data, offsets = B.joined(parts)
        start, end = B.word_edges(data)
        owner = np.searchsorted(offsets, start, "right") - 1
        hashes = B.window_hash(B.stretch_hash(B.prefix_hash(data), start, end), window)
        whole = np.flatnonzero(owner[:len(hashes)] == owner[window - 1:]) if len(hashes) else np.zeros(0, np.int64)
        yield first, parts, np.bincount(owner, minlength=len(parts)), whole, first + owner[whole], hashes[whole]


def _windows(texts: list, window: int) -> tuple[np.ndarray, np.ndarray]:
    found = [(h, d) for _, _, _, _, d, h in _tables(texts, window)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([h for h, _ in found]), np.concatenate([d for _, d in found])


def _make(window: int, buckets: int):
    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        _, numbers, texts = _sorted(pdf)
        hashes, owner = _windows(texts, window)
        keys, order, first, _ = B.unique_sorted(hashes)
        return X.questions(int(pdf["chunk"].iloc[0]), keys, numbers[owner[order[first]]], buckets)

    return make


def _smallest(keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """How far the smallest document of a key lies below the chunk's own smallest."""
    own = columns[0]
    _, order, first, counts = B.unique_sorted(keys)
    least = np.minimum.reduceat(own[order], first)
    return own - B.spread_back(least, order, counts)


def _factor(window: int):
    def factor(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({c: [] for c in ("doc_id", "n_words", "n_removed", "kept", "factors")})
        ids, numbers, texts = _sorted(docs)
        hashes, owner = _windows(texts, window)
        keys, order, first, counts = B.unique_sorted(hashes)
        least = numbers[owner[order[first]]] - X.answers_of(answers) if len(keys) else np.zeros(0, np.int64)
        copied = B.spread_back(least, order, counts) < numbers[owner]
        rows, at = [], 0
        for first_doc, parts, n_words, start, _, h in _tables(texts, window):
            gone = B.covered(start[copied[at:at + len(h)]], window, int(n_words.sum()))
            at += len(h)
            word = 0
            for i, n in enumerate(n_words.tolist()):
                mine = gone[word:word + n]
                word += n
                words = parts[i].split()
                lo, hi = B.runs(mine)
                if len(lo):
                    words = [w for w, g in zip(words, mine.tolist()) if not g]
                rows.append((ids[first_doc + i], n, int(mine.sum()), b" ".join(words),
                             [{"start": a, "words": b - a} for a, b in zip(lo.tolist(), hi.tolist())]))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept", "factors"])
        return out.astype({"doc_id": "Int64"})

    return factor


def substring_dedup(docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text",
                    chunk_bytes: int = X.CHUNK_BYTES, bucket_bytes: int = X.BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs``: words, removed words, the kept words joined by one space (bytes), the factors cut out.

    A word goes if a window of ``window`` consecutive words over it also starts in a document with a smaller id.
    Words are runs of bytes other than the six ASCII white-space bytes, unchanged. A null or empty
    text has no words and keeps nothing. A row with a null id is never a source, and every window found in a document with an id
    counts against it. Rows with one id are one document: they are no source for each other. Other columns are ignored. Empty table: no rows.
    """
    total = X.text_bytes(docs, text)
    chunks = X.in_chunks(docs, doc_id, text, total, chunk_bytes)
    answers = X.ask(chunks, _make(window, X.buckets_for(total, bucket_bytes)), _smallest)
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_factor(window), RESULT)
