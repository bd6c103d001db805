"""Stupid-backoff scores of documents under n-gram counts of all other documents.

The count tables of words and word pairs are partitioned by hash (buckets of ``exchange``) and joined back to
the n-grams of each chunk of documents. A triple can only stand elsewhere if both of its pairs do, so a second round
asks only for those triples. Each document's own occurrences are taken off its counts:
otherwise every n-gram would be known.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm import exchange as X
from flowloom.llm import textbytes as B

RESULT = "doc_id long, n_tokens long, log_score double"
TOKENS = np.zeros(1, np.uint64)  # the key under which chunks add up their numbers of words; window hashes of 0 are moved off it


def _tables(texts: list):
    """Per batch: first document, number of documents, document of each word, hashes of the n-grams that start at each word, and whether one does."""
    for first, last, parts in B.batches(texts):
        data, offsets = B.joined(parts)
        start, end = B.word_edges(data)
        owner = np.searchsorted(offsets, start, "right") - 1
        words = B.stretch_hash(B.prefix_hash(data), start, end)
        grams, whole = [], []
        for n in (1, 2, 3):
            hashes = B.window_hash(words, n)
            mask = owner[:len(hashes)] == owner[n - 1:] if len(hashes) else np.zeros(0, bool)
            grams.append(np.maximum(hashes, np.uint64(1)))
            whole.append(mask)
        yield first, last - first, owner, grams, whole


def _own(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How often a document has the key, at each of its places."""
    _, order, _, counts = B.unique_sorted(B.mix(keys + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return B.spread_back(counts, order, counts)


def _pairs(texts: list):
    """All words and pairs of the chunk as one list of keys, batch after batch."""
    keys = [g[m] for _, _, _, grams, whole in _tables(texts) for g, m in zip(grams[:2], whole[:2])]
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _ask_pairs(buckets: int):
    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = list(pdf["text"])
        keys, _, _, counts = B.unique_sorted(_pairs(texts))
        words = sum(len(owner) for _, _, owner, _, _ in _tables(texts))
        return X.questions(int(pdf["chunk"].iloc[0]), np.concatenate((TOKENS, keys)), np.append(words, counts), buckets)

    return make


def _elsewhere(keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Occurrences of a key outside the asking chunk."""
    _, order, first, counts = B.unique_sorted(keys)
    total = np.add.reduceat(columns[0][order], first)
    return B.spread_back(total, order, counts) - columns[0]


def _known(texts: list, answers: np.ndarray):
    """Tokens of the corpus, and per batch the words' and pairs' counts in other documents."""
    _, order, _, counts = B.unique_sorted(_pairs(texts))
    everywhere = B.spread_back(answers[1:] + counts, order, counts)
    words, at, found = 0, 0, []
    for first, n_docs, owner, grams, whole in _tables(texts):
        here = []
        for g, m in zip(grams[:2], whole[:2]):
            n = int(m.sum())
            count = np.zeros(len(owner), np.int64)
            count[:len(m)][m] = everywhere[at:at + n] - _own(g[m], owner[:len(m)][m])
            here.append(count)
            at += n
        words += len(owner)
        found.append(here)
    return int(answers[0]) + words, found


def _triples(texts: list, known: list):
    """Per batch: which words start a triple whose pairs both stand in other documents, and the triples' hashes."""
    for (_, _, _, grams, whole), (_, pair) in zip(_tables(texts), known):
        asked = whole[2] & (pair[:len(whole[2])] > 0) & (pair[1:len(whole[2]) + 1] > 0)
        yield asked, grams[2][asked]


def _ask_triples(buckets: int):
    def make(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts = list(docs["text"])
        _, known = _known(texts, X.answers_of(answers))
        found = [h for _, h in _triples(texts, known)]
        keys, _, _, counts = B.unique_sorted(np.concatenate(found) if found else np.zeros(0, np.uint64))
        return X.questions(int(docs["chunk"].iloc[0]), keys, counts, buckets)

    return make


def _score(backoff: float):
    def score(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts = list(docs["text"])
        total, known = _known(texts, X.answers_of(answers[answers["round"] == 1]))
        triples = list(_triples(texts, known))
        _, order, _, counts = B.unique_sorted(np.concatenate([h for _, h in triples]) if triples else np.zeros(0, np.uint64))
        everywhere = B.spread_back(X.answers_of(answers[answers["round"] == 2]) + counts, order, counts)
        n_tokens, scores = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        at = 0
        for (first, n_docs, owner, _, whole), (word, pair), (asked, hashes) in zip(_tables(texts), known, triples):
            n = len(owner)
            triple = np.zeros(n, np.int64)
            triple[:len(asked)][asked] = everywhere[at:at + len(hashes)] - _own(hashes, owner[:len(asked)][asked])
            at += len(hashes)
            has1, has2 = np.zeros(n, bool), np.zeros(n, bool)  # words with one, with two words before them
            has1[1:] = whole[1][:n - 1] if n else whole[1]
            has2[2:] = whole[2][:max(0, n - 2)]
            c2, c3, before1, before2 = (np.zeros(n, np.int64) for _ in range(4))
            c2[1:], c3[2:], before1[1:], before2[2:] = pair[:-1], triple[:-2], word[:-1], pair[:-2]
            use3 = has2 & (c3 > 0)
            use2 = ~use3 & has1 & (c2 > 0)
            steps = np.where(use3, 0, np.where(use2, has2.astype(int), has1.astype(int) + has2))
            rest = total - np.bincount(owner, minlength=n_docs)[owner]
            above = np.where(use3, c3, np.where(use2, c2, np.maximum(word, 1)))
            below = np.where(use3, before2, np.where(use2, before1, np.where(word > 0, rest, rest + 1)))
            logs = np.log(above) - np.log(below) + steps * math.log(backoff)
            n_tokens[first:first + n_docs] = np.bincount(owner, minlength=n_docs)
            scores[first:first + n_docs] = np.bincount(owner, weights=logs, minlength=n_docs)
        return pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64"), "n_tokens": n_tokens, "log_score": scores})

    return score


def lm_scores(docs: DataFrame, backoff: float = 0.4, doc_id: str = "doc_id", text: str = "text",
              chunk_bytes: int = X.CHUNK_BYTES, bucket_bytes: int = X.BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs``: words, natural log of the stupid-backoff score (sum over words), mean per word.

    With c the counts in all other rows and N their words: a word scores c(abc) / c(ab) after two words, else
    ``backoff`` times c(bc) / c(b), else again times c(c) / N, or 1 / (N + 1) if no other row has it. Words
    at the start of a text have a shorter context and no penalty for it. Words are runs of bytes other than ASCII white
    space. Null and empty texts: 0 words, score 0, mean null. Rows of one id are separate documents. Other columns are ignored.
    """
    total = X.text_bytes(docs, text)
    chunks = X.in_chunks(docs, doc_id, text, total, chunk_bytes)
    buckets = X.buckets_for(total, bucket_bytes)
    pairs = X.ask(chunks, _ask_pairs(buckets), _elsewhere)
    triples = X.ask_again(chunks, pairs, _ask_triples(buckets), _elsewhere)
    answers = pairs.withColumn("round", F.lit(1)).unionByName(triples.withColumn("round", F.lit(2)))
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_score(backoff), RESULT)
    return scored.withColumn("mean_log_score", F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens")))
