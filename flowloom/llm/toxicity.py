"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. The model of a category is a logistic regression over the words that tell
most about it, a few measures of style, and the probabilities of all earlier categories. In training, these
probabilities come from models that have not seen the row (out-of-fold), as they will in use.

The models are fitted on a bounded sample of labelled rows (``SAMPLE``), chosen by the hash of the id; all documents are scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm import textbytes as B

SAMPLE = 8000
FOLDS = 5
WORDS = 200
LEAST_DOCUMENTS = 5
LEAST_SHARE = 0.02
LEAST_CHI_SQUARE = 40
RIDGE = 0.05
STYLE = ("log_words", "letters", "capitals", "digits", "marks")

_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_CAPITAL, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(3))
_CAPITAL[65:91] = _DIGIT[48:58] = True
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _features(texts):
    """Per batch: number of documents, (document, hash) of each distinct lower-cased word, style measures."""
    for _, _, parts in B.batches(texts):
        data, offsets = B.joined(parts)
        start, end = B.word_edges(data, _NO_LETTER)
        owner = np.searchsorted(offsets, start, "right") - 1
        words = B.stretch_hash(B.prefix_hash(B.LOWER[data]), start, end)
        order = np.lexsort((words, owner))
        words, who = words[order], owner[order]
        new = np.concatenate(([True], (words[1:] != words[:-1]) | (who[1:] != who[:-1]))) if len(words) else np.zeros(0, bool)
        size = np.maximum(np.diff(offsets), 1)
        share = [np.add.reduceat(x[data], offsets[:-1]) / size for x in (~_NO_LETTER, _CAPITAL, _DIGIT, _MARK)]
        style = np.column_stack([np.log1p(np.bincount(owner, minlength=len(parts))), *share])
        yield len(parts), who[new], words[new], style


def _sample_rows(batches):
    for batch in batches:
        at = 0
        for n, who, words, style in _features(x.as_py() for x in batch.column(1)):
            cut = np.searchsorted(who, np.arange(n + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array([words[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                                              pa.array([x.tobytes() for x in style], pa.binary())], names=["doc_id", "words", "style"])
            at += n


class Linear:
    """Logistic regression over chosen words, style and earlier probabilities."""

    def __init__(self, words: np.ndarray, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.words, self.centre, self.scale, self.weights = words, centre, scale, weights

    def probability(self, table: np.ndarray, dense: np.ndarray) -> np.ndarray:
        x = np.column_stack((table, (dense - self.centre) / self.scale, np.ones(len(table))))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -35, 35)))


def _chosen(who: np.ndarray, words: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Up to ``WORDS`` words whose presence differs most between the classes, by chi-square, sorted.

    Words of a few documents are left out: a handful of copies would make each of their words telling.
    """
    keys, _, _, counts = B.unique_sorted(words)
    yes = np.add.reduceat(y[who][np.argsort(words, kind="stable")], np.concatenate(([0], np.cumsum(counts)[:-1]))) if len(keys) else np.zeros(0)
    n, positive = len(y), y.sum()
    expected = counts * positive / max(n, 1)
    spread = expected * (1 - positive / max(n, 1)) * (1 - counts / max(n, 1))
    enough = max(LEAST_DOCUMENTS, LEAST_SHARE * min(positive, n - positive))
    score = np.where((counts >= enough) & (spread > 0), (yes - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    best = np.lexsort((keys, -score))[:WORDS]
    return np.sort(keys[best[score[best] > LEAST_CHI_SQUARE]])


def _table(n: int, who: np.ndarray, words: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """One column per chosen word: 1 where the document has it."""
    out = np.zeros((n, len(chosen)))
    if len(chosen):
        at = np.minimum(np.searchsorted(chosen, words), len(chosen) - 1)
        hit = chosen[at] == words
        out[who[hit], at[hit]] = 1
    return out


def _fit(n: int, who: np.ndarray, words: np.ndarray, dense: np.ndarray, y: np.ndarray) -> Linear:
    chosen = _chosen(who, words, y)
    centre, scale = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6)
    x = np.column_stack((_table(n, who, words, chosen), (dense - centre) / scale, np.ones(n)))
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return Linear(chosen, centre, scale, w)


def _rows_of(rows: np.ndarray, who: np.ndarray, words: np.ndarray):
    place = np.full(int(who.max(initial=-1)) + 1 if len(who) else 0, -1)
    inside = rows[rows < len(place)]
    place[inside] = np.flatnonzero(rows < len(place))
    mine = place[who] >= 0
    return place[who][mine], words[mine]


def fit_chain(who: np.ndarray, words: np.ndarray, style: np.ndarray, labels: list[np.ndarray], folds: int = FOLDS) -> list[Linear]:
    """One model per category, in order."""
    n, dense, chain = len(style), style, []
    fold = np.arange(n) % folds
    for y in labels:
        chain.append(_fit(n, who, words, dense, y))
        held = np.zeros(n)
        for f in range(folds):
            rows, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if not len(rows) or not len(rest):
                held[rest] = chain[-1].probability(_table(n, who, words, chain[-1].words), dense)[rest]
                continue
            model = _fit(len(rows), *_rows_of(rows, who, words), dense[rows], y[rows])
            held[rest] = model.probability(_table(len(rest), *_rows_of(rest, who, words), model.words), dense[rest])
        dense = np.column_stack((dense, held))
    return chain


def train(docs: DataFrame, labels: DataFrame, categories: list, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> list[Linear]:
    """Fit the chain. ``categories``: (name, column of 0/1 over ``labels``) in order. Rows with a null label or id are left out; of several labels of one id the largest counts, of several texts that with the least hash."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[c.cast("double").alias(f"y{i}") for i, (_, c) in enumerate(categories)])
    known = known.dropna().groupBy("doc_id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))])
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    labelled = known.join(plain.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded, so it may be broadcast
    # of several texts of one id the one with the least hash, so a repeated task fits the same chain
    found = plain.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("first")).select("doc_id", "first.text")
    rows = found.mapInArrow(_sample_rows, "doc_id long, words binary, style binary").join(F.broadcast(chosen), "doc_id").toPandas()
    rows = rows.sort_values("doc_id", ignore_index=True)
    if not len(rows):
        return []
    each = [np.frombuffer(x, np.uint64) for x in rows["words"]]
    who = np.repeat(np.arange(len(rows)), [len(x) for x in each])
    style = np.array([np.frombuffer(x) for x in rows["style"]]).reshape(len(rows), len(STYLE))
    return fit_chain(who, np.concatenate(each), style, [rows[f"y{i}"].to_numpy() for i in range(len(categories))])


def _score(chain: list[Linear]):
    words_used = np.unique(np.concatenate([m.words for m in chain])) if chain else np.zeros(0, np.uint64)

    def run(batches):
        for batch in batches:
            at = 0
            for n, who, words, dense in _features(x.as_py() for x in batch.column(1)):
                place = np.searchsorted(words_used, words)
                hit = words_used[np.minimum(place, len(words_used) - 1)] == words if len(words_used) else np.zeros(len(words), bool)
                who, words = who[hit], words[hit]
                columns = []
                for model in chain:
                    columns.append(model.probability(_table(n, who, words, model.words), dense))
                    dense = np.column_stack((dense, columns[-1]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), *map(pa.array, columns)], names=["doc_id", *[f"p{i}" for i in range(len(chain))]])
                at += n

    return run


def toxicity(docs: DataFrame, labels: DataFrame, categories: list, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and a probability for each category, named as the category.

    Null and empty texts are scored as texts without words. Repeated rows and null ids stay. Without any labelled
    document there is no model and every probability is 0. Other columns are ignored.
    """
    return score(docs, train(docs, labels, categories, sample, doc_id, text), [name for name, _ in categories], doc_id, text)


def score(docs: DataFrame, chain: list[Linear], names: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and the probability of each category under a fitted chain."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    if not chain:
        return plain.select("doc_id", *[F.lit(0.0).alias(name) for name in names])
    scored = plain.mapInArrow(_score(chain), "doc_id long, " + ", ".join(f"p{i} double" for i in range(len(chain))))
    return scored.select("doc_id", *[F.col(f"p{i}").alias(name) for i, name in enumerate(names)])


def label_categories() -> list:
    """The chain over the given labels: low quality first, then toxic."""
    return [("p_low_quality", 1 - F.col("quality")), ("p_toxic", F.col("toxic"))]
