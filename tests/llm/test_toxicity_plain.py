"""The classifier chain against a plain version: sets of words, numbers per text, and a convex problem solved on its own."""

import math
import random
import re

import numpy as np

from flowloom.llm import toxicity as tox

ORDER = ("p_first", "p_second")


def plain_text(text):
    """Distinct words and the measures of style of one text; every text counts one byte more, for its end."""
    raw = (text or "").encode()
    words = [w.lower() for w in re.findall(rb"[A-Za-z\x80-\xff]+", raw)]
    size = len(raw) + 1
    kinds = [sum(bool(re.fullmatch(p, bytes([b]))) for b in raw) / size for p in (rb"[A-Za-z\x80-\xff]", rb"[A-Z]", rb"[0-9]", rb"[!-/:-@\[-`{-~]")]
    return set(words), [math.log1p(len(words)), *kinds]


class Plain:
    """Ridge logistic regression over the words with the largest chi-square, scaled measures, and a constant."""

    def __init__(self, sets, dense, y):
        n, positive = len(y), sum(y)
        scores = {}
        for w in set().union(*sets):
            count = sum(w in s for s in sets)
            yes = sum(yy for s, yy in zip(sets, y) if w in s)
            expected = count * positive / n
            spread = expected * (1 - positive / n) * (1 - count / n)
            if count >= max(tox.LEAST_DOCUMENTS, tox.LEAST_SHARE * min(positive, n - positive)) and spread > 0:
                scores[w] = (yes - expected) ** 2 / spread
        self.words = sorted(w for w, s in scores.items() if s > tox.LEAST_CHI_SQUARE)
        assert len(self.words) <= tox.WORDS
        dense = np.array(dense)
        self.centre, self.scale = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6)
        x, y = self.table(sets, dense), np.array(y, float)
        ridge = np.full(x.shape[1], tox.RIDGE)
        ridge[-1] = 1e-6
        self.w = np.zeros(x.shape[1])

        def loss(w):
            z = x @ w
            return (np.logaddexp(0, z) - y * z).sum() + (ridge * w * w).sum() / 2

        for _ in range(200):  # damped steps until the gradient vanishes
            p = 1 / (1 + np.exp(-x @ self.w))
            gradient = x.T @ (p - y) + ridge * self.w
            if np.abs(gradient).max() < 1e-10:
                break
            step, size = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient), 1.0
            while loss(self.w - size * step) > loss(self.w) and size > 1e-6:
                size /= 2
            self.w = self.w - size * step

    def table(self, sets, dense):
        return np.column_stack((np.array([[w in s for w in self.words] for s in sets], float).reshape(len(sets), len(self.words)), (np.array(dense) - self.centre) / self.scale, np.ones(len(sets))))

    def probability(self, sets, dense):
        return 1 / (1 + np.exp(-self.table(sets, dense) @ self.w))


def plain_chain(texts, labels, folds=5):
    sets, dense = map(list, zip(*[plain_text(t) for t in texts]))
    chain, n = [], len(texts)
    for y in labels:
        chain.append(Plain(sets, dense, y))
        held = np.zeros(n)
        for f in range(folds):
            rest, rows = [i for i in range(n) if i % folds == f], [i for i in range(n) if i % folds != f]
            model = Plain([sets[i] for i in rows], [dense[i] for i in rows], [y[i] for i in rows])
            held[rest] = model.probability([sets[i] for i in rest], [dense[i] for i in rest])
        dense = [[*d, h] for d, h in zip(dense, held)]
    return chain


def plain_scores(chain, text):
    words, dense = plain_text(text)
    out = []
    for model in chain:
        out.append(float(model.probability([words], [dense])[0]))
        dense = [*dense, out[-1]]
    return out


def test_chain(spark):
    rng = random.Random(5)
    plain, bad, worse = ["river", "Stone", "été", "walk", "green", "table", "42", "x!"], ["vile", "foul"], ["rotten", "Grim"]
    rows, labels = [], []
    for i in range(300):
        first, second = rng.random() < 0.4, rng.random() < 0.3
        pool = plain + bad * (2 if first else 0) + worse * (3 if second else 0) + (bad if rng.random() < 0.05 else [])
        rows.append((i, " ".join(rng.choices(pool, k=rng.randint(4, 30)))))
        labels.append((i, int(first), int(second or (first and rng.random() < 0.2))))
    rows += [(1000, None), (1001, ""), (1002, "vile rotten " * 50), (None, "foul grim words"), (3, "another text of a known id")]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, words int, style string")
    known = spark.createDataFrame(labels, "doc_id long, a int, b int")
    from pyspark.sql import functions as F
    categories = [("p_first", F.col("a")), ("p_second", F.col("b"))]
    # of two texts of one id the one with the least hash is learnt from
    first_of_3 = docs.filter("doc_id = 3").orderBy(F.xxhash64(F.col("text").cast("binary"))).first().text
    texts = [first_of_3 if i == 3 else t for i, t in rows[:300]]
    chain = plain_chain(texts, [[r[1] for r in labels], [r[2] for r in labels]])
    assert len(chain[0].words) > 1 and len(chain[1].words) > 1
    got = tox.toxicity(docs, known, categories).collect()
    want = sorted(((i, plain_scores(chain, t)) for i, t in rows), key=repr)
    mine = sorted(((r.doc_id, [r[name] for name in ORDER]) for r in got), key=repr)
    assert len(mine) == len(want)
    by_id = lambda found: sorted(((i is None, i or 0, *p) for i, p in found))
    for a, b in zip(by_id(mine), by_id(want)):
        assert a[:2] == b[:2] and np.allclose(a[2:], b[2:], atol=2e-5)
