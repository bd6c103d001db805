"""Substring dedup, repeated bytes and language-model scores against plain Python on small tables."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from flowloom.llm.lm_scoring import lm_scores
from flowloom.llm.pfp_dedup import repeated_bytes
from flowloom.llm.substring_dedup import substring_dedup

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("chunk", T.StringType()), T.StructField("bucket", T.IntegerType())])


def frame(spark, rows):
    """Documents with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "x", 3) for i, t in rows], SCHEMA)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [rng.choice(["a", "bé", "cc", "日本", "x", "yy", "longer"]) + str(rng.randint(0, 40)) for _ in range(200)]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(1, 40))))
        rows.append((i * 7, rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(1000, None), (1001, ""), (1002, "  \n"), (1003, "aa" * 300), (1004, "aa" * 300), (1005, rows[5][1]), (1006, "b" * 900)]
    rows += [(1007, " ".join(rng.choices(words, k=4000))), (None, rows[8][1]), (None, None)]
    return rows


def removed_words(rows, size):
    least = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[p:p + size])
                least[key] = min(least.get(key, i), i)
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - size + 1):
            if least.get(tuple(w[p:p + size]), math.inf) < (math.inf if i is None else i):
                gone.update(range(p, p + size))
        yield i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(spark, seed):
    rows = corpus(seed)
    got = substring_dedup(frame(spark, rows), window=13, chunk_bytes=2000, bucket_bytes=5000).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in got), key=repr) == sorted(removed_words(rows, 13), key=repr)
    assert all(sum(f.words for f in r.factors) == r.n_removed for r in got)


def removed_bytes(rows, size):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[p:p + size] for p in range(len(b) - size + 1))
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - size + 1):
            if seen[b[p:p + size]] > 1:
                gone[p:p + size] = [True] * size
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        yield i, len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g), spans


@pytest.mark.parametrize("seed,shape", [(3, (40, 4, 4, 12)), (4, (60, 8, 16, 20)), (5, (400, 16, 32, 128)), (6, (30, 2, 2, 3))])
def test_repeated_bytes(spark, seed, shape):
    rows = corpus(seed)
    got = repeated_bytes(frame(spark, rows), *shape, chunk_bytes=2000, bucket_bytes=5000).collect()
    mine = sorted(((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept), len(r.spans)) for r in got), key=repr)
    assert mine == sorted(removed_bytes(rows, shape[0]), key=repr)


def scores(rows):
    texts = [(t or "").encode().split() for _, t in rows]
    grams = [[Counter(tuple(w[p:p + n]) for p in range(len(w) - n + 1)) for n in (1, 2, 3)] for w in texts]
    total = [sum((g[n] for g in grams), Counter()) for n in range(3)]
    for (i, _), w, own in zip(rows, texts, grams):
        c = lambda *x: total[len(x) - 1][x] - own[len(x) - 1][x]
        rest = sum(map(len, texts)) - len(w)
        s = 0.0
        for p, x in enumerate(w):
            v, context = 1.0, w[max(0, p - 2):p]
            while context and not c(*context, x):
                v, context = v * 0.4, context[1:]
            if context:
                v *= c(*context, x) / c(*context)
            else:
                v *= c(x) / rest if c(x) else 1 / (rest + 1)
            s += math.log(v)
        yield i, len(w), s


def test_lm_scores(spark):
    rows = corpus(9)
    got = sorted(((r.doc_id, r.n_tokens, r.log_score) for r in lm_scores(frame(spark, rows), chunk_bytes=2000, bucket_bytes=3000).collect()), key=repr)
    want = sorted(scores(rows), key=repr)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(math.isclose(a[2], b[2], rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got, want))


@pytest.mark.parametrize("operator", [substring_dedup, repeated_bytes, lm_scores])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).collect() == []


@pytest.mark.parametrize("operator", [substring_dedup, repeated_bytes, lm_scores])
def test_only_null_texts(spark, operator):
    assert operator(frame(spark, [(1, None), (1, None), (None, "")])).count() == 3


