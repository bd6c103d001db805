"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from flowloom.llm.queries import QUERIES
from flowloom.llm.spelling import corpus_words, spelling_variants

SMALL = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(rows, least=7, often=2):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= often}


def edited(word):
    """All words that lack one code point of ``word`` or have it masked: two words near each other share one of these or are one."""
    return {word[:i] + word[i + 1:] for i in range(len(word))}, {word[:i] + "\0" + word[i + 1:] for i in range(len(word))}


def plain_variants(n, ratio=10):
    masked, shorter = {}, {}
    for w in n:
        less, mask = edited(w)
        for m in mask:
            masked.setdefault(m, set()).add(w)
        for s in less & n.keys():
            shorter.setdefault(w, set()).add(s)
            shorter.setdefault(s, set()).add(w)
    near = {w: set().union(*(masked[m] for m in edited(w)[1]), shorter.get(w, set())) - {w} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), None if form[w] is None else n[form[w]]) for w in n), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", "b", 1) for i, t in rows], "doc_id long, text string, word string, block string, n int")


def test_corpus_words(spark):
    rng = random.Random(1)
    words = ["Straßen", "naïvely", "ÀÉÎÕÜÿé", "letters", "LETTERSS", "tiny", "x1letterz2lettersy", "×÷×÷×÷×", "日本letters語"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice([" ", ",", "\n", "-", ""]) for _ in range(rng.randint(0, 200)))) for i in range(120)]
    rows += [(900, None), (901, ""), (902, "Straßen " * 20_000), (3, rows[3][1]), (None, rows[4][1]), (None, "letters")]
    got = {r.word: r.n for r in corpus_words(frame(spark, rows)).collect()}
    assert got == plain_words(rows)
    assert corpus_words(frame(spark, [])).collect() == [] and any(len(w) == 7 and w not in rows[0][1] for w in got)


@pytest.mark.parametrize("segments,tile", [(3, 1024), (2, 5), (3, 2), (4, 1024)])
def test_variants(spark, segments, tile):
    """Few letters, so that most words are near many others, in whole blocks and cut into tiles."""
    rng = random.Random(segments * tile)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))): rng.choice([1, 2, 3, 20, 30, 200, 3000, 10**6]) for _ in range(300)}
    words |= {"日本語": 5, "日本": 50, "日x語": 500, "l" * 3000: 2, "l" * 3001: 40}
    rows = [(w, n, "k") for w, n in words.items()]
    got = spelling_variants(spark.createDataFrame(rows, "word string, n long, block string"), segments=segments, tile=tile)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_variants(words)


def test_odd_words(spark):
    rows = [("letter", 3), ("letter", 4), ("lettre", 1), ("lette", 70), (None, 5), ("x", None), ("", 9)]
    got = spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_variants({"letter": 7, "lettre": 1, "lette": 70})
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = plain_variants(plain_words([(r.doc_id, r.text) for r in docs]))
    got = QUERIES["op12_spelling"](spark, SMALL).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert any(r.form for r in got) and any(r.n_near > 1 for r in got)
