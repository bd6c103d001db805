"""MinHash near-dedup against all pairs of full shingle sets."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from flowloom.llm import textbytes as B
from flowloom.llm.minhash import near_duplicates, one_permutation, probing_order, star_edges
from flowloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("node", T.LongType()),
                       T.StructField("n", T.StringType()), T.StructField("row", T.StringType()), T.StructField("cluster", T.StringType())])


def plain_set(text, size=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def plain_groups(rows, percent=85):
    """(doc_id, set size, smallest id reachable); null ids are larger than any."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b) and find(i) != find(j):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[find(i)].append(doc)
    smallest = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return sorted(((doc, len(s), smallest[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=repr)


def chained(rng, count, words=80):
    """Texts that drift from one to the next, so that links form chains and many pairs lie close to the bound."""
    text, out = [rng.choice("abcdefgh") + str(rng.randint(0, 999)) for _ in range(words)], []
    for _ in range(count):
        text = list(text)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(words)] = "z" + str(rng.randint(0, 10**6))
        out.append(" ".join(text))
    return out


def odd_rows():
    rng = random.Random(13)
    texts = [t for _ in range(6) for t in chained(rng, 25)] + chained(rng, 12, 5) + [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows = list(enumerate(rng.sample(texts, len(texts))))
    long = " ".join(f"v{i}" for i in range(30_000))
    return rows + [(900, None), (901, ""), (902, " \n\t"), (903, "One"), (904, "one"), (905, "one two"), (906, "ONE\x0btwo"), (907, "É a b c"), (908, "é a b c"),
                   (910, long), (911, long + " end"), (700, rows[3][1]), (700, rows[3][1]), (700, rows[60][1]), (None, rows[5][1]), (None, "only here in all rows"), (None, None)]


@pytest.mark.parametrize("documents", [512, 7])
def test_groups(spark, documents):
    """Whole clusters in a tile, and clusters cut into tiles of a few documents."""
    rows = odd_rows()
    docs = spark.createDataFrame([(i, t, 1, "n", "r", "c") for i, t in rows], SCHEMA)
    got = near_duplicates(docs, documents=documents)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_groups(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(docs).collect() == []
    assert [tuple(r) for r in near_duplicates(spark.createDataFrame([(1, None, 1, "n", "r", "c")], SCHEMA)).collect()] == [(1, 0, 1)]


def test_lookups_both_ways(spark, join_path):
    rows = odd_rows()[:60]
    docs = spark.createDataFrame([(i, t, 1, "n", "r", "c") for i, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in near_duplicates(docs).collect()), key=repr) == plain_groups(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain_groups([(r.doc_id, r.text) for r in docs.collect()])
    got = QUERIES["op13_minhash"](spark, SMALL).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and not all(r.kept for r in got)


def test_densified_bins_agree_as_often_as_sets(spark):
    """Sets much smaller than the number of bins: the share of equal bins is close to the similarity."""
    rng = np.random.default_rng(3)
    order = probing_order(288)
    shares = []
    for _ in range(300):
        a = rng.integers(1, 2**63, 20, dtype=np.uint64)
        b = np.concatenate((a[:16], rng.integers(1, 2**63, 4, dtype=np.uint64)))
        pair = [np.sort(B.mix(x)) for x in (a, b)]
        sketch = one_permutation(np.repeat([0, 1], 20), np.concatenate(pair), 2, order)
        shares.append((sketch[0] == sketch[1]).mean())
    assert abs(np.mean(shares) - 16 / 24) < 0.02


def test_star_edges_are_fewer_than_members(spark):
    members = spark.createDataFrame([(7, n) for n in range(200)] + [(8, 5), (9, 1), (9, 2)], "bucket long, node long")
    assert sorted(tuple(r) for r in star_edges(members).collect()) == sorted([(n, 0) for n in range(1, 200)] + [(2, 1)])
