import random

import numpy as np
import pytest
from flowloom.operators import clustering as cl
from flowloom.operators import matrix as mx


def graph(rng, sites, count):
    pairs = {(f"S{rng.randrange(sites):02d}", f"S{rng.randrange(sites):02d}") for _ in range(count)}
    return [(a, b, float(rng.randrange(1, 60))) for a, b in sorted(pairs)]


def frame(spark, edges):
    return spark.createDataFrame(edges, f"{mx.SRC} string, {mx.DST} string, {mx.TRAFFIC} double")


def loop_shrink(edges, limit):
    """The step-by-step reduction: drop the last site until rows, columns and the label column fit."""
    total = {}
    for a, b, w in edges:
        total[a] = total.get(a, 0) + w
        total[b] = total.get(b, 0) + w
    order = sorted(total, key=lambda s: (-total[s], s))
    sources, dests = {a for a, _, _ in edges}, {b for _, b, _ in edges}
    if len(sources) + len(dests) + 1 <= limit:
        return set(sources | dests)
    keep = limit
    while True:
        top = set(order[:keep])
        if len(sources & top) + len(dests & top) + 1 <= limit:
            return top
        keep -= 1


@pytest.mark.parametrize("seed", range(8))
def test_shrink_matrix_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    edges, limit = graph(rng, rng.choice([4, 9, 25]), rng.choice([5, 30, 90])), rng.choice([4, 9, 16, 60])
    kept = loop_shrink(edges, limit)
    found = {tuple(r) for r in mx.shrink_matrix(frame(spark, edges), limit).select(mx.SRC, mx.DST, mx.TRAFFIC).collect()}
    assert found == {e for e in edges if e[0] in kept and e[1] in kept}


def loop_edges(edges, limit):
    ranked = sorted(edges, key=lambda e: (-e[2], e[0], e[1]))[: 10 * limit]
    n = len(ranked)
    while n and len({s for e in ranked[:n] for s in e[:2]}) > limit:
        smaller = round(n - n / 10)
        n = smaller if smaller < n else n - 1
    return set(ranked[:n])


@pytest.mark.parametrize("seed", range(6))
def test_shrink_edges_equals_the_loop(spark, seed):
    rng = random.Random(100 + seed)
    edges, limit = graph(rng, 25, rng.choice([6, 40, 120])), rng.choice([1, 3, 8, 30])
    df = frame(spark, edges).toDF("source", "destination", "traffic")
    assert {tuple(r) for r in mx.shrink_edges(df, limit).collect()} == loop_edges(edges, limit)


def test_disjoint_edges_come_to_an_end(spark):
    df = spark.createDataFrame([(f"a{i}", f"b{i}", 5.0) for i in range(5)], "source string, destination string, traffic double")
    assert mx.shrink_edges(df, 3).count() == 1


def test_rescale_rounds_half_to_even(spark, rows):
    df, unit = mx.rescale(frame(spark, [("a", "b", 2_500_000_000.0), ("b", "a", 500.0), ("a", "a", 1500.0)]))
    assert unit == 6 and rows(df.select(mx.TRAFFIC)) == [(0.0,), (0.0,), (2500.0,)]
    assert mx.rescale(frame(spark, [("a", "b", 999_999.0)]))[1] == 0


def test_spread_gather_and_symmetry(spark, rows):
    edges = frame(spark, [("a", "b", 2.0), ("b", "a", 3.0), ("a", "a", 7.0), ("c", "b", 1.0)])
    wide = mx.spread(edges, 10)
    assert sorted(wide.columns) == [mx.SRC, "a", "b"]
    assert rows(mx.gather(wide).filter(f"{mx.TRAFFIC} <> 0").select(mx.SRC, mx.DST, mx.TRAFFIC)) == rows(edges)
    assert rows(mx.symmetrize(edges)) == [("a", "a", 7.0), ("a", "b", 5.0), ("b", "a", 5.0), ("b", "c", 1.0), ("c", "b", 1.0)]
    with pytest.raises(ValueError):
        mx.spread(edges, 1)


def brute_mcl(edges, inflation=1.5, expansion=4):
    sites = sorted({s for e in edges for s in e[:2]})
    index = {s: i for i, s in enumerate(sites)}
    m = np.zeros((len(sites), len(sites)))
    for a, b, w in edges:
        m[index[a], index[b]] += w
        if a != b:
            m[index[b], index[a]] += w
    m /= m.sum(axis=0)
    for _ in range(100):
        after = np.linalg.matrix_power(m, expansion) ** inflation
        after /= after.sum(axis=0)
        if np.abs(after - m).max() < 1e-9:
            break
        m = after
    owner = {s: int(np.nonzero(m[:, index[s]] > 1e-4)[0][0]) for s in sites}
    return {frozenset(s for s in sites if owner[s] == o) for o in set(owner.values())}


def test_markov_clusters_equal_brute_force(spark):
    edges = [("a", "b", 9.0), ("b", "c", 8.0), ("a", "c", 9.5), ("a", "a", 9.0), ("b", "b", 9.0), ("c", "c", 9.0),
             ("x", "y", 7.0), ("y", "z", 6.0), ("x", "z", 6.5), ("x", "x", 5.0), ("y", "y", 5.0), ("z", "z", 5.0), ("c", "x", 0.2),
             ("solo", "solo", 4.0)]
    found = {}
    for site, cluster in cl.markov_clusters(frame(spark, edges)).collect():
        found.setdefault(cluster, set()).add(site)
    expected = brute_mcl(edges)
    assert {frozenset(v) for v in found.values()} == expected
    assert found[999] == {"solo"} and set(found) == {1, 2, 999}


def test_kmeans_separates_groups(spark):
    edges = [("a", "b", 100.0), ("b", "a", 100.0), ("a", "a", 100.0), ("b", "b", 100.0), ("x", "y", 900.0), ("x", "x", 900.0), ("y", "y", 900.0)]
    found = dict(cl.kmeans_clusters(frame(spark, edges), 2).collect())
    assert found["a"] == found["b"] != found["x"] == found["y"] and set(found.values()) == {1, 2}


def test_large_graphs_are_refused(spark, monkeypatch):
    with pytest.raises(ValueError):
        cl.markov_clusters(frame(spark, [("a", "b", 1.0), ("b", "c", 1.0)]), max_nodes=2)


def test_markov_clusters_of_many_sites(spark):
    """More sites than a column may have entries: planted groups are found, and no column of the matrix is longer than the bound."""
    groups, size = 60, 6
    inner = [(f"g{g:03}s{a}", f"g{g:03}s{b}", 10.0) for g in range(groups) for a in range(size) for b in range(size) if a < b]
    outer = [(f"g{g:03}s0", f"g{(g + 1) % groups:03}s0", 0.05) for g in range(groups)]
    edges = spark.createDataFrame(inner + outer, [mx.SRC, mx.DST, mx.TRAFFIC])
    found = {r.Site: r.Cluster for r in cl.markov_clusters(edges, entries=25).collect()}
    assert len(found) == groups * size and len(set(found.values())) == groups
    assert all(found[f"g{g:03}s{a}"] == found[f"g{g:03}s0"] for g in range(groups) for a in range(size))
    cells = spark.createDataFrame([(str(i), str(j), float(i)) for i in range(40) for j in range(3)], "i string, j string, w double")
    product = cl._power(cells, 2, 7)
    assert {r.n for r in product.groupBy("j").count().withColumnRenamed("count", "n").collect()} == {7}
