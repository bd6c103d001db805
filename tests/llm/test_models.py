"""SimHash groups, BPE, decontamination, toxicity, nearest neighbours and the pipeline against plain versions."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from flowloom.llm import bpe, toxicity as tox
from flowloom.llm.ann import nearest
from flowloom.llm.decontaminate import leaks
from flowloom.llm.queries import QUERIES
from flowloom.llm.simhash import connected, links, simhash_groups

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.StringType()),
                       T.StructField("item_id", T.LongType()), T.StructField("ids", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "f", 1, "x") for i, t in rows], SCHEMA)


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(ids, prints, radius=2):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        r = root(i)
        least[r] = x if least.get(r) is None else least[r] if x is None else min(x, least[r])
    return [least[root(i)] for i in range(len(ids))]


@pytest.mark.parametrize("tile", [2048, 3])
def test_simhash_groups(spark, tile):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(25):
        base = rng.choices(words, k=rng.randint(1, 400))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            if len(copy) > 20 and rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = "É" + rng.choice(words)
            rows.append((rng.randrange(10**6), " ".join(copy).title() if rng.random() < 0.3 else "\n".join(copy)))
    rows += [(7, None), (8, ""), (9, " \t"), (10, "two words"), (11, "TWO words"), (None, rows[0][1]), (None, None), (9, " \t")]
    got = simhash_groups(frame(spark, rows), tile=tile).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([i for i, _ in rows], prints)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=repr) == sorted(zip([i for i, _ in rows], prints, want), key=repr)


@pytest.mark.parametrize("tile", [2048, 4])
def test_links_find_every_pair(spark, tile):
    rng = random.Random(2)
    prints = {0, 1, 3, 2**64 - 1}
    for _ in range(60):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 5)):
            prints.add(p)
            for _ in range(rng.randint(1, 3)):
                p ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    edges = links(spark.createDataFrame([(x,) for x in signed], "fp long"), 2, tile)
    roots = {r.node: r.root for r in connected(edges).collect()}
    got = {}
    for x in signed:
        got.setdefault(roots.get(x, x), set()).add(x)
    want = {}
    for x, c in zip(signed, plain_components(signed, prints)):
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in connected(edges).collect()} == {0}


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(tokenizer):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={})


def test_every_token_encodes_to_itself(tokenizer):
    assert all(tokenizer.merged(token) == [rank] for token, rank in tokenizer.ranks.items())


def test_bpe_equals_library(tokenizer, library):
    rng = random.Random(1)
    for k in range(1500):
        text = "".join(rng.choice("abAB -_=0é日\n\t'" + "x" * (k % 30)) for _ in range(rng.randint(0, 400)))
        ids = tokenizer.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert tokenizer.spell(ids) == text.encode()


def test_tree_equals_plain_merges(tokenizer):
    rng = random.Random(3)
    tokens = list(tokenizer.tokens)
    for _ in range(800):
        piece = b"".join(tokenizer.tokens[rng.choice(tokens)] for _ in range(rng.randint(5, 60)))
        assert tokenizer.tree(piece) == tokenizer.merged_by_heap(piece)


def test_encode_texts(spark, library):
    rows = [(1, "Hello world <|endoftext|>"), (2, None), (3, ""), (3, "ab" * 4000), (None, "x\n\n  y")]
    got = bpe.encode_texts(frame(spark, rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert [(r.doc_id, r.ids, bytes(r.decoded)) for r in got] == [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert bpe.encode_texts(frame(spark, []), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect() == []


def least_edits(segment, text):
    """Fewest edits of the segment to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for a in segment:
        new = [row[0] + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.choice([12, 25, 40])))) for i in range(12)] + [(50, None), (51, ""), (52, "short"), (53, "exactly ten")]
    rows = []
    for i in range(60):
        body = " ".join(word() for _ in range(rng.randint(0, 60)))
        if i % 2:
            item = list(rng.choice(items[:12])[1])
            for _ in range(rng.choice([0, 0, 1, 3, 6, 20])):
                at = rng.randrange(len(item))
                item[at:at + 1] = rng.choice([[], ["z"], ["q", "r"]])
            body = body + "\n" + "".join(item).upper().replace("É", "é") + "  \n" + body
        rows.append((i, body))
    rows += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (None, items[1][1]), (103, "we say exactly ten times")]
    bench = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id long")
    got = leaks(frame(spark, rows), bench).collect()
    from flowloom.llm.decontaminate import Index, _codes, normal
    index = Index([(i, t) for i, t in sorted((x for x in items if x[1] is not None))], 8, 80, 0.08)
    want = set()
    for n, (i, t) in enumerate(rows):
        text = normal(_codes(t or ""))[0].tolist()
        for s, item, codes, e in zip(index.offset, index.items.to_pylist(), index.codes, index.edits):
            if least_edits(codes.tolist(), text) <= e:
                want.add((i, item, s))
    codes_of = {(item, s): codes for s, item, codes in zip(index.offset, index.items.to_pylist(), index.codes)}
    assert {(r.doc_id, r.item_id, r.segment) for r in got} == want
    assert len({r.item_id for r in got}) > 8 and any(r.edits for r in got)
    texts = dict(rows)
    for r in got:
        if r.doc_id is not None and not r.edits:
            found = normal(_codes(texts[r.doc_id][r.start:r.end]))[0]
            assert found.tolist() == codes_of[r.item_id, r.segment].tolist()
    blocks = leaks(frame(spark, rows), bench, block_bytes=500).collect()
    assert sorted(blocks, key=repr) == sorted(got, key=repr)
    nameless = leaks(frame(spark, rows), spark.createDataFrame([(None, items[0][1]), (None, items[0][1]), (3, items[3][1])], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.segment) for r in nameless} == {(d, None if i == 0 else i, s) for d, i, s in want if i in (0, 3)}
    assert len(nameless) == len({(r.doc_id, r.item_id, r.segment) for r in nameless}) + sum(r.doc_id == 102 for r in nameless) // 2
    assert leaks(frame(spark, []), bench).collect() == [] and leaks(frame(spark, rows), bench.limit(0)).collect() == []


def test_leaks_at_the_edges_of_texts(spark):
    """A match that lacks characters at either end belongs to the text it stands in, and none lies across two texts."""
    rng = random.Random(16)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(12))[:79] + "z"
    other = "nothing of that kind stands in here " * 3
    rows = [(1, other), (2, item[4:]), (3, other), (4, other + item[:40]), (5, item[40:] + other), (6, other), (7, other + item[:-4]), (8, other)]
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = leaks(frame(spark, rows).coalesce(1), bench).collect()
    assert sorted(r.doc_id for r in got) == [2, 7]
    texts = dict(rows)
    assert all(0 <= r.start < r.end <= len(texts[r.doc_id]) and r.edits == 4 for r in got)


def test_toxicity_on_held_out_documents(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    chain = tox.train(docs, labels.filter(part > 0), tox.label_categories())
    held = tox.score(docs, chain, ["low", "toxic_p"]).join(labels.filter(part == 0), "doc_id").toPandas()
    assert ((held.toxic_p >= 0.5) & (held.toxic == 0)).sum() == 0
    assert ((held.toxic_p >= 0.5) == (held.toxic == 1)).mean() > 0.97
    assert ((held.low >= 0.5) == (held.quality == 0)).mean() > 0.93


def test_toxicity_odd_rows(spark):
    rows = [(i, ("you idiot " if i % 3 == 0 else "good day ") + f"word{i % 7} and more") for i in range(90)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)] + [(None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    odd = [(200, None), (201, ""), (None, "you idiot"), (0, rows[0][1]), (202, "idiot " * 5000)]
    got = {(r.doc_id, i): r.p_toxic for i, r in enumerate(tox.toxicity(frame(spark, rows + odd), labels, tox.label_categories()).coalesce(1).collect())}
    assert len(got) == 95
    by_id = {i: p for (i, _), p in got.items()}
    assert by_id[202] > 0.5 and by_id[None] > 0.5 and by_id[200] == by_id[201] < 0.5 and by_id[1] < 0.5 < by_id[0]
    none = tox.toxicity(frame(spark, odd), labels.limit(0), tox.label_categories()).collect()
    assert [r.p_toxic for r in none] == [0.0] * 5
    assert tox.toxicity(frame(spark, []), labels, tox.label_categories()).collect() == []


def plain_nearest(rows, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    for q in (i for i in good if i % 20 == 0):
        others = sorted(((-(good[q] * v).sum(), i) for i, v in good.items() if i != q))[:k]
        yield from ((q, n + 1, i, -s) for n, (s, i) in enumerate(others))


@pytest.mark.parametrize("count", [15, 900])
def test_nearest(spark, count):
    rng = np.random.default_rng(count)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16) * rng.choice([0.5, 1, 3])]) for i in range(count)]
    rows += [(2000 + i, rows[3][1]) for i in range(60)]
    rows += [(3000, None), (3020, [0.0] * 16), (3040, [None] + [1.0] * 15), (3060, [float("nan")] * 16), (3080, [float("inf")] + [1.0] * 15), (None, rows[1][1])]
    vectors = spark.createDataFrame([(i, v, 1, "b") for i, v in rows], "vec_id long, embedding array<float>, rank int, b string")
    got = nearest(vectors, vectors.filter("vec_id % 20 = 0"), index_rows=250, query_rows=30, leaf=16).collect()
    want = list(plain_nearest(rows, 20))
    mine = {(r.query_id, r.vec_id) for r in got}
    recall = len(mine & {(q, i) for q, _, i, _ in want}) / len(want)
    assert recall >= 0.97 and len(got) == len(want)
    assert sorted((r.query_id, r["rank"]) for r in got) == sorted(x[:2] for x in want)
    assert nearest(vectors.limit(0), vectors, index_rows=250).collect() == []


def test_nearest_within_one_length(spark):
    """Vectors of two lengths in one table: each query meets those of its own length."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6 if i % 3 else 4)]) for i in range(120)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=5).collect())
    want = [x[:3] for d in (4, 6) for x in plain_nearest([r for r in rows if len(r[1]) == d], 5)]
    assert got == sorted(want) and nearest(vectors.filter("vec_id = 1"), vectors.filter("vec_id = 0"), k=5).collect() == []


def test_nearest_recall_on_given_vectors(spark):
    got = {(r.query_id, r.vec_id) for r in QUERIES["op4_nearest"](spark, "/root/testdata/sf0.1").collect()}
    pdf = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, x = pdf.vec_id.to_numpy(), np.stack(pdf.embedding).astype(float)
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        hits += [(ids[q], i) in got for i in ids[np.lexsort((ids, -s))[:20]]]
    assert np.mean(hits) >= 0.9


def test_one_document_of_each_group(spark):
    """Null ids come last in their group, texts of one id are apart, repeated rows stay once."""
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(30)) for w in "abcd")
    rows = [(5, a, "en", "s", 1), (3, a, "en", "s", 1), (5, b, "en", "s", 1), (7, c, "en", "z", 1), (7, c, "en", "s", 2), (7, c, "en", "s", 1), (None, a, "en", "s", 1), (None, d, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.simhash_stage(spark, docs, SMALL)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} == {rows[1], rows[2], rows[5], rows[7]} and got.count() == 4
    assert corpus_pipeline.simhash_stage(spark, docs.limit(0), SMALL).count() == 0


def test_pipeline_stages(spark):
    """Each stage against a plain version of its rule on its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "null id", "en", "s", 7)], docs.schema)
    docs = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        before, after = docs.toPandas(), out.toPandas()
        if name != "byte-level BPE":
            assert out.columns == columns
        ids = set(after.doc_id.dropna())
        if name == "toxicity":
            p = tox.toxicity(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), tox.label_categories()).toPandas()
            assert ids == set(p[p.p_toxic < 0.5].doc_id.dropna())
        elif name == "line dedup":
            from test_passages import plain_passages
            want = sorted(((i, t) for i, t, _ in plain_passages([(None if i != i else int(i), t) for i, t in zip(before.doc_id, before.text)])), key=repr)
            assert sorted(((None if i != i else int(i), t) for i, t in zip(after.doc_id, after.text)), key=repr) == want
        elif name == "simhash near-dedup":
            known = before[before.doc_id.notna()]
            want = plain_components(list(known.doc_id), [plain_fingerprint(t) for t in known.text])
            assert ids == set(want)
        elif name == "benchmark decontamination":
            found = {r.doc_id for r in leaks(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
            assert found and ids == set(before.doc_id.dropna()) - found
        else:
            assert list(after.n_tokens > 0) == [bool(t) for t in before.text]
        assert not name.startswith(("line", "byte")) or len(before) == len(after)
        docs = spark.createDataFrame([tuple(r) for r in out.collect()], out.schema)
    assert corpus_pipeline.run(spark, SMALL).count() > 50
