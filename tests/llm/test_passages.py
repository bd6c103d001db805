"""Repeated passages of lines against every pair of places."""

import random

import pytest
import xxhash
from test_native import frame

from flowloom.llm.line_dedup import passage_dedup


def plain_windows(text):
    lines = text.split("\n")
    full = [n for n, x in enumerate(lines) if x.strip(" \t\r\x0b\f")]
    return [(a, b, lines[a:b + 1]) for a, b in zip(full, full[1:])]


def plain_passages(rows):
    """(id, text, lines removed): two lines go if an equal pair stands earlier and shares no line with them."""
    mark = lambda t: (lambda v: v - (1 << 64) if v >> 63 else v)(xxhash.xxh64_intdigest(t.encode(), 42))
    rank = lambda i, t: (i is not None, i or 0, mark(t))
    windows = [(rank(i, t), a, b, body) for i, t in {r for r in rows if r[1] is not None} for a, b, body in plain_windows(t)]
    for i, t in rows:
        if t is None:
            yield i, None, []
            continue
        gone, me = set(), rank(i, t)
        for a, b, body in plain_windows(t):
            first = min(w[:3] for w in windows if w[3] == body)
            if first[:2] < (me, a) and not (first[0] == me and first[2] >= a):
                gone.update(range(a, b + 1))
        yield i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone), sorted(gone)


@pytest.mark.parametrize("broadcast", ["50000000", "0"])
def test_passages_at_any_place(spark, broadcast):
    rng = random.Random(11)
    lines = [f"line {i}" for i in range(40)] + ["", "", " ", "\t", "\r", "日本"]
    blocks = [[rng.choice(lines) for _ in range(rng.randint(2, 7))] for _ in range(12)]
    rows = []
    for i in range(50):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += rng.choice(blocks) if rng.random() < 0.5 else [rng.choice(["", f"own {i} {rng.random()}"]) for _ in range(rng.randint(1, 4))]
        rows.append((i, "\n".join(text)))
    rows += [(500, None), (501, ""), (502, "one line"), (3, rows[3][1]), (3, rows[3][1]), (3, rows[5][1]), (None, rows[4][1]), (None, rows[6][1]), (504, "\n\n\n\n"),
             (505, "x\nx\nx"), (506, "y\ny\ny\ny"), (507, "z\nz\nz\nz\nz"), (508, "p\nq\np\nq\np"), (509, "\n\nline 1\n\n\nline 2\n\n")]
    spark.conf.set("flowloom.broadcast.maxBytes", broadcast)
    try:
        got = passage_dedup(frame(spark, rows)).collect()
    finally:
        spark.conf.unset("flowloom.broadcast.maxBytes")
    mine = sorted(((r.doc_id, r.text, [n for x in r.removed_chunks for n in range(x["first"], x["last"] + 1)]) for r in got), key=repr)
    assert mine == sorted(plain_passages(rows), key=repr)
    texts = {r.doc_id: r.text for r in got}
    assert (texts[505], texts[506], texts[507], texts[508]) == ("x\nx\nx", "y\ny", "z\nz", "p\nq")
    assert all(r.row == 5 and r.key == "k" and r.parts == "p" for r in got)
    kept = {x for r in got for x in (r.text or "").split("\n")}
    assert kept >= {x for _, t in rows for x in (t or "").split("\n") if x.strip()}


def test_two_lines_between_other_lines(spark):
    """Passages of two lines, each time between other lines: a rule over chunks loses most of them."""
    rows = [(i, f"before {i}\nfirst of {i % 20}\nsecond of {i % 20}\nafter {i}") for i in range(60)]
    got = {r.doc_id: r.text for r in passage_dedup(frame(spark, rows)).collect()}
    assert got == {i: t if i < 20 else f"before {i}\nafter {i}" for i, t in rows}
    assert passage_dedup(frame(spark, [])).collect() == []


def test_query_and_stage_remove_whole_passages(spark, tmp_path):
    import corpus_pipeline
    from flowloom.llm.queries import QUERIES

    rows = [(i, f"before {i}\nfirst of {i % 20}\nsecond of {i % 20}\nafter {i}", "en", "s", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_removed_lines for r in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()} == {i: 0 if i < 20 else 2 for i in range(60)}
    assert {r.doc_id: r.text.count("\n") for r in corpus_pipeline.line_dedup_stage(spark, docs, "").collect()} == {i: 3 if i < 20 else 1 for i in range(60)}
