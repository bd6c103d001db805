"""Secret scan and line dedup against plain Python."""

import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import types as T

from flowloom.llm.line_dedup import line_dedup
from flowloom.llm.secret_scan import digest, secret_scan

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("row", T.LongType()),
                       T.StructField("key", T.StringType()), T.StructField("parts", T.StringType()), T.StructField("removed_chunks", T.StringType())])


def frame(spark, rows):
    """Documents with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, 5, "k", "p", "r") for i, t in rows], SCHEMA)


ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
BETWEEN = r"""["']?\x20*[:=]\x20*["']?"""
PATTERNS = [ASSIGN, re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+"),
            re.compile(r"(?ai:\b(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|user(?:name)?|login|account(?:[_-]?id)?))" + BETWEEN + "[A-Za-z0-9@._+-]{3,}"),
            re.compile(r"(?<![A-Za-z0-9+/=])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
                       r"|(?ai:\b(?:pwd|passphrase|private[_-]?key|credential))" + BETWEEN + "[A-Za-z0-9+/_.=-]{6,}"),
            re.compile(r"""(?ai:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|ftp|s3)://[^\s"'<>]+|(?ai:\b(?:host(?:name)?|endpoint|server))""" + BETWEEN + "[A-Za-z0-9.-]{4,}")]
NAMES = ["assign", "access", "hex", "ident", "key", "url"]
NEEDED = {3: (0, 2, 4), 4: (1, 3, 5), 5: (0, 2, 4)}


def plain_spans(text):
    text = text or ""
    breaks = [m.start() for m in re.finditer("\n[ \t\r]*\n", text)]
    spans = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            if (kind == 0 and len(m[2]) < 6) or (kind == 1 and len(m[0]) < 20) or (kind == 2 and len(m[0]) < 24):
                continue
            spans.append((m.start(), kind, m.end(), sum(b < m.start() or (b == m.start()) for b in breaks)))
    firm = [s for s in spans if s[1] < 3]
    free = [s for s in spans if s[1] >= 3 and not any(f[0] < s[2] and f[2] > s[0] for f in firm)]
    near = [s for s in free if any(o[1] in NEEDED[s[1]] and o[3] == s[3] and o[0] <= s[2] + 200 and o[2] >= s[0] - 200 for o in firm + free)]
    return sorted(s[:3] for s in firm + near)


def secret_rows():
    rng = random.Random(4)
    pieces = ['token = "abcdef12"', "secret=token:abcdef", "SECRET: ab", "api_key='x.y-z/9=='", "AKIA" + "Q" * 16, "AKIAQ AKIA" + "Z" * 30, "0123456789abcdef" * 2, "deadbeef",
              "user=alice", "client_id: 77-aa", "Ab1" + "xY9/" * 9 + "z", "pwd = hunter22", "https://example.org/a?b=c", "host: db.internal", "ſecret=abcdefg", "日本 ué", "\n\n", "\n \t\n", "x" * 90, "word " * 50]
    rows = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randint(1, 30)))) for i in range(150)]
    return rows + [(900, None), (901, ""), (902, " ".join(pieces * 200)), (5, rows[5][1]), (5, rows[5][1]), (None, rows[7][1]), (None, None)]


def test_secret_scan(spark):
    rows = secret_rows()
    got = secret_scan(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=repr) == sorted(((i, [s for s in plain_spans(t)]) for i, t in rows), key=repr)
    assert any(r.n_linked for r in got) and any(r.n_assign and not r.n_linked for r in got)
    text = {r.doc_id: r for r in digest(secret_scan(frame(spark, [(1, 'token = "abcdef12"')]))).collect()}[1]
    assert text.spans == "assign:0:17" and text.n_assign == 1


def plain_chunks(text, mean=3):
    lines = (text or "").split("\n")
    if len(lines) < 2:
        return []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    first, out = 0, []
    for i in range(len(lines)):
        seed = 42
        for k in (i - 1, i):
            if k >= 0:  # a null is passed over
                seed = xxhash.xxh64_intdigest(struct.pack("<Q", h[k]), seed)
        signed = seed - (1 << 64) if seed >> 63 else seed
        if i == len(lines) - 1 or signed % mean == 0:
            out.append((first, i, "\n".join(lines[first:i + 1])))
            first = i + 1
    return [c for c in out if sum(bool(x.strip(" ")) for x in c[2].split("\n")) >= 2]


def plain_dedup(rows):
    places = {}
    mark = lambda t: (lambda v: v - (1 << 64) if v >> 63 else v)(xxhash.xxh64_intdigest(t.encode(), 42))
    rank = lambda i, t: (i is not None, i or 0, mark(t))
    for i, t in rows:
        if t is not None:
            for a, _, body in plain_chunks(t):
                places[body] = min(places.get(body, ((True, 1 << 62, 0), 0)), (rank(i, t), a))
    for i, t in rows:
        if t is None:
            yield i, None, []
            continue
        gone = [(a, b) for a, b, body in plain_chunks(t) if places[body] != (rank(i, t), a)]
        lines = t.split("\n")
        yield i, "\n".join(x for n, x in enumerate(lines) if not any(a <= n <= b for a, b in gone)), gone


@pytest.mark.parametrize("broadcast", ["50000000", "0"])
def test_line_dedup(spark, broadcast):
    rng = random.Random(8)
    lines = [f"line {i} " + "w" * rng.randint(0, 30) for i in range(60)] + ["", " ", "日本"]
    blocks = [[rng.choice(lines) for _ in range(rng.randint(3, 12))] for _ in range(5)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += rng.choice(blocks) if rng.random() < 0.6 else [f"own {i} {rng.random()}" for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(text)))
    rows += [(500, None), (501, ""), (502, "one line"), (3, rows[3][1]), (3, rows[3][1]), (None, rows[4][1]), (503, "\n".join(lines * 40)), (504, "\n\n\n\n")]
    spark.conf.set("flowloom.broadcast.maxBytes", broadcast)
    try:
        got = line_dedup(frame(spark, rows)).collect()
    finally:
        spark.conf.unset("flowloom.broadcast.maxBytes")
    assert sorted(((r.doc_id, r.text, [tuple(x) for x in r.removed_chunks]) for r in got), key=repr) == sorted(plain_dedup(rows), key=repr)
    assert any(r.removed_chunks for r in got) and all(r.row == 5 and r.key == "k" and r.parts == "p" for r in got)


def test_empty_and_null_tables(spark):
    for rows in ([], [(None, None), (1, None)]):
        assert len(secret_scan(frame(spark, rows)).collect()) == len(rows)
        assert len(line_dedup(frame(spark, rows)).collect()) == len(rows)


def test_secret_counts(spark):
    """Each kind's count is its own, with several spans of each in one text."""
    strong = ['token = "abcdef12"', "secret=token:abcdef", "AKIA" + "Q" * 16, "AKIA" + "Z" * 30, "0123456789abcdef" * 2, "deadbeef" * 4]
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(strong) for _ in range(rng.randint(0, 12)))) for i in range(80)] + secret_rows()
    got = secret_scan(frame(spark, rows)).collect()
    want = [(i, *[sum(s[1] == kind for s in plain_spans(t)) for kind in range(3)]) for i, t in rows]
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex) for r in got), key=repr) == sorted(want, key=repr)
    assert len({w[1:] for w in want}) > 20
