"""Parts of benchmark items that begin anywhere."""

import random

from test_models import frame

from flowloom.llm.decontaminate import leaks


def test_excerpts_at_any_offset(spark):
    """Every exact part of 80 characters is found, and nothing where no item stands."""
    rng = random.Random(23)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(60))) for i in range(4)]
    other = lambda: "".join(rng.choice("klmnopqr ") for _ in range(150))
    rows, want = [], set()
    for i, text in items:
        for at in range(1, len(text) - 81, 7):
            if text[at] != " " and text[at + 79] != " ":
                want.add((len(rows), i))
                rows.append((len(rows), other() + "0" + text[at:at + 80] + "1" + other()))
    clean = len(rows)
    rows += [(clean + n, other()) for n in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(want) > 80 and {(r.doc_id, r.item_id) for r in leaks(frame(spark, rows), bench).collect()} == want
