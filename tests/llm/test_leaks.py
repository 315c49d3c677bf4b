"""Leaked passages against brute force."""

import random

import numpy as np

from veilwright.llm import leaks

ITEM = "At the harbour unit, staff meet a goat farmer aged 82 whose 17-day complaint is loss of smell for citrus, and urine turns dark on standing."
ITEMS = [(1, ITEM), (2, "a b c d e f g h i j k l m"), (3, "short item"), (4, None), (5, ""), (None, ITEM)]


def brute(docs, items):
    out = set()
    for d, t in docs:
        w = leaks.words_of(t)
        s = " " + " ".join(w) + " "
        for i, u in items:
            x = leaks.words_of(u)
            if d is not None and i is not None and any(" " + " ".join(x[k : k + 12]) + " " in s for k in range(len(x) - 11)):
                out.add((d, i))
    return out


def test_variants(spark):
    w = leaks.words_of(ITEM)
    docs = [
        (1, "noise " + ITEM.upper() + " noise"),
        (2, " ".join(w[:11]) + " other"),  # one word too few
        (3, " ".join(w[5:17])),
        (4, " ".join(w[:6]) + " x " + " ".join(w[6:])[:30]),
        (5, "<p>At the har-\nbour u​nit, st<b>aff</b>&nbsp; meet a goàt farmer aged 82 whose 17</p>"),
        (6, "at the harbour unit staff meet a goat farmer aged 8 2x"),
        (7, " ".join(w[:12])[:-1] + "55"),  # the last word goes on
        (8, "A. B. C. D. E. F. G. H. I. J. K. L."),
        (9, None), (10, ""), (None, ITEM), (11, "filler words " * 30_000 + ITEM), (1, "noise " + ITEM.upper() + " noise"),
    ]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id bigint, text string, minhash string").repartition(2)
    q = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = [tuple(r) for r in leaks.find_leaks(d, q).collect()]
    assert sorted(got) == [(1, 1), (3, 1), (5, 1), (8, 2), (11, 1)]
    assert leaks.find_leaks(d.limit(0), q).count() == 0
    assert leaks.find_leaks(d, q.limit(0)).count() == 0


def test_random_corpus(spark):
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(12)] + ["a", "of"]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(10, 20)))) for i in range(30)]
    docs = []
    for i in range(200):
        t = rnd.choices(vocab, k=rnd.randint(0, 30))
        src = rnd.choice(items)[1].split()
        n = rnd.randint(9, len(src))
        at = rnd.randint(0, len(src) - n)
        docs.append((i, " ".join(t + src[at : at + n] + t[:3])))
    d, q = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert want
    assert {tuple(r) for r in leaks.find_leaks(d, q).collect()} == want


def test_slices_and_long_passages(spark, monkeypatch):
    """Windows across the borders of slices, passages of every size class, and a text that is all one word."""
    rnd = random.Random(1)
    word = lambda n: "".join(rnd.choices("abcdef", k=n))
    items = [(k, " ".join(word(n) for _ in range(14))) for k, n in enumerate((1, 2, 3, 5, 9, 14, 30, 400, 3000))]
    docs = [(i, " ".join([word(3) for _ in range(rnd.randint(0, 400))] + t.split()[1:13] + [word(4)] * 50)) for i, (_, t) in enumerate(items * 3)] + [(99, word(5000))]
    monkeypatch.setattr(leaks, "_SLICE", 997)
    maps = {c: np.full(1 << leaks.SLOT_BITS - 3, 255, np.uint8) for c in leaks.SIZE_CLASSES if c <= 40_000}
    for i, t in docs[:27]:
        keys = {(c, h, p) for c, h, _, _, p in leaks.item_keys(0, items[i % 9][1])}
        held = {p for _, c, h, x, b in leaks.windows([t], maps) for c2, h2, p in keys if (c, h) == (c2, h2) and x.startswith(p) and b[len(p) - 1] == "1"}
        assert held == {"".join(t.split()[k : k + 12]) for k in range(len(t.split()) - 11)} & {p for *_, p in keys} != set()
    monkeypatch.undo()
    d, q = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {tuple(r) for r in leaks.find_leaks(d, q).collect()} == brute(docs, items)
    assert (99,) not in {r[:1] for r in leaks.find_leaks(d, q).collect()}


def test_least_of_shingles():
    codes = leaks._codes("the cat sat on the mat and the hat")
    for size in leaks.SIZE_CLASSES[:5]:
        g = size // 2
        one = [leaks.minhashes(codes[i : i + g * 2], g * 2).min() if size == 2 * g else None for i in range(len(codes) - 2 * g + 1)]
        assert leaks.minhashes(codes, size).tolist() == one
