"""Validity periods from snapshots."""

import random
from datetime import date, timedelta

from veilwright.operators.history import attribute_history

SCHEMA = "snapshot_date date, e bigint, a bigint, b string, loaded int"


def run(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    out = attribute_history(df, "e", "snapshot_date", ["a", "b"], "loaded").collect()
    return {(r["e"], r["a"], r["b"], r["valid_from"], r["valid_to"]) for r in out}


def brute(data):
    dates = sorted({r[0] for r in data if r[0] and r[1] is not None})
    nxt = dict(zip(dates, [*dates[1:], None]))
    key = lambda v: tuple((x is not None, x if x is not None else 0) for x in v)
    last = {}
    for d, e, a, b, ld in data:
        if d and e is not None and ((e, d) not in last or (ld, key((a, b))) > last[(e, d)][0]):
            last[(e, d)] = ((ld, key((a, b))), (a, b))
    out = set()
    for e in {k[0] for k in last}:
        cur = None
        for d in dates:
            v = last.get((e, d), (None, None))[1]
            if cur and v != cur[0]:
                out.add((e, *cur[0], cur[1], d))
                cur = None
            if v is not None and cur is None:
                cur = (v, d)
        if cur:
            out.add((e, *cur[0], cur[1], None))
    assert nxt is not None
    return out


def test_against_brute_force(spark):
    rnd = random.Random(1)
    days = [date(2024, 1, 1) + timedelta(days=n) for n in (0, 3, 4, 20, 50, 51)]
    data = [(rnd.choice(days), rnd.randint(1, 25), rnd.choice([1, 2, None]), rnd.choice(["x", None]), rnd.randint(1, 4)) for _ in range(400)]
    assert run(spark, data) == brute(data)


def test_edges(spark):
    assert run(spark, []) == set()
    d = date(2024, 1, 1)
    assert run(spark, [(d, None, 1, "x", 1), (None, 5, 1, "x", 1), (d, 1, None, None, 1), (d, 1, None, None, 1)]) == {(1, None, None, d, None)}
    back = [(d, 1, 1, "x", 1), (d + timedelta(1), 2, 1, "x", 1), (d + timedelta(2), 1, 1, "x", 1)]
    assert {r for r in run(spark, back) if r[0] == 1} == {(1, 1, "x", d, d + timedelta(1)), (1, 1, "x", d + timedelta(2), None)}


def test_clashing_names(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 1, 2)], "_d date, _e bigint, _a bigint")
    out = attribute_history(df, "_e", "_d", ["_a"]).collect()
    assert out[0]["_a"] == 2 and out[0]["valid_to"] is None
