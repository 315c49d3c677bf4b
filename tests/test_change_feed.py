"""Merge on read with equality deletes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from veilwright.operators.change_feed import ChangeTable, decode_events, latest_dump, literal
from veilwright.session import StaleVersion, scratch_path

LOG = "id bigint, operation string, payload string, binlog_file string, binlog_pos bigint"
COLS = {"1": "k0", "2": "a", "3": "b"}


def events(spark, part):
    return decode_events(spark.createDataFrame(part, LOG), COLS, "k0")


def table(spark, base, log, compact=False):
    t = ChangeTable(spark, scratch_path(spark, "t7"), ["a", "b"])
    t.append_base(spark.createDataFrame(base, "k0 bigint, a string, b string"), "k0")
    for part in log:
        t.append_events(events(spark, part))
        if compact:
            t.compact()
    return rows_of(t)


def rows_of(t):
    return {r["k"]: (r["nd_operation"], r["a"], r["b"]) for r in t.read().collect()}


def brute(base, log):
    rows = {k: ["NONE", a, b] for k, a, b in base if k is not None}
    for i, op, p, f, pos in sorted((e for e in log if e[4] is not None), key=lambda e: (int(e[3].split(".")[1]), e[4], e[0])):
        m = json.loads(p)
        k = m.get("1")
        if k is None:
            continue
        k = int(k)
        if op[0].upper() == "D":
            rows.pop(k, None)
            continue
        r = rows.setdefault(k, [None, None, None])
        r[0] = {"I": "INSERT", "U": "UPDATE"}[op[0].upper()]
        for n, c in ((1, "2"), (2, "3")):
            if c in m:
                r[n] = m[c]
    return {k: tuple(v) for k, v in rows.items()}


def test_any_order_repeats_and_partial_images(spark):
    rnd = random.Random(4)
    base = [(k, f"a{k}", None) for k in range(12)]
    log = []
    for i in range(250):
        m = {"1": str(rnd.randint(0, 20))} | {c: rnd.choice(["x", "y", None]) for c in "23" if rnd.random() < 0.6}
        if rnd.random() < 0.03:
            m.pop("1")
        log.append((i, rnd.choice(["INSERT", "u", "Update", "D"]), json.dumps(m), f"f.{rnd.choice([9, 10])}", rnd.choice([None, *range(1, 4000)])))
    want = brute(base, log)
    shuffled = log + log[:50]
    rnd.shuffle(shuffled)
    assert table(spark, base, [shuffled]) == want
    assert table(spark, base, [shuffled[:100], shuffled[100:]]) == want
    assert table(spark, base, [shuffled[:100], shuffled[100:200], shuffled[200:]], compact=True) == want


def test_batches_are_seen_whole_or_not_at_all(spark, monkeypatch):
    t = ChangeTable(spark, scratch_path(spark, "t7"), ["a", "b"])
    assert rows_of(t) == {}
    t.append_base(spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "k0 bigint, a string, b string"), "k0")
    before, batch = rows_of(t), events(spark, [(1, "D", '{"1": 1}', "f.1", 1), (2, "I", '{"1": 3}', "f.1", 2)])
    commit = t.versions.commit

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(t.versions, "commit", die)
    with pytest.raises(RuntimeError, match="lost"):
        t.append_events(batch)
    assert rows_of(t) == before
    other = ChangeTable(spark, t.versions.path, ["a", "b"])
    monkeypatch.setattr(t.versions, "commit", lambda base, m: (other.append_events(events(spark, [(3, "U", '{"1": 2, "2": "x"}', "f.1", 3)])), commit(base, m)))
    with pytest.raises(StaleVersion):
        t.append_events(batch)
    monkeypatch.undo()
    assert rows_of(t) == {1: ("NONE", "a", "b"), 2: ("UPDATE", "x", "d")}
    t.append_events(batch)
    assert rows_of(t) == {2: ("UPDATE", "x", "d"), 3: ("INSERT", None, None)}


def test_a_hot_key_is_folded_before_the_shuffle(spark):
    t = ChangeTable(spark, scratch_path(spark, "t7"), ["a", "b"])
    log = spark.range(0, 3000, 1, 6).selectExpr("id", "if(id % 7 = 0, 'D', 'U') as operation", """format_string('{"1": %d, "2": "v%d"}', if(id % 3 = 0, 1, id % 50), id) as payload""", "'f.1' as binlog_file", "id as binlog_pos")
    t.append_events(decode_events(log, COLS, "k0"))
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning" in x]) == 2 and plan.count("partial_max") >= 4
    key, alive = lambda i: 1 if i % 3 == 0 else i % 50, {}
    for i in range(3000):
        alive[key(i)] = i % 7 != 0
    assert t.read().count() == sum(alive.values())


def test_literals(spark):
    vals = ["'pt\\'s request'", "NULL", "null", "'NULL and void'", "'a\\\\b'", "plain", "''", "'it''s'", "'l1\\nl2'", "'", None, "12"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(literal(F.col("v"))).collect()]
    assert got == ["pt's request", None, None, "NULL and void", "a\\b", "plain", "", "it's", "l1\nl2", "'", None, "12"]


def test_bad_events_and_empty(spark):
    bad = [(1, "X", '{"1": 1}', "f.1", 1), (2, "I", "no json", "f.1", 2), (3, None, '{"1": 1}', "f.1", 3), (4, "I", None, "f.1", 3), (5, "I", '{"1": 1}', None, 3), (6, "I", '{"1": "x"}', "f.1", 3)]
    assert table(spark, [(1, "a", "b"), (1, "a", "b"), (None, "a", "b")], [bad]) == {1: ("NONE", "a", "b")}
    assert table(spark, [], [[]]) == {}


def test_latest_dump(spark):
    meta = spark.createDataFrame([("Appts", "b.2", 5, "2024-01-01"), ("appts", "b.10", 7, "2024-02-01"), ("appts", "b.11", 1, None)], "table_name string, binlog_file string, binlog_pos bigint, dump_completed_at string")
    assert latest_dump(meta, "appts").first()["dump_seq"]["file"] == 10
    assert latest_dump(meta, "none").first()["dump_seq"] is None
