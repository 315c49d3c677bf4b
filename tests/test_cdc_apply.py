"""Applying change logs against a sequential version."""

import json
import random

from pyspark.sql import functions as F

from veilwright.operators.cdc import filled_tables, id_validation, latest_snapshot, log_page, parse_inserts
from veilwright.operators.cdc_apply import COUNTERS, apply_row_events, base_rows, counters, read_statement, row_events, run_day, statement_events

LOG = "id bigint, operation string, payload string, binlog_file string, binlog_pos bigint"
COLS = {"1": "k0", "2": "a", "3": "b"}
NAMES = ["k0", "a", "b"]


def brute(base, log):
    """One event after another: table, and the outcome of each."""
    rows = {k: {"k0": k, "a": a, "b": b, "op": "NONE", "flag": "Y"} for k, a, b in base if k is not None}
    out = {}
    for i, op, p, f, pos in sorted(log, key=lambda e: (int(e[3].split(".")[1]), e[4], e[0])):
        op, image = op[0].upper(), {COLS[c]: v for c, v in json.loads(p).items() if c in COLS}
        k = image.get("k0")
        if not image or op not in "IUD":
            out[i] = "skipped_row_based"
        elif op == "I" and k is None:
            out[i] = "errors_insert_no_pk"
        elif op == "U" and k is None:
            out[i] = "skipped_row_based"
        elif op in "IU":
            there = k in rows
            r = rows.setdefault(k, {"k0": None, "a": None, "b": None, "flag": "Y"})
            r |= image | {"op": "INSERT" if op == "I" else "UPDATE"}
            if op == "I":
                r["flag"] = "Y"
            out[i] = "updated" if op == "U" else "refreshed" if there else "inserted"
        else:
            if k is not None:
                hit = [k] if k in rows else []
            else:
                hit = [x for x, r in rows.items() if any(v is not None for v in image.values()) and all(r[c] == v for c, v in image.items())]
            for x in hit:
                rows[x] |= {"op": "DELETE", "flag": "N"}
            out[i] = "soft_deleted" if hit else "delete_no_match"
    return {k: (r["op"], r["flag"], r["a"], r["b"]) for k, r in rows.items()}, out


def applied(spark, base, log):
    b = base_rows(spark.createDataFrame(base, "k0 string, a string, b string"), "k0", NAMES)
    table, outcomes = apply_row_events(b, row_events(spark.createDataFrame(log, LOG), COLS), "k0", NAMES)
    return {r["k"]: (r["nd_operation"], r["nd_activeflag"], r["a"], r["b"]) for r in table.collect()}, outcomes


def test_against_one_event_after_another(spark):
    for seed in range(2):
        rnd = random.Random(seed)
        base = [(str(k), f"a{k % 3}", None) for k in range(6)] + [(None, "x", "y"), ("0", "a0", None)]
        log = []
        for i in range(150):
            op = rnd.choice(["INSERT", "u", "Update", "D", "DELETE", "X"] if i % 20 == 0 else ["INSERT", "u", "D"])
            m = {"1": str(rnd.randint(0, 12))} | {c: rnd.choice(["x", "y", None]) for c in "23" if rnd.random() < 0.7}
            if rnd.random() < 0.15:
                m.pop("1")
            log.append((i, op, json.dumps(m | {"9": "z"} if rnd.random() < 0.1 else m), f"f.{rnd.choice([9, 10])}", i * 3 % 101 + i))
        want, by = brute(base, log)
        got, outcomes = applied(spark, base, log + log[:20])
        assert got == want
        rows = outcomes.select(F.col("seq.id").alias("i"), "outcome").distinct().collect()
        assert {r["i"]: r["outcome"] for r in rows} == by
        n = {r["counter"]: r["n"] for r in counters(outcomes).collect()}
        assert list(sorted(n)) == sorted(COUNTERS) and n["inserted"] == sum(v == "inserted" for v in by.values())


def test_empty_and_unreadable(spark):
    assert applied(spark, [], [])[0] == {}
    got, outcomes = applied(spark, [("1", "a", None)], [(1, "I", "junk", "f.1", 1), (2, None, '{"1": 2}', "f.1", 2), (3, "I", None, "f.1", 3), (4, "I", '{"1": 5}', None, 3), (5, "D", "{}", "f.1", 4)])
    assert got == {"1": ("NONE", "Y", "a", None)}
    assert {r["outcome"] for r in outcomes.collect()} == {"skipped_row_based"}


def test_statements(spark):
    assert parse_inserts("INSERT INTO t (a, b) VALUES (1, 'x,)y'), (2, NULL), (3)") == [{"a": "1", "b": "'x,)y'"}, {"a": "2", "b": "NULL"}, {}]
    one = lambda s: [(r["op"], r["key"], r["image"], r["outcome"]) for r in read_statement(s, "id")]
    assert one("REPLACE INTO `t` (`ID`, b) VALUES (1, 2), (3, 4);") == [("INSERT", "1", {"id": "1", "b": "2"}, None), ("INSERT", "3", {"id": "3", "b": "4"}, None)]
    assert one("update t set a = 'x, y', `b`=2 where `id` = 7 limit 1") == [("UPDATE", "7", {"a": "'x, y'", "b": "2", "id": "7"}, None)]
    assert one("DELETE FROM t WHERE (id = '9')") == [("DELETE", "'9'", {"id": "'9'"}, None)]
    for sql, outcome in (("update t set a = 1", "update_where_none"), ("update t set a = 1 where b = 2", "skipped_row_based"), ("delete from t", "errors_delete_no_where"), ("delete t from t join u on 1 where t.id = 1", "errors_delete"),
                         ("insert into t select * from u", "insert_select"), ("insert into t (a) values (1, 2)", "errors_insert_mismatch"), ("drop table t", "errors"), (None, "errors")):
        assert one(sql)[0][3] == outcome, sql
    log = spark.createDataFrame([(1, "insert into t (id, a) values (1, 'x'), (2, 'it''s')", "f.1", 1), (2, "update t set a = NULL where id = 1", "f.1", 2), (3, "delete from t where id = 2", "f.1", 3), (4, "delete from t", "f.1", 4)], "id bigint, sql string, binlog_file string, binlog_pos bigint")
    events, rest = statement_events(log, "id", F.col("sql"))
    base = base_rows(spark.createDataFrame([], "id string, a string"), "id", ["id", "a"])
    table, outcomes = apply_row_events(base, events, "id", ["id", "a"])
    assert {r["k"]: (r["nd_operation"], r["nd_activeflag"], r["a"]) for r in table.collect()} == {"1": ("UPDATE", "Y", None), "2": ("DELETE", "N", "it's")}
    assert sorted(r["outcome"] for r in outcomes.select("outcome").unionByName(rest.select("outcome")).collect()) == ["errors_delete_no_where", "inserted", "inserted", "soft_deleted", "updated"]


def test_days_go_on_from_the_last_position(spark):
    from veilwright.session import Versions, scratch_path

    path = scratch_path(spark, "day")
    prod = spark.createDataFrame([("1", "a", None), ("2", "b", None)], "k0 string, a string, b string")
    log = [(1, "U", '{"1": 1, "2": "x"}', "f.9", 5), (2, "I", '{"1": 3, "2": "c"}', "f.10", 1)]
    day = lambda rows: run_day(spark, path, spark.createDataFrame(rows, LOG), COLS, "k0", prod)
    assert day(log) == {"updated": 1, "inserted": 1}
    assert day(log) == {}
    assert day([*log, (3, "D", '{"1": 2}', "f.10", 2), (4, "U", '{"1": 3, "3": "y"}', "f.11", 1)]) == {"soft_deleted": 1, "updated": 1}
    got = {r["k"]: (r["nd_operation"], r["nd_activeflag"], r["a"], r["b"]) for r in spark.read.parquet(*Versions(spark, path).current()[1]["table"]).collect()}
    assert got == {"1": ("UPDATE", "Y", "x", None), "2": ("DELETE", "N", "b", None), "3": ("UPDATE", "Y", "c", "y")}


def test_pages_snapshots_and_ids(spark):
    log = spark.createDataFrame([(i, "I", None, f"f.{i % 3 + 9}", i) for i in range(10)] + [(99, "I", None, "f.9", None)], LOG)
    one = log_page(log, 4).collect()
    two = log_page(log, 100, (9, 9, 9)).collect()
    assert [r["id"] for r in one] == [0, 3, 6, 9] and [r["id"] for r in two] == [1, 4, 7, 2, 5, 8]
    meta = spark.createDataFrame([("T", "d1", "2024-01-01"), ("t ", "d2", "2024-02-20"), ("u", "d3", "2020-01-01"), ("u", "d4", None)], "table_name string, dump_file string, dump_completed_at string").withColumn("dump_completed_at", F.col("dump_completed_at").cast("timestamp_ntz"))
    assert {tuple(r) for r in latest_snapshot(meta, F.lit("2024-03-01").cast("timestamp_ntz"), base="b").collect()} == {("t", "d2"), ("u", "b")}
    a, b = (spark.createDataFrame(x, "k bigint, v string") for x in ([(1, "a"), (1, "b"), (2, "c"), (None, "x"), (4, None)], [(1, "b"), (1, "a"), (3, "c"), (2, "d"), (4, None)]))
    summary, detail = id_validation(a, b, "k", "v")
    assert {tuple(r) for r in summary.collect()} == {("mismatch", 1), ("missing_here", 1)} and {r["key"] for r in detail.collect()} == {"2", "3"}


def test_filled_tables(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/a.parquet")
    spark.range(0).write.parquet(f"{tmp_path}/b.parquet")
    assert [r[0] for r in filled_tables(spark, str(tmp_path)).collect()] == ["a"] and filled_tables(spark, f"{tmp_path}/gone").count() == 0
