"""New and changed records: state, failures, ties, nulls, hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from veilwright.operators.incremental import RecordState, deliveries, records_to_process, taken_by_runs, transitions, windows_of_runs
from veilwright.session import StaleVersion, scratch_path

SCHEMA = "nd_auto_increment_id bigint, v string, w string, nd_operation string, nd_extracted_date timestamp_ntz, nd_updated_at timestamp_ntz"
RUNS = "run_id bigint, table_name string, status string, delta_after timestamp_ntz, delta_until timestamp_ntz"
T0 = datetime(2024, 1, 1)


def day(n):
    return None if n is None else T0 + timedelta(days=n)


def rows(spark, data):
    return spark.createDataFrame([(k, v, w, "I", day(e), day(u)) for k, v, w, e, u in data], SCHEMA)


def brute(data, windows):
    out = set()
    by = {}
    for k, v, w, e, u in data:
        t = max([x for x in (e, u) if x is not None], default=None)
        by.setdefault(k, set()).add((t, (v, w)))
    for k, ds in by.items():
        prev = object()
        for t, c in sorted(ds, key=lambda x: (x[0] is not None, x[0] or 0, str(x[1]))):
            if c != prev and (t is None or not any(a < t <= b for a, b in windows)):
                out.add(k)
            prev = c
    return out


def runs(spark, windows, status="Success"):
    return spark.createDataFrame([(i, " T ", status, day(a), day(b)) for i, (a, b) in enumerate(windows)], RUNS)


def found(spark, data, windows, **kw):
    got = records_to_process({"t": (rows(spark, data), "nd_auto_increment_id")}, runs(spark, windows), **kw)
    return {r["rec_key"] for r in got.collect()}


def test_against_brute_force(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(1, 60), rnd.choice("ab"), rnd.choice(["x", None]), rnd.choice([None, *range(20)]), rnd.choice([None, *range(20)])) for _ in range(300)]
    # deliveries of one record at one time have one content in the data
    seen, clean = {}, []
    for k, v, w, e, u in data:
        t = max([x for x in (e, u) if x is not None], default=None)
        v, w = seen.setdefault((k, t), (v, w))
        clean.append((k, v, w, e, u))
    windows = [(-1, 4), (3, 9), (12, 15)]
    assert found(spark, clean, windows) == brute(clean, windows)


def test_hot_keys_go_by_slab(spark):
    rnd = random.Random(5)
    data = [(rnd.randint(1, 3), rnd.choice("ab"), "x", n, None) for n in range(400)]
    d = deliveries(rows(spark, data), "t", "nd_auto_increment_id", ["nd_extracted_date", "nd_updated_at"], ["nd_operation"])
    a, b = transitions(d), transitions(d, hot=5)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_nulls_repeats_and_failed_runs(spark):
    data = [(1, "a", None, 1, None), (1, "a", None, 1, None), (1, None, "a", 2, None), (None, "q", "q", 5, 1), (2, "z", "z", None, None), (3, "k", "k", 1, 3), (3, "k", "k", 8, None)]
    assert found(spark, data, [(0, 3)]) == {None, 2}
    assert found(spark, data, []) == {1, 2, 3, None}
    r = runs(spark, [(0, 30)], "failed")
    assert {x["rec_key"] for x in records_to_process({"t": (rows(spark, data), "nd_auto_increment_id")}, r).collect()} == {1, 2, 3, None}


def test_windows_merge_and_open_ends(spark):
    w = windows_of_runs(spark.createDataFrame([(1, "T", "success", None, day(3)), (2, "t", "SUCCESS", day(2), day(5)), (3, "t", "success", day(9), None), (4, "t", "aborted", day(5), day(9))], RUNS)).collect()
    assert len(w) == 1 and len(w[0]["windows"]) == 2


def test_state_survives_a_run_that_dies(spark):
    state = RecordState(spark, scratch_path(spark, "test-state"))
    first = rows(spark, [(1, "a", "", 1, None), (2, "b", "", 1, None)])
    cur = transitions(deliveries(first, "t", "nd_auto_increment_id", ["nd_extracted_date"], ["nd_operation", "nd_updated_at"]))
    assert state.pending(cur).count() == 2
    state.commit(state.pending(cur))
    # files without a version: a run that died before its commit
    cur.write.parquet(state.versions.fresh("taken"))
    assert state.version() == 1
    later = rows(spark, [(1, "a", "", 1, None), (1, "A", "", 2, None), (2, "b", "", 1, None), (3, "c", "", 2, None)])
    cur2 = transitions(deliveries(later, "t", "nd_auto_increment_id", ["nd_extracted_date"], ["nd_operation", "nd_updated_at"]))
    pending = state.pending(cur2)
    assert {r["rec_key"] for r in pending.collect()} == {1, 3}
    state.commit(pending)
    assert state.version() == 2 and state.pending(cur2).count() == 0


def test_of_two_runs_from_one_version_one_fails(spark):
    path = scratch_path(spark, "test-state")
    cur = transitions(deliveries(rows(spark, [(1, "a", "", 1, None), (2, "b", "", 1, None)]), "t", "nd_auto_increment_id", ["nd_extracted_date"]))
    a, b = RecordState(spark, path), RecordState(spark, path)
    mine, theirs = a.pending(cur), b.pending(cur)
    a.commit(mine.where("rec_key = 1"))
    with pytest.raises(StaleVersion):
        b.commit(theirs)
    assert {r["rec_key"] for r in b.pending(cur).collect()} == {2}
    b.commit(b.pending(cur))
    assert a.pending(cur).count() == 0


def test_commits_become_one_folder_in_time(spark):
    state = RecordState(spark, scratch_path(spark, "test-state"), compact_after=3)
    cur = transitions(deliveries(rows(spark, [(k, "a", "", 1, None) for k in range(9)]), "t", "nd_auto_increment_id", ["nd_extracted_date"]))
    for k in range(9):
        state.commit(state.pending(cur).where(f"rec_key = {k}"))
        assert len(state.versions.current()[1]["taken"]) <= 3
    assert state.version() == 9 and state.read().count() == 9 and state.pending(cur).count() == 0


def test_empty_table_and_clashing_names(spark):
    assert found(spark, [], [(0, 3)]) == set()
    df = rows(spark, [(1, "a", "", 1, None)]).select("*", F.lit(1).alias("ts"), F.lit(2).alias("hash"), F.lit(3).alias("prev"), F.lit("x").alias("rec_key"), F.lit("x").alias("windows"))
    got = records_to_process({"t": (df, "nd_auto_increment_id")}, runs(spark, [(5, 9)])).collect()
    assert [tuple(r) for r in got] == [("t", 1)]
    cur = transitions(deliveries(df, "t", "nd_auto_increment_id", ["nd_extracted_date"]))
    assert taken_by_runs(cur, runs(spark, [(0, 2)])).count() == 1
