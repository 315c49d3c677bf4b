"""Orphan references: kinds and incremental state."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from veilwright.operators.orphans import OrphanState, orphan_counts, parent_changes, parent_index, probe, references
from veilwright.session import scratch_path

D = datetime


def kids(spark, data):
    df = spark.createDataFrame(data, "id bigint, pid string, at timestamp_ntz")
    return references(df, "kids", "id", "pid", "at")


def parents(spark, data):
    df = spark.createDataFrame(data, "pid bigint, created timestamp_ntz, flag string")
    return parent_index(df, "pid", "pid", "created", "flag")


def kinds(df):
    return {(r["child_id"], r["kind"]) for r in df.collect()}


def test_kinds_and_id_spellings(spark):
    refs = kids(spark, [(1, " 007 ", D(2024, 1, 2)), (2, "8.0", D(2024, 1, 2)), (3, "9", D(2024, 1, 2)), (4, "  ", D(2024, 1, 2)), (5, None, None), (6, "x1", D(2024, 1, 2)), (7, "10", None), (7, "10", None), (None, "99", None)])
    par = parents(spark, [(7, D(2024, 1, 1), " y"), (8, D(2024, 1, 1), "N"), (9, D(2024, 1, 5), None), (9, D(2023, 1, 1), "n"), (10, D(2024, 5, 1), "Y"), (None, None, None)])
    got = OrphanState(spark, scratch_path(spark, "t5")).advance(refs, par)
    assert kinds(got) == {(2, "deleted"), (3, "late"), (6, "missing"), (None, "missing")}
    assert got.count() == 4


def test_waiting_resolved_and_reopened(spark):
    state = OrphanState(spark, scratch_path(spark, "t5"))
    refs = kids(spark, [(1, "1", D(2024, 1, 1)), (2, "2", D(2024, 1, 1)), (3, "3", D(2024, 1, 1))])
    assert kinds(state.advance(refs, parents(spark, [(3, D(2023, 1, 1), "Y")]))) == {(1, "missing"), (2, "missing")}
    none = refs.limit(0)
    assert kinds(state.advance(none, parents(spark, [(1, D(2024, 2, 1), "Y")]), refs)) == {(1, "late"), (2, "missing")}
    got = state.advance(none, parents(spark, [(3, D(2023, 1, 1), "N")]), refs)
    assert kinds(got) == {(1, "late"), (2, "missing"), (3, "deleted")}
    c = {(r["kind"], r["period"], r["n_records"]) for r in orphan_counts(got).collect()}
    assert c == {("late", "2024-01-01", 1), ("missing", "2024-01-01", 1), ("deleted", "2024-01-01", 1)}
    # one that was late isn't both late and deleted
    assert kinds(state.advance(none, parents(spark, [(1, D(2024, 2, 1), "n")]), refs)) == {(1, "deleted"), (2, "missing"), (3, "deleted")}


def test_any_steps_give_what_one_step_gives(spark):
    for seed in range(2):
        rnd = random.Random(seed)
        when = lambda: rnd.choice([None, *(D(2024, 1, d) for d in range(1, 9))])
        state = OrphanState(spark, scratch_path(spark, "t5"), compact_after=3)
        entries, refs = {}, []
        for _ in range(6):
            new = [(rnd.randint(1, 40), str(rnd.randint(1, 9)), when()) for _ in range(rnd.randint(0, 12))]
            moved = {str(k): rnd.choice([(True, when()), (True, when()), (False, None), (None, None)]) for k in rnd.sample(range(1, 10), rnd.randint(0, 4))}
            entries |= moved
            ch = spark.createDataFrame([("pid", k, *v) for k, v in moved.items()], "ref_column string, ref_key string, alive boolean, since timestamp_ntz")
            got = state.advance(kids(spark, new), ch, kids(spark, refs))
            refs += new
            want = set()
            for i, k, at in refs:
                alive, since = entries.get(k, (None, None))
                kind = "missing" if alive is None else "deleted" if not alive else "late" if since and at and since > at else None
                if kind:
                    want.add((i, k, at, kind))
            rows = [(r["child_id"], r["ref_key"], r["child_time"], r["kind"]) for r in got.collect()]
            assert set(rows) == want and len(rows) == len(want)


def test_changes_of_parents(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), True, True), (1, D(2023, 1, 1), False, True), (2, D(2024, 1, 1), True, True), (3, D(2024, 1, 1), True, False), (None, None, False, True)], "pid bigint, created timestamp_ntz, b boolean, n boolean")
    got = {r["ref_key"]: (r["alive"], r["since"]) for r in parent_changes(df, "pid", "pid", "created", F.col("b"), F.col("n")).collect()}
    assert got == {"1": (True, D(2023, 1, 1)), "3": (None, None)}


def test_a_hot_key_is_split(spark):
    """One key with most references: the join is a skewed join."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        refs = spark.range(0, 60_000, 1, 8).selectExpr("'kids' as child_table", "id as child_id", "'pid' as ref_column", "cast(if(id % 3 > 0, 1, id) as string) as ref_key", "timestamp_ntz'2024-01-01 00:00:00' as child_time")
        par = spark.range(2, 4000).selectExpr("'pid' as ref_column", "cast(id as string) as ref_key", "true as alive", "timestamp_ntz'2023-01-01 00:00:00' as since")
        got = probe(refs, par).where("kind is not null")
        assert len(got.collect()) == 40_000 + sum(i % 3 == 0 and not 2 <= i < 4000 for i in range(60_000))
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_empty(spark):
    refs, par = kids(spark, []), parents(spark, [])
    assert OrphanState(spark, scratch_path(spark, "t5")).advance(refs, par).count() == 0
    assert orphan_counts(OrphanState(spark, scratch_path(spark, "t5")).advance(kids(spark, [(1, "1", None)]), par)).collect()[0]["period"] is None
