"""Two copies field by field."""

import random

import pytest
from pyspark.sql import functions as F

from veilwright.functions.normal import content_hash, flag, id_text
from veilwright.operators.table_diff import diff_tables

S = "k bigint, a string, b int, v int, bucket string"


def run(spark, left, right, n=50_000, cells="none"):
    f = {"a": F.col("a"), "b": F.col("b")}
    l, r = (spark.createDataFrame([(*x, "clash") for x in d], S) for d in (left, right))
    return diff_tables(l, r, "k", f, f, "v", bucket_rows=n, cells=cells).collect()


def brute(left, right):
    def last(rows):
        out = {}
        key = lambda t: tuple((x is not None, x if x is not None else 0) for x in t)
        for k, a, b, v in rows:
            if k is not None and (k not in out or key((v, a, b)) > out[k][0]):
                out[k] = (key((v, a, None if b is None else str(b))), (a, b))
        return {k: x[1] for k, x in out.items()}

    l, r = last(left), last(right)
    out = {(k, "missing_right", "*") for k in l.keys() - r.keys()} | {(k, "missing_left", "*") for k in r.keys() - l.keys()}
    for k in l.keys() & r.keys():
        out |= {(k, "mismatch", n) for n, x, y in zip("ab", l[k], r[k], strict=True) if x != y}
    return out


def test_against_brute_force(spark):
    rnd = random.Random(2)
    rows = lambda: [(rnd.choice([None, *range(40)]), rnd.choice(["x", "y", None]), rnd.choice([1, 2, None]), v) for v in range(80)]
    left, right = rows(), rows()
    for n in (50_000, 7):
        got = run(spark, left, right, n)
        assert {(r["key"], r["kind"], r["field_name"]) for r in got} == brute(left, right)
        assert len(got) == len(brute(left, right))


def test_values_and_empty_sides(spark):
    got = run(spark, [(1, None, 5, 1)], [(1, "x", 5, 1)], cells="raw")
    assert [tuple(r) for r in got] == [(1, "mismatch", "a", None, "x")]
    got = run(spark, [(1, "Zoë-12", 5, 1)], [(1, None, 6, 1)], cells="masked")
    assert {tuple(r) for r in got} == {(1, "mismatch", "a", "xxx-99", None), (1, "mismatch", "b", "9", "9")}
    assert run(spark, [], []) == []
    assert [r["kind"] for r in run(spark, [], [(1, "x", 5, 1)])] == ["missing_left"]
    assert [r["kind"] for r in run(spark, [(1, "x", 5, 1)], [])] == ["missing_right"]
    with pytest.raises(ValueError, match="same fields"):
        df = spark.createDataFrame([], S)
        diff_tables(df, df, "k", {"a": F.col("a")}, {"b": F.col("b")})


def test_text_keys(spark):
    s, f = "k string, a string, v int", {"a": F.col("a")}
    l = spark.createDataFrame([("x", "1", 1), ("", "1", 1), ("only", "1", 1), ("x", "2", 2), (None, "1", 1)], s)
    r = spark.createDataFrame([("x", "1", 1), ("", "1", 1), ("é", None, 1)], s)
    want = {("x", "mismatch", "a"), ("only", "missing_right", "*"), ("é", "missing_left", "*")}
    for n in (50_000, 1):
        assert {tuple(x)[:3] for x in diff_tables(l, r, "k", f, f, "v", bucket_rows=n).collect()} == want
    with pytest.raises(ValueError, match="keys"):
        diff_tables(l, r.withColumn("k", F.lit(1)), "k", f, f, "v")


def test_canonical_cells(spark):
    df = spark.createDataFrame([(" 007 ",), ("7.0",), ("7",), ("-0",), ("",), (None,), ("7.5",), ("AB 1",)], "x string").coalesce(1)
    assert [r[0] for r in df.select(id_text(F.col("x"))).collect()] == ["7", "7", "7", "0", None, None, "7.5", "AB 1"]
    f = spark.createDataFrame([("Yes",), (" n",), ("TRUE",), ("maybe",), (None,)], "x string").coalesce(1)
    assert [r[0] for r in f.select(flag(F.col("x"))).collect()] == ["Y", "N", "Y", "maybe", None]


def test_hash_sees_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert df.select(content_hash(["x", "y"])).distinct().count() == 2
