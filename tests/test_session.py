"""Shared storage and pointers."""

from types import SimpleNamespace

import pytest

from veilwright import session


def test_pointer_is_replaced(spark, tmp_path):
    p = f"file://{tmp_path}/_CURRENT"
    assert session.read_pointer(spark, p) is None
    for v in ("1", "2"):
        session.write_pointer(spark, p, v)
        assert session.read_pointer(spark, p) == v
    assert [x.name for x in tmp_path.iterdir() if not x.name.startswith(".")] == ["_CURRENT"]


def test_shared_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    conf = SimpleNamespace(get=lambda k, d: d)
    for master in ("spark://host:7077", "local-cluster[2,1,512]"):
        cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
        with pytest.raises(RuntimeError, match="checkpoint.dir"):
            session.shared_dir(cluster)


def test_versions(spark):
    v = session.Versions(spark, session.scratch_path(spark, "versions"))
    assert v.current() == (0, {})
    for k in range(4):
        p = v.fresh("x")
        spark.range(1).write.parquet(p)
        assert v.commit(k, {"x": [p]}) == k + 1
        with pytest.raises(session.StaleVersion):
            v.commit(k, {"x": []})
    n, m = v.current()
    v.drop_old(keep=1)
    assert n == 4 and v.current() == (4, m) and session.path_exists(spark, m["x"][0])


def test_release(spark):
    df = session.materialize(spark.range(3), "t")
    session.release(df)
    session.release(None)
    assert not session.path_exists(spark, df._scratch)


def test_materialize_spread_and_gather(spark):
    df = session.materialize(spark.range(10).coalesce(1), "t")
    assert df.count() == 10 and session.spread(df).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert session.gather(spark.range(0, 1000, 1, 200)).rdd.getNumPartitions() == 8 * spark.sparkContext.defaultParallelism
    assert session.materialize(spark.range(0), "t").count() == 0


def test_columns_in_lower_case(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "Ab int, cD int").write.parquet(f"{tmp_path}/t.parquet")
    assert session.read_table(spark, str(tmp_path), "t").columns == ["ab", "cd"]
