"""Session helpers: shared scratch storage, table access, atomic pointers."""

from __future__ import annotations

import atexit
import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, with lower-case column names."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df if all(c == c.lower() for c in df.columns) else df.toDF(*[c.lower() for c in df.columns])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one named in ``spark.checkpoint.dir``. Only a master in one process may
    fall back to a temporary folder; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="veilwright-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver process ends."""
    path = f"{shared_dir(spark)}/veilwright/{name}-{uuid.uuid4().hex[:12]}"

    def _drop() -> None:
        try:
            delete_path(spark, path)
        except Exception:  # the session may have ended already
            pass

    atexit.register(_drop)
    return path


def release(df: DataFrame | None) -> None:
    """Delete the files of a table made by :func:`materialize` that no pending plan needs any more."""
    path = getattr(df, "_scratch", None)
    if path is not None:
        delete_path(df.sparkSession, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def write_pointer(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one atomic rename."""
    jvm = spark._jvm
    fs, target = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    opts = spark.sparkContext._gateway.new_array(rename, 1)
    opts[0] = rename.OVERWRITE
    fc.rename(tmp, target, opts)


def read_pointer(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class StaleVersion(RuntimeError):
    """Another run has committed since the version was read."""


class Versions:
    """Versions of a state under one folder: each is a small manifest that names the folders of its files.

    Files are complete before their manifest appears, by one rename that fails if the
    version is there already. So readers see whole versions, a run that dies changes
    nothing, and of two runs that start from one version one fails with StaleVersion.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.path}/_versions")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d{10}\.json", n))

    def _read(self, number: int) -> dict:
        return json.loads(read_pointer(self.spark, f"{self.path}/_versions/{number:010d}.json") or "{}")

    def current(self) -> tuple[int, dict]:
        """Number and manifest of the latest version; 0 and an empty one at the start."""
        n = self._numbers()
        return (n[-1], self._read(n[-1])) if n else (0, {})

    def fresh(self, name: str) -> str:
        """A path for files of the next version."""
        return f"{self.path}/{name}-{uuid.uuid4().hex[:12]}"

    def commit(self, base: int, manifest: dict) -> int:
        """Make ``manifest`` the version after ``base``."""
        jvm = self.spark._jvm
        fs, target = _fs(self.spark, f"{self.path}/_versions/{base + 1:010d}.json")
        tmp = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_versions/.{uuid.uuid4().hex[:8]}.tmp")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            fc.rename(tmp, target, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            fs.delete(tmp, False)
            if "AlreadyExists" in str(e):
                raise StaleVersion(f"version {base + 1} of {self.path} exists") from None
            raise
        return base + 1

    def drop_old(self, keep: int = 2) -> None:
        """Delete all versions but the last ``keep``, with the files that only they name."""
        n = self._numbers()
        paths = lambda numbers: {p for k in numbers for x in self._read(k).values() if isinstance(x, list) for p in x if isinstance(p, str)}
        live = paths(n[-keep:])
        for p in paths(n[:-keep]) - live:
            delete_path(self.spark, p)
        for k in n[:-keep]:
            delete_path(self.spark, f"{self.path}/_versions/{k:010d}.json")


def spread(df: DataFrame, per_core: int = 3) -> DataFrame:
    """``df`` over all cores, for work that is heavy on CPU.

    A scan gives one task per file split, so small or few files would leave cores idle;
    only then the rows are dealt out anew.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores * per_core)


def gather(df: DataFrame, per_core: int = 8) -> DataFrame:
    """``df`` in a bounded number of tasks, for work of which each task returns a sum of fixed size.

    Beyond that number, more tasks would only mean more sums to shuffle.
    """
    most = df.sparkSession.sparkContext.defaultParallelism * per_core
    return df.coalesce(most) if df.rdd.getNumPartitions() > most else df
