"""Processing only new or changed records.

Method: key and content-hash state. A *transition* is a delivery whose content hash
differs from that of the delivery before it, or the first delivery of a key. The state
holds, for each key, the transitions that successful runs have taken up; current
transitions are joined with it and those it lacks are the work of the next run. What a
run has taken is written as files of its own, and one atomic rename makes them part of
the state, so a run that dies in between neither skips nor repeats records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.normal import content_hash
from ..session import Versions, materialize, release, scratch_path

#: Deliveries of one key beyond which its history is compared in monthly slabs.
HOT_KEY_DELIVERIES = 100_000


def _latest(cols: Sequence[str]) -> Column:
    present = [F.col(c) for c in cols]
    return present[0] if len(present) == 1 else F.greatest(*present)


def deliveries(df: DataFrame, name: str, key: str, time_cols: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """``(table_name, rec_key, ts, hash)``: a row per delivery with its time, the latest of ``time_cols``
    that isn't null, and the hash of all columns but the key, ``time_cols`` and ``ignore``."""
    skip = {key, *time_cols, *ignore}
    content = [c for c in df.columns if c not in skip]
    return df.select(F.lit(name).alias("table_name"), F.col(key).alias("rec_key"), _latest(time_cols).alias("ts"), content_hash(content).alias("hash"))


def transitions(rows: DataFrame, hot: int = HOT_KEY_DELIVERIES) -> DataFrame:
    """``(table_name, rec_key, ts, hash)`` of each delivery that shows a new state of its record.

    Order is by ``ts``; deliveries without a time come first; equal times are ordered by
    hash. Repeated rows count once. A null key is a record of its own. Records whose
    content never changes are settled by one aggregation with map-side combine; only the
    rest is sorted, and keys with more than ``hot`` deliveries are sorted in monthly slabs
    whose borders are compared afterwards.
    """
    rec = ["table_name", "rec_key"]
    per_key = rows.groupBy(*rec).agg(
        F.count("*").alias("n"),
        F.min("hash").alias("lo"),
        F.max("hash").alias("hi"),
        F.min("ts").alias("first_ts"),
        F.count_if(F.col("ts").isNull()).alias("n_null"),
    )
    per_key = materialize(per_key, "p1-keys")
    steady = per_key.where("lo = hi").select(
        *rec, F.when(F.col("n_null") > 0, None).otherwise(F.col("first_ts")).alias("ts"), F.col("lo").alias("hash")
    )
    changing = per_key.where("lo <> hi").select(F.col("table_name").alias("t"), F.col("rec_key").alias("k"), (F.col("n") > hot).alias("is_hot"))
    same = (F.col("table_name") == F.col("t")) & F.col("rec_key").eqNullSafe(F.col("k"))
    some = rows.join(changing, same).groupBy(*rec, "is_hot", "ts", "hash").count()
    some = some.withColumn("slab", F.when(F.col("is_hot") & F.col("ts").isNotNull(), F.date_format("ts", "yyyyMM").cast("int")).otherwise(0))
    inner = Window.partitionBy(*rec, "slab").orderBy(F.col("ts").asc_nulls_first(), "hash")
    marked = some.withColumn("prev", F.lag("hash").over(inner)).withColumn("at", F.row_number().over(inner))
    # Borders of slabs: the last hash of the slab before. Only hot keys have more than one slab.
    borders = some.where("is_hot").groupBy(*rec, "slab").agg(
        F.max_by("hash", F.struct(F.col("ts").isNotNull(), "ts", "hash")).alias("last")
    )
    outer = Window.partitionBy(*rec).orderBy("slab")
    borders = borders.select(F.col("table_name").alias("t"), F.col("rec_key").alias("k"), F.col("slab").alias("bs"), F.lag("last").over(outer).alias("before"))
    first = (F.col("at") == 1) & F.col("is_hot")
    cold = marked.where(~first).select(*rec, "ts", "hash", "prev")
    warm = marked.where(first).join(borders, same & (F.col("slab") == F.col("bs")), "left").select(*rec, "ts", "hash", F.col("before").alias("prev"))
    moved = cold.unionByName(warm).where(F.col("prev").isNull() | (F.col("prev") != F.col("hash")))
    out = steady.unionByName(moved.select(*rec, "ts", "hash"))
    out._scratch = per_key._scratch  # what may be released once the result is written
    return out


def windows_of_runs(runs: DataFrame) -> DataFrame:
    """Per table the merged windows ``(after, until]`` of its successful runs, as a sorted array.

    Null ``delta_after`` means from the beginning, null ``delta_until`` of a successful
    run without end. Overlapping windows merge, so the array stays as short as the
    number of gaps. Runs without a table name are left out.
    """
    ok = runs.where(F.lower(F.trim("status")) == "success").select(
        F.lower(F.trim("table_name")).alias("table_name"),
        F.coalesce("delta_after", F.expr("timestamp_ntz'0001-01-01 00:00:00'")).alias("after"),
        F.coalesce("delta_until", F.expr("timestamp_ntz'9999-12-31 23:59:59.999999'")).alias("until"),
    )
    ok = ok.where("table_name is not null and after < until").distinct()
    w = Window.partitionBy("table_name").orderBy("after", "until")
    reach = ok.withColumn("reach", F.max("until").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    island = reach.withColumn("island", F.sum(F.when(F.col("after") <= F.col("reach"), 0).otherwise(1)).over(w))
    merged = island.groupBy("table_name", "island").agg(F.min("after").alias("after"), F.max("until").alias("until"))
    return merged.groupBy("table_name").agg(F.array_sort(F.collect_list(F.struct("after", "until"))).alias("windows"))


class RecordState:
    """Versioned state of taken transitions, ``(table_name, rec_key, ts, hash)``, in a shared folder.

    A version is a list of folders, one for each commit until ``compact_after`` of them are
    written as one.
    """

    COLS = ("table_name", "rec_key", "ts", "hash")

    def __init__(self, spark: SparkSession, path: str, compact_after: int = 16):
        self.spark, self.versions, self.compact_after = spark, Versions(spark, path), compact_after
        self._seen: int | None = None

    def version(self) -> int:
        return self.versions.current()[0]

    def read(self) -> DataFrame | None:
        self._seen, files = self.versions.current()
        return self.spark.read.parquet(*files["taken"]) if files else None

    def pending(self, current: DataFrame) -> DataFrame:
        """The transitions of ``current`` that the state lacks."""
        taken = self.read()
        if taken is None:
            return current
        c, t = current.alias("c"), taken.alias("t")
        same = (
            (F.col("c.table_name") == F.col("t.table_name"))
            & F.col("c.rec_key").eqNullSafe(F.col("t.rec_key"))
            & F.col("c.ts").eqNullSafe(F.col("t.ts"))
            & (F.col("c.hash") == F.col("t.hash"))
        )
        return c.join(t, same, "left_anti")

    def commit(self, taken: DataFrame) -> int:
        """Add ``taken`` to the state as it was last read; fails with StaleVersion if another run has added to it since."""
        seen, files = self.versions.current()
        base = seen if self._seen is None else self._seen
        parts, path = list(files.get("taken", [])), self.versions.fresh("taken")
        out = taken.select(*self.COLS)
        if len(parts) >= self.compact_after:
            out, parts = out.unionByName(self.spark.read.parquet(*parts).select(*self.COLS)), []
        out.write.parquet(path)
        self._seen = self.versions.commit(base, {"taken": [*parts, path]})
        self.versions.drop_old()
        return self._seen


def taken_by_runs(current: DataFrame, runs: DataFrame) -> DataFrame:
    """The transitions whose time lies in a window of a successful run of their table."""
    w = windows_of_runs(runs)
    inside = F.exists("windows", lambda x: (F.col("ts") > x["after"]) & (F.col("ts") <= x["until"]))
    return current.join(w, "table_name").where(F.col("ts").isNotNull() & inside).select(*current.columns)


def records_to_process(tables: dict[str, tuple[DataFrame, str]], runs: DataFrame, state: RecordState | None = None) -> DataFrame:
    """``(table_name, rec_key)`` that the next run must take up.

    ``tables`` maps a name to (rows, key column). Without a state one is built by
    replaying the successful runs. Rows may carry any further columns; all but the
    delivery columns count as content.
    """
    spark = runs.sparkSession
    rows = None
    for name, (df, key) in tables.items():
        part = deliveries(df, name.lower(), key, ["nd_extracted_date", "nd_updated_at"], ["nd_operation"])
        rows = part if rows is None else rows.unionByName(part)
    found = transitions(rows)
    current = materialize(found, "p1-transitions")
    release(found)
    if state is None:
        state = RecordState(spark, scratch_path(spark, "p1-state"))
        state.commit(taken_by_runs(current, runs))
    return state.pending(current).select("table_name", "rec_key").distinct()
