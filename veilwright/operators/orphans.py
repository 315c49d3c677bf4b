"""References to records that don't exist, as keyed pending-orphan state.

New references probe the parent index; those without a live parent wait in the state.
Arriving parents resolve waiting references, deletions reopen them, and counts can be
taken per table and period at any moment. A step writes what it changes and no more: the
state is the last entry of each reference and parent key over the steps, so any sequence
of steps gives what one step over everything would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normal import id_text, is_active
from ..session import Versions, path_exists

REF = "child_table string, child_id bigint, ref_column string, ref_key string, child_time timestamp_ntz"
REF_COLS = ["child_table", "child_id", "ref_column", "ref_key", "child_time"]


def references(df: DataFrame, child_table: str, child_id: str, ref_columns: str | Sequence[str], time_col: str) -> DataFrame:
    """References of one or more columns, from one scan; null and blank ids are none.

    Numeric ids in any writing become one key.
    """
    cols = [ref_columns] if isinstance(ref_columns, str) else list(ref_columns)
    kinds = dict(df.dtypes)
    key = lambda c: (F.col(c) if kinds[c] in ("bigint", "int") else id_text(F.col(c))).cast("string")
    refs = F.array(*[F.struct(F.lit(c).alias("ref_column"), key(c).alias("ref_key")) for c in cols])
    rows = df.select(F.lit(child_table).alias("child_table"), F.col(child_id).cast("bigint").alias("child_id"), F.col(time_col).alias("child_time"), F.explode(refs).alias("_r"))
    return rows.select("child_table", "child_id", "_r.ref_column", "_r.ref_key", "child_time").where("ref_key is not null")


def parent_index(df: DataFrame, key: str, ref_column: str, created: str, active: str | None = None) -> DataFrame:
    """``(ref_column, ref_key, alive, since)``: one row per parent key, however many rows it has.

    ``since`` is the earliest creation of its active rows, null if none has one.
    """
    live = is_active(F.col(active)) if active else F.lit(True)
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.lit(ref_column).alias("ref_column"), F.col(key).cast("string").alias("ref_key"))
        .agg(F.bool_or(live).alias("alive"), F.min(F.when(live, F.col(created))).alias("since"))
    )


def parent_changes(df: DataFrame, key: str, ref_column: str, created: str, before: Column, now: Column, active_before: Column | None = None, active_now: Column | None = None) -> DataFrame:
    """Index entries of the keys whose entry isn't what it was: ``before`` and ``now`` tell which rows were and are there,
    ``active_before`` and ``active_now`` which are active. A key none of whose rows is there any more has a null ``alive``."""
    one = F.col(key)
    was, live = (F.lit(True) if a is None else a for a in (active_before, active_now))
    alive = lambda there, act: F.bool_or(F.when(there, act))
    since = lambda there, act: F.min(F.when(there & act, F.col(created)))
    out = df.where(one.isNotNull()).groupBy(F.lit(ref_column).alias("ref_column"), one.cast("string").alias("ref_key")).agg(
        alive(before, was).alias("a0"), since(before, was).alias("s0"), alive(now, live).alias("alive"), since(now, live).alias("since"))
    return out.where(~(F.col("a0").eqNullSafe(F.col("alive")) & F.col("s0").eqNullSafe(F.col("since")))).drop("a0", "s0")


def kind_of(alive: Column, since: Column, child_time: Column) -> Column:
    """missing, deleted, late or null (resolved in time)."""
    return F.when(alive.isNull(), "missing").when(~alive, "deleted").when(since > child_time, "late")


def probe(refs: DataFrame, index: DataFrame, how: str = "left") -> DataFrame:
    """References with their ``kind`` by an index of one row a key; null for those resolved in time.

    Nothing here needs the join's partitioning, so AQE can split a key that holds a large
    share of the references as long as the next step is a write or an exchange.
    """
    kind = kind_of(F.col("alive"), F.col("since"), F.col("child_time")).alias("kind")
    return refs.select(*REF_COLS).join(index.select("ref_column", "ref_key", "alive", "since"), ["ref_column", "ref_key"], how).select(*REF_COLS, kind)


class OrphanState:
    """Versioned state: entries of references that wait or were late, and of parent keys, each with the step that wrote it."""

    def __init__(self, spark: SparkSession, path: str, compact_after: int = 16):
        self.spark, self.versions, self.compact_after = spark, Versions(spark, path), compact_after

    def _last(self, files: dict, part: str, keys: Sequence[str], schema: str, before: int | None = None) -> DataFrame:
        """The last entry of each key over the steps, with map-side combine."""
        paths = [p for q in files.get("steps", []) if path_exists(self.spark, p := f"{q}/{part}")]
        df = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        rest = [c for c in df.columns if c not in (*keys, "step")]
        return df.groupBy(*keys).agg(F.max(F.struct("step", *rest)).alias("x")).select(*keys, "x.*")

    def _orphans(self, files: dict) -> DataFrame:
        return self._last(files, "orphans", REF_COLS, f"{REF}, kind string, step int").where("kind is not null").drop("step")

    def _parents(self, files: dict) -> DataFrame:
        return self._last(files, "parents", ["ref_column", "ref_key"], "ref_column string, ref_key string, alive boolean, since timestamp_ntz, step int").drop("step")

    def read(self) -> DataFrame | None:
        """The present orphans, each once."""
        n, files = self.versions.current()
        return self._orphans(files) if n else None

    def advance(self, new_refs: DataFrame, changes: DataFrame, taken: DataFrame | None = None) -> DataFrame:
        """Take in new references and the index entries of changed parents; returns the new state.

        ``changes`` has one row per changed key as :func:`parent_index` or
        :func:`parent_changes` give it; ``alive`` is null for a parent that is gone.
        ``taken`` holds the references of earlier steps (usually the child tables as they
        were); without it references that were resolved can't be reopened. References
        whose parent changed get their kind anew: those that wait from the state, those
        that were resolved from ``taken``. Each of the three joins meets one row a key on
        its right side and ends in a write, so AQE can split a key that holds a large
        share of the references. The step is complete on disk before its version is, so a
        failed call changes nothing.
        """
        base, files = self.versions.current()
        step, path = F.lit(base + 1).alias("step"), self.versions.fresh("step")
        key = ["ref_column", "ref_key"]
        entry = changes.select(*key, "alive", F.col("since").cast("timestamp_ntz").alias("since"))
        if base:
            old = self._parents(files).select(*key, F.coalesce("alive", F.lit(False)).alias("was_alive"))
            entry = entry.join(old, key, "left")
        else:
            entry = entry.withColumn("was_alive", F.lit(False))
        entry.select(*key, "alive", "since", step, "was_alive").write.parquet(f"{path}/parents")
        moved = self.spark.read.parquet(f"{path}/parents")
        index = self._parents({"steps": [*files.get("steps", []), path]})
        out = probe(new_refs, index).where("kind is not null")
        if base:
            out = out.unionByName(probe(self._orphans(files), moved, "inner"))
            if taken is not None:
                out = out.unionByName(probe(taken, moved.where("was_alive"), "inner"))
        out.select(*REF_COLS, "kind", step).write.parquet(f"{path}/orphans")
        steps = [*files.get("steps", []), path]
        if len(steps) > self.compact_after:
            steps = [self._compact(steps, step)]
        self.versions.commit(base, {"steps": steps})
        self.versions.drop_old()
        return self.read()

    def _compact(self, steps: list[str], step: Column) -> str:
        path, files = self.versions.fresh("step"), {"steps": steps}
        self._parents(files).where("alive is not null").select("ref_column", "ref_key", "alive", "since", step).write.parquet(f"{path}/parents")
        self._orphans(files).select(*REF_COLS, "kind", step).write.parquet(f"{path}/orphans")
        return path


def orphan_counts(state: DataFrame, period: str = "month") -> DataFrame:
    """Orphans per table, column, kind and period of extraction (null time: period null)."""
    return (
        state.groupBy("child_table", "ref_column", "kind", F.date_format(F.date_trunc(period, "child_time"), "yyyy-MM-dd").alias("period"))
        .agg(F.countDistinct("child_id").alias("n_records"), F.count("*").alias("n_references"))
    )
