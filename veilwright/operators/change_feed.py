"""Applying a feed of inserts, updates and deletes (merge on read with equality deletes).

Upserts are appended to data files and deletes to equality-delete files, both with
their sequence number. Readers drop every data row that a later delete of its key
covers and fold the rest column by column, so late and repeated events need no rewrite.
A version of the table names its files; batches become visible whole, with one rename.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Versions, path_exists

SEQ = "struct<file:bigint,pos:bigint,id:bigint>"


def sequence(file: Column, pos: Column, event_id: Column) -> Column:
    """Order of an event: number after the dot of the log file, position, id."""
    number = F.regexp_extract(file, r"\.(\d+)\s*$", 1).try_cast("bigint")
    return F.struct(number.alias("file"), pos.cast("bigint").alias("pos"), event_id.cast("bigint").alias("id"))


def literal(c: Column) -> Column:
    """Value of a log literal: quoted text is unescaped, NULL in any case is null, the rest stays."""
    quoted = c.rlike(r"(?s)^'.*'$") & (F.length(c) >= 2)
    body = F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), r"''", "'")
    # Backslash escapes: control characters first, then the escaped character itself.
    parts = F.split(body, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.regexp_replace(F.replace(F.replace(F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t")), F.lit("\\r"), F.lit("\r")), F.lit("\\0"), F.lit("\0")), r"\\(.)", "$1"))
    return F.when(F.upper(F.trim(c)) == "NULL", None).when(quoted, F.array_join(plain, "\\")).otherwise(c)


def decode_events(log: DataFrame, columns: dict[str, str], key: str) -> DataFrame:
    """``(k, op, seq, seen, <columns>)`` of row events; ``columns`` maps payload position to column.

    ``seen`` tells which columns the event gave; a position that isn't in the payload
    leaves its column as it was, one that is null sets null. Events without key, with an
    unknown operation or without a position are left out; JSON that can't be read has no key.
    """
    fields = F.from_json("payload", "map<string,string>")
    first = F.upper(F.substring(F.trim("operation"), 1, 1))
    op = F.when(first == "I", "INSERT").when(first == "U", "UPDATE").when(first == "D", "DELETE")
    ev = log.select(op.alias("op"), sequence(F.col("binlog_file"), F.col("binlog_pos"), F.col("id")).alias("seq"), fields.alias("_m"))
    vals = [literal(F.col("_m")[p]).alias(c) for p, c in columns.items()]
    seen = F.struct(*[F.map_contains_key("_m", F.lit(p)).alias(c) for p, c in columns.items()])
    ev = ev.select("op", "seq", seen.alias("seen"), *vals)
    ev = ev.withColumn("k", F.col(key).try_cast("bigint"))
    return ev.where(F.col("k").isNotNull() & F.col("op").isNotNull() & F.col("seq.pos").isNotNull() & F.col("seq.file").isNotNull())


class ChangeTable:
    """A table of append-only data and equality-delete files under one path, in versions."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str]):
        self.spark, self.columns, self.versions = spark, columns, Versions(spark, path)

    def _append(self, rows: DataFrame) -> None:
        """One write of rows ``(deleted, k, op, seq, seen, <columns>)``, divided into data and deletes, then one commit."""
        base, files = self.versions.current()
        path = self.versions.fresh("batch")
        rows.write.partitionBy("deleted").parquet(path)
        new = {name: [p] if path_exists(self.spark, p := f"{path}/deleted={flag}") else [] for name, flag in (("data", "false"), ("deletes", "true"))}
        self.versions.commit(base, {k: files.get(k, []) + v for k, v in new.items()})

    def append_base(self, rows: DataFrame, key: str) -> None:
        """Rows of a dump: before every event, all columns given, operation NONE."""
        seen = F.struct(*[F.lit(True).alias(c) for c in self.columns])
        first = F.lit(-1).cast("bigint")
        out = rows.where(F.col(key).isNotNull()).select(
            F.lit(False).alias("deleted"), F.col(key).cast("bigint").alias("k"), F.lit("NONE").alias("op"),
            F.struct(first.alias("file"), first.alias("pos"), first.alias("id")).alias("seq"),
            seen.alias("seen"), *[F.col(c).cast("string").alias(c) for c in self.columns],
        )
        self._append(out)

    def append_events(self, events: DataFrame) -> None:
        """Upserts to the data files, deletes to the delete files, in one pass over the log.

        Batches may come in any order and more than once: readers go by sequence number.
        """
        gone = F.col("op") == "DELETE"
        value = lambda c: F.when(~gone, F.col(c).cast("string")).alias(c)
        seen = F.struct(*[F.col(f"seen.{c}").alias(c) for c in self.columns])
        self._append(events.select(gone.alias("deleted"), "k", "op", "seq", seen.alias("seen"), *[value(c) for c in self.columns]))

    def _part(self, name: str) -> DataFrame:
        files = self.versions.current()[1].get(name, [])
        if files:
            return self.spark.read.parquet(*files)
        seen = ", ".join(f"{c}: boolean" for c in self.columns)
        return self.spark.createDataFrame([], f"k bigint, op string, seq {SEQ}, seen struct<{seen}>, {', '.join(f'{c} string' for c in self.columns)}")

    def _folded(self) -> DataFrame:
        """``(k, op, seq, <columns>)``: the last row of each key and, as (seq, v), the value each column was given last, where no later delete covers them.

        Data rows and deletes are folded per key before they are shuffled, so both sides
        of the anti-join have one row a key, however many events it has. A delete covers
        the row, or else the values given before it.
        """
        last = lambda c: F.max(F.when(F.col(f"seen.{c}"), F.struct("seq", F.col(c).alias("v")))).alias(c)
        data = self._part("data").groupBy("k").agg(F.max(F.struct("seq", "op")).alias("last"), *[last(c) for c in self.columns])
        dels = self._part("deletes").groupBy(F.col("k").alias("dk")).agg(F.max("seq").alias("dseq"))
        covered = lambda seq: F.coalesce(F.col("dseq") > seq, F.lit(False))
        live = data.join(dels, F.col("k") == F.col("dk"), "left").where(~covered(F.col("last.seq")))
        return live.select("k", "last.op", "last.seq", *[F.when(~covered(F.col(f"{c}.seq")), F.col(c)).alias(c) for c in self.columns])

    def read(self) -> DataFrame:
        """Current rows ``(k, nd_operation, <columns>)``; each column has the value given last since the key's last delete.

        Of events with one sequence number and key the greater value counts.
        """
        return self._folded().select("k", F.col("op").alias("nd_operation"), *[F.col(f"{c}.v").alias(c) for c in self.columns])

    def compact(self) -> None:
        """Write what is current as one set of data files, and one delete for each key that had any, so late events still meet it."""
        base, _ = self.versions.current()
        data, gone = self.versions.fresh("data"), self.versions.fresh("deletes")
        rows = self._folded()
        nothing = {c: F.lit(None).cast("string").alias(c) for c in self.columns}
        flags = lambda own: F.struct(*[F.lit(c == own).alias(c) for c in self.columns]).alias("seen")
        out = rows.select("k", "op", "seq", flags(None), *nothing.values())
        for own in self.columns:  # values have sequence numbers of their own
            given = rows.where(F.col(own).isNotNull())
            out = out.unionByName(given.select("k", "op", F.col(f"{own}.seq").alias("seq"), flags(own), *[F.col(f"{c}.v").alias(c) if c == own else nothing[c] for c in self.columns]))
        out.write.parquet(data)
        self._part("deletes").groupBy("k").agg(F.max("seq").alias("seq")).write.parquet(gone)
        self.versions.commit(base, {"data": [data], "deletes": [gone]})
        self.versions.drop_old()


def latest_dump(meta: DataFrame, table: str) -> DataFrame:
    """``(dump_seq)`` of the completed dump of ``table`` that ended last."""
    done = meta.where((F.lower(F.trim("table_name")) == table) & F.col("dump_completed_at").isNotNull())
    s = sequence(F.col("binlog_file"), F.col("binlog_pos"), F.lit(-1))
    return done.agg(F.max_by(s, F.struct("dump_completed_at", s)).alias("dump_seq"))
