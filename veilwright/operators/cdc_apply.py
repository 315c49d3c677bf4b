"""Applying a change log to a staging table: what each event does, and the table after all of them.

Rows are never removed: a delete sets the active flag to N. An event's effect depends on
whether its key was there before it, that is on the key's birth (in the table, or by its
first insert or update), so outcomes come from one join with births and the new table
from one fold, both with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Versions
from .cdc import decode_literal, merge_tables, parse_inserts, split_arguments
from .change_feed import SEQ, sequence

#: The counters of a run.
COUNTERS = ["inserted", "refreshed", "unchanged", "updated", "update_where_none", "soft_deleted", "delete_no_match", "errors_delete_no_where", "errors_delete", "insert_select", "errors", "errors_update",
            "errors_update_prod", "errors_insert_none_fmt", "errors_insert", "errors_insert_no_pk", "errors_insert_select", "errors_insert_select_select", "insert_select_no_rows", "errors_insert_select_insert",
            "errors_insert_mismatch", "skipped_row_based"]


def row_events(log: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``(seq, op, image)`` of row events; ``image`` maps column names to decoded values.

    ``columns`` maps payload positions to columns. Events without a position in the log
    have no order and are left out; unknown operations have a null ``op``.
    """
    first = F.upper(F.substring(F.trim("operation"), 1, 1))
    op = F.when(first == "I", "INSERT").when(first == "U", "UPDATE").when(first == "D", "DELETE")
    m = F.from_json("payload", "map<string,string>")
    pairs = [F.struct(F.lit(c).alias("key"), decode_literal(m[p]).alias("value")) for p, c in columns.items()]
    given = F.filter(F.array(*pairs), lambda e: F.map_contains_key(m, F.element_at(F.create_map(*[x for p, c in columns.items() for x in (F.lit(c), F.lit(p))]), e["key"])))
    seq = sequence(F.col("binlog_file"), F.col("binlog_pos"), F.col("id"))
    ev = log.select(seq.alias("seq"), op.alias("op"), F.when(m.isNotNull(), F.map_from_entries(given)).alias("image"))
    return ev.where("seq.file is not null and seq.pos is not null")


def base_rows(table: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``(k, nd_operation, nd_activeflag, <columns>)`` of a staging table; rows without key are left out, of several rows the greatest counts."""
    have = {c.lower() for c in table.columns}
    opt = lambda c, d: F.coalesce(F.col(c), F.lit(d)) if c in have else F.lit(d)
    rows = table.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k"), F.struct(opt("nd_operation", "NONE").alias("nd_operation"), opt("nd_activeflag", "Y").alias("nd_activeflag"), *[F.col(c).cast("string").alias(c) for c in cols]).alias("r"))
    return rows.groupBy("k").agg(F.max("r").alias("r")).select("k", "r.*")


def _keyed(base: DataFrame, events: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Events with their key ``k``; deletes without one get the keys of the rows that equal their image at that time."""
    ev = events.withColumn("k", F.col("image")[key])
    lost = ev.where("op = 'DELETE' and k is null and size(map_filter(image, (c, v) -> v is not null)) > 0").select("seq", "image")
    start = F.struct(*[F.lit(-1).cast("bigint").alias(f) for f in ("file", "pos", "id")]).cast(SEQ)
    steps = base.select("k", start.alias("seq"), *[F.struct(F.col(c).alias("v")).alias(c) for c in cols]).unionByName(
        ev.where("op in ('INSERT', 'UPDATE') and k is not null").select("k", "seq", *[F.when(F.map_contains_key("image", F.lit(c)), F.struct(F.col("image")[c].alias("v"))).alias(c) for c in cols]))
    w = Window.partitionBy("k").orderBy("seq")
    versions = steps.select("k", "seq", F.lead("seq").over(w).alias("until"), *[F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))["v"].alias(c) for c in cols])
    # All cells an image gives must agree; the join goes by a hash of the columns it gives, of which logs have few sets.
    shape = F.concat_ws(",", *[F.when(F.map_contains_key("image", F.lit(c)), F.lit(c)) for c in cols])
    shapes = [r[0] for r in lost.select(shape.alias("s")).distinct().collect()]
    found = None
    for s in shapes:
        names = s.split(",") if s else []
        if not names:
            continue
        h = lambda cells: F.xxhash64(*cells)
        a = lost.where(shape == s).select(F.col("seq").alias("_s"), "image", h([F.coalesce(F.col("image")[c], F.lit("\0")) for c in names]).alias("_h"))
        b = versions.select("*", h([F.coalesce(F.col(c), F.lit("\0")) for c in names]).alias("_h"))
        same = (F.col("seq") < F.col("_s")) & (F.col("until").isNull() | (F.col("until") > F.col("_s")))
        for c in names:
            same = same & F.col("image")[c].eqNullSafe(F.col(c))
        part = a.join(b, "_h").where(same).select(F.col("_s").alias("seq"), F.lit("DELETE").alias("op"), "image", "k")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return ev
    whole = ev.join(found.select(F.col("seq").alias("_s")).distinct(), F.col("seq") == F.col("_s"), "left_anti")
    return whole.unionByName(found)


def apply_row_events(base: DataFrame, events: DataFrame, key: str, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(table ``(k, nd_operation, nd_activeflag, <columns>)``, outcomes ``(seq, k, op, outcome)``) of :func:`row_events` on :func:`base_rows`.

    Inserts keep their key and are refused without one; on a key that is there they
    refresh its row. Updates set the cells they give, or make the row from them; without
    key they are skipped. Deletes are soft, by key or by their whole image; without match
    they do nothing. Repeated events count once.
    """
    ev = _keyed(base, events.dropDuplicates(["seq"]), key, cols)
    writes = F.col("op").isin("INSERT", "UPDATE") & F.col("k").isNotNull()
    first = F.struct(*[F.lit(-1).cast("bigint").alias(f) for f in ("file", "pos", "id")]).cast(SEQ)
    births = base.select("k", first.alias("seq")).unionByName(ev.where(writes).select("k", "seq")).groupBy(F.col("k").alias("_k")).agg(F.min("seq").alias("born"))
    j = ev.join(births, F.col("k") == F.col("_k"), "left").drop("_k")
    there = F.coalesce(F.col("seq") > F.col("born"), F.lit(False))
    outcome = (
        F.when(F.col("image").isNull() | F.col("op").isNull() | (F.size("image") == 0), "skipped_row_based")
        .when((F.col("op") == "INSERT") & F.col("k").isNull(), "errors_insert_no_pk")
        .when((F.col("op") == "UPDATE") & F.col("k").isNull(), "skipped_row_based")
        .when(F.col("op") == "INSERT", F.when(there, "refreshed").otherwise("inserted"))
        .when(F.col("op") == "UPDATE", "updated")
        .when(there, "soft_deleted").otherwise("delete_no_match")
    )
    j = j.withColumn("outcome", outcome)
    took = j.where(F.col("outcome").isin("inserted", "refreshed", "updated", "soft_deleted"))
    flag = F.when(F.col("op") == "DELETE", "N").when((F.col("op") == "INSERT") | (F.col("seq") == F.col("born")), "Y")
    cell = lambda c: F.when((F.col("op") != "DELETE") & F.map_contains_key("image", F.lit(c)), F.struct(F.col("image")[c].alias("v")))
    rows = took.select("k", "seq", F.col("op").alias("nd_operation"), flag.alias("nd_activeflag"), *[cell(c).alias(c) for c in cols])
    rows = rows.unionByName(base.select("k", first.alias("seq"), "nd_operation", "nd_activeflag", *[F.struct(F.col(c).alias("v")).alias(c) for c in cols]))
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("seq", F.col(c).alias("x"))))
    table = rows.groupBy("k").agg(*[last(c).alias(c) for c in ("nd_operation", "nd_activeflag", *cols)])
    return table.select("k", F.col("nd_operation.x").alias("nd_operation"), F.col("nd_activeflag.x").alias("nd_activeflag"), *[F.col(f"{c}.x.v").alias(c) for c in cols]), j.select("seq", "k", "op", "outcome")


def counters(outcomes: DataFrame) -> DataFrame:
    """``(counter, n)`` of all counters, those that never occur with 0."""
    spark = outcomes.sparkSession
    every = spark.createDataFrame([(c,) for c in COUNTERS], "counter string")
    n = outcomes.groupBy(F.col("outcome").alias("counter")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(n, "counter", "left").select("counter", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def run_day(spark: SparkSession, path: str, log: DataFrame, columns: dict[str, str], key: str, prod: DataFrame) -> dict[str, int]:
    """One run of a table under ``path``: the log's events from the last position on go to a staging table, which is merged into production rows.

    The version holds the merged table, the counters and the position reached; all of it
    becomes visible together, and events up to that position are never taken twice.
    ``prod`` is where the first run starts from. Returns the counters that aren't 0.
    """
    cols = list(dict.fromkeys(columns.values()))
    versions = Versions(spark, path)
    n, files = versions.current()
    base = spark.read.parquet(*files["table"]) if n else base_rows(prod, key, cols)
    events = row_events(log, columns)
    if n and files["position"]:
        events = events.where(F.col("seq") > F.struct(*[F.lit(x).cast("bigint").alias(f) for f, x in zip(("file", "pos", "id"), files["position"], strict=True)]))
    staged, outcomes = apply_row_events(base, events, key, cols)
    table, counts = versions.fresh("table"), versions.fresh("counters")
    merge_tables(base, staged.select(*base.columns), "k").write.parquet(table)
    counters(outcomes).write.parquet(counts)
    last = events.agg(F.max("seq").alias("s")).first()["s"]
    reached = list(last) if last is not None else files.get("position", [])
    versions.commit(n, {"table": [table], "counters": [counts], "position": reached})
    return {r["counter"]: r["n"] for r in spark.read.parquet(counts).where("n > 0").collect()}


# --- statements ---------------------------------------------------------------------------
def read_statement(sql: str | None, key: str) -> list[dict]:
    """Row events of one statement: op, key literal, image of literals, and the counter where nothing can be applied.

    Inserts give a row for each tuple of VALUES, or one for SET. Updates and deletes are
    read where their condition is equality with the key; others are counted.
    """
    import re

    none = lambda outcome, op=None: [{"op": op, "key": None, "image": None, "outcome": outcome}]
    s = (sql or "").strip().rstrip(";")
    if re.match(r"(?is)^(insert|replace)\b", s):
        rows = parse_inserts(s)
        if rows is None:
            return none("insert_select" if re.search(r"(?is)\bselect\b", s) else "errors_insert_none_fmt", "INSERT")
        low = [{c.lower(): v for c, v in r.items()} for r in rows]
        return [{"op": "INSERT", "key": r.get(key), "image": r, "outcome": None if r else "errors_insert_mismatch"} for r in low]
    where = rf"(?is)\bwhere\s+\(?\s*`?{re.escape(key)}`?\s*=\s*([^\s()]+|'(?:[^'\\]|\\.)*')\s*\)?(?:\s+limit\s+1)?\s*$"
    if re.match(r"(?is)^update\b", s):
        m = re.match(r"(?is)^update\s+[`\w.]+\s+set\s+", s)
        w = re.search(where, s)
        if not w:
            return none("skipped_row_based" if re.search(r"(?is)\bwhere\b", s) else "update_where_none", "UPDATE")
        if not m:
            return none("errors_update", "UPDATE")
        pairs = [p.split("=", 1) for p in split_arguments(s[m.end() : w.start()]) if "=" in p]
        return [{"op": "UPDATE", "key": w[1], "image": {c.strip().strip("`").lower(): v.strip() for c, v in pairs} | {key: w[1]}, "outcome": None}]
    if re.match(r"(?is)^delete\b", s):
        if not re.search(r"(?is)\bwhere\b", s):
            return none("errors_delete_no_where", "DELETE")
        w = re.search(where, s)
        if not w or re.search(r"(?is)\bjoin\b", s):
            return none("errors_delete", "DELETE")
        return [{"op": "DELETE", "key": w[1], "image": {key: w[1]}, "outcome": None}]
    return none("errors")


def statement_events(log: DataFrame, key: str, sql: Column) -> tuple[DataFrame, DataFrame]:
    """(row events as of :func:`row_events`, ``(seq, outcome)`` of statements that give none) of a log with raw statements."""

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("op", T.StringType()), T.StructField("key", T.StringType()), T.StructField("image", T.MapType(T.StringType(), T.StringType())), T.StructField("outcome", T.StringType())])))
    def read(text: pd.Series) -> pd.Series:
        return text.map(lambda t: read_statement(t, key))

    seq = sequence(F.col("binlog_file"), F.col("binlog_pos"), F.col("id"))
    rows = log.select(seq.alias("seq"), F.posexplode(read(sql)).alias("n", "e")).where("seq.file is not null and seq.pos is not null")
    # Rows of one statement stand in order at one position.
    at = F.struct(F.col("seq.file").alias("file"), F.col("seq.pos").alias("pos"), (F.col("seq.id") * 1_000_000 + F.col("n")).alias("id"))
    good = rows.where("e.outcome is null").select(at.alias("seq"), "e.op", F.transform_values("e.image", lambda _, v: decode_literal(v)).alias("image"))
    return good, rows.where("e.outcome is not null").select("seq", "e.outcome")

