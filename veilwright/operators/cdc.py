"""Change data capture: reading logs, decoding values, classifying statements, folding state, merging."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Versions
from .change_feed import literal, sequence

AUDIT = ["nd_extracted_date", "nd_updated_at", "nd_operation", "nd_activeflag"]


def after_position(log: DataFrame, meta: DataFrame) -> DataFrame:
    """Events at or after the dump position of their table; events without file are dropped, tables without dump keep all."""
    m = meta.where("binlog_file is not null").groupBy(F.lower(F.trim("table_name")).alias("_t")).agg(
        F.max_by(F.struct("binlog_file", "binlog_pos"), "dump_completed_at").alias("_d"))
    s = lambda f, p: F.struct(F.regexp_extract(f, r"\.(\d+)$", 1).try_cast("bigint"), p)
    j = log.where("binlog_file is not null").join(m, F.lower(F.trim("table_name")) == F.col("_t"), "left")
    ok = F.col("_d").isNull() | (s(F.col("binlog_file"), F.col("binlog_pos")) >= s(F.col("_d.binlog_file"), F.col("_d.binlog_pos")))
    return j.where(ok).select(*log.columns)


def latest_snapshot(meta: DataFrame, day: Column, days: int = 30, base: str | None = None) -> DataFrame:
    """``(table_name, dump_file)``: of each table the last dump completed in the days before ``day``, else ``base``."""
    at = F.col("dump_completed_at")
    recent = (at >= day - F.make_dt_interval(F.lit(days))) & (at < day)
    return meta.groupBy(F.lower(F.trim("table_name")).alias("table_name")).agg(F.coalesce(F.max_by("dump_file", F.when(recent, at)), F.lit(base)).alias("dump_file"))


def without_generated(payload: Column, positions: Sequence[str]) -> Column:
    """A positional payload as a map without the columns that the database computes."""
    return F.map_filter(F.from_json(payload, "map<string,string>"), lambda k, _: ~k.isin(list(positions)))


def log_page(log: DataFrame, n: int, after: tuple[int, int, int] | None = None) -> DataFrame:
    """The next ``n`` events of a log in the order of file number, position and id, after the last one taken."""
    rows = log.withColumn("_seq", sequence(F.col("binlog_file"), F.col("binlog_pos"), F.col("id"))).where("_seq.file is not null and _seq.pos is not null")
    if after is not None:
        rows = rows.where(F.col("_seq") > F.struct(*[F.lit(x).cast("bigint").alias(k) for k, x in zip(("file", "pos", "id"), after, strict=True)]))
    return rows.orderBy("_seq").limit(n).drop("_seq")


def id_validation(here: DataFrame, there: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(summary ``(kind, n_ids)``, detail ``(key, kind, here, there)``) of two environments' ids: missing on a side, or of another value."""
    a, b = (df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.array_sort(F.collect_set(F.col(value).cast("string"))).alias(n)) for df, n in ((here, "here"), (there, "there")))
    kind = F.when(F.col("there").isNull(), "missing_there").when(F.col("here").isNull(), "missing_here").when(~F.col("here").eqNullSafe(F.col("there")), "mismatch")
    detail = a.join(b, "key", "full").select("key", kind.alias("kind"), F.array_join("here", ",").alias("here"), F.array_join("there", ",").alias("there")).where("kind is not null")
    return detail.groupBy("kind").agg(F.count(F.lit(1)).alias("n_ids")), detail


def insert_format(sql: Column) -> Column:
    """VALUES, SET or INSERT_SELECT form of an insert statement, else null."""
    return F.when(sql.rlike(r"(?is)^\s*(?:insert|replace)\b.*?\bvalues?\s*\("), "VALUES").when(sql.rlike(r"(?is)^\s*(?:insert|replace)\b.*?\bset\b"), "SET").when(sql.rlike(r"(?is)^\s*(?:insert|replace)\b.*?\bselect\b"), "INSERT_SELECT")


def delete_kind(sql: Column) -> Column:
    """What becomes of a delete statement: a join is flagged, a where clause deletes softly, without one it is refused."""
    return F.when(~sql.rlike(r"(?is)^\s*delete\b"), None).when(sql.rlike(r"(?is)\bjoin\b"), "flag_join").when(sql.rlike(r"(?is)\bwhere\b"), "soft_delete").otherwise("refuse")


def decode_literal(c: Column) -> Column:
    """A log literal as text: quoted text, NULL, hex, bit and signed numbers with their unsigned form; others stay."""
    t = F.trim(c)
    signed = F.regexp_extract(t, r"^(-?\d+)\s+\(\d+\)$", 1)
    hexed = F.regexp_extract(t, r"(?i)^(?:0x|x')([0-9a-f]+)'?$", 1)
    bits = F.regexp_extract(t, r"(?i)^b'([01]+)'$", 1)
    return (
        F.when(signed != "", signed)
        .when(hexed != "", F.decode(F.unhex(hexed), "UTF-8"))
        .when(bits != "", F.conv(bits, 2, 10))
        .otherwise(literal(t))
    )


def ordinals(payload: Column, columns: Sequence[str]) -> Column:
    """Array of ``(column, value)`` of a positional payload; positions out of range are dropped."""
    m = F.from_json(payload, "map<string,string>")
    names = F.array(*[F.lit(c) for c in columns])
    pairs = F.transform(F.map_entries(m), lambda e: F.struct(F.try_element_at(names, e["key"].try_cast("int")).alias("column"), decode_literal(e["value"]).alias("value")))
    return F.filter(pairs, lambda p: p["column"].isNotNull())


def net_effect(events: DataFrame, key: str, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last state per key: each column's last given (non-null) value, last operation and active flag.

    Deletes are soft: the row stays with its last values and flag N.
    """
    o = F.struct(*order)
    return events.groupBy(key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), o)).alias(c) for c in cols],
        F.max_by("op", o).alias("nd_operation"), F.when(F.max_by("op", o) == "DELETE", "N").otherwise("Y").alias("nd_activeflag"),
        F.count("*").alias("n_events"), F.min_by(order[-1], o).alias("first_event"),
    )


def outcome(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Events with ``outcome``: inserted, refreshed, updated, upserted, soft_deleted or unchanged, by what went before."""
    w = Window.partitionBy(key).orderBy(*order)
    prev = F.lag("op").over(w)
    alive = prev.isNotNull() & (prev != "DELETE")
    return df.withColumn("outcome", F.when(F.col("op") == "INSERT", F.when(alive, "refreshed").otherwise("inserted")).when(F.col("op") == "UPDATE", F.when(alive, "updated").otherwise("upserted")).when(alive, "soft_deleted").otherwise("unchanged"))


def merge_tables(prod: DataFrame, staging: DataFrame, key: str, keep: str = "nd_auto_increment_id") -> DataFrame:
    """Staging rows over production rows; the record number of an existing row stays."""
    cols = [c for c in prod.columns if c != key]
    s = staging.select(F.col(key).alias("_k"), F.lit(True).alias("_has"), *[F.col(c).alias(f"_s_{c}") for c in cols])
    j = prod.join(s, F.col(key) == F.col("_k"), "full")
    pick = lambda c: F.coalesce(F.col(c), F.col(f"_s_{c}")) if c == keep else F.when(F.col("_has"), F.col(f"_s_{c}")).otherwise(F.col(c))
    return j.select(F.coalesce(key, "_k").alias(key), *[pick(c).alias(c) for c in cols])


def positions(log: DataFrame) -> DataFrame:
    """``(table_name, binlog_file, binlog_pos, n_events)``: the last position of each table."""
    top = F.max(F.struct(sequence(F.col("binlog_file"), F.col("binlog_pos"), F.lit(0)).alias("s"), "binlog_file", "binlog_pos"))
    return log.where("binlog_file is not null and binlog_pos is not null").groupBy(F.lower(F.trim("table_name")).alias("table_name")).agg(top.alias("t"), F.count("*").alias("n_events")).select("table_name", "t.binlog_file", "t.binlog_pos", "n_events")


def filled_tables(spark: SparkSession, path: str) -> DataFrame:
    """``(table_name)`` of the Parquet tables in a folder that have rows."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in fs.listStatus(hpath)) if fs.exists(hpath) else []
    found = [n[:-8] for n in names if n.endswith(".parquet") and not spark.read.parquet(f"{path}/{n}").isEmpty()]
    return spark.createDataFrame([(n,) for n in found], "table_name string")


def carry_forward(today: DataFrame, before: DataFrame, key: str = "table_name") -> DataFrame:
    """Today's snapshot and the earlier rows of tables it lacks."""
    return today.unionByName(before.join(today.select(key).distinct(), key, "left_anti").select(*today.columns))


def with_audit(df: DataFrame, at: Column) -> DataFrame:
    """Audit columns added or their nulls filled."""
    cols = {c.lower() for c in df.columns}
    fill = {"nd_extracted_date": at, "nd_updated_at": at, "nd_operation": F.lit("INSERT"), "nd_activeflag": F.lit("Y")}
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in cols else v for c, v in fill.items()})


def rename_audit(df: DataFrame) -> DataFrame:
    """Former audit names to the present ones; null and 'Yes' flags become Y."""
    for old, new in (("nd_extracted_at", "nd_extracted_date"), ("nd_is_active", "nd_activeflag")):
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    if "nd_activeflag" in df.columns:
        df = df.withColumn("nd_activeflag", F.when(F.col("nd_activeflag").isNull() | (F.lower("nd_activeflag") == "yes"), "Y").otherwise(F.col("nd_activeflag")))
    return df


def backfill(enc: DataFrame, patients: DataFrame) -> DataFrame:
    """Missing patient surrogates of an encounter map from the patient map."""
    p = patients.groupBy(F.col("patientid").alias("_p")).agg(F.min("nd_patient_id").alias("_nd"))
    return enc.join(p, F.col("patientid") == F.col("_p"), "left").withColumn("nd_patient_id", F.coalesce("nd_patient_id", "_nd")).select(*enc.columns)


# --- log texts ---------------------------------------------------------------------------
_AT = re.compile(r"^# at (\d+)")
_USE = re.compile(r"^use [`']?(\w+)", re.I)
_INSERT_ID = re.compile(r"^SET INSERT_ID=(\d+)", re.I)
_ROW = re.compile(r"^### (INSERT INTO|UPDATE|DELETE FROM) `?(\w+)`?\.`?(\w+)`?", re.I)
_CELL = re.compile(r"^###\s+@(\d+)=(.*)$")
_STATEMENT = re.compile(r"^(INSERT|UPDATE|DELETE|REPLACE)\b", re.I)
_TARGET = re.compile(r"^(?:INSERT\s+(?:IGNORE\s+)?INTO|REPLACE\s+INTO|UPDATE|DELETE\s+FROM)\s+`?(?:(\w+)`?\.`?)?(\w+)`?", re.I)


def parse_log_text(lines: Iterator[str], schemas: set[str] | None = None) -> Iterator[tuple]:
    """``(table, operation, payload, position)`` of one log text in order.

    Row events give payloads by column number (of an update the image after it),
    statements their text and a positive insert id. Schemas outside the list are skipped.
    """
    import json

    pos, schema, insert_id = 0, None, None
    row: tuple[str, str] | None = None
    cells: dict[str, str] = {}
    stmt: list[str] = []

    def wanted(s: str | None) -> bool:
        return schemas is None or (s or "").lower() in schemas

    def flush_row():
        nonlocal row, cells
        if row and cells:
            yield row[1], row[0], json.dumps(cells), pos
        row, cells = None, {}

    def flush_stmt():
        nonlocal stmt, insert_id
        if stmt:
            sql = re.sub(r"[\s;]*(?:/\*!\*/)?[\s;]*$", "", "\n".join(stmt))
            m = _TARGET.match(sql)
            if m and wanted(m[1] or schema):
                body = {"raw_sql": sql}
                op = _STATEMENT.match(sql)[1].upper()
                if op == "INSERT" and insert_id:
                    body["insert_id"] = insert_id
                yield m[2], op, json.dumps(body), pos
            stmt, insert_id = [], None

    for raw in lines:
        line = raw.rstrip("\n")
        if m := _AT.match(line):
            yield from flush_row()
            yield from flush_stmt()
            pos = int(m[1])
        elif m := _USE.match(line):
            schema = m[1]
        elif m := _INSERT_ID.match(line):
            insert_id = int(m[1])
        elif m := _ROW.match(line):
            yield from flush_row()
            op = m[1].split()[0].upper()
            row = (op, m[3]) if wanted(m[2]) else None
        elif m := _CELL.match(line):
            if row:
                cells[m[1]] = re.sub(r"\s*/\*.*\*/\s*$", "", m[2])
        elif line.startswith("###"):
            continue
        elif _STATEMENT.match(line):
            yield from flush_stmt()
            stmt = [line]
        elif stmt and not line.startswith(("#", "/*!", "SET ", "BEGIN", "COMMIT", "DELIMITER")):
            stmt.append(line)
    yield from flush_row()
    yield from flush_stmt()


def read_log_texts(files: DataFrame, schemas: Sequence[str] | None = None) -> DataFrame:
    """Change log of ``files(path, value)`` (whole texts): files are parsed side by side, each in order."""
    allow = {s.lower() for s in schemas} if schemas else None

    def parse(batches):
        for pdf in batches:
            rows = []
            for path, value in zip(pdf["path"], pdf["value"], strict=True):
                name = path.rsplit("/", 1)[-1]
                for k, (t, op, payload, pos) in enumerate(parse_log_text(iter((value or "").split("\n")), allow)):
                    rows.append((t, op, payload, name, pos, k))
            yield pd.DataFrame(rows, columns=["table_name", "operation", "payload", "binlog_file", "binlog_pos", "seq"])

    return files.mapInPandas(parse, "table_name string, operation string, payload string, binlog_file string, binlog_pos bigint, seq bigint")


def split_arguments(text: str) -> list[str]:
    """Comma-separated values outside quotes and parentheses."""
    out, cur, depth, quote, k = [], "", 0, "", 0
    while k < len(text):
        ch = text[k]
        if quote:
            cur += ch
            if ch == "\\" and k + 1 < len(text):
                k += 1
                cur += text[k]
            elif ch == quote:
                quote = ""
        elif ch in "'\"`":
            quote = ch
            cur += ch
        elif ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            depth += (ch == "(") - (ch == ")")
            cur += ch
        k += 1
    return [*out, cur.strip()] if cur.strip() or out else []


def closing(text: str, at: int) -> int:
    """Index of the parenthesis that closes the one at ``at``, quotes and escapes respected; -1 if none does."""
    depth, quote, k = 0, "", at
    while k < len(text):
        ch = text[k]
        if quote:
            if ch == "\\":
                k += 1
            elif ch == quote:
                quote = ""
        elif ch in "'\"`":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return k
        k += 1
    return -1


def parse_inserts(sql: str | None) -> list[dict[str, str]] | None:
    """Column to literal of each row of an insert in VALUES or SET form; null for other statements.

    A row with another number of values than columns is empty.
    """
    if not sql:
        return None
    m = re.match(r"(?is)^\s*(?:insert|replace)\s+(?:ignore\s+)?into\s+[`\w.]+\s*\(", sql)
    if m:
        end = closing(sql, m.end() - 1)
        v = re.match(r"(?is)\s*values?\s*(?=\()", sql[end + 1 :]) if end > 0 else None
        if not v:
            return None
        cols = [c.strip().strip("`") for c in split_arguments(sql[m.end() : end])]
        rows, at = [], end + 1 + v.end()
        while at < len(sql) and sql[at] == "(":
            stop = closing(sql, at)
            if stop < 0:
                return None
            vals = split_arguments(sql[at + 1 : stop])
            rows.append(dict(zip(cols, vals, strict=True)) if len(cols) == len(vals) else {})
            more = re.match(r"\s*,\s*(?=\()", sql[stop + 1 :])
            at = stop + 1 + more.end() if more else len(sql)
        return rows
    m = re.match(r"(?is)^\s*(?:insert|replace)\s+(?:ignore\s+)?into\s+[`\w.]+\s+set\s+(.*?)(?:\s+on\s+duplicate\s+key.*)?;?\s*$", sql)
    if m:
        pairs = [p.split("=", 1) for p in split_arguments(m[1]) if "=" in p]
        return [{c.strip().strip("`"): v.strip() for c, v in pairs}]
    return None


def parse_insert(sql: str | None) -> dict[str, str] | None:
    """The first row of :func:`parse_inserts`; null if it is malformed."""
    rows = parse_inserts(sql)
    return (rows[0] or None) if rows else None


def take_logs(files: DataFrame, out: str, schemas: Sequence[str] | None = None, tables: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> dict[str, int]:
    """Add the events of log texts ``files(path, value)`` that ``out`` lacks to it; names of tables in any letter case.

    Each call is a partition named after its version, which lists the files taken; a call
    that dies leaves no version and its partition is written anew. Returns counts.
    """
    spark = files.sparkSession
    versions = Versions(spark, out)
    n, seen = versions.current()
    name = F.substring_index("path", "/", -1)
    new = files.withColumn("_name", name)
    if seen:
        new = new.join(spark.read.parquet(*seen["names"]).select(F.col("name").alias("_taken")), F.col("_name") == F.col("_taken"), "left_anti")
    events = read_log_texts(new.select("path", "value"), schemas)
    low = F.lower("table_name")
    if tables:
        events = events.where(low.isin([t.lower() for t in tables]))
    if exclude:
        events = events.where(~low.isin([t.lower() for t in exclude]))
    path, names = f"{out}/batch={n + 1:010d}", f"{out}/_names-{n + 1:010d}"
    events.write.mode("overwrite").parquet(path)
    new.select(F.col("_name").alias("name")).distinct().write.mode("overwrite").parquet(names)
    versions.commit(n, {"batches": [*seen.get("batches", []), path], "names": [*seen.get("names", []), names]})
    return {"files": spark.read.parquet(names).count(), "events": spark.read.parquet(path).count()}


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def insert_values(sql: pd.Series) -> pd.Series:
    """Column to literal of insert statements, on Arrow batches."""
    return sql.map(parse_insert)


# --- transaction-log rows of another database ------------------------------------------------
#: Operations of transaction-log records.
LOG_OPERATIONS = {"LOP_INSERT_ROWS": "INSERT", "LOP_MODIFY_ROW": "UPDATE", "LOP_DELETE_ROWS": "DELETE"}


def log_operation(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in LOG_OPERATIONS.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def decode_row(data: bytes | None, columns: Sequence[tuple[str, str, int]]) -> dict[str, str] | None:
    """Cells of a fixed/variable-length row image: (name, type, length) of each column in order.

    Layout: two status bytes, offset of the end of the fixed part, fixed columns, column
    count, null bitmap, count and end offsets of variable columns, their bytes.
    """
    import struct
    from datetime import datetime, timedelta

    if not data or len(data) < 4:
        return None
    end = struct.unpack_from("<H", data, 2)[0]
    n = struct.unpack_from("<H", data, end)[0]
    bitmap = data[end + 2 : end + 2 + (n + 7) // 8]
    null = [bool(bitmap[i // 8] >> (i % 8) & 1) for i in range(n)]
    at = end + 2 + (n + 7) // 8
    nvar = struct.unpack_from("<H", data, at)[0] if at + 2 <= len(data) else 0
    ends = struct.unpack_from(f"<{nvar}H", data, at + 2) if nvar else ()
    pos, var, start, out = 4, 0, at + 2 + 2 * nvar, {}
    for i, (name, kind, size) in enumerate(columns):
        missing = i < n and null[i]
        if kind in ("varchar", "nvarchar", "varbinary"):
            stop = ends[var] if var < nvar else start
            raw, start, var = data[start:stop], stop, var + 1
            value = raw.decode("utf-16-le" if kind == "nvarchar" else "utf-8", "replace") if kind != "varbinary" else raw.hex()
        else:
            raw, pos = data[pos : pos + size], pos + size
            if kind == "datetime":
                ticks, days = struct.unpack("<iI", raw) if len(raw) == 8 else (0, 0)
                value = (datetime(1900, 1, 1) + timedelta(days=days, milliseconds=round(ticks * 10 / 3))).isoformat(sep=" ")
            elif kind.startswith("numeric"):
                scale = int(kind.split(":")[1]) if ":" in kind else 0
                num = int.from_bytes(raw[1:], "little") * (1 if raw[:1] == b"\x01" else -1)
                value = f"{num / 10**scale:.{scale}f}" if scale else str(num)
            else:
                value = str(int.from_bytes(raw, "little", signed=kind != "bit"))
        out[name] = None if missing else value
    return out


def row_decoder(columns: Sequence[tuple[str, str, int]]):
    """Arrow UDF from row images to maps."""
    cols = list(columns)

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def decode(data: pd.Series) -> pd.Series:
        return data.map(lambda b: decode_row(b, cols))

    return decode
