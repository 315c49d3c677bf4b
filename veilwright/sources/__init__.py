"""Scans, slices, sinks and connectors."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How to reach the supported databases.
URLS = {
    "mysql": "jdbc:mysql://{host}:{port}/{database}?zeroDateTimeBehavior=CONVERT_TO_NULL",
    "mssql": "jdbc:sqlserver://{host}:{port};databaseName={database};encrypt=true",
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
    "snowflake": "jdbc:snowflake://{host}/?db={database}",
    "sqlite": "jdbc:sqlite:{database}",
}
PORTS = {"mysql": 3306, "mssql": 1433, "postgresql": 5432}


def jdbc_url(kind: str, host: str = "", database: str = "", port: int | None = None) -> str:
    if kind not in URLS:
        raise ValueError(f"unknown database kind {kind!r}")
    return URLS[kind].format(host=host, database=database, port=port or PORTS.get(kind, ""))


#: Statements that write, and what makes a session of each database read-only.
WRITES = ("INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "TRUNCATE", "REPLACE", "MERGE", "UPSERT", "EXEC", "EXECUTE")
READ_ONLY = {
    "mysql": "SET SESSION TRANSACTION READ ONLY",
    "postgresql": "SET SESSION CHARACTERISTICS AS TRANSACTION READ ONLY",
    "mssql": "SET TRANSACTION ISOLATION LEVEL READ UNCOMMITTED",
    "snowflake": "ALTER SESSION SET TRANSACTION_DEFAULT_ISOLATION_LEVEL = 'READ COMMITTED'",
    "sqlite": "PRAGMA query_only=ON",
}


def only_reads(sql: str) -> str:
    """The statement, or an error if any statement in it writes; comments and quoted text don't count."""
    bare = re.sub(r"(?s)'(?:[^'\\]|\\.|'')*'|\"[^\"]*\"|`[^`]*`|\[[^\]]*\]|--[^\n]*|/\*.*?\*/", " ", sql)
    for part in bare.split(";"):
        words = re.findall(r"\w+", part.upper())
        if words and (words[0] in WRITES or words[0] == "WITH" and set(words) & set(WRITES[:3]) or words[0] == "SELECT" and "INTO" in words):
            raise PermissionError(f"the source is read-only: {sql.strip()[:120]}")
    return sql


def table_query(kind: str, table: str, columns: Mapping[str, str] | None = None, schema: str | None = None) -> str:
    """A query over a whole table in a database's own writing; ``columns`` maps names to types.

    ``schema.table`` names are taken apart. On mssql tables are read without locks and XML
    columns as text, as its drivers can't deliver them.
    """
    parts = [x.strip("[]`\"") for x in table.split(".")]
    if schema and len(parts) == 1:
        parts = [schema, *parts]
    marks = {"mssql": "[]", "mysql": "``"}.get(kind, '""')
    q = lambda n: marks[0] + n.replace(marks[1], marks[1] * 2) + marks[1]
    one = lambda n, t: f"CAST({q(n)} AS NVARCHAR(MAX)) AS {q(n)}" if kind == "mssql" and "XML" in t.upper() else q(n)
    cols = ", ".join(one(n, t) for n, t in columns.items()) if columns else "*"
    return only_reads(f"SELECT {cols} FROM {'.'.join(map(q, parts))}" + (" WITH (NOLOCK)" if kind == "mssql" else ""))


def read_source(spark: SparkSession, kind: str, url: str, table: str, options: Mapping[str, str], columns: Mapping[str, str] | None = None, key: str | None = None, low: int = 0, high: int = 0, parts: int = 1) -> DataFrame:
    """A table of a source database, whose session can only read."""
    opts = {"sessionInitStatement": READ_ONLY[kind], **options} if kind in READ_ONLY else dict(options)
    return read_jdbc(spark, url, f"({table_query(kind, table, columns)}) q", opts, key, low, high, parts)


def read_jdbc(spark: SparkSession, url: str, table: str, options: Mapping[str, str], key: str | None = None, low: int = 0, high: int = 0, parts: int = 1) -> DataFrame:
    """A table over JDBC; with a key and its range read by that many tasks."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and parts > 1:
        r = r.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, options: Mapping[str, str], columns: Sequence[str], batch: int = 10_000, types: str | None = None) -> None:
    """The columns the destination knows, in batches."""
    w = df.select(*[c for c in df.columns if c.lower() in {x.lower() for x in columns}]).write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch).options(**options)
    (w.option("createTableColumnTypes", types) if types else w).mode("append").save()


def id_range(df: DataFrame, key: str, low: int, high: int) -> DataFrame:
    return df.where(F.col(key).between(low, high))


def page(df: DataFrame, key: str, offset: int, n: int) -> DataFrame:
    """Rows ``offset`` to ``offset + n`` in key order."""
    return df.orderBy(key).offset(offset).limit(n)


def keyset_page(df: DataFrame, key: str, after: int, n: int) -> DataFrame:
    """The next ``n`` rows after a key."""
    return df.where(F.col(key) > after).orderBy(key).limit(n)


def keyset_ranges(df: DataFrame, key: str, step: int) -> DataFrame:
    """``(gt, lt)`` windows that cover all keys, null keys aside."""
    r = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo is not null")
    starts = F.explode(F.sequence(F.col("lo"), F.col("hi"), F.lit(step).cast("bigint"))).alias("s")
    return r.select("hi", starts).select((F.col("s") - 1).alias("gt"), (F.least(F.col("s") + step - 1, F.col("hi")) + 1).alias("lt"))


def id_windows(df: DataFrame, key: str, step: int) -> DataFrame:
    """``df`` with ``gt`` and ``lt``, the window of ``step`` keys from the least one on that holds the row's key, so windows can be read apart without a cursor; null keys have none."""
    low = df.agg(F.min(key)).first()[0]
    if low is None:
        return df.withColumns({"gt": F.lit(None).cast("bigint"), "lt": F.lit(None).cast("bigint")})
    start = F.lit(low) + F.floor((F.col(key) - low) / step) * step
    return df.withColumns({"gt": start - 1, "lt": start + step})


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    v = F.trim(F.col(col).cast("string"))
    return df.select(v.alias(col)).where(F.col(col) != "").distinct()


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in (a, b)]).where((F.col(a) != "") & (F.col(b) != "")).distinct()


def lookup(df: DataFrame, key: str, keys: DataFrame, other: str) -> DataFrame:
    """Rows whose key is in a list of any length."""
    return df.join(keys.select(F.col(other).alias("_in")).distinct(), F.col(key) == F.col("_in"), "left_semi")


def fit_columns(df: DataFrame, widths: Mapping[str, int], numeric: Sequence[str] = ()) -> DataFrame:
    """Texts cut to their width, blanks of numeric columns to null."""
    fit = {c: F.substring(F.col(c), 1, n) for c, n in widths.items()}
    fit |= {c: F.when(F.trim(F.col(c).cast("string")) == "", None).otherwise(F.col(c)) for c in numeric}
    return df.withColumns(fit)


def replace_range(dest: DataFrame, rows: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """Destination after an id range was deleted and written anew: the same whether run once or again."""
    return dest.where(~F.col(key).between(low, high)).unionByName(rows.where(F.col(key).between(low, high)).select(*dest.columns))


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, data_type)`` of tables."""
    rows = [(t, n, k) for t, df in tables.items() for n, k in df.dtypes]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def estimated_rows(df: DataFrame) -> int | None:
    """Rows by the optimizer's statistics, null where it has none."""
    n = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    return int(n.get().toString()) if n.isDefined() else None


_COMPLETED = r"-- Dump completed on (\d{4}-\d{2}-\d{2}\s+\d{1,2}:\d{2}:\d{2})"
_POSITION = r"(?i)MASTER_LOG_FILE='([^']+)',\s*MASTER_LOG_POS=(\d+)"


def dump_metadata(files: DataFrame) -> DataFrame:
    """``(path, binlog_file, binlog_pos, completed)`` of dump texts ``(path, value)``."""
    get = lambda p, g: F.nullif(F.regexp_extract("value", p, g), F.lit(""))
    return files.select("path", get(_POSITION, 1).alias("binlog_file"), get(_POSITION, 2).try_cast("bigint").alias("binlog_pos"), get(_COMPLETED, 1).alias("completed"))


def whole_texts(spark: SparkSession, path: str, after: str | None = None, before: str | None = None) -> DataFrame:
    """``(path, value)`` of text files, one row each, by time of change."""
    r = spark.read
    if after:
        r = r.option("modifiedAfter", after)
    if before:
        r = r.option("modifiedBefore", before)
    return r.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def varchar_overflow(columns: Mapping[str, int], limit: int = 65_535, per_char: int = 4) -> list[str]:
    """Text columns to store out of row, widest first, until a row fits."""
    size, out = sum(columns.values()) * per_char, []
    for c, w in sorted(columns.items(), key=lambda x: (-x[1], x[0])):
        if size <= limit:
            break
        out.append(c)
        size -= w * per_char
    return out


def column_type(name: str, rule: str | None, source: str, width: int = 50) -> str:
    """Destination type of a column under a rule."""
    r = (rule or "").upper()
    if r in ("DOB", "PATIENT_DOB"):
        return "INTEGER"
    if r.startswith("PATIENT_") or r in ("ENCOUNTER_ID", "REFERENCE_PID", "APPOINTMENT_ID", "CHART_ID"):
        return "BIGINT"
    if r in ("DATE_OFFSET", "STATIC_OFFSET"):
        return "DATETIME"
    if r == "ZIP_CODE":
        return "VARCHAR(50)"
    if r in ("NOTES", "GENERIC_NOTES"):
        return "LONGTEXT"
    if r == "MASK":
        return f"VARCHAR({max(width, len(name) + 4, 50) + 10})"
    return source


#: Types of one database in terms of another.
TYPE_MAP = {
    "UNIQUEIDENTIFIER": "CHAR(36)", "BIT": "TINYINT(1)", "TINYINT": "TINYINT UNSIGNED", "DATETIMEOFFSET": "DATETIME(6)", "MONEY": "DECIMAL(19,4)",
    "SMALLMONEY": "DECIMAL(10,4)", "REAL": "FLOAT", "NTEXT": "LONGTEXT", "TEXT": "LONGTEXT", "IMAGE": "LONGTEXT", "SMALLDATETIME": "DATETIME",
}


def translate_type(t: str) -> str:
    """A server type as the destination writes it; long texts have no width."""
    m = re.fullmatch(r"(?i)\s*(\w+)\s*(?:\(\s*(\w+)\s*(?:,\s*(\d+)\s*)?\))?\s*", t)
    if not m:
        return t
    base, a, b = m[1].upper(), m[2], m[3]
    if base in ("VARCHAR", "NVARCHAR"):
        return "LONGTEXT" if (a or "").upper() == "MAX" or a and a.isdigit() and int(a) >= 255 else f"VARCHAR({a or 50})"
    if base == "DATETIME2":
        return f"DATETIME({min(int(a or 6), 6)})"
    if base in ("DECIMAL", "NUMERIC"):
        p, s = int(a or 18), int(b or 0)
        return f"DECIMAL({20 if p <= 18 and s >= 2 else p},{s})"
    return TYPE_MAP.get(base, t.strip().upper())
