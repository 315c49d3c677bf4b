"""Quality control: column detectors, mapping gate, identity diffs, notes audit, fill rates, reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import DEFAULT_OFFSET, strip

#: Residual patterns by type, and the street address pattern of the audit.
PHONE = r"(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"
RESIDUAL = {
    "PHONE_NUMBER": PHONE,
    "EMAIL_ADDRESS": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "US_SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "URL": r"(?i)https?://\S+|\bwww\.\S+",
    "ZIP_CODE": r"\b\d{5}(?:-\d{4})?\b",
}
STREET = r"(?i)\b\d{1,6}\s+(?:[A-Za-z0-9.]+\s+){0,3}(?:street|st|avenue|ave|road|rd|boulevard|blvd|lane|ln|drive|dr|court|ct|way|place|pl|terrace|ter|circle|cir|highway|hwy|parkway|pkwy)\b\.?"
DATE_TOKEN = r"\b(\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{2,4})\b"
#: Names of business keys, in order.
BIZ_KEYS = ["patientid", "patient_id", "encounterid", "encounter_id", "invoiceid", "invoice_id", "ndid", "psid", "claimid", "claim_id", "visitid", "visit_id", "chartid", "chart_id"]
NULL_WORDS = ["", "none", "null", "nan"]


def null_like(c: Column) -> Column:
    return c.isNull() | F.lower(strip(c)).isin(NULL_WORDS)


# --- detectors: conditions under which a cell passes ---------------------------------
def zip_ok(c: Column) -> Column:
    return null_like(c) | (F.length(strip(c)) == 3)


def birth_year_ok(c: Column) -> Column:
    return null_like(c) | c.cast("string").rlike(r"^[0-9]{4}$")


def mask_ok(c: Column, token: str) -> Column:
    return F.coalesce(c == f"<<{token}>>", F.lit(False))


def id_ok(c: Column, length: int, prefix: str) -> Column:
    """Length and prefix of a surrogate; null passes."""
    t = c.cast("string")
    return c.isNull() | ((F.length(t) == length) & t.startswith(prefix))


def day_of(c: Column) -> Column:
    """The date before the first blank, year-month-day in digits; else null."""
    d = F.substring_index(strip(c), " ", 1)
    return F.when(d.rlike(r"^\d{1,4}-\d{1,2}-\d{1,2}$"), F.try_to_date(d, "y-M-d"))


def offset_verdict(dest: Column, source: Column, days: Column, matched: Column, today: Column) -> Column:
    """pass, fail, bad_format, or null where a row isn't counted (no source row, empty cell).

    With a known source date the difference must be the offset; else the date must lie
    between 1900 and today plus the offset.
    """
    d, s = day_of(dest), day_of(source)
    days = F.coalesce(days, F.lit(DEFAULT_OFFSET))
    plausible = d.between(F.lit("1900-01-01").cast("date"), F.date_add(today, F.greatest(days, F.lit(0))))
    return (
        F.when(~matched | null_like(dest), None)
        .when(d.isNull(), "bad_format")
        .when(s.isNotNull(), F.when(F.datediff(d, s) == days, "pass").otherwise("fail"))
        .otherwise(F.when(plausible, "pass").otherwise("fail"))
    )


def tally(df: DataFrame, name: str, ok: Column) -> DataFrame:
    """``(detector, passed_count, failed_count)`` of one pass over the rows."""
    return df.agg(F.lit(name).alias("detector"), F.count_if(ok).alias("passed_count"), F.count_if(~ok).alias("failed_count"))


def capped(df: DataFrame, group: Sequence[str], order: Sequence[str], cap: int) -> DataFrame:
    """The first rows of each group: a report's samples, the cap is its feature."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn")


def reverse_ids(dest: DataFrame, source: DataFrame, row: str, col: str, reverse: DataFrame, nd: str, original: str) -> DataFrame:
    """``(row, nd_value, expected, actual, ok)``: surrogates mapped back against the aligned source."""
    s = source.select(F.col(row).alias("_r"), F.col(col).cast("string").alias("expected"))
    m = reverse.groupBy(F.col(nd).alias("_nd")).agg(F.min(F.col(original).cast("string")).alias("actual"))
    j = dest.select(row, F.col(col).alias("nd_value")).join(s, F.col(row) == F.col("_r")).join(m, F.col("nd_value") == F.col("_nd"), "left")
    return j.select(row, "nd_value", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("ok"))


# --- mapping gate ---------------------------------------------------------------------
def check(name: str, df: DataFrame, failed: Column, detail: Column) -> DataFrame:
    """``(check_name, status, detail)`` of a one-row aggregate."""
    return df.select(F.lit(name).alias("check_name"), F.when(failed, "fail").otherwise("pass").alias("status"), detail.cast("string").alias("detail"))


def one_to_one(df: DataFrame, key: str, nd: str) -> DataFrame:
    """Number of keys with more than one surrogate."""
    return df.groupBy(key).agg(F.countDistinct(nd).alias("n")).agg(F.count_if(F.col("n") > 1).alias("violations"))


def offset_band(df: DataFrame, col: str, low: int = -38, high: int = 38, least: int = 30) -> DataFrame:
    """Number of offsets outside the band."""
    c = F.col(col)
    return df.agg(F.count_if((c < low) | (c > high) | (F.abs(c) < least)).alias("violations"))


def histogram(df: DataFrame, key: str, count_of: str | None = None) -> DataFrame:
    """``(n, keys)``: how many keys have n rows, or n distinct values of a column."""
    per = df.groupBy(key).agg((F.countDistinct(count_of) if count_of else F.count("*")).alias("n"))
    return per.groupBy("n").agg(F.count("*").alias("keys"))


def same_histogram(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(differences)``: bars that differ between two histograms."""
    j = a.join(b.select(F.col("n").alias("_n"), F.col("keys").alias("_keys")), F.col("n") == F.col("_n"), "full")
    return j.agg(F.count_if(~F.col("keys").eqNullSafe(F.col("_keys"))).alias("differences"))


def biz_key(columns: Sequence[str], id_col: str, names: Sequence[str] = tuple(BIZ_KEYS)) -> str | None:
    """The first column besides the id whose name contains a business key's name."""
    return next((c for c in columns if c.lower() != id_col.lower() and any(n in c.lower() for n in names)), None)


def delta_identity(source: DataFrame, dest: DataFrame, id_col: str, key_col: str, restrict: bool = True) -> DataFrame:
    """``(id, issue, source_value, dest_value)``: missing_in_dest, extra_in_dest, mismatch; values as text.

    ``restrict`` limits the source to the ids of the destination's window.
    """
    if restrict:
        source = source.join(dest.select(id_col).distinct(), id_col, "left_semi")
    s = source.select(F.col(id_col).alias("_s"), F.col(key_col).cast("string").alias("source_value"))
    d = dest.select(F.col(id_col).alias("_d"), F.col(key_col).cast("string").alias("dest_value"))
    j = s.join(d, F.col("_s") == F.col("_d"), "full")
    issue = F.when(F.col("_d").isNull(), "missing_in_dest").when(F.col("_s").isNull(), "extra_in_dest").when(~F.col("source_value").eqNullSafe(F.col("dest_value")), "mismatch")
    return j.select(F.coalesce("_s", "_d").alias("id"), issue.alias("issue"), "source_value", "dest_value").where("issue is not null")


# --- notes ------------------------------------------------------------------------------
def residual(text: Column) -> Column:
    """Distinct ``(type, text)`` of all residual patterns in a text."""

    def found(kind: str, pattern: str) -> Column:
        return F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))), lambda x: F.struct(F.lit(kind).alias("type"), x.alias("text")))

    hits = [found(k, p) for k, p in RESIDUAL.items()]
    return F.flatten(F.array(*[F.coalesce(h, F.array().cast("array<struct<type:string,text:string>>")) for h in hits]))


def presence(text: Column, phi: Mapping[str, Column], names: Sequence[str] = ()) -> Column:
    """Columns of the master whose value occurs in the text, any case; names also by one part of three letters or more."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = []
    for c, v in phi.items():
        val = F.lower(F.trim(v.cast("string")))
        exact = (val != "") & F.contains(low, val)
        if c in names:
            exact = exact | F.exists(F.filter(F.split(val, r"\s+"), lambda p: F.length(p) >= 3), lambda p: F.contains(low, p))
        hits.append(F.when(F.coalesce(exact, F.lit(False)), F.lit(c)))
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def outcomes(text: Column, facilities: Sequence[str] = ()) -> Column:
    """Kinds of residue in a note: phone, zip5, url, address, facility."""
    t = F.coalesce(text, F.lit(""))
    tests = [("phone", t.rlike(PHONE)), ("zip5", t.rlike(RESIDUAL["ZIP_CODE"])), ("url", t.rlike(r"(?i)https?://|www\.")), ("address", t.rlike(STREET))]
    if facilities:
        any_of = F.lit(False)
        for f in facilities:
            any_of = any_of | F.contains(F.lower(t), F.lit(f.lower()))
        tests.append(("facility", any_of))
    return F.filter(F.array(*[F.when(ok, F.lit(k)) for k, ok in tests]), lambda x: x.isNotNull())


def note_dates(text: Column, master: Column, today: Column) -> Column:
    """``(kind, match)`` of dates in a note: a date of the master (``master``: array of dates), or before 1900 or after today."""
    toks = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(DATE_TOKEN), F.lit(1))

    def read(x: Column) -> Column:
        return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)).cast("date") for f in ("yyyy-M-d", "M/d/yyyy", "M/d/yy")])

    found = F.transform(toks, lambda x: F.struct(
        F.when(F.array_contains(master, read(x)), "date_leak").when((read(x) > today) | (F.year(read(x)) < 1900), "date_implausible").alias("kind"), x.alias("match")))
    return F.filter(found, lambda x: x["kind"].isNotNull())


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, n_rows, n_empty)`` of text columns, in one pass."""
    a = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(c) for c in cols])
    return a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(c).alias("n_empty")) for c in cols])).alias("x")).select("x.*")


def fill_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, n_rows, n_filled, rate)`` in percent, in one pass."""
    a = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in cols])
    rows = a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(c).alias("n_filled")) for c in cols])).alias("x")).select("x.*")
    return rows.withColumn("rate", F.round(F.when(F.col("n_rows") > 0, F.col("n_filled") * 100.0 / F.col("n_rows")).otherwise(0.0), 2))


def compare_fill(source: DataFrame, dest: DataFrame, cols: Sequence[str], tolerance: float = 1.0) -> DataFrame:
    """Fill rates of both sides and whether they agree within the tolerance."""
    s = fill_rates(source, cols).select("column_name", F.col("rate").alias("source_rate"))
    d = fill_rates(dest, cols).select("column_name", F.col("rate").alias("dest_rate"))
    return s.join(d, "column_name").withColumn("ok", F.abs(F.col("source_rate") - F.col("dest_rate")) <= tolerance)


# --- sampling and report ---------------------------------------------------------------
def sample_size(n: int, seed: int = 42) -> int:
    """Rows to sample of a table: all of a small one, then steps up to 5,000. The random choice within a step is by seed."""
    import random

    pick = random.Random(seed * 1_000_003 + n).randint
    if n <= 300:
        return n
    if n <= 1_000:
        return pick(300, min(500, n))
    if n <= 5_000:
        return pick(500, 800)
    if n <= 10_000:
        return pick(800, 1_000)
    return min(3_000 + (n - 10_000) // 30_000 * 1_000, 5_000)


def _draw(key: str, seed: int) -> Column:
    """What orders a sample: a hash of seed and key that any database can compute."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by the order of a seeded hash of the key: random, yet the same on every run. Null keys come last."""
    return df.orderBy(_draw(key, seed).asc_nulls_last(), key).limit(n)


def stratified_sample(df: DataFrame, key: str, stratum: Column, per: int, seed: int = 42) -> DataFrame:
    """Up to ``per`` rows of each stratum by seeded hash; what a stratum keeps is cut off before it is sorted whole."""
    w = Window.partitionBy("_s").orderBy(_draw(key, seed).asc_nulls_last(), key)
    return df.withColumn("_s", stratum).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per).drop("_s", "_rn")


def overall(statuses: Column) -> Column:
    """Status of a table from those of its checks: FAIL, else all SKIPPED, else ERROR (PARTIAL beside a PASS), else PASS."""
    has = lambda s: F.array_contains(statuses, s)
    return (
        F.when(has("FAIL"), "FAIL")
        .when(~F.exists(statuses, lambda x: x != "SKIPPED"), "SKIPPED")
        .when(has("ERROR"), F.when(has("PASS"), "PARTIAL").otherwise("ERROR"))
        .otherwise("PASS")
    )


def summary(findings: DataFrame) -> DataFrame:
    """``(table_name, n_checks, n_passed, n_failed, n_error, overall_status)`` of ``findings(table_name, check_name, status)``."""
    return findings.groupBy("table_name").agg(
        F.count("*").alias("n_checks"), *[F.count_if(F.col("status") == s).alias(n) for s, n in (("PASS", "n_passed"), ("FAIL", "n_failed"), ("ERROR", "n_error"))],
        overall(F.array_sort(F.collect_set("status"))).alias("overall_status"),
    )


def markdown(rows: list, title: str = "Quality report") -> str:
    """A small report of collected summary rows."""
    head = list(rows[0].asDict()) if rows else []
    lines = [f"# {title}", "", "| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    return "\n".join(lines + ["| " + " | ".join(str(r[c]) for c in head) + " |" for r in rows])


class GateError(RuntimeError):
    """Checks of the mapping gate failed."""


def gate(checks: DataFrame) -> DataFrame:
    """The checks, or an exception naming those that failed or broke (few rows reach the driver)."""
    bad = [r["check_name"] for r in checks.where("status in ('fail', 'error')").select("check_name").collect()]
    if bad:
        raise GateError("blocked by " + ", ".join(sorted(bad)))
    return checks
