"""Running tables and their checks: de-identification jobs, automatic quality control, reports."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as qc
from ..operators import resolve as rs
from ..operators.incremental import RecordState, deliveries, transitions
from ..session import materialize, release
from . import NotePlan, TablePlan, UnsafePlan, interpolate, overlay, roles
from .identifiers import check_identifiers, remap_single


@dataclass
class Config:
    """A project: where tables lie, their rules, maps, and what quality control checks.

    ``notes`` says how NOTES columns are masked: ``tables`` (of each master table its name
    as ``table``, and ``key``, ``mask``, ``dob``, ``combine``), ``regex``, ``replace``,
    ``address`` and ``facility``. ``secret`` decides the date offsets of new patients.
    Tables in ``exclude`` are left out, in any letter case. ``identifiers`` are the
    project's identifiers, columns of the patient map. ``incremental`` gives tables that
    are taken up by runs their ``key`` and ``times`` columns, and ``state`` is where what
    runs have taken is kept. With ``prune`` rules of columns that a table lacks are left
    out instead of failing the table.
    """

    source: str
    destination: str
    rules: dict[str, dict[str, str]]
    patient_map: str = "patient_mapping_table"
    encounter_map: str | None = "encounter_mapping_table"
    appointment_map: str | None = None
    chart_map: str | None = None
    date_offset_days: int = 34
    secret: str = ""
    exclude: list[str] = field(default_factory=list)
    identifiers: list[str] = field(default_factory=list)
    incremental: dict[str, dict] = field(default_factory=dict)
    state: str = ""
    prune: bool = False
    qc: dict = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


def parse_rules(text: str) -> list[tuple[str, str, str]]:
    """``(table, column, rule)`` of a rules CSV; lines beginning with # and rows without a table are left out."""
    lines = [x for x in text.splitlines() if x.strip() and not x.lstrip().startswith("#")]
    rows = csv.DictReader(io.StringIO("\n".join(lines)))
    return [(r["table_name"].strip(), (r.get("column_name") or "").strip(), (r.get("rule") or "").strip()) for r in rows if (r.get("table_name") or "").strip()]


def load_config(text: str, env: Mapping[str, str] | None = None, over: Mapping | None = None) -> Config:
    """Configuration of JSON (or YAML where that library is there), with variables filled in."""
    try:
        raw = json.loads(text)
    except ValueError:
        import yaml

        raw = yaml.safe_load(text)
    raw = interpolate(overlay(raw, over or {}), env)
    if "rules_csv" in raw:
        rules: dict[str, dict[str, str]] = {}
        for t, c, r in parse_rules(raw.pop("rules_csv")):
            rules.setdefault(t, {})[c] = r
        raw["rules"] = rules
    return Config(**raw)


def tables_to_run(text: str, known: Sequence[str]) -> list[str]:
    """Table names of a list with # comments that are configured."""
    names = [x.split(",")[0].strip() for x in text.splitlines()]
    return [n for n in names if n and not n.startswith("#") and n in set(known)]


_REPORT = "table_name string, status string, n_in bigint, n_out bigint, n_rejected bigint, error string"


def prerequisites(spark: SparkSession, cfg: Config, read: Callable[[str], DataFrame] | None = None) -> list[str]:
    """What a run lacks: maps and master tables that don't exist or are empty."""
    read = read or (lambda t: spark.read.parquet(f"{cfg.source}/{t}.parquet"))
    need = [m for m in (cfg.patient_map, cfg.encounter_map, cfg.appointment_map, cfg.chart_map) if m] + [m["table"] for m in cfg.notes.get("tables", [])]
    out = []
    for t in dict.fromkeys(need):
        try:
            if read(t).isEmpty():
                out.append(f"table {t} is empty")
        except Exception as e:
            out.append(f"table {t} can't be read: {str(e).splitlines()[0][:200]}")
    return out


def chosen(cfg: Config, tables: Sequence[str] | None = None) -> list[str]:
    """The tables of a run: those asked for, else all configured, without the excluded ones."""
    out = {t.strip().lower() for t in cfg.exclude}
    return [t for t in tables or list(cfg.rules) if t.lower() not in out]


def existing_rules(rules: Mapping[str, str], columns: Sequence[str]) -> dict[str, str]:
    """Rules of the columns that exist, in any letter case."""
    have = {c.lower() for c in columns}
    return {c: r for c, r in rules.items() if c.lower() in have}


def run_stats(reports: DataFrame) -> DataFrame:
    """Totals of run reports by status: tables, rows in, out and rejected, errors."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return reports.groupBy("status").agg(F.count(F.lit(1)).alias("n_tables"), n("n_in"), n("n_out"), n("n_rejected"), F.count("error").alias("n_errors"))


def effective_rules(cfg: Config, map_columns: Sequence[str]) -> dict[str, dict[str, str]]:
    """Rules after the identifier settings: checked, and old names mapped where there is one identifier."""
    if not cfg.identifiers:
        return cfg.rules
    rules = {t: remap_single(rs, cfg.identifiers) for t, rs in cfg.rules.items()}
    check_identifiers(cfg.identifiers, [c.lower() for c in map_columns], rules)
    return rules


def run_tables(spark: SparkSession, cfg: Config, tables: Sequence[str] | None = None, read: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """De-identify tables and write rows and rejects; ``(table_name, status, n_in, n_out, n_rejected, error)``.

    A table without any rule is copied, one whose rules don't fit, or whose notes can't be
    masked, fails, and the others go on. Writing overwrites, so a run may be repeated;
    tables under ``incremental`` get only what no run has taken. The report is kept for
    :func:`last_report`.
    """
    read = read or (lambda t: spark.read.parquet(f"{cfg.source}/{t}.parquet"))
    report = []
    all_rules = effective_rules(cfg, read(cfg.patient_map).columns if cfg.identifiers else [])
    for t in chosen(cfg, tables):
        try:
            rules = all_rules.get(t)
            if rules is None:
                raise UnsafePlan(f"table {t} isn't configured")
            if cfg.prune:
                rules = existing_rules(rules, read(t).columns)
            if t in cfg.incremental:
                report.append((t, *_run_increment(spark, cfg, t, rules, read), None))
            elif not any(rules.values()):
                read(t).write.mode("overwrite").parquet(f"{cfg.destination}/{t}.parquet")
                n = spark.read.parquet(f"{cfg.destination}/{t}.parquet").count()
                report.append((t, "passthrough", n, n, 0, None))
            else:
                report.append((t, *_run_whole(spark, cfg, t, rules, read), None))
        except Exception as e:  # one table's trouble is no other's
            report.append((t, "failed", None, None, None, str(e).splitlines()[0][:500]))
    out = spark.createDataFrame(report, _REPORT)
    out.coalesce(1).withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{cfg.destination}/_reports")
    return out


def last_report(spark: SparkSession, cfg: Config) -> DataFrame:
    """The last line of each table over all runs."""
    rows = spark.read.parquet(f"{cfg.destination}/_reports")
    cols = [c for c in rows.columns if c != "table_name"]
    return rows.groupBy("table_name").agg(F.max_by(F.struct(*cols), "at").alias("r")).select("table_name", "r.*")


def retry_failed(spark: SparkSession, cfg: Config, read: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Run the tables again whose last run failed."""
    names = [r["table_name"] for r in last_report(spark, cfg).where("status = 'failed'").select("table_name").collect()]
    known = [t for t in names if t in cfg.rules]
    return run_tables(spark, cfg, known, read) if known else spark.createDataFrame([], _REPORT)


def _applied(cfg: Config, t: str, df: DataFrame, rules: Mapping[str, str], read: Callable[[str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    plan = TablePlan(t, {c: r for c, r in rules.items() if r}, default_offset=cfg.date_offset_days)
    notes = None
    if cfg.notes and "NOTES" in {r.strip().upper() for r in plan.rules.values()}:
        notes = NotePlan(**cfg.notes | {"tables": [m | {"table": read(m["table"])} for m in cfg.notes.get("tables", [])]})
    maps = [read(m) if m else None for m in (cfg.encounter_map, cfg.appointment_map, cfg.chart_map)]
    return plan.apply(df, read(cfg.patient_map), maps[0], notes, *maps[1:])


def _write(spark: SparkSession, good: DataFrame, bad: DataFrame, n_in: int, to: str, rejects: str) -> tuple[str, int, int, int]:
    """Write both sides; the rejects are only looked for if rows are missing. Counts come from the files' footers."""
    good.write.mode("overwrite").parquet(to)
    n_out = spark.read.parquet(to).count()
    (bad if n_out < n_in else spark.createDataFrame([], "reason string, row_data string")).write.mode("overwrite").parquet(rejects)
    n_bad = spark.read.parquet(rejects).count()
    return "completed" if n_in == n_out + n_bad else "failed", n_in, n_out, n_bad


def _run_whole(spark: SparkSession, cfg: Config, t: str, rules: Mapping[str, str], read: Callable[[str], DataFrame]) -> tuple[str, int, int, int]:
    df = read(t)
    good, bad = _applied(cfg, t, df, rules, read)
    return _write(spark, good, bad, df.count(), f"{cfg.destination}/{t}.parquet", f"{cfg.destination}/_rejects/{t}.parquet")


def _run_increment(spark: SparkSession, cfg: Config, t: str, rules: Mapping[str, str], read: Callable[[str], DataFrame]) -> tuple[str, int, int, int]:
    """Take up the records that no run has taken, into a partition named after the state's next version.

    A run that dies before its commit leaves the version as it was, so the next one writes
    the same partition anew: nothing is skipped and nothing comes twice.
    """
    if not cfg.state:
        raise UnsafePlan(f"table {t} is incremental, but there is no state folder")
    df, how = read(t), cfg.incremental[t]
    key = how["key"]
    state = RecordState(spark, f"{cfg.state}/{t}")
    found = transitions(deliveries(df, t, key, how["times"], how.get("ignore", ["nd_operation"])))
    now = materialize(found, "run-transitions")
    release(found)
    pending = materialize(state.pending(now), "run-pending")
    number = state.version() + 1
    todo = df.join(pending.select(F.col("rec_key").alias("_rk")).distinct(), F.col(key).eqNullSafe(F.col("_rk")), "left_semi")
    good, bad = _applied(cfg, t, todo, rules, read) if any(rules.values()) else (todo, todo.limit(0).select(F.lit("").alias("reason"), F.lit("").alias("row_data")))
    got = _write(spark, good, bad, todo.count(), f"{cfg.destination}/{t}.parquet/run={number}", f"{cfg.destination}/_rejects/{t}.parquet/run={number}")
    if got[0] == "completed":
        state.commit(pending)
    release(now)
    release(pending)
    return got


def roles_of(cfg: Config):
    return roles([(t, c, r) for t, rs in cfg.rules.items() for c, r in rs.items()])


def mapping_gate(spark: SparkSession, cfg: Config, raise_on_failure: bool = False) -> DataFrame:
    """Checks of the maps ``(check_name, status, detail)``: one surrogate per id, offsets in their band, id format."""
    p = spark.read.parquet(f"{cfg.source}/{cfg.patient_map}.parquet")
    q, v = cfg.qc, F.col("violations")
    band = {"low": q.get("offset_min", -38), "high": q.get("offset_max", 38), "least": q.get("offset_abs_min", 30)}
    checks = [
        qc.check("mapping_uniqueness", qc.one_to_one(p, "patientid", "nd_patient_id"), v > 0, v),
        qc.check("offset_range", qc.offset_band(p, "offset_days", **band), v > 0, v),
    ]
    if "id_length" in q:
        bad = p.agg(F.count_if(~qc.id_ok(F.col("nd_patient_id"), q["id_length"], str(q.get("id_prefix", "")))).alias("violations"))
        checks.append(qc.check("mapping_id_format", bad, v > 0, v))
    if cfg.encounter_map:
        e = spark.read.parquet(f"{cfg.source}/{cfg.encounter_map}.parquet")
        checks.append(qc.check("encounter_uniqueness", qc.one_to_one(rs.usable(e), "encounter_id", "nd_encounter_id"), v > 0, v))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return qc.gate(out) if raise_on_failure else out


def delta_qc(spark: SparkSession, cfg: Config, tables: Sequence[str] | None = None, id_col: str = "nd_auto_increment_id", after: str | None = None, restrict: bool = True) -> DataFrame:
    """``(table_name, id, issue, source_value, dest_value)`` of tables with a business key, in the destination's window."""
    out = None
    for t in tables or list(cfg.rules):
        src, dst = (spark.read.parquet(f"{p}/{t}.parquet") for p in (cfg.source, cfg.destination))
        key = cfg.qc.get("biz_keys", {}).get(t) or qc.biz_key(dst.columns, id_col)
        if key is None or id_col not in dst.columns:
            continue
        if after and "nd_extracted_date" in dst.columns:
            dst = dst.where(F.col("nd_extracted_date") > F.lit(after).cast("timestamp_ntz"))
        d = qc.delta_identity(src, dst, id_col, key, restrict).withColumn("table_name", F.lit(t))
        out = d if out is None else out.unionByName(d)
    return out if out is not None else spark.createDataFrame([], "id bigint, issue string, source_value string, dest_value string, table_name string")


def notes_audit(notes: DataFrame, master: DataFrame, content: Sequence[str], key: str = "nd_patient_id", names: Sequence[str] = ("ufname", "ulname"), facilities: Sequence[str] = (), today=None) -> DataFrame:
    """Notes with ``gap`` (no text), ``phi_hits``, ``mask_hits``, ``date_hits`` and ``passed``.

    All rows of a patient in the master count: its columns but ids are looked for in the
    text, its dates as dates. Content columns are read as one text.
    """
    today = F.current_date() if today is None else today
    cols = [c for c, k in master.dtypes if not c.lower().endswith("id") and c != key]
    dates = [c for c, k in master.dtypes if c in cols and k.startswith(("date", "timestamp"))]
    texts = [c for c in cols if c not in dates]
    m = master.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_mk")).agg(
        *[F.collect_set(F.col(c).cast("string")).alias(f"_m_{c}") for c in texts], F.flatten(F.collect_set(F.array_compact(F.array(*[F.col(c).cast("date") for c in dates])) if dates else F.array().cast("array<date>"))).alias("_dates"))
    text = F.concat_ws("\n", *[F.col(c) for c in content])
    j = notes.withColumn("_text", text).join(m, F.col(key) == F.col("_mk"), "left")
    low = F.lower("_text")

    def hit(c: str):
        exact = F.exists(F.col(f"_m_{c}"), lambda v: (F.trim(v) != "") & F.contains(low, F.lower(F.trim(v))))
        if c in names:
            exact = exact | F.exists(F.col(f"_m_{c}"), lambda v: F.exists(F.filter(F.split(F.lower(F.trim(v)), r"\s+"), lambda p: F.length(p) >= 3), lambda p: F.contains(low, p)))
        return F.when(F.coalesce(exact, F.lit(False)), F.lit(c))

    hits = F.array_compact(F.array(*[hit(c) for c in texts])) if texts else F.array().cast("array<string>")
    none = F.array().cast("array<date>")
    j = j.withColumns({"gap": F.trim("_text") == "", "phi_hits": hits, "mask_hits": qc.outcomes(F.col("_text"), facilities), "date_hits": qc.note_dates(F.col("_text"), F.coalesce("_dates", none), today)})
    ok = (F.size("phi_hits") == 0) & (F.size("mask_hits") == 0) & (F.size("date_hits") == 0)
    return j.withColumn("passed", ok).select(*notes.columns, "gap", "phi_hits", "mask_hits", "date_hits", "passed")
