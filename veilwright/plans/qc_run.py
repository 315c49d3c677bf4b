"""Quality control of whole projects: every part of every table, the gate over the maps, one report.

Parts of a table: ``part1`` (detectors by rule and row counts), ``delta`` (business keys of
the destination's window), ``master`` (released notes against the master table) and
``fillrate`` (filled identifier cells). A part that doesn't apply is SKIPPED, one that
breaks is an ERROR of its table only. What reaches the driver are counts and at most
``OFFENDERS`` record ids a check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import rule_of
from ..operators import quality as qc
from .pipeline import Config, delta_qc, mapping_gate, notes_audit, roles_of

#: Fields of the two reports, in order.
SUMMARY_FIELDS = ["table", "overall_status", "part1_status", "part1_failed_columns", "part1_source_rows", "part1_dest_rows", "delta_status", "delta_missing_in_dest", "delta_extra_in_dest", "delta_value_mismatch",
                  "master_status", "master_fail_count", "master_coverage_gaps", "fillrate_status", "fillrate_failed_columns", "errors"]
FINDING_FIELDS = ["table", "part", "check", "column", "status", "count", "detail"]
GATE = "(mapping gate)"
OFFENDERS = 50
PARTS = ("part1", "delta", "master", "fillrate")


@dataclass
class Part:
    status: str = "SKIPPED"
    reason: str = ""
    values: dict = field(default_factory=dict)
    findings: list[tuple] = field(default_factory=list)  # check, column, status, count, detail


def _offenders(df: DataFrame, bad, id_col: str) -> str:
    if id_col not in df.columns:
        return ""
    ids = [str(r[0]) for r in df.where(bad).select(id_col).orderBy(id_col).limit(OFFENDERS).collect()]
    return f"{id_col}=[{', '.join(ids)}]"


def _detectors(rules: dict[str, str], columns: Sequence[str]) -> dict:
    tests = {}
    for c, r in rules.items():
        c, r = c.lower(), (r or "").strip().upper()
        if c not in columns:
            continue
        if r == "ZIP_CODE":
            tests[c] = qc.zip_ok(F.col(c))
        elif r in ("DOB", "PATIENT_DOB"):
            tests[c] = qc.birth_year_ok(F.col(c))
        elif r == "MASK":
            tests[c] = qc.mask_ok(F.col(c), c.upper())
    return tests


def wrong_ids(src: DataFrame, dst: DataFrame, col: str, reverse: DataFrame, nd: str, original: str, id_col: str) -> DataFrame:
    """Released rows whose surrogate, mapped back, is none of the ids that deliveries of the record have; null surrogates pass."""
    s = src.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_r")).agg(F.collect_set(F.col(col).cast("string")).alias("_expected"))
    m = reverse.where(F.col(nd).isNotNull()).groupBy(F.col(nd).cast("string").alias("_nd")).agg(F.collect_set(F.col(original).cast("string")).alias("_actual"))
    j = dst.where(F.col(col).isNotNull()).join(s, F.col(id_col) == F.col("_r")).join(m, F.col(col).cast("string") == F.col("_nd"), "left")
    return j.where(F.col("_actual").isNull() | ~F.arrays_overlap("_expected", "_actual"))


def _part1(src: DataFrame, dst: DataFrame, rules: dict[str, str], n_rejected: int, id_col: str, reverse: dict[str, tuple[DataFrame, str, str]]) -> Part:
    tests = _detectors(rules, dst.columns)
    notes = [c.lower() for c, r in rules.items() if (r or "").strip().upper() in ("NOTES", "GENERIC_NOTES") and c.lower() in dst.columns]
    hits = {c: F.coalesce(F.size(qc.residual(F.col(c))), F.lit(0)) > 0 for c in notes}
    n = dst.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(~ok).alias(f"_t_{c}") for c, ok in tests.items()], *[F.count_if(h).alias(f"_h_{c}") for c, h in hits.items()]).first()
    p, n_src = Part("PASS", values={"dest_rows": n["_n"]}), src.count()
    p.values["source_rows"] = n_src
    failed = [c for c in tests if n[f"_t_{c}"]]
    for c in failed:
        p.findings.append(("phi_detected", c, "FAIL", n[f"_t_{c}"], _offenders(dst, ~tests[c], id_col)))
    for c, (table, nd, original) in reverse.items():
        bad = wrong_ids(src, dst, c, table, nd, original, id_col)
        if n_bad := bad.count():
            failed.append(c)
            p.findings.append(("id_mismatch", c, "FAIL", n_bad, _offenders(bad, F.lit(True), id_col)))
    if n_src != n["_n"] + n_rejected:
        p.findings.append(("row_count", "", "FAIL", n_src, f"source={n_src} dest={n['_n']} rejected={n_rejected}"))
    if p.findings:
        p.status = "FAIL"
    p.values["failed_columns"] = ";".join(failed)
    p.findings += [("residual_pii_advisory", c, "ADVISORY", n[f"_h_{c}"], _offenders(dst, h, id_col)) for c, h in hits.items() if n[f"_h_{c}"]]
    return p


def _delta(spark: SparkSession, cfg: Config, table: str, id_col: str) -> Part:
    d = delta_qc(spark, cfg, [table], id_col, cfg.qc.get("delta_after"))
    n = {r["issue"]: r["count"] for r in d.groupBy("issue").count().collect()}
    values = {"missing_in_dest": n.get("missing_in_dest", 0), "extra_in_dest": n.get("extra_in_dest", 0), "value_mismatch": n.get("mismatch", 0)}
    return Part("FAIL" if any(values.values()) else "PASS", values=values, findings=[(k, "", "FAIL", v, "") for k, v in values.items() if v])


def _master(dst: DataFrame, master: DataFrame, patient: str, notes: Sequence[str], key: str, id_col: str) -> Part:
    rows = dst.drop(*[c for c in ("nd_patient_id",) if patient != c and c in dst.columns]).withColumnRenamed(patient, "nd_patient_id")
    a = notes_audit(rows, master.withColumnRenamed(key, "nd_patient_id"), notes)
    bad = ~F.col("passed")
    n = a.agg(F.count_if(bad).alias("fail_count"), F.count_if(F.coalesce("gap", F.lit(True))).alias("coverage_gaps"), F.count(F.lit(1)).alias("records")).first().asDict()
    p = Part("FAIL" if n["fail_count"] else "PASS", values=n)
    if n["fail_count"]:
        p.findings.append(("phi_or_mask", ";".join(notes), "FAIL", n["fail_count"], _offenders(a, bad, id_col)))
    if n["coverage_gaps"]:
        p.findings.append(("coverage_gap", ";".join(notes), "ADVISORY", n["coverage_gaps"], "null or empty text"))
    return p


def _fill(src: DataFrame, dst: DataFrame, cols: Sequence[str], tolerance: float) -> Part:
    rows = qc.compare_fill(src, dst, cols, tolerance).collect()
    show = lambda r: f"{r['column_name']}(src={r['source_rate']}%/dst={r['dest_rate']}%)"
    bad = [r for r in rows if not r["ok"]]
    return Part("FAIL" if bad else "PASS", values={"failed_columns": ";".join(map(show, bad))}, findings=[("id_fill_rate_mismatch", r["column_name"], "FAIL", 1, show(r)) for r in bad])


def check_table(spark: SparkSession, cfg: Config, table: str, id_col: str = "nd_auto_increment_id") -> dict[str, Part]:
    """All parts of one table."""
    read = lambda base, t: spark.read.parquet(f"{base}/{t}.parquet")
    low = lambda df: df.toDF(*[c.lower() for c in df.columns])
    rules = {c.lower(): r for c, r in cfg.rules.get(table, {}).items()}
    role = roles_of(cfg).get(table)

    def run(f: Callable[[], Part]) -> Part:
        try:
            return f()
        except Exception as e:
            reason = str(e).splitlines()[0][:300]
            return Part("ERROR", reason, findings=[("(error)", "", "ERROR", 0, reason)])

    def part1() -> Part:
        try:
            rejected = spark.read.parquet(f"{cfg.destination}/_rejects/{table}.parquet").count()
        except Exception:  # nothing was rejected
            rejected = 0
        src, dst, reverse = low(read(cfg.source, table)), low(read(cfg.destination, table)), {}
        if id_col in src.columns and id_col in dst.columns:
            maps = {"PATIENT_ID": (cfg.patient_map, "nd_patient_id", "patientid"), "ENCOUNTER_ID": (cfg.encounter_map, "nd_encounter_id", "encounter_id"), "APPOINTMENT_ID": (cfg.appointment_map, "nd_appointment_id", "appointment_id"),
                    "CHART_ID": (cfg.chart_map, "nd_chart_id", "chart_id")}
            for c, r in rules.items():
                name, nd, original = maps.get(rule_of(r) if (r or "").strip().upper() != "PATIENT_DOB" else None, (None, "", ""))
                if name and c in dst.columns:
                    reverse[c] = (low(read(cfg.source, name)), nd, original)
        return _part1(src, dst, rules, rejected, id_col, reverse)

    def master() -> Part:
        tables = cfg.notes.get("tables", [])
        if not tables or role is None or not role.note_cols or not role.patient_col:
            return Part()
        return _master(low(read(cfg.destination, table)), low(read(cfg.source, tables[0]["table"])), role.patient_col, role.note_cols, tables[0].get("key", "nd_patient_id").lower(), id_col)

    def fill() -> Part:
        ids = [c for c, r in rules.items() if r and rule_of(r) in ("PATIENT_ID", "ENCOUNTER_ID", "APPOINTMENT_ID", "CHART_ID", "REFERENCE_PID") and r.upper() != "PATIENT_DOB"]
        return _fill(low(read(cfg.source, table)), low(read(cfg.destination, table)), ids, cfg.qc.get("fill_tolerance", 1.0)) if ids else Part()

    return {"part1": run(part1), "delta": run(lambda: _delta(spark, cfg, table, id_col)) if cfg.qc.get("delta") else Part(), "master": run(master), "fillrate": run(fill)}


def _overall(s: Sequence[str]) -> str:
    if "FAIL" in s:
        return "FAIL"
    if all(x == "SKIPPED" for x in s):
        return "SKIPPED"
    return ("PARTIAL" if "PASS" in s else "ERROR") if "ERROR" in s else "PASS"


def check_project(spark: SparkSession, cfg: Config, tables: Sequence[str] | None = None, workers: int = 4, gate: bool = True) -> tuple[DataFrame, DataFrame, dict]:
    """(summary, findings, report) of all parts of all tables and the mapping gate, tables side by side."""
    names = list(tables or cfg.rules)
    with ThreadPoolExecutor(max(1, workers)) as pool:
        got = dict(zip(names, pool.map(lambda t: check_table(spark, cfg, t), names), strict=True))
    rows, found = [], []
    text = lambda v: "" if v is None else str(v)
    for t, parts in got.items():
        p1, d, m, f = (parts[k] for k in PARTS)
        errors = " | ".join(f"{k}:{p.reason}" for k, p in parts.items() if p.status == "ERROR")
        rows.append((t, _overall([p.status for p in parts.values()]), p1.status, p1.values.get("failed_columns"), p1.values.get("source_rows"), p1.values.get("dest_rows"), d.status, d.values.get("missing_in_dest"), d.values.get("extra_in_dest"),
                     d.values.get("value_mismatch"), m.status, m.values.get("fail_count"), m.values.get("coverage_gaps"), f.status, f.values.get("failed_columns"), errors))
        found += [(t, k, *x) for k, p in parts.items() for x in p.findings]
    checks: list = []
    if gate:
        try:
            checks = mapping_gate(spark, cfg).collect()
            bad = [c for c in checks if c["status"] in ("fail", "error")]
            rows.append((GATE, "FAIL" if bad else "PASS", *[""] * 13, "; ".join(c["check_name"] for c in bad)))
            found += [(GATE, "gate", c["check_name"], "", c["status"].upper(), 1, text(c["detail"])) for c in bad]
        except Exception as e:
            rows.append((GATE, "ERROR", *[""] * 13, str(e).splitlines()[0][:300]))
            checks = [{"status": "error"}]
    string = lambda names: ", ".join(f"`{n}` string" for n in names)
    summary = spark.createDataFrame([tuple(map(text, r)) for r in rows], string(SUMMARY_FIELDS))
    findings = spark.createDataFrame([(*map(text, r[:5]), int(r[5]), text(r[6])) for r in found], string(FINDING_FIELDS[:5]) + ", `count` bigint, detail string")
    return summary, findings, _report(got, checks)


def _report(got: dict[str, dict[str, Part]], checks: Sequence) -> dict:
    out: dict = {}
    for k in PARTS:
        ran = [(t, p[k]) for t, p in got.items() if p[k].status != "SKIPPED"]
        out[k] = {"tables": len(ran), "passed": sum(p.status == "PASS" for _, p in ran), "failed": sum(p.status != "PASS" for _, p in ran), "failures": [t for t, p in ran if p.status != "PASS"]}
    for name in ("fail_count", "coverage_gaps", "records"):
        out["master"][name] = sum(p["master"].values.get(name, 0) for p in got.values())
    bad = [c for c in checks if c["status"] != "pass"]
    out["gate"] = {"checks": len(checks), "passed": len(checks) - len(bad), "failed": len(bad)}
    out["overall_passed"] = not any(out[k]["failed"] for k in (*PARTS, "gate"))
    lines = ["# Quality report", "", f"Overall: {'passed' if out['overall_passed'] else 'failed'}", "", "| Part | Tables or checks | Passed | Failed |", "|-|-|-|-|"]
    lines += [f"| {k} | {v.get('tables', v.get('checks'))} | {v['passed']} | {v['failed']} |" for k, v in out.items() if isinstance(v, dict)]
    lines += [f"- {k}: {t}" for k in PARTS for t in out[k]["failures"]]
    return out | {"markdown": "\n".join(lines)}
