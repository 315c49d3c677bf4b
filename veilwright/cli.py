"""Command line: run, retry, status, check, qc, auto-qc, gate, qc-delta, qc-audit, mapping, pii-table, cdc, decrypt-notes, generate-config."""

from __future__ import annotations

import argparse
import importlib
import json
import os
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import cdc
from .operators import mapping as mp
from .operators.documents import decrypt_notes
from .plans import auto_rule
from .plans.identifiers import pii_tables
from .plans.pipeline import delta_qc, last_report, load_config, mapping_gate, notes_audit, prerequisites, retry_failed, run_tables
from .plans.qc_run import check_project
from .sources import whole_texts


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="veilwright", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name, text in (("run", "de-identify the configured tables"), ("retry", "run failed tables again"), ("status", "last result of each table"), ("check", "look for what a run needs"), ("auto-qc", "check the configured tables and the maps"), ("qc", "check the configured tables"), ("mapping", "add new patients to the patient map"), ("gate", "check the maps"), ("qc-delta", "compare ids of source and destination")):
        c = sub.add_parser(name, help=text)
        c.add_argument("--config", required=True)
        c.add_argument("--tables", nargs="*")
        c.add_argument("--out", help="folder of CSV reports, or of the new map")
    q = sub.add_parser("qc-audit", help="look for personal data in released notes")
    q.add_argument("--notes", required=True)
    q.add_argument("--master", required=True)
    q.add_argument("--content", nargs="+", required=True)
    t = sub.add_parser("pii-table", help="build the master table of personal data")
    t.add_argument("--config", required=True)
    t.add_argument("--out", required=True)
    x = sub.add_parser("cdc", help="parse log texts of a folder into a change log")
    x.add_argument("--logs", required=True)
    x.add_argument("--out", required=True)
    x.add_argument("--schemas", nargs="*")
    x.add_argument("--tables", nargs="*")
    x.add_argument("--exclude", nargs="*", default=())
    x.add_argument("--after", help="only logs changed after this time, YYYY-MM-DDTHH:MM:SS")
    x.add_argument("--before", help="only logs changed before this time")
    y = sub.add_parser("decrypt-notes", help="decrypt the notes of a table")
    y.add_argument("--table", required=True)
    y.add_argument("--out", required=True)
    y.add_argument("--cipher", required=True, help="module:function of (data, key) that decrypts")
    y.add_argument("--secret-env", required=True, help="environment variable that holds the secret")
    y.add_argument("--content", default="content")
    y.add_argument("--date", default="date")
    g = sub.add_parser("generate-config", help="suggest rules for the tables of a folder")
    g.add_argument("--source", required=True)
    g.add_argument("--tables", nargs="+", required=True)
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.command == "generate-config":
        rows = [(t, n, k) for t in a.tables for n, k in spark.read.parquet(f"{a.source}/{t}.parquet").dtypes]
        df = spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
        for r in df.withColumn("rule", auto_rule(F.col("column_name"), F.col("data_type"))).collect():
            print(f"{r['table_name']},{r['column_name']},{r['rule']}")
        return 0
    if a.command == "qc-audit":
        n = notes_audit(spark.read.parquet(a.notes), spark.read.parquet(a.master), a.content).agg(F.count("*").alias("audited"), F.count_if(~F.col("passed")).alias("failed"), F.count_if("gap").alias("gaps")).first()
        print(json.dumps(n.asDict()))
        return int(n["failed"] > 0)
    if a.command == "cdc":
        n = cdc.take_logs(whole_texts(spark, a.logs, a.after, a.before), a.out, a.schemas, a.tables, a.exclude)
        print(json.dumps(n))
        return 0
    if a.command == "decrypt-notes":
        module, name = a.cipher.split(":")
        cipher, secret = getattr(importlib.import_module(module), name), os.environ[a.secret_env].encode()
        decrypt_notes(spark.read.parquet(a.table), a.content, a.date, secret, cipher).write.mode("overwrite").parquet(a.out)
        return 0
    cfg = load_config(Path(a.config).read_text())
    if a.command == "gate":
        checks = mapping_gate(spark, cfg)
        checks.show(truncate=False)
        return int(checks.where("status <> 'pass'").count() > 0)
    if a.command == "qc-delta":
        d = delta_qc(spark, cfg, a.tables).groupBy("table_name", "issue").count()
        d.show(truncate=False)
        return int(d.count() > 0)
    if a.command == "pii-table":
        found = pii_tables(cfg.rules).get("pii_data_table", {}).get("tables", {})
        parts = {t: spark.read.parquet(f"{cfg.source}/{t}.parquet").select(F.col(c["primary_col"]).alias("patientid"), *c["other_required_columns"]) for t, c in found.items()}
        mp.master_table("patientid", parts).write.mode("overwrite").parquet(a.out)
        return 0
    if a.command == "check":
        lacking = prerequisites(spark, cfg)
        print("\n".join(lacking) or "complete")
        return int(bool(lacking))
    if a.command in ("run", "retry", "status"):
        if a.command != "status" and (lacking := prerequisites(spark, cfg)):
            print("\n".join(lacking))
            return 2
        report = run_tables(spark, cfg, a.tables) if a.command == "run" else retry_failed(spark, cfg) if a.command == "retry" else last_report(spark, cfg)
        report.show(report.count(), truncate=False)
        return int(report.where("status = 'failed'").count() > 0)
    if a.command == "mapping":
        if not a.out or not cfg.secret:
            print("mapping needs --out, as the map tells who is who and stays out of the destination, and a secret in the configuration")
            return 2
        pids = [(spark.read.parquet(f"{cfg.source}/{t}.parquet"), c) for t, rs in cfg.rules.items() for c, r in rs.items() if r == "PATIENT_ID" and (not a.tables or t in a.tables)]
        old = spark.read.parquet(f"{cfg.source}/{cfg.patient_map}.parquet").select("nd_patient_id", "patientid", F.col("offset_days"))
        ids = mp.id_pool(pids, "patientid").select(F.col("patientid").try_cast("bigint").alias("patientid")).where("patientid is not null")
        mp.populate_patient_map(old, ids, cfg.secret).write.mode("overwrite").parquet(f"{a.out}/{cfg.patient_map}.parquet")
        return 0
    summary, findings, rep = check_project(spark, cfg, a.tables, gate=a.command == "auto-qc")
    if a.out:
        summary.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{a.out}/qc_summary")
        findings.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{a.out}/qc_findings")
    print(rep["markdown"])
    print(json.dumps({k: v for k, v in rep.items() if k != "markdown"}))
    return int(not rep["overall_passed"])


if __name__ == "__main__":
    raise SystemExit(main())
