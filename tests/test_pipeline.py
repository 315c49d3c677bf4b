"""A project end to end on small parquet tables; identifier settings; command line."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from veilwright import cli
from veilwright.plans import UnsafePlan
from veilwright.plans.identifiers import check_identifiers, id_columns, pii_config, pii_tables, remap_single
from veilwright.operators.quality import GateError
from veilwright.plans.pipeline import delta_qc, last_report, load_config, mapping_gate, notes_audit, parse_rules, prerequisites, retry_failed, run_tables, tables_to_run
from veilwright.plans.qc_run import FINDING_FIELDS, GATE, SUMMARY_FIELDS, check_project


@pytest.fixture
def project(spark, tmp_path):
    src, dst = f"{tmp_path}/src", f"{tmp_path}/dst"
    spark.createDataFrame([(1001, 101, 30, False), (1002, 102, -31, True)], "nd_patient_id bigint, patientid bigint, offset_days int, excluded boolean").write.parquet(f"{src}/patient_mapping_table.parquet")
    spark.createDataFrame([(5001, 10010001, 1001, "Y")], "encounter_id bigint, nd_encounter_id bigint, nd_patient_id bigint, nd_activeflag string").write.parquet(f"{src}/encounter_mapping_table.parquet")
    spark.createDataFrame([(1, 101, "Ann", "02139", "1985-06-15"), (2, 102, "Bo", None, None), (3, 999, "Cy", "", "x")], "nd_auto_increment_id bigint, patientid bigint, fname string, zip string, dob string").write.parquet(f"{src}/patients.parquet")
    spark.createDataFrame([(1, "plain")], "k int, v string").write.parquet(f"{src}/codes.parquet")
    text = json.dumps({"source": src, "destination": "${OUT}", "rules": {"patients": {"patientid": "PATIENT_ID", "fname": "MASK", "zip": "ZIP_CODE", "dob": "PATIENT_DOB"}, "codes": {"k": ""}, "gone": {"a": "MASK"}}})
    return load_config(text, {"OUT": dst}), text, dst


def test_run_and_qc(spark, project):
    cfg, _, dst = project
    rep = {r["table_name"]: r for r in run_tables(spark, cfg).collect()}
    assert (rep["patients"]["status"], rep["patients"]["n_out"], rep["patients"]["n_rejected"]) == ("completed", 1, 2)
    assert rep["codes"]["status"] == "passthrough" and rep["gone"]["status"] == "failed" and rep["gone"]["error"]
    row = spark.read.parquet(f"{dst}/patients.parquet").first()
    assert tuple(row) == (1, 1001, "<<FNAME>>", "021", 1985)
    summary, findings, report = check_project(spark, cfg, ["patients", "gone"])
    assert summary.columns == SUMMARY_FIELDS and findings.columns == FINDING_FIELDS
    s = {r["table"]: r for r in summary.collect()}
    assert s["gone"]["part1_status"] == "ERROR" and s["gone"]["overall_status"] == "ERROR" and s[GATE]["overall_status"] == "PASS"
    p = s["patients"]
    assert (p["part1_status"], p["part1_source_rows"], p["part1_dest_rows"], p["delta_status"], p["master_status"]) == ("PASS", "3", "1", "SKIPPED", "SKIPPED")
    assert report["overall_passed"] is False and report["part1"]["failures"] == ["gone"] and "# Quality report" in report["markdown"]
    spark.createDataFrame([(k, 1001, "Ann", "02139", 1985) for k in range(60)], "nd_auto_increment_id bigint, patientid bigint, fname string, zip string, dob int").write.mode("overwrite").parquet(f"{dst}/patients.parquet")
    cfg.qc["delta"] = True
    summary, findings, _ = check_project(spark, cfg, ["patients"], gate=False)
    p = summary.first()
    assert (p["overall_status"], p["part1_failed_columns"], p["delta_status"]) == ("FAIL", "fname;zip;patientid", "FAIL")
    f = {(r["check"], r["column"]): r for r in findings.collect()}
    assert f[("phi_detected", "zip")]["count"] == 60 and f[("phi_detected", "zip")]["detail"].count(",") == 49 and ("row_count", "") in f and f[("extra_in_dest", "")]["count"] == 57


def test_prerequisites_retry_exclude_and_identifiers(spark, project):
    cfg, _, dst = project
    assert prerequisites(spark, cfg) == []
    cfg.appointment_map, cfg.exclude = "absent", ["CODES"]
    assert len(prerequisites(spark, cfg)) == 1
    cfg.appointment_map = None
    assert {r["table_name"]: r["status"] for r in run_tables(spark, cfg).collect()} == {"patients": "completed", "gone": "failed"}
    spark.createDataFrame([("x",)], "a string").write.parquet(f"{cfg.source}/gone.parquet")
    assert [tuple(r)[:4] for r in retry_failed(spark, cfg).collect()] == [("gone", "completed", 1, 1)]
    assert {r["table_name"]: r["status"] for r in last_report(spark, cfg).collect()} == {"patients": "completed", "gone": "completed"}
    assert retry_failed(spark, cfg).count() == 0
    cfg.rules["patients"]["absent"], cfg.prune = "MASK", True
    assert run_tables(spark, cfg, ["patients"]).first()["status"] == "completed"
    cfg.prune = False
    assert "absent" in run_tables(spark, cfg, ["patients"]).first()["error"]
    del cfg.rules["patients"]["absent"]
    cfg.identifiers = ["patientid"]
    assert run_tables(spark, cfg, ["patients"]).first()["status"] == "completed"
    assert spark.read.parquet(f"{dst}/patients.parquet").first()["dob"] == 1985
    cfg.identifiers = ["chart_id"]
    with pytest.raises(UnsafePlan):
        run_tables(spark, cfg, ["patients"])


def test_runs_take_up_new_and_changed_records(spark, project, tmp_path, monkeypatch):
    cfg, _, dst = project
    schema = "k bigint, patientid bigint, v string, at timestamp_ntz"
    day = lambda n: datetime(2024, 1, n)
    rows = [(1, 101, "a", day(1)), (2, 101, "b", day(1)), (3, 999, "c", day(1))]
    put = lambda: spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{cfg.source}/visits.parquet")
    cfg.rules["visits"] = {"patientid": "PATIENT_ID"}
    cfg.incremental["visits"] = {"key": "k", "times": ["at"]}
    put()
    assert "state" in run_tables(spark, cfg, ["visits"]).first()["error"]
    cfg.state = f"file://{tmp_path}/state"
    once = lambda: tuple(run_tables(spark, cfg, ["visits"]).first())[1:5]
    monkeypatch.setattr("veilwright.plans.pipeline.RecordState.commit", lambda *_: 1 / 0)
    assert once()[0] == "failed"  # dies between writing and commit
    monkeypatch.undo()
    assert once() == ("completed", 3, 2, 1) and once() == ("completed", 0, 0, 0)
    rows += [(1, 101, "A", day(2)), (4, 101, "d", day(2)), (2, 101, "b", day(2))]
    put()
    assert once() == ("completed", 3, 3, 0)  # both deliveries of 1, and 4; 2 came again as it was
    got = sorted((r["run"], r["k"], r["v"]) for r in spark.read.parquet(f"{dst}/visits.parquet").collect())
    assert got == [(1, 1, "a"), (1, 2, "b"), (3, 1, "A"), (3, 1, "a"), (3, 4, "d")]


def test_command_line(spark, project, tmp_path, capsys, monkeypatch):
    cfg, text, dst = project
    monkeypatch.setenv("OUT", dst)
    path = tmp_path / "c.json"
    path.write_text(text)
    assert cli.main(["run", "--config", str(path), "--tables", "patients"], spark) == 0
    cli.main(["auto-qc", "--config", str(path), "--tables", "patients", "--out", f"{tmp_path}/rep"], spark)
    assert "patients" in capsys.readouterr().out
    assert cli.main(["mapping", "--config", str(path)], spark) == 2
    path.write_text(json.dumps(json.loads(text) | {"secret": "s"}))
    assert cli.main(["mapping", "--config", str(path), "--out", f"{tmp_path}/maps"], spark) == 0
    assert cli.main(["status", "--config", str(path)], spark) == 0 and cli.main(["retry", "--config", str(path)], spark) == 0 and cli.main(["check", "--config", str(path)], spark) == 0
    got = {r["patientid"]: r["nd_patient_id"] for r in spark.read.parquet(f"{tmp_path}/maps/patient_mapping_table.parquet").collect()}
    assert got == {101: 1001, 102: 1002, 999: 1003}
    cli.main(["generate-config", "--source", cfg.source, "--tables", "patients"], spark)
    assert "patients,zip,ZIP_CODE" in capsys.readouterr().out


def test_rule_lists():
    assert parse_rules("table_name,column_name,rule\n# note\nt,A,MASK\n,x,y\nt,b,\n") == [("t", "A", "MASK"), ("t", "b", "")]
    assert tables_to_run("# all\na\nb,5\nzz\n", ["a", "b"]) == ["a", "b"]


def test_identifiers():
    assert remap_single({"p": "PATIENT_ID", "d": "PATIENT_DOB", "x": "MASK"}, ["chartid"]) == {"p": "PATIENT_CHARTID", "d": "DOB", "x": "MASK"}
    assert remap_single({"p": "PATIENT_ID"}, ["a", "b"]) == {"p": "PATIENT_ID"}
    check_identifiers(["chartid"], ["chartid"], {"t": {"p": "PATIENT_CHARTID"}})
    for args in ((["chart_id"], ["chart_id"], {}), (["pid"], ["x"], {}), (["pid"], ["pid"], {"t": {"p": "PATIENT_OTHER"}})):
        with pytest.raises(UnsafePlan):
            check_identifiers(*args)
    assert id_columns({"t": {"p": "PATIENT_ID", "q": "PATIENT_X", "e": "ENCOUNTER_ID", "d": "PATIENT_DOB"}, "u": {"m": "MASK"}}) == {"t": {"patient": ["p", "q"], "encounter": ["e"]}}
    t = pii_tables({"pat": {"pid": "PATIENT_ID", "first_name": "MASK", "lname": "MASK", "dob": "PATIENT_DOB", "x": "ZIP_CODE"}})
    assert t["pii_data_table"]["tables"]["pat"]["other_required_columns"] == ["first_name", "lname", "dob"]
    c = pii_config(t)
    assert c["mask"]["pat_lname"]["masking_value"] == "((LAST_NAME))" and c["dob"] == {"pat_dob": {}} and c["combine"]["pat_name"]["combine_columns"] == ["pat_first_name", "pat_lname"]
    assert pii_tables({}, {"s": ["PatientId", "homePhone", "z"]})["pii_data_table"]["tables"] == {"s": {"primary_col": "PatientId", "other_required_columns": ["homePhone"]}}
    assert pii_tables({}) == {} and pii_config({}) == {}


def test_gate_delta_audit_and_logs(spark, project, tmp_path, capsys, monkeypatch):
    cfg, text, dst = project
    assert {r["check_name"]: r["status"] for r in mapping_gate(spark, cfg).collect()} == {"mapping_uniqueness": "pass", "offset_range": "pass", "encounter_uniqueness": "pass"}
    cfg.qc["offset_max"] = 20
    with pytest.raises(GateError, match="offset_range"):
        mapping_gate(spark, cfg, raise_on_failure=True)
    run_tables(spark, cfg, ["patients"])
    d = delta_qc(spark, cfg, ["patients"]).collect()
    assert [(r["id"], r["issue"], r["source_value"], r["dest_value"]) for r in d] == [(1, "mismatch", "101", "1001")]
    master = spark.createDataFrame([(1, "John Smith", "555-1", date(1985, 6, 15)), (1, "J", None, None)], "nd_patient_id bigint, ufname string, umobileno string, dob date")
    notes = spark.createDataFrame([(1, "clean", None), (1, "saw SMITH on", "1985-06-15"), (1, "", None), (9, "call 713-555-0192", None), (None, None, None)], "nd_patient_id bigint, a string, b string")
    got = [(r["gap"], list(r["phi_hits"]), list(r["mask_hits"]), [x["kind"] for x in r["date_hits"]], r["passed"]) for r in notes_audit(notes, master, ["a", "b"]).orderBy(F.coalesce("a", F.lit(" "))).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(False, [], [], [], True), (False, ["ufname"], [], ["date_leak"], False), (True, [], [], [], True), (True, [], [], [], True), (False, [], ["phone"], [], False)]))
    monkeypatch.setenv("OUT", dst)
    path = tmp_path / "c.json"
    path.write_text(text)
    assert cli.main(["gate", "--config", str(path)], spark) == 0 and cli.main(["qc-delta", "--config", str(path), "--tables", "patients"], spark) == 1
    assert cli.main(["pii-table", "--config", str(path), "--out", f"{tmp_path}/pii"], spark) == 0
    assert {"patientid", "patients_fname", "patients_dob"} == set(spark.read.parquet(f"{tmp_path}/pii").columns)
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "bin.1").write_text("# at 5\n### INSERT INTO `a`.`b`\n### SET\n###   @1=1\n")
    assert cli.main(["cdc", "--logs", f"{tmp_path}/logs", "--out", f"{tmp_path}/log"], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/log").first()["table_name"] == "b"
    (tmp_path / "logs" / "bin.2").write_text("# at 7\n### INSERT INTO `a`.`c`\n### SET\n###   @1=1\n# at 9\n### DELETE FROM `a`.`D`\n### WHERE\n###   @1=1\n")
    assert cli.main(["cdc", "--logs", f"{tmp_path}/logs", "--out", f"{tmp_path}/log", "--exclude", "d"], spark) == 0
    assert '{"files": 1, "events": 1}' in capsys.readouterr().out
    (tmp_path / "logs" / "bin.3").write_text("# at 7\n")
    assert cli.main(["cdc", "--logs", f"{tmp_path}/logs", "--out", f"{tmp_path}/log", "--before", "2001-01-01T00:00:00"], spark) == 0
    assert '{"files": 0, "events": 0}' in capsys.readouterr().out
    assert {r["table_name"] for r in spark.read.parquet(f"{tmp_path}/log").collect()} == {"b", "c"}
    notes.write.parquet(f"{tmp_path}/notes")
    master.write.parquet(f"{tmp_path}/master")
    assert cli.main(["qc-audit", "--notes", f"{tmp_path}/notes", "--master", f"{tmp_path}/master", "--content", "a", "b"], spark) == 1
    assert '"failed": 2' in capsys.readouterr().out


def test_notes_are_masked_or_refused(spark, project):
    cfg, _, dst = project
    spark.createDataFrame([(1, "101.0", 5001, "Ann LEE (101), visit 5001\tborn 06/15/1985, seen 2020-01-01, call 713-555-0192, ann.lee@x.test"), (2, None, 5001, "chart of 101, not 1012"), (3, "101", None, None), (5, "101", None, "ANNÉ NÚÑEZ"), (4, "999", None, "Ann Lee")], "k bigint, patientid string, enc bigint, body string").write.parquet(f"{cfg.source}/letters.parquet")
    spark.createDataFrame([(1001, "Ann", "Lee", date(1985, 6, 15), "ann.lee@x.test"), (1001, "Anné", "Núñez", None, None)], "nd_patient_id bigint, FName string, lname string, dob date, email string").write.parquet(f"{cfg.source}/master.parquet")
    cfg.rules["letters"] = {"patientid": "PATIENT_ID", "enc": "ENCOUNTER_ID", "body": "NOTES"}
    rep = run_tables(spark, cfg, ["letters"]).first()
    assert rep["status"] == "failed" and "notes" in rep["error"]
    cfg.notes = {"tables": [{"table": "master", "mask": {"((EMAIL))": ["email"], "((LAST_NAME))": ["lname"], "((FIRST_NAME))": ["fname"]}, "dob": ["dob"], "combine": {"((NAME))": ["fname", "lname"]}}]}
    rep = run_tables(spark, cfg, ["letters"]).first()
    assert (rep["status"], rep["n_out"], rep["n_rejected"]) == ("completed", 4, 1)
    got = {r["k"]: r["body"] for r in spark.read.parquet(f"{dst}/letters.parquet").collect()}
    assert got == {1: "((FIRST_NAME)) ((LAST_NAME)) (1001), visit 10010001 born 1985, seen  2020-01-31 , call ((PHONE_NUMBER)), ((EMAIL))", 2: "chart of 1001, not 1012", 3: "", 5: "((FIRST_NAME)) ((LAST_NAME))"}
    cfg.notes["tables"][0]["mask"]["((X))"] = ["absent"]
    assert "absent" in run_tables(spark, cfg, ["letters"]).first()["error"]
