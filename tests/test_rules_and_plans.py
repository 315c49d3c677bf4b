"""Column rules, notes, mapping, resolution, plans, documents, logs."""

import json
import zlib

import pytest
from pyspark.sql import functions as F

from veilwright import plans, sources
from veilwright.functions import notes as nt
from veilwright.functions import rules as ru
from veilwright.operators import cdc, documents as dc, mapping as mp, quality as qc, resolve as rs


def vals(spark, xs, f, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def today():
    return F.lit("2024-06-30").cast("date")


def test_date_rule(spark):
    got = vals(spark, ["9999-12-20 00:00:00", "2020-06-15 00:00:00", "1000-01-05 00:00:00", " ", None, "junk", "1/7/44", "31/01/2020"], lambda c: ru.shift(c, F.lit(30), today()))
    assert got == ["9999-12-31 23:59:59", "2020-07-15 00:00:00", "1000-02-04 00:00:00", None, None, None, "1944-02-06 00:00:00", "2020-03-01 00:00:00"]
    assert vals(spark, ["1000-01-05 00:00:00"], lambda c: ru.shift(c, F.lit(-10))) == ["1000-01-01 00:00:00"]
    assert vals(spark, ["2020-01-01"], lambda c: ru.shift(c, F.lit(None).cast("int"))) == ["2020-01-01 00:00:00"]


def test_other_rules(spark):
    assert vals(spark, ["02139", "02139-1234", "02", "", "nan", None, " 90210 "], ru.zip3) == ["021", "021", "02", None, None, None, "902"]
    assert vals(spark, ["born 1985-06-15", "1/7/44", "none", None, "01252024"], lambda c: ru.birth_year(c, today())) == [1985, 1944, None, None, 2024]
    assert vals(spark, [None, "x"], lambda c: ru.mask("NAME")) == ["<<NAME>>"] * 2
    assert (ru.rule_of("patient_x"), ru.rule_of("other"), ru.rule_of(None)) == ("PATIENT_ID", None, None)


def test_notes(spark):
    assert vals(spark, [" a^b \n c ", None], nt.normalise) == ["a b c", ""]
    assert vals(spark, ["id 123 x1234 123."], lambda c: nt.replace_number(c, F.lit("123.0"), F.lit(900))) == ["id 900 x1234 900."]
    assert vals(spark, ["US$ for JOHN Smith's"], lambda c: nt.replace_pattern(c, nt.any_word(F.array(F.lit("john smith"), F.lit("x"))), "$1((N))")) == ["US$ for $1((N))'s"]
    assert vals(spark, ["Smith John and john"], lambda c: nt.replace_pattern(c, nt.combined_words([F.lit("John"), F.lit("Smith")]), "N")) == ["N and N"]
    assert vals(spark, ["ab cd"], lambda c: nt.replace_values(c, [{"value": "ab", "replacement": "X"}, {"bad": 1}])) == ["X cd"]
    got = vals(spark, ["call 123-456-7890 or http://a.b/c at 10.1.2.3", None, "x" * 70_000], nt.generic_chain)
    assert got == ["call ((PHONE_NUMBER)) or ((URL)) at ((IPADDRESS))", None, "x" * 70_000]
    assert vals(spark, ["on 2020-01-31 10:00:00, 31 Jan 2020"], lambda c: nt.shift_dates_in_text(c, F.lit(1))) == ["on  2020-02-01 10:00:00 ,  2020-02-01 "]
    with pytest.raises(ValueError, match="five"):
        nt.combined_words([F.lit("a")] * 6)


def test_mapping(spark):
    old = spark.createDataFrame([(10_000_005, 5, 33)], "nd_patient_id bigint, patientid bigint, offset_days int")
    ids = spark.createDataFrame([(9,), (7,), (5,), (7,), (None,)], "patientid bigint")
    got = {r["patientid"]: r["nd_patient_id"] for r in mp.populate_patient_map(old, ids, "s").collect()}
    assert got == {5: 10_000_005, 7: 10_000_006, 9: 10_000_007}
    band = {r[0] for r in spark.range(5000).select(mp.banded_offset(F.col("id"), "s")).collect()}
    assert band == {*range(-38, -29), *range(30, 39)}
    n = mp.numbered(spark.range(1000).repartition(7), ["id"], "n").collect()
    assert all(r["n"] == r["id"] + 1 for r in n)


def test_offsets_need_the_secret(spark):
    a, b = ([r[0] for r in spark.range(200).select(mp.banded_offset(F.col("id"), x)).collect()] for x in ("s", "t"))
    assert a != b and len(set(a)) > 10


def test_encounter_numbers_are_unique(spark, monkeypatch):
    monkeypatch.setattr(mp, "ENCOUNTER_BAND", 10)
    pats = spark.createDataFrame([(1, 101), (2, 102), (3, 103)], "patientid bigint, nd_patient_id bigint")
    enc = spark.createDataFrame([(e, 1 + (e % 5 == 0) + (e % 7 == 0), e % 4) for e in range(40)], "encounter_id bigint, patientid bigint, encounter_date int")
    got = mp.encounter_surrogates(enc, pats).collect()
    numbers = [r["nd_encounter_id"] for r in got]
    assert len(set(numbers)) == len(numbers) == 40
    first = sorted((r for r in got if r["patientid"] == 1), key=lambda r: (r["encounter_date"], r["encounter_id"]))
    assert [r["nd_encounter_id"] for r in first[:9]] == list(range(1011, 1020)) and min(r["nd_encounter_id"] for r in first[9:]) > 1030
    old = spark.createDataFrame([(100, 101, 1013), (101, 103, 1015), (102, 103, 1012), (103, 102, 5000)], "encounter_id bigint, nd_patient_id bigint, nd_encounter_id bigint")
    new = {r["encounter_id"]: r["nd_encounter_id"] for r in mp.encounter_surrogates(enc.where("encounter_id < 20"), pats, old).collect()}
    mine = [new[r["encounter_id"]] for r in first if r["encounter_id"] in new]
    assert mine[:5] == [1014, 1016, 1017, 1018, 1019] and all(n > 5000 for n in mine[5:])
    assert not set(new.values()) & {1013, 1015, 1012, 5000} and len(set(new.values())) == 20


def test_mapping_delta_of_new_patients(spark):
    old = spark.createDataFrame([(5, 1005, 33, None, False, None)], "patientid bigint, nd_patient_id bigint, offset_days int, registration_date string, excluded boolean, excluded_at string")
    delta = spark.createDataFrame([(9, "d", True), (7, None, False), (5, None, True), (None, "x", True)], "patientid bigint, registration_date string, excluded boolean")
    got = {r["patientid"]: r for r in mp.mapping_delta(old, delta, F.lit("now"), "s").collect()}
    assert {k: r["nd_patient_id"] for k, r in got.items()} == {5: 1005, 7: 1006, 9: 1007}
    assert got[5]["offset_days"] == 33 and all(30 <= abs(r["offset_days"]) <= 38 for r in got.values())
    assert {k: r["excluded_at"] for k, r in got.items()} == {5: "now", 7: None, 9: "now"}


def test_get_or_create_by_several_runs(spark, monkeypatch):
    from veilwright.session import scratch_path

    path = scratch_path(spark, "patients")
    a, b = mp.PatientMap(spark, path, "s"), mp.PatientMap(spark, path, "s")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "patientid bigint")
    commit = a.versions.commit

    def late(base, manifest):
        monkeypatch.undo()
        b.get_or_create(ids(5, 6))
        return commit(base, manifest)

    monkeypatch.setattr(a.versions, "commit", late)
    got = {r["patientid"]: r["nd_patient_id"] for r in a.get_or_create(ids(5, 7, None, 7)).collect()}
    assert got == {5: 10_000_001, 7: 10_000_003} and a.read().count() == 3
    assert {tuple(r)[:2] for r in b.get_or_create(ids(6)).collect()} == {(10_000_002, 6)} and a.versions.current()[0] == 2


def test_own_rules():
    with pytest.raises(ValueError):
        ru.register_rule("mask", lambda c, x: c)
    with pytest.raises(ValueError):
        ru.register_rule("PATIENT_X", lambda c, x: c)


def test_id_windows(spark):
    got = {r["id"]: (r["gt"], r["lt"]) for r in sources.id_windows(spark.createDataFrame([(5,), (14,), (15,), (None,)], "id bigint"), "id", 10).collect()}
    assert got == {5: (4, 15), 14: (4, 15), 15: (14, 25), None: (None, None)}
    assert sources.id_windows(spark.createDataFrame([], "id bigint"), "id", 10).count() == 0


def test_sources_only_read():
    for sql in ("delete from t", " /* x */ INSERT into t values (1)", "select 1; drop table t", "with x as (select 1) update t set a = 1", "select * into u from t", "exec p"):
        with pytest.raises(PermissionError):
            sources.only_reads(sql)
    assert sources.only_reads("select 'delete; drop', `update` from t -- insert") and sources.only_reads("with d as (select 1) select * from d")
    assert sources.table_query("mssql", "dbo.Notes", {"id": "INT", "body": "XML"}) == "SELECT [id], CAST([body] AS NVARCHAR(MAX)) AS [body] FROM [dbo].[Notes] WITH (NOLOCK)"
    assert sources.table_query("mysql", "a`b") == "SELECT * FROM `a``b`" and sources.table_query("postgresql", "t", schema="s") == 'SELECT * FROM "s"."t"'


def test_map_join_keys(spark):
    left = spark.createDataFrame([("PAT1", 1), ("7", 2), (None, 3)], "pid string, v int")
    right = spark.createDataFrame([(7, 100)], "pid bigint, nd bigint")
    got = {r["v"]: r["nd_m"] for r in rs.map_join(left, right, "pid", "pid", "_m").collect()}
    assert got == {1: None, 2: 100, 3: None}


def test_plan_rejects_and_guards(spark):
    pats = spark.createDataFrame([(1001, 101, 30, False), (1002, 102, 31, True)], "nd_patient_id bigint, patientid bigint, offset_days int, excluded boolean")
    enc = spark.createDataFrame([(5001, 10010001, 1001, "Y"), (5002, 10020001, 1002, "Y"), (5003, 10010002, 1001, "N")], "encounter_id bigint, nd_encounter_id bigint, nd_patient_id bigint, nd_activeflag string")
    rows = spark.createDataFrame([(5001, "a", "2020-01-01"), (5002, "b", "2020-01-01"), (5003, "c", None), (None, "d", "x")], "EncounterId bigint, note string, at string")
    plan = plans.TablePlan("visits", {"encounterid": "ENCOUNTER_ID", "at": "DATE_OFFSET"})
    good, bad = plan.apply(rows, pats, enc)
    assert [tuple(r) for r in good.collect()] == [(10010001, "a", "2020-01-31 00:00:00")]
    assert {r["reason"] for r in bad.collect()} == {"unresolved_id:5002", "unresolved_id:5003", "unresolved_id:NULL"}
    assert all(json.loads(r["row_data"]) for r in bad.collect())
    for r in ({}, {"note": ""}, {"absent": "MASK"}, {"encounterid": "ENCOUNTER_ID", "note": "MASKED"}):
        with pytest.raises(plans.UnsafePlan):
            plans.TablePlan("visits", r).apply(rows, pats, enc)


def test_dates_in_cells_and_generic_notes(spark):
    pats = spark.createDataFrame([(1001, 1, 3)], "nd_patient_id bigint, patientid bigint, offset_days int")
    cells = ["seen 03/04/2024, left 2024-03-05 10:00:00", "03042024", "03/04/2024", "none", "", None, "13/13/2024 x"]
    rows = spark.createDataFrame([(1, c, c) for c in cells], "pid bigint, at string, note string").coalesce(1)
    got = plans.TablePlan("t", {"pid": "PATIENT_ID", "at": "DATE_OFFSET", "note": "GENERIC_NOTES"}).apply(rows, pats)[0].collect()
    assert [r["at"] for r in got] == ["seen 2024-03-07, left 2024-03-08 10:00:00", "2024-03-07", "2024-03-07 00:00:00", None, None, None, None]
    assert got[0]["note"] == "seen  2024-03-07 , left  2024-03-08 10:00:00 " and got[5]["note"] is None


def test_configuration():
    env = {"A": "x", "L": '["p", "q"]'}
    assert plans.interpolate({"k": "${A}-${B:-d}", "l": "${L}", "n": 3}, env) == {"k": "x-d", "l": ["p", "q"], "n": 3}
    with pytest.raises(KeyError):
        plans.interpolate("${MISSING_NAME}", {})
    assert plans.overlay({"a": {"b": 1, "c": [1]}}, {"a": {"c": [2]}}) == {"a": {"b": 1, "c": [2]}}
    r = plans.roles([("T", "PatientID", "PATIENT_ID"), ("T", "pat2", "PATIENT_X"), ("T", "Notes", "NOTES"), ("T", "d", "DATE_OFFSET"), ("T", "lname", "MASK")])["T"]
    assert (r.patient_col, r.note_cols, r.date_cols, r.name_cols) == ("patientid", ["notes"], ["d"], ["lname"])


def test_types():
    assert [sources.translate_type(t) for t in ("uniqueidentifier", "nvarchar(max)", "varchar(20)", "decimal(10,2)", "numeric(30, 4)", "datetime2(3)", "bit")] == ["CHAR(36)", "LONGTEXT", "VARCHAR(20)", "DECIMAL(20,2)", "DECIMAL(30,4)", "DATETIME(3)", "TINYINT(1)"]
    assert sources.varchar_overflow({"a": 20_000, "b": 100}) == ["a"]
    assert sources.column_type("x", "PATIENT_DOB", "DATE") == "INTEGER"
    assert "sqlserver" in sources.jdbc_url("mssql", "h", "d", 1433)


def test_documents():
    assert dc.inflate(zlib.compress(b"abc")) == b"abc" and dc.inflate(b"plain") == b"plain" and dc.inflate(None) is None and dc.inflate(b"") == b""
    assert dc.clean_xml(b"<a>x\x01y</a>") == "<a>xy</a>" and dc.clean_xml(b"") is None
    assert dc.mask_xml("no tag") == "no tag" and dc.mask_xml("<a><b></a>") == "<a><b></a>" and dc.mask_xml(None) is None
    out = dc.mask_xml("<DOB>1/7/44</DOB><zip>02139</zip><facName>X &amp; Y</facName>", 2024)
    assert "<DOB>1944</DOB>" in out and "<zip>021</zip>" in out and "((FACILITYNAME))" in out
    doc = {"levelone": {"body": {"section": [
        {"caption": "Assessment", "list": {"item": {"content": [{"coded_entry": {"coded_entry.value": {"@V": "E11"}}, "#text": "Diabetes"}, {"dxdesc": "Flu", "dxcode": "J11"}]}}},
        {"caption": "Review of Systems", "section": {"caption": {"#text": "Heart"}, "list": {"item": [{"caption": "Denies", "content": "pain"}, {"caption": "Other", "content": "x"}]}}},
        {"caption": "Physical Examination", "section": [{"caption": "Skin", "list": {"item": [{"caption": "Arm", "content": {"list": {"item": {"caption": "Left", "content": "ok"}}}}]}}]},
        {"caption": "Plan", "section": [{"caption": "Orders", "list": {"item": [{"content": {"#text": "CBC"}}, {"content": "rest"}]}}]},
        {"caption": "Vitals", "local_markup": {"datahtml": ".c { x } Date 01/02/2020 10:30 AM 120/80 Sitting 98.6 L Adult 150 24.2 1.8"}},
        {"caption": None, "paragraph": [{"@title": "Dear", "content": "all"}, {"content": ["Re: visit", "more"]}]},
        {"caption": "Empty"},
    ]}}}
    s = dc.document_sections(json.dumps(doc))
    assert s["Assessment"] == [{"description": "Diabetes", "code": "E11"}, {"description": "Flu", "code": "J11"}]
    assert s["Review of Systems"] == {"Heart": {"Denies": ["pain"]}} and s["Physical Examination"] == {"Skin": {"Arm": {"Left": "ok"}}}
    assert s["Plan"] == {"Orders": ["CBC", "rest"]} and s["Vitals"]["BP"] == "120/80" and s["Dear"] == "all" and s["Re"] == "Re: visit\nmore"
    assert dc.document_sections("junk") is None and dc.document_text("{}") == ""
    assert "Heart:" in dc.document_text(json.dumps(doc))


def test_log_text(spark):
    text = "\n".join(["use `ehr`;", "# at 100", "SET INSERT_ID=7/*!*/;", "INSERT INTO users (a, b) VALUES (1,", "'x')", "/*!*/;", "# at 200", "### UPDATE `ehr`.`appts`", "### WHERE", "###   @1=1", "###   @2='old'", "### SET", "###   @1=1", "###   @2='new'", "# at 300", "### DELETE FROM `other`.`t`", "###   @1=5", ""])
    df = spark.createDataFrame([("/x/bin.0001", text), ("/x/bin.0002", None)], "path string, value string")
    got = [(r["table_name"], r["operation"], json.loads(r["payload"]), r["binlog_pos"]) for r in cdc.read_log_texts(df, ["EHR"]).orderBy("seq").collect()]
    assert got[0][:2] == ("users", "INSERT") and got[0][2]["insert_id"] == 7 and got[0][3] == 100
    assert got[1] == ("appts", "UPDATE", {"1": "1", "2": "'new'"}, 200) and len(got) == 2
    assert cdc.parse_insert("INSERT INTO t SET a = 1, b = f(2, 'x,y')") == {"a": "1", "b": "f(2, 'x,y')"}
    assert cdc.parse_insert("UPDATE t SET a = 1") is None and cdc.parse_insert(None) is None


def test_quality(spark):
    df = spark.createDataFrame([("p1", 1, 0), ("p1", 2, 10), ("p2", 3, 40), ("p3", 4, 33)], "pid string, nd int, off int")
    assert qc.one_to_one(df, "pid", "nd").first()[0] == 1 and qc.offset_band(df, "off").first()[0] == 3
    checks = qc.check("offset_range", qc.offset_band(df, "off"), F.col("violations") > 0, F.col("violations"))
    with pytest.raises(qc.GateError, match="offset_range"):
        qc.gate(checks)
    assert vals(spark, ["021", None, "02139", "02"], qc.zip_ok) == [True, True, False, False]
    st = lambda *x: spark.range(1).select(qc.overall(F.array(*[F.lit(v) for v in x]))).first()[0]
    assert [st("PASS", "FAIL"), st("SKIPPED"), st("ERROR", "PASS"), st("ERROR"), st("PASS", "SKIPPED")] == ["FAIL", "SKIPPED", "PARTIAL", "ERROR", "PASS"]
    assert qc.sample_size(100) == 100 and 300 <= qc.sample_size(800) <= 500 and qc.sample_size(100_000) == 5000 and qc.sample_size(40_000) == 4000
    assert qc.biz_key(["nd_auto_increment_id", "x", "Encounter_ID"], "nd_auto_increment_id") == "Encounter_ID"
    d = vals(spark, ["born 1985-06-15 and 2099-01-01"], lambda c: qc.note_dates(c, F.array(F.lit("1985-06-15").cast("date")), today()))
    assert [(x["kind"], x["match"]) for x in d[0]] == [("date_leak", "1985-06-15"), ("date_implausible", "2099-01-01")]


def test_plan_of_appointment_chart_and_reference_ids(spark):
    pats = spark.createDataFrame([(1001, 101, 30, False, "r1"), (1002, 102, 31, True, "r2"), (1003, 103, -32, False, None)], "nd_patient_id bigint, patientid bigint, offset_days int, excluded boolean, reference_mapping string")
    appts = spark.createDataFrame([(71, 7001, 1001, "Y"), (72, 7002, 1002, "Y"), (73, 7003, 1003, "Y"), (73, 7009, 1001, "N")], "appointment_id bigint, nd_appointment_id bigint, nd_patient_id bigint, nd_activeflag string")
    charts = spark.createDataFrame([("c1", 8001, 1001), ("c3", 8003, 1003)], "chart_id string, nd_chart_id bigint, nd_patient_id bigint")
    at = "2020-01-01"
    for rule, rows, want, gone in (
        ("APPOINTMENT_ID", ["71", "72", "73", None], {(7001, "2020-01-31 00:00:00"), (7003, "2019-11-30 00:00:00")}, {"unresolved_id:72", "unresolved_id:NULL"}),
        ("CHART_ID", ["c1", "c3", "c9"], {(8001, "2020-01-31 00:00:00"), (8003, "2019-11-30 00:00:00")}, {"unresolved_id:c9"}),
        ("REFERENCE_PID", ["r1", "r2", None], {(1001, "2020-01-31 00:00:00")}, {"unresolved_id:r2", "unresolved_id:NULL"}),
    ):
        df = spark.createDataFrame([(x, at) for x in rows], "x string, at string")
        good, bad = plans.TablePlan("t", {"x": rule, "at": "DATE_OFFSET"}).apply(df, pats, appointments=appts, charts=charts)
        assert {tuple(r) for r in good.collect()} == want and {r["reason"] for r in bad.collect()} == gone
        with pytest.raises(plans.UnsafePlan):
            plans.TablePlan("t", {"x": rule}).apply(df, pats.drop("reference_mapping"))
    both = spark.createDataFrame([("r1", 103), ("r9", 103)], "ref string, pid bigint")
    good, _ = plans.TablePlan("t", {"ref": "REFERENCE_PID", "pid": "PATIENT_ID"}).apply(both, pats)
    assert {tuple(r) for r in good.collect()} == {(1001, 1003), (1003, 1003)}
