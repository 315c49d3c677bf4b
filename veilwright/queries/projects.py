"""Queries of settings, guards and whole runs, with their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from .. import plans, sources
from ..functions import rules
from ..operators import cdc
from ..operators import quality as qc
from ..plans import identifiers
from ..plans.pipeline import Config, mapping_gate, run_stats, run_tables
from ..plans.qc_run import check_project
from ..session import scratch_path
from .structured import T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""with m as (select min(nd_auto_increment_id) lo from enc_staging), w as (select lo + (nd_auto_increment_id - lo) // 1000 * 1000 s from enc_staging, m)
select s - 1 as gt, s + 1000 as lt, count(*) as n_rows from w group by s""")
def s03_id_windows(s, d):
    """Rows of each window of a thousand ids; null ids are a window of their own."""
    return sources.id_windows(T(s, d, "enc_staging"), "nd_auto_increment_id", 1000).groupBy("gt", "lt").agg(F.count(F.lit(1)).alias("n_rows"))


_TYPES = [("dob", "PATIENT_DOB", "DATE"), ("pid", "PATIENT_ID", "INT"), ("enc", "ENCOUNTER_ID", "INT"), ("at", "DATE_OFFSET", "DATETIME2(3)"), ("zip", "ZIP_CODE", "VARCHAR(10)"), ("body", "NOTES", "NTEXT"), ("ssn", "MASK", "VARCHAR(11)"), ("n", "", "DECIMAL(10,2)"), ("u", "", "UNIQUEIDENTIFIER"), ("t", "", "NVARCHAR(MAX)")]


@query("""select * from (values ('dob', 'INTEGER'), ('pid', 'BIGINT'), ('enc', 'BIGINT'), ('at', 'DATETIME'), ('zip', 'VARCHAR(50)'), ('body', 'LONGTEXT'), ('ssn', 'VARCHAR(60)'), ('n', 'DECIMAL(20,2)'), ('u', 'CHAR(36)'), ('t', 'LONGTEXT')) v(column_name, column_type)""")
def s19_s22_destination_types(s, d):
    """Types of a destination table: by rule, else the source's type in the destination's terms."""
    rows = [(n, sources.column_type(n, r, sources.translate_type(t))) for n, r, t in _TYPES]
    return s.createDataFrame(rows, "column_name string, column_type string")


@query("select * from (values ('a'), ('b')) v(column_name)")
def s20_row_size(s, d):
    """Text columns stored out of row, the widest first, until a row fits."""
    return s.createDataFrame([(c,) for c in sources.varchar_overflow({"a": 9000, "b": 8000, "c": 7000, "d": 2000})], "column_name string")


@query("""select * from (values ('mysql', 'SELECT * FROM `ehr`.`notes`'), ('mssql', 'SELECT [id], CAST([body] AS NVARCHAR(MAX)) AS [body] FROM [dbo].[notes] WITH (NOLOCK)'), ('postgresql', 'SELECT * FROM "ehr"."notes"')) v(kind, sql)""")
def s22_dialects(s, d):
    q = sources.table_query
    return s.createDataFrame([("mysql", q("mysql", "ehr.notes")), ("mssql", q("mssql", "dbo.notes", {"id": "INT", "body": "XML"})), ("postgresql", q("postgresql", "ehr.notes"))], "kind string, sql string")


@query("select event_id, user_id % 4 <> 3 as refused from events")
def s21_read_only(s, d):
    """Statements that a source refuses."""
    ok = {}
    for k, sql in enumerate(("delete from t where a = 1", "SELECT 1; DROP TABLE t", "with x as (select 1) insert into t select * from x", "select 'update' from t -- drop")):
        try:
            sources.only_reads(sql)
            ok[k] = False
        except PermissionError:
            ok[k] = True
    table = F.create_map(*[F.lit(x) for k, v in ok.items() for x in (k, v)])
    return T(s, d, "events").select("event_id", table[(F.col("user_id") % 4).cast("int")].alias("refused"))


@query("""select * from (values ('visits', 'patientid', 'encounterid', 'at', 'body', 'fname'), ('codes', null, null, '', '', '')) v(table_name, patient_col, encounter_col, date_cols, note_cols, name_cols)""")
def f10_roles(s, d):
    """What the rules of tables say about their columns."""
    r = plans.roles([("visits", "PatientID", "PATIENT_ID"), ("visits", "pid2", "PATIENT_X"), ("visits", "EncounterID", "ENCOUNTER_ID"), ("visits", "at", "DATE_OFFSET"), ("visits", "body", "NOTES"), ("visits", "FName", "MASK"), ("codes", "k", "")])
    return s.createDataFrame([(t, x.patient_col, x.encounter_col, ",".join(x.date_cols), ",".join(x.note_cols), ",".join(x.name_cols)) for t, x in r.items()], "table_name string, patient_col string, encounter_col string, date_cols string, note_cols string, name_cols string")


@query("select p_partkey, case when n <= 300 then n else least(3000 + (n - 10000) // 30000 * 1000, 5000) end as n_sample from (select p_partkey, case when p_partkey % 2 = 0 then p_partkey % 301 else 10001 + p_partkey * 37 end n from part)")
def l02_sample_sizes(s, d):
    """Sizes of samples by the table's size, where they aren't drawn."""
    n = F.expr("cast(if(p_partkey % 2 = 0, p_partkey % 301, 10001 + p_partkey * 37) as bigint)")

    @F.pandas_udf("bigint")
    def size(n: pd.Series) -> pd.Series:
        return n.map(qc.sample_size)

    return T(s, d, "part").select("p_partkey", size(n).alias("n_sample"))


@query("select facilityid::bigint as insert_id, count(*) as n from facilities where facilityid > 0 group by 1")
def c02_insert_ids(s, d):
    """Insert ids of statements in log texts; those that aren't positive are left out."""
    f = T(s, d, "facilities")
    text = F.concat(F.lit("use `ehr`;\n# at 100\nSET INSERT_ID="), F.col("facilityid").cast("string"), F.lit("/*!*/;\nINSERT INTO appts (a) VALUES (1)\n/*!*/;\n# at 200\nINSERT INTO appts (a) VALUES (2)\n# at 300\n"))
    log = cdc.read_log_texts(f.select(F.concat(F.lit("/logs/log."), F.monotonically_increasing_id()).alias("path"), text.alias("value")))
    i = F.get_json_object("payload", "$.insert_id").try_cast("bigint")
    return log.where(i.isNotNull()).groupBy(i.alias("insert_id")).agg(F.count(F.lit(1)).alias("n"))


_PII_RULES = {"pat": {"pid": "PATIENT_ID", "first_name": "MASK", "lname": "MASK", "dob": "PATIENT_DOB", "zip": "ZIP_CODE"}, "visits": {"pid": "PATIENT_ID", "at": "DATE_OFFSET"}}


@query("select * from (values ('mask', 'pat_first_name', '((FIRST_NAME))'), ('mask', 'pat_lname', '((LAST_NAME))'), ('dob', 'pat_dob', ''), ('combine', 'pat_name', '((PATIENT_NAME))')) v(kind, name, token)")
def m14_m16_personal_settings(s, d):
    """Masks, birth dates and combined names of the master table that the rules of tables give."""
    c = identifiers.pii_config(identifiers.pii_tables(_PII_RULES))
    return s.createDataFrame([(k, n, v.get("masking_value", "")) for k, m in c.items() for n, v in m.items()], "kind string, name string, token string")


@query("select * from (values ('one', 'PATIENT_CHARTID,DOB'), ('two', 'PATIENT_ID,PATIENT_DOB'), ('underscore', 'refused'), ('absent', 'refused'), ('other rule', 'refused'), ('fits', 'accepted')) v(name, result)")
def m17_m18_identifiers(s, d):
    """Old names under one identifier and under two, and what the identifier checks say."""
    r = {"p": "PATIENT_ID", "d": "PATIENT_DOB"}
    rows = [("one", ",".join(identifiers.remap_single(r, ["chartid"]).values())), ("two", ",".join(identifiers.remap_single(r, ["a", "b"]).values()))]
    for name, args in (("underscore", (["chart_id"], ["chart_id"], {})), ("absent", (["pid"], ["x"], {})), ("other rule", (["pid"], ["pid"], {"t": {"p": "PATIENT_OTHER"}})), ("fits", (["pid"], ["pid"], {"t": {"p": "PATIENT_PID"}}))):
        try:
            identifiers.check_identifiers(*args)
            rows.append((name, "accepted"))
        except plans.UnsafePlan:
            rows.append((name, "refused"))
    return s.createDataFrame(rows, "name string, result string")


@query("select * from (values ('no rules', true), ('unknown rule', true), ('absent column', true), ('notes without settings', true), ('no chart map', true), ('sound', false)) v(name, refused)")
def o06_guards(s, d):
    """Plans that would release what they mustn't are refused before anything runs."""
    rows, p = T(s, d, "encounter_notes"), T(s, d, "patient_mapping_table")
    out = []
    for name, r in (("no rules", {}), ("unknown rule", {"patientid": "PATIENT_ID", "content": "MASKED"}), ("absent column", {"gone": "MASK"}), ("notes without settings", {"patientid": "PATIENT_ID", "content": "NOTES"}), ("no chart map", {"facilityid": "CHART_ID"}), ("sound", {"patientid": "PATIENT_ID", "content": "MASK"})):
        try:
            plans.TablePlan("encounter_notes", r).apply(rows, p)
            out.append((name, False))
        except plans.UnsafePlan:
            out.append((name, True))
    return s.createDataFrame(out, "name string, refused boolean")


@query("""select * from (values ('a', 'x-d'), ('b', '["p", "q"]'), ('c', '{"k": 1}')) v(name, value)""")
def p04_variables(s, d):
    """Variables of a configuration, defaults, and values that are lists or maps."""
    import json

    got = plans.interpolate({"a": "${A}-${B:-d}", "b": "${L}", "c": "${M}"}, {"A": "x", "L": '["p", "q"]', "M": '{"k": 1}'})
    return s.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in got.items()], "name string, value string")


@query("select nd_auto_increment_id, left(ufname, 1) || '.' as ufname, '<<ULNAME>>' as ulname from pii_data_table")
def p05_own_rule(s, d):
    """A rule of one's own beside the given ones."""
    if "INITIAL" not in rules.RULES:
        rules.register_rule("INITIAL", lambda c, x: F.concat(F.left(c, F.lit(1)), F.lit(".")))
    rows = T(s, d, "pii_data_table").select("nd_auto_increment_id", "ufname", "ulname")
    return plans.TablePlan("pii", {"ufname": "INITIAL", "ulname": "MASK"}).apply(rows, T(s, d, "patient_mapping_table"))[0]


@query("""with p as (select (select count(*) from (select patientid from patient_mapping_table where patientid is not null group by 1 having count(distinct nd_patient_id) > 1)) u,
  (select count(*) from patient_mapping_table where offset_days < -38 or offset_days > 38 or abs(offset_days) < 30) o)
select 'mapping_uniqueness' as check_name, case when u > 0 then 'fail' else 'pass' end as status, u::varchar as detail from p union all select 'offset_range', case when o > 0 then 'fail' else 'pass' end, o::varchar from p""")
def q26_q44_gate(s, d):
    """Checks of the patient map as a run makes them before it starts."""
    return mapping_gate(s, Config(d, "", {}, encounter_map=None)).select("check_name", "status", F.col("detail").cast("string").alias("detail"))


def _run(s, d):
    cfg = Config(d, scratch_path(s, "project"), {"appointment_dump": {"patientid": "PATIENT_ID"}, "facilities": {"facility_name": ""}, "absent": {"a": "MASK"}}, exclude=["Other"])
    return cfg, run_tables(s, cfg)


_GOOD = "select count(*) n, count(*) filter (patientid in (select patientid from patient_mapping_table where not coalesce(excluded, false))) o from appointment_dump"


@query(f"""select 'completed' as status, 1 as n_tables, n as n_in, o as n_out, n - o as n_rejected, 0 as n_errors from ({_GOOD})
union all select 'passthrough', 1, count(*), count(*), 0, 0 from facilities union all select 'failed', 1, 0, 0, 0, 1""")
def a14_o07_run_stats(s, d):
    """Totals by status of a run over a table with rules, one without and one that isn't there."""
    return run_stats(_run(s, d)[1])


@query("""select * from (values ('part1', 2, 1), ('delta', 0, 0), ('master', 0, 0), ('fillrate', 1, 0), ('gate', 0, 0)) v(part, n_checked, n_failed)""")
def q40_q46_report(s, d):
    """The consolidated report of the checks of that run; the table that isn't there is an error of its own."""
    cfg, _ = _run(s, d)
    rep = check_project(s, cfg, ["appointment_dump", "absent"], gate=False)[2]
    return s.createDataFrame([(k, v.get("tables", v.get("checks")), v["failed"]) for k, v in rep.items() if isinstance(v, dict)], "part string, n_checked bigint, n_failed bigint")


@query(f"""select 1 as run, n as n_in, o as n_out from ({_GOOD.replace('from appointment_dump', 'from appointment_dump where nd_extracted_date < (select max(nd_extracted_date) from appointment_dump)')})""")
def s15_increment(s, d):
    """The first of two runs that take up records as they come, written to a partition of its own; a repeated run takes nothing."""
    dump = T(s, d, "appointment_dump")
    top = dump.agg(F.max("nd_extracted_date").alias("t")).first()["t"]
    rows = dump.where(F.col("nd_extracted_date") < F.lit(top).cast("timestamp_ntz")) if top is not None else dump.limit(0)
    out = scratch_path(s, "increment")
    cfg = Config(d, out, {"appointment_dump": {"patientid": "PATIENT_ID"}}, incremental={"appointment_dump": {"key": "nd_auto_increment_id", "times": ["nd_extracted_date", "nd_updated_at"]}}, state=f"{out}/_state", encounter_map=None)
    read = lambda t: rows if t == "appointment_dump" else T(s, d, t)
    first, again = run_tables(s, cfg, None, read).first(), run_tables(s, cfg, None, read).first()
    assert again["n_in"] == 0
    return s.createDataFrame([(1, first["n_in"], first["n_out"])], "run int, n_in bigint, n_out bigint")
