"""Queries of quality control, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import plans
from ..operators import quality as qc
from ..operators import resolve as rs
from ..plans.pipeline import Config, notes_audit, run_tables
from ..plans.qc_run import check_project
from ..session import scratch_path
from .structured import _DEID_RULES, _MAPS, _deid, T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add




@query(r"""select 'zip' as detector, count(*) filter (ok) as passed_count, count(*) filter (not ok) as failed_count
from (select trim(coalesce(z, '')) = '' or length(trim(z)) = 3 as ok from (select regexp_extract(upaddress, '(\d{5})', 1) z from pii_data_table))""")
def q01_zip(s, d):
    z = F.coalesce(F.regexp_extract("upaddress", r"(\d{5})", 1), F.lit(""))
    return qc.tally(T(s, d, "pii_data_table"), "zip", qc.zip_ok(z))


@query("select 'dob' as detector, count(*) as passed_count, 0::bigint as failed_count from pii_data_table")
def q02_birth_year(s, d):
    return qc.tally(T(s, d, "pii_data_table"), "dob", qc.birth_year_ok(F.year("dob")))


@query(f"with {_MAPS} select 'mask' as detector, count(*) filter (nd is not null) as passed_count, 0::bigint as failed_count from r")
def q04_mask(s, d):
    return qc.tally(_deid(s, d)[0], "mask", qc.mask_ok(F.col("visittype"), "VISITTYPE"))


def _verdicts(j, matched, p, e):
    """Verdicts of rows that carry their source date, patient and encounter, counted; offsets are looked up anew."""
    pats = rs.usable(p).groupBy("patientid").agg(F.min("nd_patient_id").alias("nd"), F.min("offset_days").alias("p_off"))
    off = pats.groupBy("nd").agg(F.min("p_off").alias("e_off"))
    enc = rs.without_excluded(rs.usable(e), p).groupBy("encounter_id").agg(F.min("nd_patient_id").alias("e_nd")).join(off, F.col("e_nd") == F.col("nd"), "left").select("encounter_id", "e_off")
    j = j.join(pats.select("patientid", "p_off").withColumnRenamed("patientid", "_pp"), F.col("_pid") == F.col("_pp"), "left").join(enc, F.col("_eid") == F.col("encounter_id"), "left")
    v = qc.offset_verdict(F.col("enc_date"), F.col("_s"), F.coalesce("e_off", "p_off"), matched, F.lit("2100-01-01").cast("date"))
    return j.select(v.alias("verdict")).groupBy("verdict").agg(F.count("*").alias("n_rows"))


@query(f"""with {_MAPS}, k as (select nd_auto_increment_id from r group by 1 having count(*) = 1)
select case when enc_date is null then null when true then 'pass' end as verdict, count(*) as n_rows from r where nd is not null and nd_auto_increment_id in (select nd_auto_increment_id from k) group by 1""")
def q03_q05_date_offset(s, d):
    """Shifted dates against the aligned source rows; records delivered once, as the alignment is by record number."""
    src, p, e = T(s, d, "enc_staging", "patient_mapping_table", "encounter_mapping_table")
    once = src.groupBy("nd_auto_increment_id").count().where("count = 1").select("nd_auto_increment_id")
    dest = _deid(s, d)[0].join(once, "nd_auto_increment_id", "left_semi")
    aligned = src.select(F.col("nd_auto_increment_id").alias("_r"), F.col("enc_date").cast("string").alias("_s"), F.col("patientid").alias("_pid"), F.col("encounterid").alias("_eid"))
    return _verdicts(dest.join(aligned, F.col("nd_auto_increment_id") == F.col("_r"), "left"), F.col("_r").isNotNull(), p, e)


@query()
def q03_q05_date_offset_all(s, d):
    """Shifted dates of all released rows, repeated deliveries and null ids too: the source cells travel through the plan beside the shifted ones."""
    src, p, e = T(s, d, "enc_staging", "patient_mapping_table", "encounter_mapping_table")
    src = src.withColumns({"_s": F.col("enc_date").cast("string"), "_pid": F.col("patientid"), "_eid": F.col("encounterid")})
    return _verdicts(plans.TablePlan("enc_staging", _DEID_RULES).apply(src, p, e)[0], F.lit(True), p, e)


@query("""with m as (select nd_patient_id nd, min(patientid)::varchar p from patient_mapping_table group by 1), s as (select id, nd_patient_id, patientid from encounter_mapping_table)
select ok, count(*) as n_rows from (select a.id, a.patientid::varchar is not distinct from m.p ok from s a join s b on a.id = b.id left join m on b.nd_patient_id = m.nd) group by 1""")
def q06_patient_id(s, d):
    e, p = T(s, d, "encounter_mapping_table", "patient_mapping_table")
    src = e.select("id", F.col("patientid").alias("v"))
    dest = e.select("id", F.col("nd_patient_id").alias("v"))
    return qc.reverse_ids(dest, src, "id", "v", p, "nd_patient_id", "patientid").groupBy("ok").agg(F.count("*").alias("n_rows"))


@query("""select 'encounter_id' as detector, count(*) filter (nd_encounter_id is null or (length(nd_encounter_id::varchar) = 12 and nd_encounter_id::varchar like nd_patient_id::varchar || '%')) as passed_count,
count(*) filter (not (nd_encounter_id is null or (length(nd_encounter_id::varchar) = 12 and nd_encounter_id::varchar like nd_patient_id::varchar || '%'))) as failed_count from encounter_mapping_table""")
def q08_encounter_id(s, d):
    t = F.col("nd_encounter_id").cast("string")
    ok = F.col("nd_encounter_id").isNull() | ((F.length(t) == 12) & F.startswith(t, F.col("nd_patient_id").cast("string")))
    return qc.tally(T(s, d, "encounter_mapping_table"), "encounter_id", ok)


@query("""select 'appointment_id' as detector, count(*) filter (apptid is null or (length(apptid::varchar) = 9 and apptid::varchar like '600%')) as passed_count,
count(*) filter (not (apptid is null or (length(apptid::varchar) = 9 and apptid::varchar like '600%'))) as failed_count from appointment_dump""")
def q09_appointment_id(s, d):
    return qc.tally(T(s, d, "appointment_dump"), "appointment_id", qc.id_ok(F.col("apptid"), 9, "600"))


@query(r"""with t as (select nd_auto_increment_id id, content c from encounter_notes where content is not null),
h as (select id, 'PHONE_NUMBER' k, unnest(regexp_extract_all(c, '(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}')) v from t
union all select id, 'EMAIL_ADDRESS', unnest(regexp_extract_all(c, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b')) from t
union all select id, 'US_SSN', unnest(regexp_extract_all(c, '\b\d{3}-\d{2}-\d{4}\b')) from t
union all select id, 'ZIP_CODE', unnest(regexp_extract_all(c, '\b\d{5}(?:-\d{4})?\b')) from t)
select k as type, count(*) as n_hits from (select distinct id, k, v from h) group by 1""")
def q13_residual(s, d):
    n = T(s, d, "encounter_notes").where("content is not null").select("nd_auto_increment_id", F.explode(qc.residual(F.col("content"))).alias("x")).select("nd_auto_increment_id", "x.type", "x.text").distinct()
    return n.groupBy("type").agg(F.count("*").alias("n_hits"))


@query("""select 'mapping_to_table_count' as check_name, case when a = b then 'pass' else 'fail' end as status, a::varchar || ' / ' || b::varchar as detail
from (select (select count(distinct patientid) from patient_mapping_table) a, (select count(distinct patientid) from encounter_mapping_table) b)""")
def q20_mapping_count(s, d):
    p, e = T(s, d, "patient_mapping_table", "encounter_mapping_table")
    u = p.select(F.lit("a").alias("k"), "patientid").unionByName(e.select(F.lit("b").alias("k"), "patientid")).distinct().agg(F.count_if((F.col("k") == "a") & F.col("patientid").isNotNull()).alias("a"), F.count_if((F.col("k") == "b") & F.col("patientid").isNotNull()).alias("b"))
    return qc.check("mapping_to_table_count", u, F.col("a") != F.col("b"), F.concat_ws(" / ", F.col("a").cast("string"), F.col("b").cast("string")))


@query("""with a as (select n, count(*) keys from (select patientid, count(distinct encounter_id) n from encounter_mapping_table group by 1) group by 1),
b as (select n, count(*) keys from (select nd_patient_id, count(distinct nd_encounter_id) n from encounter_mapping_table group by 1) group by 1)
select count(*) filter (a.keys is distinct from b.keys) as differences from a full join b on a.n = b.n""")
def q21_patient_encounters(s, d):
    e = T(s, d, "encounter_mapping_table")
    return qc.same_histogram(qc.histogram(e, "patientid", "encounter_id"), qc.histogram(e, "nd_patient_id", "nd_encounter_id"))


@query("""with a as (select n, count(*) keys from (select encounterid, count(*) n from enc_staging group by 1) group by 1), b as (select n, count(*) keys from (select encounterid, count(*) n from encounter_notes group by 1) group by 1)
select count(*) filter (a.keys is distinct from b.keys) as differences from a full join b on a.n = b.n""")
def q22_encounter_rows(s, d):
    a, b = T(s, d, "enc_staging", "encounter_notes")
    return qc.same_histogram(qc.histogram(a, "encounterid"), qc.histogram(b, "encounterid"))


_GATE = """select 'mapping_uniqueness' as check_name, case when v > 0 then 'fail' else 'pass' end as status, v::varchar as detail from (select count(*) v from (select patientid from patient_mapping_table group by 1 having count(distinct nd_patient_id) > 1))
union all select 'offset_range', case when v > 0 then 'fail' else 'pass' end, v::varchar from (select count(*) filter (offset_days < -38 or offset_days > 38 or abs(offset_days) < 30) v from patient_mapping_table)
union all select 'mapping_id_format', case when v > 0 then 'fail' else 'pass' end, v::varchar from (select count(*) filter (length(nd_patient_id::varchar) <> 8 or nd_patient_id::varchar not like '1%') v from patient_mapping_table)"""


def _checks(s, d):
    p = T(s, d, "patient_mapping_table")
    v = F.col("violations")
    fmt = p.agg(F.count_if(~qc.id_ok(F.col("nd_patient_id"), 8, "1")).alias("violations"))
    parts = [qc.check(n, df, v > 0, v) for n, df in (("mapping_uniqueness", qc.one_to_one(p, "patientid", "nd_patient_id")), ("offset_range", qc.offset_band(p, "offset_days")), ("mapping_id_format", fmt))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(_GATE)
def q23_q25_gate(s, d):
    return _checks(s, d)


@query("""with s as (select id, patientid::varchar v from encounter_mapping_table qualify row_number() over (partition by id order by patientid) = 1),
t as (select nd_auto_increment_id id, nd_patient_id::varchar v from pii_data_table qualify row_number() over (partition by nd_auto_increment_id order by nd_patient_id) = 1)
select t.id, case when s.id is null then 'extra_in_dest' else 'mismatch' end as issue, s.v as source_value, t.v as dest_value from t left join s on s.id = t.id where s.id is null or s.v is distinct from t.v""")
def q27_delta_identity(s, d):
    e, p = T(s, d, "encounter_mapping_table", "pii_data_table")
    e = e.groupBy("id").agg(F.min("patientid").alias("v"))
    p = p.groupBy(F.col("nd_auto_increment_id").alias("id")).agg(F.min("nd_patient_id").alias("v"))
    return qc.delta_identity(e, p, "id", "v")




@query("""with m as (select nd_patient_id, max(uemail) e, max(umobileno) ph, max(ulname) l from pii_data_table where nd_patient_id is not null group by 1),
n as (select nd_auto_increment_id, lower(coalesce(content, '')) t, e, ph, l from encounter_notes x join m using (nd_patient_id))
select nd_auto_increment_id, list_filter([case when trim(e) <> '' and contains(t, lower(trim(e))) then 'uemail' end, case when trim(ph) <> '' and contains(t, lower(trim(ph))) then 'umobileno' end,
case when trim(l) <> '' and (contains(t, lower(trim(l))) or len(list_filter(string_split(lower(trim(l)), ' '), lambda p: length(p) >= 3 and contains(t, p))) > 0) then 'ulname' end], lambda x: x is not null)::varchar as hits from n""")
def q12_q30_presence(s, d):
    n, p = T(s, d, "encounter_notes", "pii_data_table")
    m = p.where("nd_patient_id is not null").groupBy("nd_patient_id").agg(F.max("uemail").alias("e"), F.max("umobileno").alias("ph"), F.max("ulname").alias("l"))
    hits = qc.presence(F.col("content"), {"uemail": F.col("e"), "umobileno": F.col("ph"), "ulname": F.col("l")}, ["ulname"])
    return n.join(m, "nd_patient_id").select("nd_auto_increment_id", F.concat(F.lit("["), F.array_join(hits, ", "), F.lit("]")).alias("hits"))


@query(r"""select nd_auto_increment_id, concat_ws(',', case when regexp_matches(t, '(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}') then 'phone' end, case when regexp_matches(t, '\b\d{5}(?:-\d{4})?\b') then 'zip5' end,
case when regexp_matches(t, '(?i)https?://|www\.') then 'url' end,
case when regexp_matches(t, '(?i)\b\d{1,6}\s+(?:[A-Za-z0-9.]+\s+){0,3}(?:street|st|avenue|ave|road|rd|boulevard|blvd|lane|ln|drive|dr|court|ct|way|place|pl|terrace|ter|circle|cir|highway|hwy|parkway|pkwy)\b\.?') then 'address' end,
case when contains(lower(t), 'tarnwick clinic') then 'facility' end) as kinds from (select nd_auto_increment_id, coalesce(content, '') t from encounter_notes)""")
def q31_outcomes(s, d):
    return T(s, d, "encounter_notes").select("nd_auto_increment_id", F.array_join(qc.outcomes(F.col("content"), ["Tarnwick Clinic"]), ",").alias("kinds"))


@query("""select nd_auto_increment_id, 'date_leak' as kind, strftime(dob, '%Y-%m-%d') as match from pii_data_table where dob is not null
union all select nd_auto_increment_id, 'date_implausible', '1/2/2099' from pii_data_table where dob is not null""")
def q32_note_dates(s, d):
    p = T(s, d, "pii_data_table").where("dob is not null")
    text = F.concat(F.lit("born "), F.date_format("dob", "yyyy-MM-dd"), F.lit(", due 1/2/2099"))
    hits = qc.note_dates(text, F.array("dob"), F.lit("2024-12-31").cast("date"))
    return p.select("nd_auto_increment_id", F.explode(hits).alias("x")).select("nd_auto_increment_id", "x.kind", "x.match")


@query("""select count(*) as n_rows, count(*) filter (coalesce(trim(content), '') = '') as coverage_gaps, count(*) filter (contains(lower(content), '<<name>>')) as with_token from encounter_notes""")
def q33_q35_audit_totals(s, d):
    c = F.col("content")
    return T(s, d, "encounter_notes").agg(F.count("*").alias("n_rows"), F.count_if(F.trim(F.coalesce(c, F.lit(""))) == "").alias("coverage_gaps"), F.count_if(F.contains(F.lower(c), F.lit("<<name>>"))).alias("with_token"))


@query("""with a as (select count(*) n, count(patientid) p, count(encounterid) e from enc_staging), b as (select count(*) n, count(patientid) p, count(encounterid) e from encounter_notes)
select c as column_name, round(x * 100.0 / a.n, 2) as source_rate, round(y * 100.0 / b.n, 2) as dest_rate, abs(round(x * 100.0 / a.n, 2) - round(y * 100.0 / b.n, 2)) <= 1.0 as ok from a, b, lateral (values ('patientid', a.p, b.p), ('encounterid', a.e, b.e)) v(c, x, y)""")
def q45_a08_fill_rate(s, d):
    a, b = T(s, d, "enc_staging", "encounter_notes")
    return qc.compare_fill(a, b, ["patientid", "encounterid"])


@query(f"""with f as ({_GATE}) select 'patient_mapping_table' as table_name, count(*) as n_checks, count(*) filter (status = 'pass') as n_passed, count(*) filter (status = 'fail') as n_failed, 0::bigint as n_error,
case when bool_or(status = 'fail') then 'FAIL' else 'PASS' end as overall_status from f""")
def q41_q43_summary(s, d):
    f = _checks(s, d).select(F.lit("patient_mapping_table").alias("table_name"), "check_name", F.upper("status").alias("status"))
    return qc.summary(f)


@query("""select table_name, count(*) as n_runs, sum(epoch(finished_at) - epoch(started_at))::bigint as seconds, count(*) filter (lower(trim(status)) <> 'success') as n_not_ok
from (select lower(trim(table_name)) table_name, started_at, finished_at, status from delta_runs) group by 1""")
def a14_run_stats(s, d):
    r = T(s, d, "delta_runs").withColumn("table_name", F.lower(F.trim("table_name")))
    sec = F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at"))
    return r.groupBy("table_name").agg(F.count("*").alias("n_runs"), F.sum(sec).cast("bigint").alias("seconds"), F.count_if(F.lower(F.trim("status")) != "success").alias("n_not_ok"))


@query(f"""with {_MAPS}, n as (select (select count(*) from enc_staging) s, count(*) filter (nd is not null) d, count(*) filter (nd is null) r from r)
select 'enc_staging' as table_name, s as source_rows, d as dest_rows, r as rejected_rows, s = d + r as passed from n""")
def q14_table_scan(s, d):
    """Row-count verdict of a table against its rejects."""
    good, bad = _deid(s, d)
    n = rs.conservation(T(s, d, "enc_staging"), good, bad)
    return n.select(F.lit("enc_staging").alias("table_name"), F.col("n_in").alias("source_rows"), F.col("n_out").alias("dest_rows"), F.col("n_rejected").alias("rejected_rows"), F.col("balanced").alias("passed"))


@query("""with a as (select nd_patient_id k, min(offset_days) o, min(registration_date) r from patient_mapping_table group by 1), b as (select nd_patient_id k, min(offset_days) o, min(registration_date) r from patient_mapping_local group by 1)
select count(*) as total_records, count(*) filter (a.o is not distinct from b.o) as matching_records, count(*) filter (a.r is not null and b.r is not null and a.r <> b.r) as different_values, count(*) filter (a.r is null or b.r is null) as null_values from a join b on a.k = b.k""")
def q16_compare_samples(s, d):
    """Plain columns must agree; for changed columns the differing and empty values are counted."""
    a, b = (t.groupBy(F.col("nd_patient_id").alias("k")).agg(F.min("offset_days").alias(f"o{i}"), F.min("registration_date").alias(f"r{i}")) for i, t in enumerate(T(s, d, "patient_mapping_table", "patient_mapping_local")))
    j = a.join(b, "k")
    return j.agg(F.count("*").alias("total_records"), F.count_if(F.col("o0").eqNullSafe(F.col("o1"))).alias("matching_records"), F.count_if(F.col("r0") != F.col("r1")).alias("different_values"), F.count_if(F.col("r0").isNull() | F.col("r1").isNull()).alias("null_values"))


@query("""with n as (select nd_auto_increment_id, nd_patient_id, content from encounter_notes), m as (select distinct nd_patient_id p from pii_data_table where nd_patient_id is not null)
select count(*) as audited, count(*) filter (p is null) as without_master, count(*) filter (coalesce(content, '') = '') as coverage_gaps from n left join m on n.nd_patient_id = m.p""")
def q34_q37_audit(s, d):
    n, p = T(s, d, "encounter_notes", "pii_data_table")
    m = p.where("nd_patient_id is not null").select(F.col("nd_patient_id").alias("p")).distinct()
    j = n.join(m, F.col("nd_patient_id") == F.col("p"), "left")
    return j.agg(F.count("*").alias("audited"), F.count_if(F.col("p").isNull()).alias("without_master"), F.count_if(F.coalesce("content", F.lit("")) == "").alias("coverage_gaps"))


@query("""with m as (select nd_patient_id k, list(v) vs, list(w) filter (length(w) >= 3) ws from (
  select nd_patient_id, unnest([ufname, ulname, umobileno, uemail, upaddress, registration_date]) v, unnest(string_split_regex(lower(trim(coalesce(ufname, ''))), '\\s+') || string_split_regex(lower(trim(coalesce(ulname, ''))), '\\s+')) w from pii_data_table) where k is not null group by 1)
select nd_auto_increment_id, coalesce(trim(content) = '', true) as gap,
  coalesce(len(list_filter(vs, lambda x: trim(x) <> '' and contains(lower(content), lower(trim(x))))) > 0 or len(list_filter(ws, lambda x: contains(lower(content), x))) > 0, false) as has_phi
from encounter_notes left join m on nd_patient_id = k""")
def q34_notes_audit(s, d):
    """All notes against all rows of their patient in the master table."""
    a = notes_audit(T(s, d, "encounter_notes"), T(s, d, "pii_data_table"), ["content"])
    return a.select("nd_auto_increment_id", F.coalesce("gap", F.lit(True)).alias("gap"), (F.size("phi_hits") > 0).alias("has_phi"))


@query("""select 'appointment_dump' as "table", 'PASS' as overall_status, 'PASS' as part1_status, '' as part1_failed_columns, count(*)::varchar as part1_source_rows,
count(*) filter (patientid in (select patientid from patient_mapping_table where not coalesce(excluded, false)))::varchar as part1_dest_rows,
'SKIPPED' as delta_status, '' as delta_missing_in_dest, '' as delta_extra_in_dest, '' as delta_value_mismatch, 'SKIPPED' as master_status, '' as master_fail_count, '' as master_coverage_gaps, 'PASS' as fillrate_status, '' as fillrate_failed_columns, '' as errors from appointment_dump
union all select 'pii_data_table', 'FAIL', 'FAIL', 'ulname', count(*)::varchar, count(*)::varchar, 'SKIPPED', '', '', '', 'SKIPPED', '', '', 'SKIPPED', '', '' from pii_data_table""")
def q41_project_summary(s, d):
    """Two tables run through the pipeline and checked; in one a column was put back as it was."""
    summary, _ = _checked_project(s, d)
    return summary


@query("""select 'pii_data_table' as "table", 'part1' as part, 'phi_detected' as "check", 'ulname' as "column", 'FAIL' as status, count(*) as "count" from pii_data_table where ulname is distinct from '<<ULNAME>>'""")
def q42_project_findings(s, d):
    """The findings of that check without their details."""
    return _checked_project(s, d)[1].drop("detail")


def _checked_project(s, d):
    cfg = Config(d, scratch_path(s, "project"), {"appointment_dump": {"patientid": "PATIENT_ID"}, "pii_data_table": {"ufname": "MASK", "ulname": "MASK", "dob": "DOB"}})
    run_tables(s, cfg)
    done = s.read.parquet(f"{cfg.destination}/pii_data_table.parquet")
    raw = T(s, d, "pii_data_table").select("nd_auto_increment_id", "ulname")
    whole = raw.groupBy(F.col("nd_auto_increment_id").alias("_k")).agg(F.min("ulname").alias("raw"))
    done.join(whole, F.col("nd_auto_increment_id").eqNullSafe(F.col("_k")), "left").withColumn("ulname", F.col("raw")).drop("_k", "raw").write.parquet(f"{cfg.destination}/changed.parquet")
    s.read.parquet(f"{cfg.destination}/changed.parquet").write.mode("overwrite").parquet(f"{cfg.destination}/pii_data_table.parquet")
    summary, findings, _ = check_project(s, cfg, gate=False)
    return summary, findings
