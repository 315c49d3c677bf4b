"""Queries of change data capture, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc
from ..operators import cdc_apply as ca
from ..operators.change_feed import sequence
from ..session import scratch_path
from ..streaming.changes import StateTable, run_available
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


def _log(s, d):
    return T(s, d, "change_log")


@query("select lower(trim(table_name)) as table_name, count(*) as n_events from change_log group by 1")
def c04_events_per_table(s, d):
    return _log(s, d).groupBy(F.lower(F.trim("table_name")).alias("table_name")).agg(F.count("*").alias("n_events"))


@query("""with m as (select lower(trim(table_name)) t, max_by(regexp_extract(binlog_file, '\\.(\\d+)$', 1)::bigint, dump_completed_at) f, max_by(binlog_pos, dump_completed_at) p from dump_metadata where binlog_file is not null and dump_completed_at is not null group by 1)
select id from (select c.id, regexp_extract(binlog_file, '\\.(\\d+)$', 1)::bigint cf, binlog_pos cp, m.f, m.p from change_log c left join m on lower(trim(c.table_name)) = m.t where binlog_file is not null) where f is null or cf > f or (cf = f and cp >= p)""")
def c05_position_filter(s, d):
    return cdc.after_position(_log(s, d), T(s, d, "dump_metadata").where("dump_completed_at is not null")).select("id")


@query("select event_id, case user_id % 3 when 0 then '-1' when 1 then 'abc' else null end as value from events")
def c09_literals(s, d):
    lit = F.when(F.col("user_id") % 3 == 0, F.lit("-1 (4294967295)")).when(F.col("user_id") % 3 == 1, F.lit("0x616263")).otherwise(F.lit("NULL"))
    return T(s, d, "events").select("event_id", cdc.decode_literal(lit).alias("value"))


@query("""select id, k as "column", count(*) as n from (select id, unnest(json_keys(payload)) j, ['apptid', 'patientid', 'facilityid'] names from change_log), lateral (select names[try_cast(j as int)] k) where k is not null group by 1, 2""")
def c10_ordinals(s, d):
    p = _log(s, d).select("id", F.explode(cdc.ordinals(F.col("payload"), ["apptid", "patientid", "facilityid"])).alias("x"))
    return p.groupBy("id", F.col("x.column").alias("column")).agg(F.count("*").alias("n"))


_SQLS = "case user_id % 5 when 0 then 'DELETE FROM t WHERE id = 1' when 1 then 'DELETE t FROM t JOIN u ON t.id = u.id' when 2 then 'DELETE FROM t' when 3 then 'INSERT INTO t (a) VALUES (1)' else 'INSERT INTO t SELECT 1' end"


@query(f"select event_id, case user_id % 5 when 0 then 'soft_delete' when 1 then 'flag_join' when 2 then 'refuse' end as delete_kind, case user_id % 5 when 3 then 'VALUES' when 4 then 'INSERT_SELECT' end as insert_format from events")
def c07_c15_statements(s, d):
    e = T(s, d, "events").withColumn("sql", F.expr(_SQLS))
    return e.select("event_id", cdc.delete_kind(F.col("sql")).alias("delete_kind"), cdc.insert_format(F.col("sql")).alias("insert_format"))


@query("select event_id, user_id::varchar as a, '''x, (y)''' as b from events")
def c08_insert_values(s, d):
    sql = F.concat(F.lit("INSERT INTO `t` (`a`, b) VALUES ("), F.col("user_id").cast("string"), F.lit(", 'x, (y)')"))
    m = T(s, d, "events").select("event_id", cdc.insert_values(sql).alias("m"))
    return m.select("event_id", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"))


_OP = "case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end"


def _events(s, d):
    return T(s, d, "events").select("user_id", "ts", "event_id", F.expr(_OP).alias("op"), F.when(F.col("event_type") != "view", F.col("value")).alias("value"), "event_type")


@query(f"""with e as (select user_id, ts, event_id, {_OP} op, case when event_type <> 'view' then value end as v from events)
select user_id, max_by(v, (ts, event_id)) filter (v is not null) as value, max_by(op, (ts, event_id)) as nd_operation, case when max_by(op, (ts, event_id)) = 'DELETE' then 'N' else 'Y' end as nd_activeflag, count(*) as n_events, min_by(event_id, (ts, event_id)) as first_event from e group by 1""")
def c20_net_effect(s, d):
    return cdc.net_effect(_events(s, d), "user_id", ["value"], ["ts", "event_id"])


@query(f"""with e as (select user_id, ts, event_id, {_OP} op from events), w as (select *, lag(op) over (partition by user_id order by ts, event_id) p from e)
select case op when 'INSERT' then case when p is not null and p <> 'DELETE' then 'refreshed' else 'inserted' end when 'UPDATE' then case when p is not null and p <> 'DELETE' then 'updated' else 'upserted' end
else case when p is not null and p <> 'DELETE' then 'soft_deleted' else 'unchanged' end end as outcome, count(*) as n_events from w group by 1""")
def c18_stats(s, d):
    return cdc.outcome(_events(s, d), "user_id", ["ts", "event_id"]).groupBy("outcome").agg(F.count("*").alias("n_events"))


@query("select user_id, max_by(event_type, (ts, event_id)) as event_type, max_by(value, (ts, event_id)) as value from events group by 1")
def c20_stream_state(s, d):
    """The state rebuilt by a checkpointed file stream equals that of the batch."""
    base = scratch_path(s, "c20")
    src = f"{base}/in"
    T(s, d, "events").write.parquet(src)
    table = StateTable(s, f"{base}/state", "user_id", ["event_type", "value"], ["ts", "event_id"])
    stream = s.readStream.schema(s.read.parquet(src).schema).option("maxFilesPerTrigger", 8).parquet(src)
    run_available(stream, table, f"{base}/progress")
    return table.read().select("user_id", "event_type", "value")


@query("""with p as (select apptid, min(nd_auto_increment_id) n, min(appt_status) s from appointment_dump group by 1), g as (select (payload->>'1')::bigint apptid, 99 n, 'from log' s from change_log where lower(trim(table_name)) = 'appointments' group by 1)
select coalesce(p.apptid, g.apptid) as apptid, coalesce(p.n, g.n)::bigint as nd_auto_increment_id, coalesce(g.s, p.s) as appt_status from p full join g on p.apptid = g.apptid""")
def c21_merge(s, d):
    a = T(s, d, "appointment_dump").groupBy("apptid").agg(F.min("nd_auto_increment_id").alias("nd_auto_increment_id"), F.min("appt_status").alias("appt_status"))
    log = _log(s, d).where(F.lower(F.trim("table_name")) == "appointments")
    g = log.select(F.get_json_object("payload", "$.1").try_cast("bigint").alias("apptid")).distinct().select("apptid", F.lit(99).cast("bigint").alias("nd_auto_increment_id"), F.lit("from log").alias("appt_status"))
    return cdc.merge_tables(a, g, "apptid")


_POS = """select lower(trim(table_name)) as table_name, max_by(binlog_file, (regexp_extract(binlog_file, '\\.(\\d+)$', 1)::bigint, binlog_pos)) as binlog_file,
max_by(binlog_pos, (regexp_extract(binlog_file, '\\.(\\d+)$', 1)::bigint, binlog_pos)) as binlog_pos, count(*) as n_events from change_log where binlog_file is not null and binlog_pos is not null group by 1"""


@query(_POS)
def a11_last_positions(s, d):
    return cdc.positions(_log(s, d))


@query(f"""with t as ({_POS}), b as (select 'old_' || lower(trim(table_name)) as table_name, max(binlog_file) as binlog_file, max(binlog_pos) as binlog_pos, count(*) as n_events from dump_metadata group by 1)
select * from t union all select * from b where table_name not in (select table_name from t)""")
def c23_j18_snapshot(s, d):
    before = T(s, d, "dump_metadata").groupBy(F.concat(F.lit("old_"), F.lower(F.trim("table_name"))).alias("table_name")).agg(F.max("binlog_file").alias("binlog_file"), F.max("binlog_pos").alias("binlog_pos"), F.count("*").alias("n_events"))
    return cdc.carry_forward(cdc.positions(_log(s, d)), before)


@query("select nd_auto_increment_id, coalesce(nd_extracted_date, timestamp '2024-07-01 00:00:00') as nd_extracted_date, coalesce(nd_operation, 'INSERT') as nd_operation, coalesce(nd_activeflag, 'Y') as nd_activeflag from enc_staging")
def c19_audit(s, d):
    return cdc.with_audit(T(s, d, "enc_staging"), F.expr("timestamp_ntz'2024-07-01 00:00:00'")).select("nd_auto_increment_id", "nd_extracted_date", "nd_operation", "nd_activeflag")


@query("select nd_auto_increment_id, nd_extracted_date, case when nd_activeflag is null or lower(nd_activeflag) = 'yes' then 'Y' else nd_activeflag end as nd_activeflag from enc_staging")
def c27_renames(s, d):
    e = T(s, d, "enc_staging").select("nd_auto_increment_id", F.col("nd_extracted_date").alias("nd_extracted_at"), F.col("nd_activeflag").alias("nd_is_active"))
    return cdc.rename_audit(e)


@query("""with p as (select patientid, min(nd_patient_id) nd from patient_mapping_table group by 1)
select id, e.patientid, coalesce(case when nd_activeflag = 'Y' then nd_patient_id end, p.nd) as nd_patient_id from encounter_mapping_table e left join p on e.patientid = p.patientid""")
def c33_backfill(s, d):
    e, p = T(s, d, "encounter_mapping_table", "patient_mapping_table")
    gaps = e.select("id", "patientid", F.when(F.col("nd_activeflag") == "Y", F.col("nd_patient_id")).alias("nd_patient_id"))
    return cdc.backfill(gaps, p)


@query("""select 'enc_staging' as table_name, count(*) as n_rows, count(nd_operation) as n_changed from enc_staging union all select 'encounter_notes', count(*), count(nd_operation) from encounter_notes union all select 'appointment_dump', count(*), count(nd_operation) from appointment_dump""")
def c22_c34_table_stats(s, d):
    out = None
    for t in ("enc_staging", "encounter_notes", "appointment_dump"):
        x = T(s, d, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows"), F.count("nd_operation").alias("n_changed"))
        out = x if out is None else out.unionByName(x)
    return out


@query("select upper(trim(operation)) as operation, lower(trim(table_name)) as table_name, count(*) as n_events from change_log group by 1, 2 order by 3 desc")
def c35_failure_counts(s, d):
    return _log(s, d).groupBy(F.upper(F.trim("operation")).alias("operation"), F.lower(F.trim("table_name")).alias("table_name")).agg(F.count("*").alias("n_events")).orderBy(F.desc("n_events"))


@query("select id, binlog_file, binlog_pos from change_log order by try_cast(regexp_extract(binlog_file, '\\.(\\d+)$', 1) as bigint) nulls first, binlog_pos nulls first, id")
def c31_l08_log_order(s, d):
    """The whole log in the order of its files' numbers, positions and ids."""
    return _log(s, d).select("id", "binlog_file", "binlog_pos").orderBy(sequence(F.col("binlog_file"), F.col("binlog_pos"), F.col("id")))


@query("select o_orderkey, case o_orderstatus when 'F' then 'INSERT' when 'O' then 'UPDATE' when 'P' then 'DELETE' end as op from orders")
def c26_log_operations(s, d):
    code = F.when(F.col("o_orderstatus") == "F", "LOP_INSERT_ROWS").when(F.col("o_orderstatus") == "O", "LOP_MODIFY_ROW").when(F.col("o_orderstatus") == "P", "LOP_DELETE_ROWS")
    return T(s, d, "orders").select("o_orderkey", cdc.log_operation(code).alias("op"))


@query("select user_id as k, 'row' as v, event_id from events")
def c25_row_images(s, d):
    """Row images built and decoded again: status, fixed part, null bitmap, variable part."""
    head = F.unhex(F.lit("30000C00"))
    le = F.unhex(F.regexp_replace(F.lpad(F.hex("user_id"), 16, "0"), "(..)(..)(..)(..)(..)(..)(..)(..)", "$8$7$6$5$4$3$2$1"))
    tail = F.unhex(F.concat(F.lit("0200" + "00" + "0100" + "1600"), F.hex(F.encode(F.lit("row"), "UTF-8"))))
    img = F.concat(head, le, tail)
    m = T(s, d, "events").select("event_id", cdc.row_decoder([("k", "bigint", 8), ("v", "varchar", 0)])(img).alias("m"))
    return m.select(F.col("m")["k"].try_cast("bigint").alias("k"), F.col("m")["v"].alias("v"), "event_id")


@query("""select 'log.' || lpad(facilityid::varchar, 4, '0') as binlog_file, 'appts' as table_name, 'INSERT' as operation, count(*) as n_events from facilities group by 1, 2, 3""")
def c01_log_texts(s, d):
    """Log texts written from a table and parsed file by file."""
    f = T(s, d, "facilities")
    text = F.concat(F.lit("# at 100\n### INSERT INTO `ehr`.`appts`\n### SET\n###   @1="), F.col("facilityid").cast("string"), F.lit("\n###   @2='"), "facility_name", F.lit("'\n# at 200\n"))
    files = f.select(F.concat(F.lit("/logs/log."), F.lpad(F.col("facilityid").cast("string"), 4, "0")).alias("path"), text.alias("value"))
    return cdc.read_log_texts(files, ["ehr"]).groupBy("binlog_file", "table_name", "operation").agg(F.count("*").alias("n_events"))


@query("""select max_by(dump_file, dump_completed_at) as dump_file from dump_metadata where dump_completed_at >= timestamp '2024-03-01' - interval 30 day and dump_completed_at < timestamp '2024-03-01'""")
def c06_latest_snapshot(s, d):
    """The last snapshot of the 30 days before a run."""
    m = T(s, d, "dump_metadata").where("dump_completed_at >= timestamp_ntz'2024-01-31 00:00:00' and dump_completed_at < timestamp_ntz'2024-03-01 00:00:00'")
    return m.agg(F.max_by("dump_file", "dump_completed_at").alias("dump_file"))


@query("""with s as (select nd_patient_id k, 'missing_in_local' kind from patient_mapping_table where nd_patient_id not in (select nd_patient_id from patient_mapping_local) group by 1
union all select nd_patient_id, 'extra_in_local' from patient_mapping_local where nd_patient_id not in (select nd_patient_id from patient_mapping_table) group by 1)
select kind, count(*) as n_ids from s group by 1""")
def c24_id_validation(s, d):
    a, b = (t.select("nd_patient_id").distinct() for t in T(s, d, "patient_mapping_table", "patient_mapping_local"))
    out = a.join(b, "nd_patient_id", "left_anti").select(F.lit("missing_in_local").alias("kind")).unionByName(b.join(a, "nd_patient_id", "left_anti").select(F.lit("extra_in_local").alias("kind")))
    return out.groupBy("kind").agg(F.count("*").alias("n_ids"))


@query("""with c as (select apptid, case when nd_operation = 'DELETE' then 'N' else coalesce(nd_activeflag, 'Y') end f from appointment_dump) select apptid, min(f) as nd_activeflag from c group by 1""")
def c14_soft_delete(s, d):
    """Deleted rows stay with flag N."""
    a = T(s, d, "appointment_dump")
    f = F.when(F.col("nd_operation") == "DELETE", "N").otherwise(F.coalesce("nd_activeflag", F.lit("Y")))
    return a.groupBy("apptid").agg(F.min(f).alias("nd_activeflag"))


@query("select id, count(*) as n_columns from (select id, unnest(json_keys(payload)) k from change_log) where k <> '5' group by 1")
def c11_generated_columns(s, d):
    """Columns the database computes are taken out of the payload."""
    kept = _log(s, d).select("id", F.size(cdc.without_generated(F.col("payload"), ["5"])).cast("bigint").alias("n_columns"))
    return kept.where("n_columns > 0")


@query("""with l as (select lower(trim(table_name)) t, upper(substr(trim(operation), 1, 1)) o, payload->>'1' k, id from change_log where binlog_pos is not null)
select t as table_name, count(*) filter (o = 'I' and k is not null) as inserts, count(*) filter (o = 'I' and k is null) as inserts_without_key, count(*) filter (o = 'U' and k is null) as updates_skipped, count(*) filter (o = 'D') as deletes from l group by 1""")
def c12_c13_apply_rules(s, d):
    """Inserts need a key, updates without key are skipped, deletes are counted."""
    l = _log(s, d).where("binlog_pos is not null").select(F.lower(F.trim("table_name")).alias("table_name"), F.upper(F.substring(F.trim("operation"), 1, 1)).alias("o"), F.get_json_object("payload", "$.1").alias("k"))
    o, k = F.col("o"), F.col("k")
    return l.groupBy("table_name").agg(F.count_if((o == "I") & k.isNotNull()).alias("inserts"), F.count_if((o == "I") & k.isNull()).alias("inserts_without_key"), F.count_if((o == "U") & k.isNull()).alias("updates_skipped"), F.count_if(o == "D").alias("deletes"))


@query("select nd_auto_increment_id, coalesce(nd_operation, 'INSERT') as nd_operation, coalesce(nd_updated_at, timestamp '2024-07-01 00:00:00') as nd_updated_at from appointment_dump")
def c32_null_fill(s, d):
    return cdc.with_audit(T(s, d, "appointment_dump"), F.expr("timestamp_ntz'2024-07-01 00:00:00'")).select("nd_auto_increment_id", "nd_operation", "nd_updated_at")


@query("select event_id, case user_id % 2 when 0 then 'insert_select' else 'insert' end as kind from events")
def c30_insert_select(s, d):
    """Inserts that copy from a query are told apart, as they can't be replayed from the log alone."""
    sql = F.expr("case user_id % 2 when 0 then 'INSERT INTO a SELECT * FROM b' else 'INSERT INTO a SET x = 1' end")
    f = cdc.insert_format(sql)
    return T(s, d, "events").select("event_id", F.when(f == "INSERT_SELECT", "insert_select").otherwise("insert").alias("kind"))


_COLS = {"1": "apptid", "2": "patientid", "3": "facilityid", "4": "appt_status"}
_APPLY = r"""
with e as (
  select (try_cast(regexp_extract(binlog_file, '\.(\d+)$', 1) as bigint), binlog_pos, id) s, upper(substr(trim(operation), 1, 1)) o, payload::json j
  from change_log where lower(trim(table_name)) = 'appointments' and binlog_pos is not null and regexp_matches(binlog_file, '\.(\d+)$')),
v as (
  select s, o, json_keys(j) ks, list_transform(['1', '2', '3', '4'], lambda p: case when upper(trim(j->>p)) = 'NULL' then null
    when regexp_matches(trim(j->>p), '^-?\d+\s+\(\d+\)$') then regexp_extract(trim(j->>p), '^(-?\d+)', 1)
    when starts_with(trim(j->>p), chr(39)) and ends_with(trim(j->>p), chr(39)) and length(trim(j->>p)) > 1 then regexp_replace(trim(j->>p)[2:-2], '\\(.)', '\1', 'g') else trim(j->>p) end) c from e),
b as (select apptid::varchar k, max(coalesce(nd_operation, 'NONE')) op, max_by(coalesce(nd_activeflag, 'Y'), coalesce(nd_operation, 'NONE')) fl, max(patientid)::varchar c2, max(facilityid)::varchar c3, max(appt_status) c4
  from appointment_dump where apptid is not null group by 1),
births as (select k, min(s) born from (select k, (-1::bigint, -1::bigint, -1::bigint) s from b union all select c[1], s from v where o in ('I', 'U') and c[1] is not null) group by 1),
x as (
  select v.*, c[1] k, born, case when len(list_intersect(ks, ['1', '2', '3', '4'])) = 0 or o not in ('I', 'U', 'D') then 'skipped_row_based' when o = 'I' and c[1] is null then 'errors_insert_no_pk' when o = 'U' and c[1] is null then 'skipped_row_based'
    when o = 'I' then case when s > born then 'refreshed' else 'inserted' end when o = 'U' then 'updated' when s > born then 'soft_deleted' else 'delete_no_match' end outcome
  from v left join births on c[1] = births.k)
"""


def _applied(s, d):
    cols = list(_COLS.values())
    base = ca.base_rows(T(s, d, "appointment_dump"), "apptid", cols)
    log = _log(s, d).where(F.lower(F.trim("table_name")) == "appointments")
    return ca.apply_row_events(base, ca.row_events(log, _COLS), "apptid", cols)


@query(_APPLY + r"""
, r as (select k, s, case o when 'I' then 'INSERT' when 'U' then 'UPDATE' else 'DELETE' end op, case when o = 'D' then 'N' when o = 'I' or s = born then 'Y' end fl, o <> 'D' and list_contains(ks, '2') h2, c[2] c2, o <> 'D' and list_contains(ks, '3') h3, c[3] c3, o <> 'D' and list_contains(ks, '4') h4, c[4] c4
  from x where outcome in ('inserted', 'refreshed', 'updated', 'soft_deleted')
  union all select k, (-1::bigint, -1::bigint, -1::bigint), op, fl, true, c2, true, c3, true, c4 from b)
select k as apptid, max_by(op, s) as nd_operation, max_by(fl, s) filter (fl is not null) as nd_activeflag, (max_by([c2], s) filter (h2))[1] as patientid, (max_by([c3], s) filter (h3))[1] as facilityid, (max_by([c4], s) filter (h4))[1] as appt_status from r group by 1""")
def c12_c13_c14_apply(s, d):
    """All events of appointments applied to the dump: inserts, upserting updates and soft deletes by key."""
    return _applied(s, d)[0].select(F.col("k").alias("apptid"), "nd_operation", "nd_activeflag", "patientid", "facilityid", "appt_status")


@query(_APPLY + "select u.c as counter, (select count(*) from x where outcome = u.c) as n from (select unnest([" + ", ".join(f"'{c}'" for c in ca.COUNTERS) + "]) c) u")
def a15_counters(s, d):
    """All counters of that run."""
    return ca.counters(_applied(s, d)[1])


@query("""select nd_auto_increment_id::varchar as k, 'DELETE' as nd_operation, 'N' as nd_activeflag from appointment_dump group by 1 having true
union all select '-1', 'INSERT', 'Y'""")
def c14_image_deletes(s, d):
    """Every row deleted by its whole image, as the log of a table without key has it, and one new row."""
    t = T(s, d, "appointment_dump")
    cols = ["nd_auto_increment_id", "apptid", "patientid", "facilityid", "appt_status"]
    base = ca.base_rows(t.drop("nd_operation", "nd_activeflag"), "nd_auto_increment_id", cols)
    seq = lambda pos: F.struct(F.lit(1).cast("bigint").alias("file"), pos.cast("bigint").alias("pos"), pos.cast("bigint").alias("id"))
    image = F.create_map(*[x for c in cols[1:] for x in (F.lit(c), F.col(c))])
    gone = base.select(seq(F.col("nd_auto_increment_id")).alias("seq"), F.lit("DELETE").alias("op"), image.alias("image"))
    new = s.range(1).select(seq(F.lit(0)).alias("seq"), F.lit("INSERT").alias("op"), F.create_map(F.lit("nd_auto_increment_id"), F.lit("-1"), F.lit("apptid"), F.lit("-1")).alias("image"))
    return ca.apply_row_events(base, gone.unionByName(new), "nd_auto_increment_id", cols)[0].select("k", "nd_operation", "nd_activeflag")


@query("""select o_orderkey::varchar as k, case when o_orderkey % 3 = 2 then 'DELETE' when o_orderkey % 3 = 1 then 'UPDATE' else 'INSERT' end as nd_operation, case when o_orderkey % 3 = 2 then 'N' else 'Y' end as nd_activeflag,
case when o_orderkey % 3 = 1 then 'it''s (new), ' || o_orderstatus else o_orderstatus end as status, o_custkey::varchar as cust from orders""")
def c16_statements(s, d):
    """Statements of a log read and applied: inserts of two tuples, updates and deletes by key."""
    o = T(s, d, "orders")
    row = F.concat(F.lit("("), F.col("o_orderkey"), F.lit(", '"), "o_orderstatus", F.lit("', "), "o_custkey", F.lit(")"))
    ins = F.concat(F.lit("INSERT INTO t (id, status, cust) VALUES "), row, F.lit(", ("), -F.col("o_orderkey") - 1, F.lit(", NULL, NULL)"))
    upd = F.concat(F.lit("UPDATE t SET status = 'it''s (new), "), "o_orderstatus", F.lit("' WHERE id = "), "o_orderkey")
    dele = F.concat(F.lit("DELETE FROM t WHERE id = "), "o_orderkey")
    key = F.col("o_orderkey") % 3
    sql = F.array_compact(F.array(ins, F.when(key == 1, upd), F.when(key == 2, dele)))
    log = o.select(F.posexplode(sql).alias("n", "sql"), "o_orderkey").select("sql", F.lit("log.1").alias("binlog_file"), (F.col("o_orderkey") * 4 + F.col("n")).alias("binlog_pos"), F.lit(1).alias("id"))
    events, _ = ca.statement_events(log, "id", F.col("sql"))
    cols = ["id", "status", "cust"]
    table, _ = ca.apply_row_events(ca.base_rows(s.createDataFrame([], "id string, status string, cust string"), "id", cols), events, "id", cols)
    return table.where("not startswith(k, '-')").select("k", "nd_operation", "nd_activeflag", "status", "cust")


@query("""select lower(trim(table_name)) as table_name, coalesce(max_by(dump_file, dump_completed_at) filter (dump_completed_at >= timestamp '2024-03-01' - interval 30 day and dump_completed_at < timestamp '2024-03-01'), 'base') as dump_file from dump_metadata group by 1""")
def c06_snapshot_per_table(s, d):
    """The last dump of the 30 days before a run of each table, else the base dump."""
    return cdc.latest_snapshot(T(s, d, "dump_metadata"), F.expr("timestamp_ntz'2024-03-01 00:00:00'"), base="base")


@query("""with a as (select nd_patient_id k, list_sort(list(distinct patientid::varchar)) v from patient_mapping_table where nd_patient_id is not null group by 1), b as (select nd_patient_id k, list_sort(list(distinct patientid) filter (patientid is not null)) v from patient_mapping_local where nd_patient_id is not null group by 1)
select case when b.k is null then 'missing_there' when a.k is null then 'missing_here' else 'mismatch' end as kind, count(*) as n_ids from a full join b using (k) where b.k is null or a.k is null or coalesce(a.v, []) <> coalesce(b.v, []) group by 1""")
def c24_id_report(s, d):
    """Ids that one environment lacks or maps to other patients, as written."""
    return cdc.id_validation(*T(s, d, "patient_mapping_table", "patient_mapping_local"), "nd_patient_id", "patientid")[0]


@query("""with l as (select id, try_cast(regexp_extract(binlog_file, '\\.(\\d+)$', 1) as bigint) f, binlog_pos p from change_log where binlog_pos is not null and regexp_matches(binlog_file, '\\.(\\d+)\\s*$')),
o as (select *, row_number() over (order by f, p, id) n from l) select id from o where n > 500 and n <= 1500""")
def c31_l08_log_page(s, d):
    """The second page of the log: it goes on after the last event of the first."""
    first = cdc.log_page(_log(s, d), 500)
    last = first.select(sequence(F.col("binlog_file"), F.col("binlog_pos"), F.col("id")).alias("q")).agg(F.max("q").alias("q")).first()["q"]
    return cdc.log_page(_log(s, d), 1000, tuple(last)).select("id")


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "patient_mapping_table", "patient_mapping_local", "encounter_mapping_table", "enc_staging", "encounter_map_snapshots",
           "pii_data_table", "encounter_notes", "change_log", "appointment_dump", "dump_metadata", "delta_runs", "facilities", "eval_items", "subject_areas", "subject_labels"]


@query(" union all ".join(f"select '{t}' as table_name where exists (select 1 from {t})" for t in _TABLES))
def c22_filled_tables(s, d):
    """Tables of a folder that have rows and so take part in a merge."""
    return cdc.filled_tables(s, d)
