"""Queries p1, p2, p4, p5, p6 and p7 over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normal import flag, id_text
from ..operators import change_feed as cf
from ..operators import orphans as orp
from ..operators.history import OPEN_END, attribute_history
from ..operators.incremental import records_to_process
from ..operators.table_diff import diff_tables
from ..operators.timestamps import ABBREVIATIONS, normalise_times
from ..session import read_table, scratch_path


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Records that the next run over enc_staging and encounter_notes must process."""
    key = "nd_auto_increment_id"
    tables = {t: (read_table(spark, sf, t), key) for t in ("enc_staging", "encounter_notes")}
    return records_to_process(tables, read_table(spark, sf, "delta_runs")).select("table_name", F.col("rec_key").alias(key))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    snaps = read_table(spark, sf, "encounter_map_snapshots")
    active = F.coalesce(flag(F.col("nd_activeflag")), F.lit("Y")).alias("active")
    rows = snaps.select("snapshot_date", "encounter_id", "nd_encounter_id", "nd_patient_id", "loaded_at", active)
    return attribute_history(rows, "encounter_id", "snapshot_date", ["nd_encounter_id", "nd_patient_id", "active"], "loaded_at")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of every encounter with the period in which each held."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return _history(spark, sf).select("encounter_id", day("valid_from").alias("valid_from"), F.coalesce(day("valid_to"), F.lit(OPEN_END)).alias("valid_to"))


def p2_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The history with its attributes."""
    return _history(spark, sf).select("encounter_id", "nd_encounter_id", "nd_patient_id", "active", F.col("valid_from").cast("string").alias("valid_from"), F.coalesce(F.col("valid_to").cast("string"), F.lit(OPEN_END)).alias("valid_to"), "n_snapshots")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every readable time text of registrations and notes as a UTC instant."""
    places = read_table(spark, sf, "facilities")
    parts = []
    for table, col in (("pii_data_table", "registration_date"), ("encounter_notes", "note_date")):
        found = normalise_times(read_table(spark, sf, table), "nd_auto_increment_id", col, "facilityid", places)
        parts.append(found.select(F.lit(table).alias("source_table"), "row_id", "utc_ts"))
    return parts[0].unionByName(parts[1])


#: Steps in which p5 takes in the references, by time.
P5_STEPS = 3


def _orphan_state(spark: SparkSession, sf: str) -> DataFrame:
    """The state after steps over slices of time, each with the references and the changes of parents that fall in it.

    A parent row is there from its creation on, and what is inactive was active until its last update.
    """
    maps, patients = read_table(spark, sf, "encounter_mapping_table"), read_table(spark, sf, "patient_mapping_table")
    span = maps.agg(F.min("created_at").alias("lo"), F.max("created_at").alias("hi")).first()
    cuts = [span["lo"] + (span["hi"] - span["lo"]) * k / P5_STEPS for k in range(1, P5_STEPS)] if span["lo"] else []

    def until(c: str, cut: datetime | None) -> Column:
        return F.lit(True) if cut is None else F.col(c).isNull() | (F.col(c) <= F.lit(cut).cast("timestamp_ntz"))

    def refs(which: Callable[[str], Column]) -> DataFrame:
        out = None
        for table, id_col, cols, at in (
            ("enc_staging", "nd_auto_increment_id", ("patientid", "encounterid"), "nd_extracted_date"),
            ("encounter_notes", "nd_auto_increment_id", ("patientid", "encounterid"), "nd_extracted_date"),
            ("encounter_mapping_table", "id", ("patientid",), "created_at"),
        ):
            r = orp.references(read_table(spark, sf, table).where(which(at)), table, id_col, cols, at)
            out = r if out is None else out.unionByName(r)
        return out

    state, got = orp.OrphanState(spark, scratch_path(spark, "p5-state")), None
    nothing, on = F.lit(False), orp.is_active(F.col("nd_activeflag"))
    for k, cut in enumerate([*cuts, None]):
        last = cuts[k - 1] if k else None
        before = (lambda c: until(c, last)) if k else (lambda c: nothing)  # noqa: B023
        active = lambda t: on if t is None else on | F.coalesce(F.col("updated_at") > F.lit(t).cast("timestamp_ntz"), nothing)
        changes = orp.parent_changes(patients, "patientid", "patientid", "created_at", before("created_at"), until("created_at", cut)).unionByName(
            orp.parent_changes(maps, "encounter_id", "encounterid", "created_at", before("created_at"), until("created_at", cut), active(last), active(cut)))
        got = state.advance(refs(lambda c: until(c, cut) & ~before(c)), changes, refs(before) if k else None)  # noqa: B023
    return got


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan references: missing, deleted or late parents."""
    return _orphan_state(spark, sf).select("child_table", "child_id", "ref_column", "kind").distinct()


def p5_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans per table, column, kind and month of extraction."""
    return orp.orphan_counts(_orphan_state(spark, sf))


def _mapping_diff(spark: SparkSession, sf: str, cells: str = "none") -> DataFrame:
    fields = {
        "patientid": id_text(F.col("patientid")),
        "offset_days": F.col("offset_days"),
        "registration_date": F.date_trunc("second", "registration_date"),
        "excluded": flag(F.col("excluded").cast("string")),
    }
    return diff_tables(read_table(spark, sf, "patient_mapping_table"), read_table(spark, sf, "patient_mapping_local"), "nd_patient_id", fields, fields, "updated_at", cells=cells)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Differences between the mapping table and its local copy."""
    kind = F.when(F.col("kind") == "missing_right", "missing_in_local").when(F.col("kind") == "missing_left", "extra_in_local").otherwise(F.col("kind"))
    return _mapping_diff(spark, sf).select(F.col("key").alias("nd_patient_id"), kind.alias("kind"), "field_name")


def p6_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The differing cells of both sides, masked."""
    out = _mapping_diff(spark, sf, "masked").where("kind = 'mismatch'")
    return out.select(F.col("key").alias("nd_patient_id"), "field_name", F.col("left_value").alias("main_cell"), F.col("right_value").alias("local_cell"))


APPOINTMENT_COLUMNS = {"1": "apptid", "2": "patientid", "3": "facilityid", "4": "appt_status", "5": "reason"}


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Current appointments after the change log was applied to the dump."""
    cols = ["patientid", "facilityid", "appt_status"]
    start = cf.latest_dump(read_table(spark, sf, "dump_metadata"), "appointments").first()["dump_seq"]
    table = cf.ChangeTable(spark, scratch_path(spark, "p7-appointments"), cols)
    dump = read_table(spark, sf, "appointment_dump")
    table.append_base(dump.where(~F.coalesce(F.upper(F.trim("nd_activeflag")), F.lit("Y")).eqNullSafe("N")), "apptid")
    log = read_table(spark, sf, "change_log").where(F.lower(F.trim("table_name")) == "appointments")
    events = cf.decode_events(log, APPOINTMENT_COLUMNS, "apptid")
    if start is not None:
        after = F.struct(*[F.lit(start[f]).cast("bigint").alias(f) for f in ("file", "pos", "id")])
        events = events.where(F.col("seq") >= after)
    table.append_events(events)
    return table.read().select(
        F.col("k").alias("apptid"), "nd_operation", F.col("patientid").try_cast("bigint").alias("patientid"),
        F.col("facilityid").try_cast("bigint").alias("facilityid"), F.coalesce("appt_status", F.lit("")).alias("appt_status"),
    )


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_versions, p4_found, p5_found, p5_counts, p6_found, p6_cells, p7_found)}

_P1 = """
with runs as (
  select lower(trim(table_name)) t, coalesce(delta_after, timestamp '0001-01-01') a, coalesce(delta_until, timestamp '9999-12-31 23:59:59') u
  from delta_runs where lower(trim(status)) = 'success'),
d as (
  select 'enc_staging' t, nd_auto_increment_id k, greatest(nd_extracted_date, nd_updated_at) ts,
         concat_ws('|', coalesce(patientid::varchar, '~'), coalesce(encounterid::varchar, '~'), coalesce(enc_date::varchar, '~'), coalesce(visittype, '~'), coalesce(facilityid::varchar, '~'), coalesce(nd_activeflag, '~')) c
  from enc_staging
  union all
  select 'encounter_notes', nd_auto_increment_id, greatest(nd_extracted_date, nd_updated_at),
         concat_ws('|', coalesce(nd_patient_id::varchar, '~'), coalesce(patientid, '~'), coalesce(encounterid::varchar, '~'), coalesce(facilityid::varchar, '~'), coalesce(note_date, '~'), coalesce(content, '~'), coalesce(nd_activeflag, '~'))
  from encounter_notes),
x as (select t, k, ts, c, lag(c) over (partition by t, k order by ts nulls first, c) p from d)
select distinct t as table_name, k as nd_auto_increment_id from x
where (p is null or p <> c) and (ts is null or not exists (select 1 from runs r where r.t = x.t and x.ts > r.a and x.ts <= r.u))
"""

_P2_BODY = """
with s as (
  select snapshot_date d, encounter_id e, nd_encounter_id ne, nd_patient_id np,
         case when nd_activeflag is null or lower(trim(nd_activeflag)) in ('y', 'yes', '1') then 'Y' else 'N' end a, loaded_at
  from encounter_map_snapshots where encounter_id is not null and snapshot_date is not null),
l as (select * from s qualify row_number() over (partition by e, d order by loaded_at desc) = 1),
dates as (select d, lead(d) over (order by d) nx, row_number() over (order by d) n from (select distinct d from s)),
m as (
  select l.*, n, nx,
         case when n = lag(n) over w + 1 and ne is not distinct from lag(ne) over w and np is not distinct from lag(np) over w and a = lag(a) over w then 0 else 1 end st
  from l join dates using (d) window w as (partition by e order by d)),
i as (select *, sum(st) over (partition by e order by d) g from m)
"""

_P7 = r"""
with dump as (
  select try_cast(regexp_extract(binlog_file, '\.(\d+)$', 1) as bigint) f, binlog_pos p from dump_metadata
  where lower(trim(table_name)) = 'appointments' and dump_completed_at is not null order by dump_completed_at desc limit 1),
e as (
  select try_cast(regexp_extract(binlog_file, '\.(\d+)$', 1) as bigint) f, binlog_pos p, id, upper(substr(trim(operation), 1, 1)) op, payload::json j
  from change_log where lower(trim(table_name)) = 'appointments' and binlog_pos is not null),
v as (
  select (e.f, e.p, e.id) s, op, json_keys(j) ks,
         list_transform(['1', '2', '3', '4'], lambda k: case when upper(j->>k) = 'NULL' then null when starts_with(j->>k, '''') and ends_with(j->>k, '''') and length(j->>k) > 1
           then regexp_replace((j->>k)[2:-2], '\\(.)', '\1', 'g') else j->>k end) c
  from e, dump where (e.f, e.p) >= (dump.f, dump.p)),
r as (
  select try_cast(c[1] as bigint) k, s, op, ks, c from v where c[1] is not null
  union all
  select apptid, (-1::bigint, -1::bigint, -1::bigint), 'N', ['1', '2', '3', '4'], [apptid::varchar, patientid::varchar, facilityid::varchar, appt_status]
  from appointment_dump where coalesce(upper(trim(nd_activeflag)), 'Y') <> 'N'),
d as (select k, max(s) ds from r where op = 'D' group by k),
l as (select r.* from r left join d using (k) where op <> 'D' and (ds is null or s > ds))
select k as apptid, case max_by(op, s) when 'N' then 'NONE' when 'I' then 'INSERT' else 'UPDATE' end as nd_operation,
       try_cast((max_by([c[2]], s) filter (list_contains(ks, '2')))[1] as bigint) as patientid,
       try_cast((max_by([c[3]], s) filter (list_contains(ks, '3')))[1] as bigint) as facilityid,
       coalesce((max_by([c[4]], s) filter (list_contains(ks, '4')))[1], '') as appt_status
from l group by k
"""

_P5 = """
with refs as (
  select 'enc_staging' ct, nd_auto_increment_id id, 'patientid' rc, patientid k, nd_extracted_date ts from enc_staging
  union all select 'enc_staging', nd_auto_increment_id, 'encounterid', encounterid, nd_extracted_date from enc_staging
  union all select 'encounter_notes', nd_auto_increment_id, 'patientid', try_cast(try_cast(trim(patientid) as decimal(20,2)) as bigint), nd_extracted_date from encounter_notes
  union all select 'encounter_notes', nd_auto_increment_id, 'encounterid', encounterid, nd_extracted_date from encounter_notes
  union all select 'encounter_mapping_table', id, 'patientid', patientid, created_at from encounter_mapping_table),
par as (
  select 'patientid' rc, patientid k, true alive, min(created_at) since from patient_mapping_table group by patientid
  union all
  select 'encounterid', encounter_id, bool_or(nd_activeflag is null or lower(trim(nd_activeflag)) = 'y'),
         min(created_at) filter (where nd_activeflag is null or lower(trim(nd_activeflag)) = 'y')
  from encounter_mapping_table group by encounter_id),
j as (select refs.*, case when alive is null then 'missing' when not alive then 'deleted' when since > ts then 'late' end kind
      from refs left join par using (rc, k) where k is not null)
"""

# Notations for the SQL of p4: pattern and what its groups are.
_P4_MONTH = "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_P4_CLOCK, _P4_ZONE = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?", r" *(z|[+-]\d{2}:?\d{2}|[a-z]{2,5})?"
_P4_WEEKDAY = "(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? )?"
_P4_NOTATIONS = [
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})(?:(?:t| ) *{_P4_CLOCK}{_P4_ZONE}(?:\[[a-z_+\-/0-9]+\])?)?$", "y mo d h mi s f z"),
    (rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})(?: +{_P4_CLOCK}{_P4_ZONE})?$", "y mo d h mi s f z"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:t?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d{{1,12}}))?{_P4_ZONE})?$", "y mo d h mi s f z"),
    *[(rf"^(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{{n}}})(?:,? +{_P4_CLOCK} *([ap]\.?m\.?)?{_P4_ZONE})?$", "a b y h mi s f ap z") for sep in ("/", r"\.", "-") for n in (4, 2)],
    (rf"^{_P4_WEEKDAY}(\d{{1,2}})[ \-]{_P4_MONTH}\.?[ \-,] *(\d{{4}})(?:,? +(?:at +)?{_P4_CLOCK} *([ap]\.?m\.?)?{_P4_ZONE})?$", "d mon y h mi s f ap z"),
    (rf"^{_P4_WEEKDAY}{_P4_MONTH}\.? +(\d{{1,2}})(?:st|nd|rd|th)?,? +(\d{{4}})(?:,? +(?:at +)?{_P4_CLOCK} *([ap]\.?m\.?)?{_P4_ZONE})?$", "mon d y h mi s f ap z"),
]


def _p4_take(name: str) -> str:
    """SQL of one part of a time text: the group that holds it in the notation that matched."""
    rows = [f"when n = {k} then regexp_extract(t, '{p}', {1 + g.split().index(name)})" for k, (p, g) in enumerate(_P4_NOTATIONS) if name in g.split()]
    return f"coalesce(case {' '.join(rows)} end, '') as {name}"


_P4_ABBREVIATIONS = ", ".join(f"('{r}', '{a.lower()}', {v})" for r, m in ABBREVIATIONS.items() for a, v in m.items())
_P4 = rf"""
with places as (select facilityid, min(tz_name) tz, min(date_order) ord from facilities where facilityid is not null group by 1),
src as (select 'pii_data_table' st, nd_auto_increment_id id, registration_date v, facilityid from pii_data_table union all select 'encounter_notes', nd_auto_increment_id, note_date, facilityid from encounter_notes),
t as (select distinct st, id, lower(trim(regexp_replace(v, '[\s\x{{A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}]+', ' ', 'g'))) t, coalesce(tz, 'UTC') tz, coalesce(upper(trim(ord)) = 'MDY', false) mdy from src left join places using (facilityid) where v is not null),
n as (select *, case {' '.join(f"when regexp_matches(t, '{p}') then {k}" for k, (p, _) in enumerate(_P4_NOTATIONS))} end n from t),
g as (select *, {', '.join(_p4_take(x) for x in ('y', 'mo', 'd', 'a', 'b', 'mon', 'h', 'mi', 's', 'f', 'ap', 'z'))} from n),
w as (select st, id, t, tz, z, n, f,
  case when length(y) = 2 then '20' || y else y end yy, case when mon <> '' then (1 + (instr('janfebmaraprmayjunjulaugsepoctnovdec', left(mon, 3)) - 1) // 3)::varchar when a <> '' then case when mdy then a else b end else mo end mm, case when a <> '' then case when mdy then b else a end else d end dd,
  case when h = '' then '0' when ap = '' then h when h::int between 1 and 12 then (h::int % 12 + case when ap[1] = 'p' then 12 else 0 end)::varchar end hh, case when mi = '' then '0' else mi end mm2, case when s = '' then '0' else s end ss from g),
x as (select *, case when yy <> '0000' then try_strptime(yy || '-' || mm || '-' || dd || ' ' || hh || ':' || mm2 || ':' || ss, '%Y-%m-%d %H:%M:%S') end + to_microseconds(rpad(case when f = '' then '0' else f end, 6, '0')[1:6]::bigint) wall from w),
c as (select *, timezone(tz, wall) at time zone 'UTC' u from x),
e as (select *, case when timezone(tz, timezone('UTC', u - interval 30 minute)) = wall then u - interval 30 minute when timezone(tz, timezone('UTC', u - interval 60 minute)) = wall then u - interval 60 minute when timezone(tz, timezone('UTC', u - interval 120 minute)) = wall then u - interval 120 minute else u end first from c),
ab(part, name, minutes) as (values {_P4_ABBREVIATIONS}),
i as (select e.*, case when regexp_matches(t, '^(/date\(-?\d{{1,14}}([+-]\d{{4}})?\)/|\d{{13}}|\d{{10}})$') then
    timestamp '1970-01-01' + to_microseconds(case when t[1] = '/' then regexp_extract(t, '-?\d+')::bigint * 1000 when length(t) = 13 then t::bigint * 1000 else t::bigint * 1000000 end)
  when z = '' then first when z in ('z', 'utc', 'gmt', 'ut') then wall
  when regexp_matches(z, '^[+-](0\d|1[0-7]):?[0-5]\d$') then wall - to_minutes((case when z[1] = '-' then -1 else 1 end) * (z[2:3]::int * 60 + right(z, 2)::int))
  else wall - to_minutes(minutes) end instant from e left join ab on part = split_part(tz, '/', 1) and name = z)
select distinct st as source_table, id as row_id, strftime(instant, '%Y-%m-%dT%H:%M:%S.%fZ') as utc_ts from i where instant is not null
"""

_P6 = """
with m as (
  select nd_patient_id k, patientid p, offset_days o, date_trunc('second', registration_date) r, excluded e
  from patient_mapping_table qualify row_number() over (partition by nd_patient_id order by updated_at desc) = 1),
l as (
  select nd_patient_id k, try_cast(try_cast(trim(patientid) as decimal(20,2)) as bigint) p, offset_days o, date_trunc('second', registration_date) r,
         case when lower(trim(excluded)) in ('1','y','true') then true when lower(trim(excluded)) in ('0','n','false') then false end e
  from patient_mapping_local qualify row_number() over (partition by nd_patient_id order by updated_at desc) = 1)
"""

ORACLES = {
    "p4_found": _P4,
    "p7_found": _P7,
    "p1_found": _P1,
    "p2_found": _P2_BODY + """
select e as encounter_id, strftime(min(d), '%Y-%m-%d') as valid_from, coalesce(strftime(max_by(coalesce(nx, date '9999-12-31'), d), '%Y-%m-%d'), '9999-12-31') as valid_to
from i group by e, g""",
    "p2_versions": _P2_BODY + """
select e as encounter_id, any_value(ne) as nd_encounter_id, any_value(np) as nd_patient_id, any_value(a) as active, strftime(min(d), '%Y-%m-%d') as valid_from,
       strftime(max_by(coalesce(nx, date '9999-12-31'), d), '%Y-%m-%d') as valid_to, count(*) as n_snapshots
from i group by e, g""",
    "p5_found": _P5 + """select distinct ct as child_table, id as child_id, rc as ref_column, kind from j where kind is not null""",
    "p5_counts": _P5 + """select ct as child_table, rc as ref_column, kind, strftime(date_trunc('month', ts), '%Y-%m-%d') as period, count(distinct id) as n_records, count(*) as n_references
from (select distinct ct, id, rc, k, ts, kind from j where kind is not null) group by 1, 2, 3, 4""",
    "p6_found": _P6 + """select k as nd_patient_id, 'missing_in_local' as kind, '*' as field_name from m where k not in (select k from l)
union all select k, 'extra_in_local', '*' from l where k not in (select k from m)
union all select k, 'mismatch', 'patientid' from m join l using (k) where m.p is distinct from l.p
union all select k, 'mismatch', 'offset_days' from m join l using (k) where m.o is distinct from l.o
union all select k, 'mismatch', 'registration_date' from m join l using (k) where m.r is distinct from l.r
union all select k, 'mismatch', 'excluded' from m join l using (k) where m.e is distinct from l.e""",
    "p6_cells": _P6 + """
, j as (select k, unnest([
    {'f': 'patientid', 'a': m.p::varchar, 'b': l.p::varchar}, {'f': 'offset_days', 'a': m.o::varchar, 'b': l.o::varchar},
    {'f': 'registration_date', 'a': strftime(m.r, '%Y-%m-%d %H:%M:%S'), 'b': strftime(l.r, '%Y-%m-%d %H:%M:%S')},
    {'f': 'excluded', 'a': case when m.e then 'Y' when not m.e then 'N' end, 'b': case when l.e then 'Y' when not l.e then 'N' end}]) x from m join l using (k))
select k as nd_patient_id, x.f as field_name, regexp_replace(regexp_replace(x.a, '\\pL', 'x', 'g'), '\\pN', '9', 'g') as main_cell, regexp_replace(regexp_replace(x.b, '\\pL', 'x', 'g'), '\\pN', '9', 'g') as local_cell
from j where x.a is distinct from x.b""",
}
