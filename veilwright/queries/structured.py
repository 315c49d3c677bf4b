"""Queries of scans, joins, aggregates, windows, set operations, rules and mappings, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import plans, sources
from ..functions import rules
from ..functions.normal import flag, id_long
from ..operators import mapping as mp
from ..operators import quality as qc
from ..operators import resolve as rs
from ..plans import identifiers
from ..session import materialize, read_table, scratch_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query and its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def T(spark: SparkSession, sf: str, *names: str):
    out = [read_table(spark, sf, n) for n in names]
    return out[0] if len(out) == 1 else out


# --- scans and sinks --------------------------------------------------------------------
@query("select * from region")
def s01_full_scan(s, d):
    return T(s, d, "region")


@query("select o_orderkey, o_custkey from orders where o_orderkey between 1000 and 5000")
def s02_id_range(s, d):
    return sources.id_range(T(s, d, "orders"), "o_orderkey", 1000, 5000).select("o_orderkey", "o_custkey")


@query("select o_orderkey, o_totalprice from orders order by o_orderkey limit 100 offset 50")
def s04_offset_page(s, d):
    return sources.page(T(s, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 50, 100)


@query("select o_orderkey, o_custkey from orders where o_orderkey > 500 order by o_orderkey limit 100")
def s05_keyset_page(s, d):
    return sources.keyset_page(T(s, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 500, 100)


@query("""with r as (select min(o_orderkey) lo, max(o_orderkey) hi from orders), g as (select hi, unnest(generate_series(lo, hi, 1000)) s from r)
select s - 1 as gt, least(s + 999, hi) + 1 as lt from g""")
def s06_keyset_ranges(s, d):
    return sources.keyset_ranges(T(s, d, "orders"), "o_orderkey", 1000)


@query("select min(o_orderkey) as min_id, max(o_orderkey) as max_id, count(*) as n_rows from orders")
def s07_min_max_count(s, d):
    return T(s, d, "orders").agg(F.min("o_orderkey").alias("min_id"), F.max("o_orderkey").alias("max_id"), F.count("*").alias("n_rows"))


@query("select distinct trim(visittype) as visittype from enc_staging where trim(visittype) <> ''")
def s10_distinct_values(s, d):
    return sources.distinct_values(T(s, d, "enc_staging"), "visittype")


@query("select distinct trim(visittype) as visittype, trim(nd_activeflag) as nd_activeflag from enc_staging where trim(visittype) <> '' and trim(nd_activeflag) <> ''")
def s11_distinct_pairs(s, d):
    return sources.distinct_pairs(T(s, d, "enc_staging"), "visittype", "nd_activeflag")


@query("select e.nd_auto_increment_id, e.patientid from enc_staging e where e.patientid in (select patientid from patient_mapping_table)")
def s12_lookup(s, d):
    e, p = T(s, d, "enc_staging", "patient_mapping_table")
    return sources.lookup(e.select("nd_auto_increment_id", "patientid"), "patientid", p, "patientid")


@query("""select o_orderkey, o_orderstatus from orders where not o_orderkey between 100 and 200
union all select o_orderkey, lower(o_orderstatus) from orders where o_orderkey between 100 and 200""")
def s15_idempotent_rewrite(s, d):
    o = T(s, d, "orders").select("o_orderkey", "o_orderstatus")
    new = o.withColumn("o_orderstatus", F.lower("o_orderstatus"))
    return sources.replace_range(sources.replace_range(o, new, "o_orderkey", 100, 200), new, "o_orderkey", 100, 200)


@query("select p_partkey, substr(p_name, 1, 10) as p_name, substr(p_type, 1, 5) as p_type from part")
def s17_truncate(s, d):
    return sources.fit_columns(T(s, d, "part"), {"p_name": 10, "p_type": 5}).select("p_partkey", "p_name", "p_type")


@query("select nd_auto_increment_id, case when trim(patientid) = '' then null else patientid end as patientid from encounter_notes")
def s18_blank_to_null(s, d):
    return sources.fit_columns(T(s, d, "encounter_notes"), {}, ["patientid"]).select("nd_auto_increment_id", "patientid")


@query("""select 'orders' as table_name, unnest(['o_orderkey','o_custkey','o_orderstatus','o_totalprice','o_orderdate','o_orderpriority']) as column_name""")
def s23_schema_rows(s, d):
    return sources.schema_rows(s, {"orders": T(s, d, "orders")}).select("table_name", "column_name")


@query("select * from nation")
def s29_passthrough(s, d):
    return T(s, d, "nation")


# --- filters ------------------------------------------------------------------------------
@query("select id, encounter_id, nd_encounter_id from encounter_mapping_table where nd_activeflag is null or lower(trim(nd_activeflag)) in ('y', 'yes', 'true', '1')")
def f05_active_rows(s, d):
    return rs.usable(T(s, d, "encounter_mapping_table")).select("id", "encounter_id", "nd_encounter_id")


@query("select nd_patient_id, patientid from patient_mapping_table where not coalesce(excluded, false)")
def f06_not_excluded(s, d):
    return rs.usable(T(s, d, "patient_mapping_table")).select("nd_patient_id", "patientid")


@query("select nd_auto_increment_id, nd_extracted_date from enc_staging where nd_extracted_date > timestamp '2024-03-01 00:00:00'")
def f07_delta_window(s, d):
    return T(s, d, "enc_staging").where("nd_extracted_date > timestamp_ntz'2024-03-01 00:00:00'").select("nd_auto_increment_id", "nd_extracted_date")


_MAPS = """
pats as (select patientid, min(nd_patient_id) nd, min(offset_days) off from patient_mapping_table where not coalesce(excluded, false) group by patientid),
bad as (select distinct nd_patient_id from patient_mapping_table where coalesce(excluded, false)),
encs as (select encounter_id, min(nd_encounter_id) ne, min(nd_patient_id) nd from encounter_mapping_table
         where (nd_activeflag is null or lower(trim(nd_activeflag)) in ('y', 'yes', 'true', '1')) and nd_patient_id not in (select nd_patient_id from bad) group by encounter_id),
offs as (select nd, min(off) off from pats group by nd),
ence as (select encs.*, offs.off from encs left join offs using (nd)),
r as (select e.*, pats.nd p_nd, ence.ne e_ne, coalesce(ence.nd, pats.nd) nd, coalesce(ence.off, pats.off, 34) off
      from enc_staging e left join pats on e.patientid = pats.patientid left join ence on e.encounterid = ence.encounter_id)
"""


_DEID_RULES = {"patientid": "PATIENT_ID", "encounterid": "ENCOUNTER_ID", "enc_date": "DATE_OFFSET", "visittype": "MASK"}


def _deid(s, d):
    plan = plans.TablePlan("enc_staging", _DEID_RULES)
    return plan.apply(*T(s, d, "enc_staging", "patient_mapping_table", "encounter_mapping_table"))


@query(f"""with {_MAPS}
select nd_auto_increment_id, p_nd as patientid, e_ne as encounterid, strftime(enc_date + to_days(off), '%Y-%m-%d %H:%M:%S') as enc_date, '<<VISITTYPE>>' as visittype, facilityid,
       nd_extracted_date, nd_updated_at, nd_operation, nd_activeflag from r where nd is not null""")
def deid_enc_staging(s, d):
    """Structured de-identification of the largest table: mapping joins, resolution, rules, rejects taken out."""
    return _deid(s, d)[0]


@query(f"with {_MAPS} select 'unresolved_id:' || coalesce(patientid::varchar, 'NULL') as reason, count(*) as n_rows from r where nd is null group by 1")
def f03_reject_unresolved(s, d):
    return _deid(s, d)[1].groupBy("reason").agg(F.count("*").alias("n_rows"))


@query(f"with {_MAPS} select count(*) as n_in, count(*) filter (nd is not null) as n_out, count(*) filter (nd is null) as n_rejected, true as balanced from r")
def f04_conservation(s, d):
    good, bad = _deid(s, d)
    return rs.conservation(T(s, d, "enc_staging"), good, bad)


# --- joins ------------------------------------------------------------------------------------
@query("""select n.nd_auto_increment_id, p.nd_patient_id as nd_patient_id_from_map from encounter_notes n
left join (select patientid, min(nd_patient_id) nd_patient_id from patient_mapping_table group by 1) p on n.patientid = p.patientid::varchar""")
def j01_key_harmonise(s, d):
    n, p = T(s, d, "encounter_notes", "patient_mapping_table")
    p = p.groupBy("patientid").agg(F.min("nd_patient_id").alias("nd_patient_id"))
    return rs.map_join(n.select("nd_auto_increment_id", "patientid"), p, "patientid", "patientid", "_from_map").select("nd_auto_increment_id", "nd_patient_id_from_map")


@query(f"with {_MAPS} select e.id, e.patientid, e.nd_patient_id as as_written, pats.nd as by_patient, pats.off as offset_days from encounter_mapping_table e left join pats on e.patientid = pats.patientid")
def j02_patient_join(s, d):
    e, p = T(s, d, "encounter_mapping_table", "patient_mapping_table")
    p = rs.usable(p).groupBy("patientid").agg(F.min("nd_patient_id").alias("nd"), F.min("offset_days").alias("off"))
    return rs.map_join(e, p, "patientid", "patientid", "_m").select("id", "patientid", F.col("nd_patient_id").alias("as_written"), F.col("nd_m").alias("by_patient"), F.col("off_m").alias("offset_days"))


@query(f"with {_MAPS} select nd_auto_increment_id, encounterid, ence.ne as nd_encounter_id, ence.nd as nd_patient_id from encounter_notes n left join ence on n.encounterid = ence.encounter_id")
def j03_encounter_join(s, d):
    n, e, p = T(s, d, "encounter_notes", "encounter_mapping_table", "patient_mapping_table")
    e = rs.without_excluded(rs.usable(e), p).groupBy("encounter_id").agg(F.min("nd_encounter_id").alias("nd_encounter_id"), F.min("nd_patient_id").alias("nd_patient_id"))
    return rs.map_join(n.select("nd_auto_increment_id", "encounterid"), e, "encounterid", "encounter_id", "_e").select("nd_auto_increment_id", "encounterid", F.col("nd_encounter_id_e").alias("nd_encounter_id"), F.col("nd_patient_id_e").alias("nd_patient_id"))


@query("""select l_orderkey, l_linenumber, l_suppkey, 20000000 + a.rn as nd_appointment_id, l_partkey, 30000000 + c.rn as nd_chart_id from lineitem
left join (select s_suppkey, row_number() over (order by s_suppkey) rn from supplier) a on l_suppkey = s_suppkey
left join (select p_partkey, row_number() over (order by p_partkey) rn from part) c on l_partkey = p_partkey""")
def j04_j05_appointment_chart(s, d):
    l, a, c = T(s, d, "lineitem", "supplier", "part")
    a = mp.numbered(a.select("s_suppkey"), ["s_suppkey"], "nd_appointment_id", 20_000_000)
    c = mp.numbered(c.select("p_partkey"), ["p_partkey"], "nd_chart_id", 30_000_000)
    out = rs.map_join(rs.map_join(l, a, "l_suppkey", "s_suppkey", "_a"), c, "l_partkey", "p_partkey", "_c")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("nd_appointment_id_a").alias("nd_appointment_id"), "l_partkey", F.col("nd_chart_id_c").alias("nd_chart_id"))


@query("""with p as (select patientid, min(nd_patient_id) nd from patient_mapping_table group by 1)
select a.apptid, a.patientid as fromid, x.nd as nd_from, e.patientid as toid, y.nd as nd_to from appointment_dump a
left join (select encounter_id, min(patientid) patientid from encounter_mapping_table group by 1) e on a.apptid = e.encounter_id
left join p x on a.patientid = x.patientid left join p y on e.patientid = y.patientid""")
def j02_two_patients_per_row(s, d):
    a, e, p = T(s, d, "appointment_dump", "encounter_mapping_table", "patient_mapping_table")
    p = p.groupBy("patientid").agg(F.min("nd_patient_id").alias("nd"))
    e = e.groupBy("encounter_id").agg(F.min("patientid").alias("toid"))
    rows = a.select("apptid", F.col("patientid").alias("fromid")).join(e, F.col("apptid") == F.col("encounter_id"), "left").select("apptid", "fromid", "toid")
    out = rs.map_join(rs.map_join(rows, p, "fromid", "patientid", "_from"), p, "toid", "patientid", "_to")
    return out.select("apptid", "fromid", F.col("nd_from"), "toid", F.col("nd_to"))


@query("""select n.nd_auto_increment_id, n.nd_patient_id, m.nd_patient_id as reference_id from encounter_notes n
left join (select nd_patient_id, min(patientid) patientid from patient_mapping_table group by 1) r on n.nd_patient_id = r.nd_patient_id
left join (select patientid, min(nd_patient_id) nd_patient_id from encounter_mapping_table group by 1) m on r.patientid = m.patientid""")
def j06_reference_pid(s, d):
    n, p, e = T(s, d, "encounter_notes", "patient_mapping_table", "encounter_mapping_table")
    return rs.reference_chain(n.select("nd_auto_increment_id", "nd_patient_id"), "nd_patient_id", [(p, "nd_patient_id", "patientid"), (e, "patientid", "nd_patient_id")], "reference_id")


@query("select id, encounter_id, nd_patient_id from encounter_mapping_table where nd_patient_id not in (select nd_patient_id from patient_mapping_table where excluded)")
def j07_excluded_anti(s, d):
    e, p = T(s, d, "encounter_mapping_table", "patient_mapping_table")
    return rs.without_excluded(e, p).select("id", "encounter_id", "nd_patient_id")


@query("""select l_orderkey, l_linenumber, l_extendedprice, n_name from lineitem left join orders on l_orderkey = o_orderkey
left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey""")
def j08_reference_chain(s, d):
    l, o, c, n = T(s, d, "lineitem", "orders", "customer", "nation")
    out = rs.reference_chain(l.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_orderkey", [(o, "o_orderkey", "o_custkey"), (c, "c_custkey", "c_nationkey"), (n, "n_nationkey", "n_name")], "n_name")
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", "n_name")


@query("""with a as (select nd_patient_id id, max(offset_days)::varchar v from patient_mapping_table group by 1), b as (select nd_patient_id id, max(offset_days)::varchar v from patient_mapping_local group by 1)
select coalesce(a.id, b.id) as id, case when b.id is null then 'missing_in_dest' when a.id is null then 'extra_in_dest' else 'mismatch' end as issue, a.v as source_value, b.v as dest_value
from a full join b on a.id = b.id where a.id is null or b.id is null or a.v is distinct from b.v""")
def j10_full_diff(s, d):
    a, b = (x.groupBy(F.col("nd_patient_id").alias("id")).agg(F.max("offset_days").alias("v")) for x in T(s, d, "patient_mapping_table", "patient_mapping_local"))
    return qc.delta_identity(a, b, "id", "v", restrict=False)


@query("""with u as (select nd_patient_id id, max(umobileno) phone from pii_data_table group by 1), p as (select nd_patient_id id, max(registration_date) reg from patient_mapping_table group by 1)
select coalesce(u.id, p.id) as id, phone, reg from u full join p on u.id = p.id""")
def j16_record_merge(s, d):
    u, p = T(s, d, "pii_data_table", "patient_mapping_table")
    u = u.where("nd_patient_id is not null").groupBy(F.col("nd_patient_id").alias("id")).agg(F.max("umobileno").alias("phone"))
    p = p.groupBy(F.col("nd_patient_id").alias("id")).agg(F.max("registration_date").alias("reg"))
    return u.join(p, "id", "full")


ORACLES["j16_record_merge"] = ORACLES["j16_record_merge"].replace("from pii_data_table group", "from pii_data_table where nd_patient_id is not null group")


@query("""select n.nd_auto_increment_id, case when m.nd is null then false else try_cast(trim(n.patientid) as bigint) is not distinct from m.p end as ok from encounter_notes n
left join (select nd_patient_id nd, min(patientid) p from patient_mapping_table group by 1) m on n.nd_patient_id = m.nd where try_cast(trim(n.patientid) as bigint) is not null""")
def j19_reverse_check(s, d):
    n, p = T(s, d, "encounter_notes", "patient_mapping_table")
    m = p.groupBy(F.col("nd_patient_id").alias("nd")).agg(F.min("patientid").alias("p"))
    pid = id_long(F.col("patientid"))
    return n.where(pid.isNotNull()).join(m, F.col("nd_patient_id") == F.col("nd"), "left").select("nd_auto_increment_id", F.when(F.col("nd").isNull(), False).otherwise(pid.eqNullSafe(F.col("p"))).alias("ok"))


# --- aggregates, windows, limits, sets ------------------------------------------------------------
@query("select n, count(*) as keys from (select patientid, count(distinct encounterid) n from enc_staging group by 1) group by 1")
def a02_distribution(s, d):
    return qc.histogram(T(s, d, "enc_staging"), "patientid", "encounterid")


@query("select n, count(*) as keys from (select encounterid, count(*) n from enc_staging group by 1) group by 1")
def a03_rows_per_encounter(s, d):
    return qc.histogram(T(s, d, "enc_staging"), "encounterid")


@query("select count(*) as violations from (select encounter_id from encounter_mapping_table group by 1 having count(distinct nd_encounter_id) > 1)")
def a04_uniqueness(s, d):
    return qc.one_to_one(T(s, d, "encounter_mapping_table"), "encounter_id", "nd_encounter_id")


@query("select count(*) filter (offset_days < -38 or offset_days > 38 or abs(offset_days) < 30) as violations from patient_mapping_table")
def a05_offset_band(s, d):
    return qc.offset_band(T(s, d, "patient_mapping_table"), "offset_days")


@query("select count(*) filter (nd_patient_id is not null and not (length(nd_patient_id::varchar) = 8 and nd_patient_id::varchar like '1000%')) as violations from patient_mapping_table")
def a06_id_format(s, d):
    return T(s, d, "patient_mapping_table").agg(F.count_if(~qc.id_ok(F.col("nd_patient_id"), 8, "1000")).alias("violations"))


@query("""with a as (select count(*) n, count(patientid) p, count(encounterid) e, count(enc_date) t, count(nd_activeflag) f from enc_staging)
select c as column_name, n as n_rows, x as n_filled, round(x * 100.0 / n, 2) as rate from a, lateral (values ('patientid', p), ('encounterid', e), ('enc_date', t), ('nd_activeflag', f)) v(c, x)""")
def a07_fill_counts(s, d):
    return qc.fill_rates(T(s, d, "enc_staging"), ["patientid", "encounterid", "enc_date", "nd_activeflag"])


@query("""with a as (select count(*) n, count(*) filter (content is null or content = '') c, count(*) filter (note_date is null or note_date = '') t from encounter_notes)
select c2 as column_name, n as n_rows, x as n_empty from a, lateral (values ('content', c), ('note_date', t)) v(c2, x)""")
def a09_coverage(s, d):
    return qc.coverage(T(s, d, "encounter_notes"), ["content", "note_date"])


@query("select coalesce(max(nd_patient_id), 10000000) as top_id from patient_mapping_table")
def a10_max_surrogate(s, d):
    return T(s, d, "patient_mapping_table").agg(F.coalesce(F.max("nd_patient_id"), F.lit(10_000_000)).alias("top_id"))


@query("select facilityid, visittype, count(*) as n_rows, count(*) * 1.0 / sum(count(*)) over (partition by facilityid) as share from enc_staging group by 1, 2")
def a16_value_share(s, d):
    g = T(s, d, "enc_staging").groupBy("facilityid", "visittype").agg(F.count("*").alias("n_rows"))
    return g.withColumn("share", F.col("n_rows") * F.lit(1.0).cast("double") / F.sum("n_rows").over(Window.partitionBy("facilityid")))


@query("select distinct patientid, encounterid from enc_staging")
def a18_distinct(s, d):
    return T(s, d, "enc_staging").select("patientid", "encounterid").dropDuplicates()


@query("""select nd_auto_increment_id, nd_extracted_date from (select *, row_number() over (partition by nd_auto_increment_id order by nd_extracted_date nulls first) rn from enc_staging) where rn = 1""")
def w01_dedup_keep_first(s, d):
    return rs.keep_first(T(s, d, "enc_staging"), ["nd_auto_increment_id"], [F.col("nd_extracted_date")]).select("nd_auto_increment_id", "nd_extracted_date")


@query("select event_id, row_number() over (order by ts, event_id) as row_id from events")
def w02_row_ids(s, d):
    return mp.numbered(T(s, d, "events").select("event_id", "ts"), ["ts", "event_id"], "row_id").select("event_id", "row_id")


#: Secret of the offsets in these queries.
_SECRET = "example secret"


def _offset(k: str) -> str:
    v = f"(('0x' || substr(sha256('{_SECRET}:' || sha256('{_SECRET}:' || {k})), 1, 8))::bigint % 18)"
    return f"case when {v} < 9 then {v} - 38 else {v} + 21 end::int"


_CUST = f"""cmap as (select c_custkey patientid, 10000000 + row_number() over (order by c_custkey) nd_patient_id, {_offset('c_custkey')} offset_days from customer)"""


def _customers(s, d):
    empty = s.createDataFrame([], "nd_patient_id bigint, patientid bigint, offset_days int")
    return mp.populate_patient_map(empty, T(s, d, "customer").select(F.col("c_custkey").alias("patientid")), _SECRET)


@query(f"with {_CUST} select nd_patient_id, patientid, offset_days::int as offset_days from cmap")
def m02_w03_patient_map(s, d):
    return _customers(s, d)


@query(f"""with {_CUST} select o_orderkey as encounter_id, o_custkey as patientid, nd_patient_id,
  nd_patient_id * 10000 + row_number() over (partition by nd_patient_id order by o_orderdate, o_orderkey) as nd_encounter_id, o_orderdate as encounter_date from orders join cmap on o_custkey = patientid""")
def m04_w04_encounter_map(s, d):
    o = T(s, d, "orders").select(F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patientid"), F.col("o_orderdate").alias("encounter_date"))
    return mp.encounter_surrogates(o, _customers(s, d))


@query("select encounter_id, min(patientid) as patientid from encounter_mapping_table where encounter_id is not null group by 1")
def u05_first_pair(s, d):
    return mp.first_pair(T(s, d, "encounter_mapping_table"), "encounter_id", "patientid")


@query("select distinct id from (select trim(patientid::varchar) id from enc_staging union all select trim(patientid) from encounter_notes union all select trim(patientid::varchar) from appointment_dump) where id <> ''")
def u04_id_pool(s, d):
    return mp.id_pool([(t, "patientid") for t in T(s, d, "enc_staging", "encounter_notes", "appointment_dump")])


@query("select patientid from enc_staging union select patientid from encounter_mapping_table")
def u01_union_distinct(s, d):
    a, b = T(s, d, "enc_staging", "encounter_mapping_table")
    return a.select("patientid").union(b.select("patientid")).distinct()


@query("select distinct patientid from enc_staging where patientid is not null and patientid not in (select patientid from patient_mapping_table)")
def u03_set_difference(s, d):
    e, p = T(s, d, "enc_staging", "patient_mapping_table")
    return mp.new_ids(e.where("patientid is not null"), p, "patientid")


@query("select nd_auto_increment_id, content from encounter_notes union all select doc_id, text from documents")
def u02_union_all(s, d):
    n, t = T(s, d, "encounter_notes", "documents")
    return n.select("nd_auto_increment_id", "content").unionByName(t.select(F.col("doc_id").alias("nd_auto_increment_id"), F.col("text").alias("content")))


@query("select o_orderkey, o_custkey from orders order by o_orderkey limit 300")
def l01_aligned_sample(s, d):
    return T(s, d, "orders").orderBy("o_orderkey").limit(300).select("o_orderkey", "o_custkey")


@query("select visittype, nd_auto_increment_id from (select distinct visittype, nd_auto_increment_id from enc_staging) qualify row_number() over (partition by visittype order by nd_auto_increment_id) <= 10")
def l07_cap_per_issue(s, d):
    return qc.capped(T(s, d, "enc_staging").select("visittype", "nd_auto_increment_id").distinct(), ["visittype"], ["nd_auto_increment_id"], 10)


_LINE_KEY = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


@query(f"""select * from lineitem order by md5('42:' || {_LINE_KEY}), {_LINE_KEY}
limit (select case when n <= 300 then n else least(3000 + (n - 10000) // 30000 * 1000, 5000) end from (select count(*) n from lineitem))""")
def l03_hash_sample(s, d):
    """Its SQL has the sizes for more than 10,000 rows, as the steps below them are drawn by a random number generator."""
    t = T(s, d, "lineitem").withColumn("k", F.expr(_LINE_KEY))
    return qc.hash_sample(t, "k", qc.sample_size(t.count())).drop("k")


@query("select * from orders qualify row_number() over (partition by o_orderpriority order by md5('42:' || o_orderkey), o_orderkey) <= 50")
def l04_stratified_sample(s, d):
    return qc.stratified_sample(T(s, d, "orders"), "o_orderkey", F.col("o_orderpriority"), 50)


# --- column rules -----------------------------------------------------------------------------------
@query("""select nd_auto_increment_id, case when lower(trim(v)) in ('', 'nan', 'none') then null when length(trim(v)) > 2 then substr(trim(v), 1, 3) else trim(v) end as zip
from (select nd_auto_increment_id, regexp_extract(upaddress, '(\\d{5})', 1) v from pii_data_table)""")
def r10_zip(s, d):
    return T(s, d, "pii_data_table").select("nd_auto_increment_id", rules.zip3(F.coalesce(F.regexp_extract("upaddress", r"(\d{5})", 1), F.lit(None))).alias("zip"))


@query("select nd_auto_increment_id, '<<UFNAME>>' as ufname, '<<<<>>>>' as ulname from pii_data_table")
def r06_mask(s, d):
    return T(s, d, "pii_data_table").select("nd_auto_increment_id", rules.mask("UFNAME").alias("ufname"), rules.mask("<<>>").alias("ulname"))


@query("select nd_auto_increment_id, year(dob)::int as birth_year from pii_data_table")
def r09_birth_year(s, d):
    return T(s, d, "pii_data_table").select("nd_auto_increment_id", rules.birth_year(F.date_format("dob", "MM/dd/yyyy")).alias("birth_year"))


@query("""select o_orderkey, strftime(date_trunc('second', o_orderdate) + interval 34 day, '%Y-%m-%d %H:%M:%S') as iso, strftime(o_orderdate::date + interval 34 day, '%Y-%m-%d %H:%M:%S') as us,
strftime(o_orderdate::date + interval 34 day, '%Y-%m-%d %H:%M:%S') as slashed, strftime(date_trunc('second', o_orderdate) + interval 34 day, '%Y-%m-%d %H:%M:%S') as iso_t,
strftime(o_orderdate::date + interval 34 day, '%Y-%m-%d %H:%M:%S') as dotted, null::varchar as junk from orders""")
def r07_r08_formats(s, d):
    o = T(s, d, "orders")
    forms = {"iso": "yyyy-MM-dd HH:mm:ss", "us": "MM/dd/yyyy", "slashed": "yyyy/MM/dd", "iso_t": "yyyy-MM-dd'T'HH:mm:ss", "dotted": "MM.dd.yyyy"}
    return o.select("o_orderkey", *[rules.shift(F.date_format("o_orderdate", f), F.lit(34)).alias(k) for k, f in forms.items()], rules.shift(F.concat(F.lit("no date "), "o_orderpriority"), F.lit(34)).alias("junk"))


@query("""select l_orderkey, l_linenumber, case when ts < timestamp '1000-01-01' then '1000-01-01 00:00:00' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as low
from (select l_orderkey, l_linenumber, timestamp '1000-01-05 00:00:00' - to_days(l_linenumber::int * 2) ts from lineitem)""")
def r07_clamp(s, d):
    return T(s, d, "lineitem").select("l_orderkey", "l_linenumber", rules.shift(F.lit("1000-01-05 00:00:00"), -F.col("l_linenumber") * 2).alias("low"))


_USABLE = """pats as (select patientid, min(nd_patient_id) nd, min(offset_days) off from patient_mapping_table where not coalesce(excluded, false) group by 1),
exc as (select distinct nd_patient_id from patient_mapping_table where excluded)"""


@query(f"""with {_USABLE}, offs as (select nd, min(off) off from pats group by 1),
own as (select patientid, min(nd_patient_id) nd from patient_mapping_table group by 1),
amap as (select apptid, min(own.nd) nd from appointment_dump left join own using (patientid) where own.nd is null or own.nd not in (from exc) group by 1),
j as (select d.nd_auto_increment_id, d.apptid, d.patientid, p.nd rnd, a.nd an, case when d.patientid % 2 = 0 and own.nd not in (from exc) then own.nd end cn, a.apptid hasa
  from appointment_dump d left join pats p on p.patientid = d.patientid and p.patientid % 3 > 0 left join amap a on a.apptid = d.apptid left join own on own.patientid = d.patientid)
select nd_auto_increment_id, case when hasa is not null then 100100000000000 + apptid end as apptid, coalesce(rnd, an, cn) as ref, case when cn is not null then 7000000 + patientid end as chart
from j where coalesce(rnd, an, cn) is not null""")
def r03_r04_r05_ids(s, d):
    """Reference, appointment and chart ids of all appointments through a table plan; two thirds of the patients have a reference, half a chart."""
    a, p = T(s, d, "appointment_dump", "patient_mapping_table")
    rows = a.select("nd_auto_increment_id", "apptid", F.concat(F.lit("r"), "patientid").alias("ref"), F.concat(F.lit("c"), "patientid").alias("chart"))
    own = p.groupBy("patientid").agg(F.min("nd_patient_id").alias("nd_patient_id"))
    appts = a.join(own, "patientid", "left").select(F.col("apptid").alias("appointment_id"), (F.col("apptid") + 100100000000000).alias("nd_appointment_id"), "nd_patient_id")
    charts = own.where("patientid % 2 = 0").select(F.concat(F.lit("c"), "patientid").alias("chart_id"), (F.col("patientid") + 7000000).alias("nd_chart_id"), "nd_patient_id")
    pats = p.withColumn("reference_mapping", F.when(F.col("patientid") % 3 > 0, F.concat(F.lit("r"), "patientid")))
    plan = plans.TablePlan("appointments", {"apptid": "APPOINTMENT_ID", "ref": "REFERENCE_PID", "chart": "CHART_ID"})
    return plan.apply(rows, pats, appointments=appts, charts=charts)[0]


@query(f"""with {_USABLE} select id, nd as patientid, 'visit  ' || strftime(encounter_date::date + to_days(off), '%Y-%m-%d') || '  call ((PHONE_NUMBER)) x' as note
from encounter_mapping_table join pats using (patientid) where encounter_date is not null""")
def r11_generic_notes_plan(s, d):
    """Generic notes through a table plan: masks, and dates shifted by the patient's offset."""
    e, p = T(s, d, "encounter_mapping_table", "patient_mapping_table")
    rows = e.where("encounter_date is not null").select("id", "patientid", F.concat(F.lit("visit "), F.date_format("encounter_date", "MM/dd/yyyy"), F.lit(" call 212-555-0100 x")).alias("note"))
    return plans.TablePlan("visits", {"patientid": "PATIENT_ID", "note": "GENERIC_NOTES"}).apply(rows, p)[0]


@query(f"""with {_USABLE} select id, nd as patientid, case when id % 3 = 0 then strftime(encounter_date::date + to_days(off), '%Y-%m-%d 00:00:00') when id % 3 = 1 then 'seen ' || strftime(encounter_date::date + to_days(off), '%Y-%m-%d') || ', twice' end as at
from encounter_mapping_table join pats using (patientid) where encounter_date is not null""")
def r15_dates_in_cells_plan(s, d):
    """Date cells through a table plan: whole dates, dates within text, and text without a date, which isn't released."""
    e, p = T(s, d, "encounter_mapping_table", "patient_mapping_table")
    day = F.date_format("encounter_date", "MM/dd/yyyy")
    at = F.when(F.col("id") % 3 == 0, day).when(F.col("id") % 3 == 1, F.concat(F.lit("seen "), day, F.lit(", twice"))).otherwise("no date")
    return plans.TablePlan("visits", {"patientid": "PATIENT_ID", "at": "DATE_OFFSET"}).apply(e.where("encounter_date is not null").select("id", "patientid", at.alias("at")), p)[0]


@query("""select c_custkey, (case when 2000 + c_custkey % 100 > 2024 then 1900 + c_custkey % 100 else 2000 + c_custkey % 100 end)::int as birth_year from customer""")
def r14_two_digit_year(s, d):
    text = F.concat(F.lit("1/7/"), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"))
    return T(s, d, "customer").select("c_custkey", rules.birth_year(text, F.lit("2024-06-30").cast("date")).alias("birth_year"))


# --- mapping and master tables ------------------------------------------------------------------------
_NOW = "2024-07-01 00:00:00"


@query(f"""with old as (select patientid, min(nd_patient_id) nd_patient_id, min(offset_days) offset_days, min(registration_date) registration_date, bool_or(excluded) excluded, min(excluded_at) excluded_at from patient_mapping_table where patientid is not null group by 1),
d as (select try_cast(trim(patientid) as bigint) patientid, max(registration_date) d_reg, bool_or(coalesce(lower(trim(excluded)) in ('1','y','true'), false)) d_exc from patient_mapping_local where try_cast(trim(patientid) as bigint) is not null group by 1),
fresh as (select patientid, (select max(nd_patient_id) from old) + row_number() over (order by patientid) nd, {_offset('patientid')} off from d where patientid not in (select patientid from old))
select coalesce(old.patientid, d.patientid) as patientid, coalesce(nd_patient_id, nd) as nd_patient_id, coalesce(offset_days, off) as offset_days, coalesce(d_reg, registration_date) as registration_date, coalesce(excluded, false) or coalesce(d_exc, false) as excluded,
case when (coalesce(excluded, false) or coalesce(d_exc, false)) and not coalesce(excluded, false) then timestamp '{_NOW}' else excluded_at end as excluded_at from old full join d on old.patientid = d.patientid left join fresh on fresh.patientid = d.patientid""")
def m07_mapping_delta(s, d):
    """New patients get a surrogate and an offset, known ones keep theirs."""
    m, l = T(s, d, "patient_mapping_table", "patient_mapping_local")
    old = m.where("patientid is not null").groupBy("patientid").agg(*[F.min(c).alias(c) for c in ("nd_patient_id", "offset_days", "registration_date")], F.bool_or("excluded").alias("excluded"), F.min("excluded_at").alias("excluded_at"))
    pid = id_long(F.col("patientid"))
    delta = l.where(pid.isNotNull()).select(pid.alias("patientid"), "registration_date", (F.coalesce(flag(F.col("excluded")), F.lit("N")) == "Y").alias("excluded"))
    return mp.mapping_delta(old, delta, F.expr(f"timestamp_ntz'{_NOW}'"), _SECRET)


@query("""with o as (select nd_patient_id, max(umobileno) umobileno, max(uemail) uemail from pii_data_table where nd_patient_id is not null group by 1),
n as (select nd_patient_id, max(case when offset_days > 0 then 'new' end) umobileno from patient_mapping_table group by 1)
select coalesce(o.nd_patient_id, n.nd_patient_id) as nd_patient_id, coalesce(n.umobileno, o.umobileno) as umobileno, uemail from o full join n on o.nd_patient_id = n.nd_patient_id""")
def m10_pii_upsert(s, d):
    p, m = T(s, d, "pii_data_table", "patient_mapping_table")
    old = p.where("nd_patient_id is not null").groupBy("nd_patient_id").agg(F.max("umobileno").alias("umobileno"), F.max("uemail").alias("uemail"))
    new = m.groupBy("nd_patient_id").agg(F.max(F.expr("case when offset_days > 0 then 'new' end")).alias("umobileno"))
    return mp.upsert_keep(old, new, "nd_patient_id")


@query("""select nd_patient_id, encounter_id from encounter_mapping_table where nd_patient_id not in (select nd_patient_id from encounter_map_snapshots where nd_patient_id is not null)
union all select nd_patient_id, encounter_id from encounter_map_snapshots""")
def m11_group_refresh(s, d):
    a, b = T(s, d, "encounter_mapping_table", "encounter_map_snapshots")
    return mp.refresh_groups(a.select("nd_patient_id", "encounter_id"), b.select("nd_patient_id", "encounter_id"), "nd_patient_id")


@query("""with p as (select nd_patient_id, max((coalesce(ufname, ''), coalesce(ulname, ''))) r from pii_data_table where nd_patient_id is not null group by 1), e as (select nd_patient_id, max(encounter_id) x from encounter_mapping_table where nd_patient_id is not null group by 1)
select coalesce(p.nd_patient_id, e.nd_patient_id) as nd_patient_id, r[1] as pii_ufname, r[2] as pii_ulname, x as enc_encounter_id from p full join e on p.nd_patient_id = e.nd_patient_id""")
def m12_master_table(s, d):
    p, e = T(s, d, "pii_data_table", "encounter_mapping_table")
    p = p.select("nd_patient_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("ufname", "ulname")])
    return mp.master_table("nd_patient_id", {"pii": p, "enc": e.select("nd_patient_id", "encounter_id")})


_NAMES = [("patientId", "INT"), ("PatientDOB", "DATE"), ("zipCode", "VARCHAR(10)"), ("first_name", "VARCHAR(50)"), ("homePhone", "VARCHAR(20)"), ("visitId", "INT"), ("clinicalNotes", "TEXT"), ("created", "DATETIME"), ("blob", "LONGTEXT"), ("amount", "DECIMAL"), ("apptId", "INT"), ("startTime", "VARCHAR(9)")]


@query("""select * from (values ('patientId', 'PATIENT_ID'), ('PatientDOB', 'PATIENT_DOB'), ('zipCode', 'ZIP_CODE'), ('first_name', 'MASK'), ('homePhone', 'MASK'), ('visitId', 'ENCOUNTER_ID'),
('clinicalNotes', 'NOTES'), ('created', 'DATE_OFFSET'), ('blob', 'GENERIC_NOTES'), ('amount', ''), ('apptId', 'APPOINTMENT_ID'), ('startTime', 'DATE_OFFSET')) v(column_name, rule)""")
def m15_auto_rules(s, d):
    df = s.createDataFrame(_NAMES, "column_name string, data_type string")
    return df.select("column_name", plans.auto_rule(F.col("column_name"), F.col("data_type")).alias("rule"))


@query("""with p as (select patientid, min(nd_patient_id) nd, min(offset_days) off from patient_mapping_table group by 1), e as (select encounter_id, min(nd_patient_id) nd from encounter_mapping_table group by 1)
select s.nd_auto_increment_id, coalesce(e.nd, p.nd) as nd_patient_id, coalesce(p.off, 34)::int as offset_days from enc_staging s left join p on s.patientid = p.patientid left join e on s.encounterid = e.encounter_id""")
def m19_resolver(s, d):
    st, p, e = T(s, d, "enc_staging", "patient_mapping_table", "encounter_mapping_table")
    p = p.groupBy("patientid").agg(F.min("nd_patient_id").alias("nd_patient_id"), F.min("offset_days").alias("offset_days"))
    e = e.groupBy("encounter_id").agg(F.min("nd_patient_id").alias("nd_patient_id"))
    cur = rs.map_join(rs.map_join(st, p, "patientid", "patientid", "_from_patientid"), e, "encounterid", "encounter_id", "_from_encounterid")
    src = {"patient": ["patientid"], "encounter": ["encounterid"]}
    cur = rs.resolve(rs.resolve(cur, src, "nd_patient_id", "nd_patient_id"), src, "offset_days", "offset_days", 34)
    return cur.select("nd_auto_increment_id", "nd_patient_id", F.col("offset_days").cast("int").alias("offset_days"))


@query("select distinct nd_patient_id from patient_mapping_table p join enc_staging e on p.patientid = e.patientid where lower(trim(visittype)) = 'tele' union select nd_patient_id from patient_mapping_table where excluded")
def m09_exclusions(s, d):
    p, e = T(s, d, "patient_mapping_table", "enc_staging")
    return mp.exclusions(p, e, ["TELE"])



# --- files and further joins --------------------------------------------------------------------
@query("select o_orderkey, o_custkey from orders where o_orderkey between 200 and 900")
def s13_cached_range(s, d):
    """A table kept in the shared folder and read by range."""
    return sources.id_range(materialize(T(s, d, "orders").select("o_orderkey", "o_custkey"), "s13"), "o_orderkey", 200, 900)


@query("select s_suppkey, s_name, s_nationkey from supplier")
def s24_s25_csv_round_trip(s, d):
    path = scratch_path(s, "s25")
    df = T(s, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    df.write.option("header", True).csv(path)
    return s.read.option("header", True).schema(df.schema).csv(path)


@query("select dump_file as path, binlog_file, binlog_pos, strftime(dump_completed_at, '%Y-%m-%d %H:%M:%S') as completed from dump_metadata")
def s28_dump_texts(s, d):
    m = T(s, d, "dump_metadata")
    text = F.concat(F.lit("-- dump\nCHANGE MASTER TO MASTER_LOG_FILE='"), "binlog_file", F.lit("', MASTER_LOG_POS="), F.col("binlog_pos").cast("string"), F.lit(";\n"), F.coalesce(F.concat(F.lit("-- Dump completed on "), F.date_format("dump_completed_at", "yyyy-MM-dd HH:mm:ss")), F.lit("")))
    return sources.dump_metadata(m.select(F.col("dump_file").alias("path"), text.alias("value")))


@query("select l_orderkey, l_linenumber, o_custkey, l_extendedprice from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F'")
def j13_inner_join(s, d):
    l, o = T(s, d, "lineitem", "orders")
    return l.join(o.where("o_orderstatus = 'F'"), l["l_orderkey"] == o["o_orderkey"]).select("l_orderkey", "l_linenumber", "o_custkey", "l_extendedprice")


@query("""select count(*) filter (p is not null) as n_mapped, count(*) filter (p is null) as n_skipped from enc_staging e left join (select distinct patientid p from patient_mapping_table) m on e.patientid = m.p""")
def j15_mapped_and_skipped(s, d):
    e, p = T(s, d, "enc_staging", "patient_mapping_table")
    j = e.join(p.select(F.col("patientid").alias("p")).distinct(), F.col("patientid") == F.col("p"), "left")
    return j.agg(F.count_if(F.col("p").isNotNull()).alias("n_mapped"), F.count_if(F.col("p").isNull()).alias("n_skipped"))


@query("select count(*) as keys_that_fan_out from (select encounter_id from encounter_mapping_table group by 1 having count(*) > 1)")
def j21_fan_out(s, d):
    return T(s, d, "encounter_mapping_table").groupBy("encounter_id").count().where("count > 1").agg(F.count("*").alias("keys_that_fan_out"))


@query("select patientid, offset_days from (select patientid, offset_days, row_number() over (order by patientid, offset_days) rn from (select distinct patientid, offset_days from patient_mapping_table where abs(offset_days) < 30)) where rn <= 20")
def a13_offenders(s, d):
    """The first 20 offsets under the band, as a report shows them."""
    bad = T(s, d, "patient_mapping_table").where(F.abs("offset_days") < 30).select("patientid", "offset_days").distinct()
    return bad.orderBy("patientid", "offset_days").limit(20)


@query("select a.apptid, 40000000 + row_number() over (order by a.apptid) as nd_appointment_id from (select distinct apptid from appointment_dump) a")
def m05_appointment_map(s, d):
    return mp.numbered(T(s, d, "appointment_dump").select("apptid").distinct(), ["apptid"], "nd_appointment_id", 40_000_000)


@query("""select * from (values ('appointment_dump', 'patient', 'patientid'), ('enc_staging', 'patient', 'patientid'), ('enc_staging', 'encounter', 'encounterid')) v(table_name, kind, column_name)""")
def m01_f09_id_columns(s, d):
    cols = identifiers.id_columns({"enc_staging": {"patientid": "PATIENT_ID", "encounterid": "ENCOUNTER_ID", "visittype": "MASK"}, "appointment_dump": {"patientid": "PATIENT_ID"}})
    return s.createDataFrame([(t, k, c) for t, g in cols.items() for k, cs in g.items() for c in cs], "table_name string, kind string, column_name string")


@query("""with m as (select nd_patient_id k, ufname f, ulname l from pii_data_table), s as (select k, count(*) n, count(distinct f) nf from m group by 1) select k as nd_patient_id, n as n_rows, nf as n_first_names from s""")
def m13_pii_by_patient(s, d):
    return T(s, d, "pii_data_table").groupBy("nd_patient_id").agg(F.count("*").alias("n_rows"), F.countDistinct("ufname").alias("n_first_names"))


@query("""select nd_patient_id, array_to_string(list_sort(list_distinct(list(ufname))), '|') as first_names, array_to_string(list_sort(list_distinct(list(ulname))), '|') as last_names from pii_data_table
where nd_patient_id in (select nd_patient_id from encounter_mapping_table) group by 1""")
def m13_n13_personal_values(s, d):
    """The values by which notes of the patients with an encounter are masked."""
    p, e = T(s, d, "pii_data_table", "encounter_mapping_table")
    v = mp.personal_values(p, "nd_patient_id", ["ufname", "ulname"], e)
    return v.select("nd_patient_id", F.array_join("ufname", "|").alias("first_names"), F.array_join("ulname", "|").alias("last_names"))


@query("select nd_auto_increment_id, length(content) as width from (select distinct nd_auto_increment_id, content from encounter_notes where content is not null) qualify row_number() over (order by length(content) desc, nd_auto_increment_id, content) <= 25")
def l09_longest_first(s, d):
    n = T(s, d, "encounter_notes").where("content is not null").select("nd_auto_increment_id", "content").distinct()
    return n.orderBy(F.length("content").desc(), "nd_auto_increment_id", "content").limit(25).select("nd_auto_increment_id", F.length("content").alias("width"))


@query("select * from (select distinct * from appointment_dump)")
def u06_full_row_dedup(s, d):
    return T(s, d, "appointment_dump").dropDuplicates()


@query("select table_name, min(run_id) as first_run from (select lower(trim(table_name)) table_name, run_id from delta_runs where lower(trim(status)) <> 'success') group by 1")
def w06_first_open_run(s, d):
    r = T(s, d, "delta_runs").where(F.lower(F.trim("status")) != "success")
    return r.groupBy(F.lower(F.trim("table_name")).alias("table_name")).agg(F.min_by("run_id", "run_id").alias("first_run"))


@query("""with a as (select patientid k, min(nd_patient_id) v from patient_mapping_table group by 1), b as (select patientid k, min(nd_patient_id) v from encounter_mapping_table group by 1)
select coalesce(a.k, b.k) as id, case when b.k is null then 'missing_in_dest' when a.k is null then 'extra_in_dest' else 'mismatch' end as issue, a.v::varchar as source_value, b.v::varchar as dest_value
from a full join b on a.k = b.k where a.k is null or b.k is null or a.v is distinct from b.v""")
def j11_typed_diff(s, d):
    a, b = (t.groupBy(F.col("patientid").alias("id")).agg(F.min("nd_patient_id").alias("v")) for t in T(s, d, "patient_mapping_table", "encounter_mapping_table"))
    return qc.delta_identity(a, b, "id", "v", restrict=False)


@query("select nd_auto_increment_id, encounterid from enc_staging where nd_auto_increment_id in (select nd_auto_increment_id from encounter_notes)")
def j12_semi_restrict(s, d):
    a, b = T(s, d, "enc_staging", "encounter_notes")
    return sources.lookup(a.select("nd_auto_increment_id", "encounterid"), "nd_auto_increment_id", b, "nd_auto_increment_id")


@query("select p_partkey, l_orderkey, l_quantity from part, lineitem where p_partkey = l_partkey and p_size > 25")
def j14_comma_join(s, d):
    p, l = T(s, d, "part", "lineitem")
    return p.where("p_size > 25").join(l, p["p_partkey"] == l["l_partkey"]).select("p_partkey", "l_orderkey", "l_quantity")


@query("""select n.nd_auto_increment_id, m.n_phones from encounter_notes n left join (select nd_patient_id, count(distinct umobileno) n_phones from pii_data_table group by 1) m on n.nd_patient_id = m.nd_patient_id""")
def j20_pii_lookup(s, d):
    n, p = T(s, d, "encounter_notes", "pii_data_table")
    m = p.groupBy("nd_patient_id").agg(F.countDistinct("umobileno").alias("n_phones"))
    return n.select("nd_auto_increment_id", "nd_patient_id").join(m, "nd_patient_id", "left").select("nd_auto_increment_id", "n_phones")


@query("select 'documents' as table_name, count(*) as n_rows from documents union all select 'enc_staging', count(*) from enc_staging union all select 'lineitem', count(*) from lineitem")
def a01_s08_row_counts(s, d):
    out = None
    for t in ("documents", "enc_staging", "lineitem"):
        x = T(s, d, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows"))
        out = x if out is None else out.unionByName(x)
    return out


@query("select sum(case when enc_date is null then 1 else 0 end)::bigint as nulls_before, sum(case when enc_date is null then 1 else 0 end)::bigint as nulls_after from enc_staging")
def a19_null_delta(s, d):
    """Nulls of a column before and after its rule."""
    e = T(s, d, "enc_staging").select("enc_date", rules.shift(F.col("enc_date"), F.lit(5), typed=True).alias("after"))
    return e.agg(F.count_if(F.col("enc_date").isNull()).alias("nulls_before"), F.count_if(F.col("after").isNull()).alias("nulls_after"))


@query("select encounter_id, min(nd_patient_id) as nd_patient_id from encounter_mapping_table group by 1")
def w05_first_per_key(s, d):
    x = F.col("nd_patient_id")
    return rs.keep_first(T(s, d, "encounter_mapping_table"), ["encounter_id"], [x.isNull(), x]).select("encounter_id", "nd_patient_id")


@query("select o_orderkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def l06_rows_of_ids(s, d):
    o, c = T(s, d, "orders", "customer")
    return sources.lookup(o.select("o_orderkey", "o_totalprice", "o_custkey"), "o_custkey", c.where("c_mktsegment = 'BUILDING'"), "c_custkey").select("o_orderkey", "o_totalprice")


@query("""with m as (select nd_patient_id k, min(patientid) p from patient_mapping_table group by 1)
select e.id, p as resolved_patientid, e.nd_patient_id as resolved_nd_patient_id from encounter_mapping_table e left join m on e.nd_patient_id = m.k""")
def m20_resolved_identifiers(s, d):
    e, p = T(s, d, "encounter_mapping_table", "patient_mapping_table")
    m = p.groupBy("nd_patient_id").agg(F.min("patientid").alias("p"))
    return rs.map_join(e.select("id", "nd_patient_id"), m, "nd_patient_id", "nd_patient_id", "_m").select("id", F.col("p_m").alias("resolved_patientid"), F.col("nd_patient_id").alias("resolved_nd_patient_id"))


@query(f"""with {_CUST}, old as (select o_orderkey e, nd_patient_id n, nd_patient_id * 10000 + row_number() over (partition by nd_patient_id order by o_orderdate, o_orderkey) x from orders join cmap on o_custkey = patientid where o_orderdate < timestamp '1996-01-01'),
top as (select n, max(x) m from old group by 1)
select o_orderkey as encounter_id, o_custkey as patientid, nd_patient_id, coalesce(m, nd_patient_id * 10000) + row_number() over (partition by nd_patient_id order by o_orderdate, o_orderkey) as nd_encounter_id
from orders join cmap on o_custkey = patientid left join top on nd_patient_id = n where o_orderdate >= timestamp '1996-01-01'""")
def m08_encounter_delta(s, d):
    """New encounters go on from each patient's highest number."""
    o = T(s, d, "orders").select(F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patientid"), F.col("o_orderdate").alias("encounter_date"))
    pats = _customers(s, d)
    old = mp.encounter_surrogates(o.where("encounter_date < timestamp'1996-01-01 00:00:00'"), pats)
    return mp.encounter_surrogates(o, pats, old).select("encounter_id", "patientid", "nd_patient_id", "nd_encounter_id")


@query("""select nd_auto_increment_id, coalesce(try_strptime(t, '%m/%d/%Y'), try_strptime(t, '%Y-%m-%d')) as read_as from (select nd_auto_increment_id, case when facilityid % 2 = 0 then strftime(dob, '%m/%d/%Y') else strftime(dob, '%Y-%m-%d') end t from pii_data_table)""")
def r13_notation_by_row(s, d):
    """The notation is found for each row, not for a sample of the column."""
    t = F.when(F.col("facilityid") % 2 == 0, F.date_format("dob", "MM/dd/yyyy")).otherwise(F.date_format("dob", "yyyy-MM-dd"))
    return T(s, d, "pii_data_table").select("nd_auto_increment_id", rules.parse_any(t).alias("read_as"))
