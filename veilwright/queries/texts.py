"""Queries of free-text masking and documents, with their SQL."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import plans
from ..functions import notes as nt
from ..operators import documents as dc
from ..session import spread
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


def _notes(s, d):
    return T(s, d, "encounter_notes").select("nd_auto_increment_id", "nd_patient_id", "patientid", "encounterid", "content")


@query("select nd_auto_increment_id, trim(replace(regexp_replace(coalesce(content, ''), '\\s+', ' ', 'g'), '^', ' ')) as content from encounter_notes")
def n01_normalise(s, d):
    return _notes(s, d).select("nd_auto_increment_id", nt.normalise(F.col("content")).alias("content"))


@query("""with e as (select encounter_id, min(nd_encounter_id) ne from encounter_mapping_table group by 1)
select nd_auto_increment_id, coalesce(content, '') || ' visit ' || coalesce(e.ne::varchar, case when encounterid is null then 'none' else '((ENCOUNTER_ID))' end) || ' end' as content
from encounter_notes n left join e on n.encounterid = e.encounter_id""")
def n02_key_ids(s, d):
    n, e = _notes(s, d), T(s, d, "encounter_mapping_table")
    e = e.groupBy("encounter_id").agg(F.min("nd_encounter_id").alias("ne"))
    j = n.join(e, F.col("encounterid") == F.col("encounter_id"), "left")
    text = F.concat(F.coalesce("content", F.lit("")), F.lit(" visit "), F.coalesce(F.col("encounterid").cast("string"), F.lit("none")), F.lit(" end"))
    return j.select("nd_auto_increment_id", nt.key_ids(text, [(F.col("encounterid"), F.col("ne"), "((ENCOUNTER_ID))")]).alias("content"))


def _masked_by(text: str, pairs) -> str:
    """SQL that replaces patterns one after another."""
    for pattern, mask, flags in pairs:
        text = f"regexp_replace({text}, {pattern}, '{mask}', '{flags}')"
    return text


#: Word borders are those of the letters a to z there; no value of the master table ends in another letter.
_N05 = r"""
with p as (select nd_patient_id k, trim(ufname) f, trim(ulname) l, trim(umobileno) t, trim(uemail) e, trim(upaddress) a from pii_data_table where nd_patient_id is not null),
w as (select k, 'f' g, f v from p union select k, 'l', l from p union select k, 't', t from p union select k, 'e', e from p union select k, 'a', a from p union select k, 'n', lower(f) from p where f <> '' union select k, 'n', lower(l) from p where l <> ''
  union select k, 'n', lower(f) || ' ' || lower(l) from p where f <> '' and l <> '' union select k, 'n', lower(l) || ' ' || lower(f) from p where f <> '' and l <> ''),
x as (select k, g, '\b(?:' || string_agg(regexp_escape(v), '|' order by length(v) desc, v) || ')\b' as pat from w where length(v) > 2 group by 1, 2),
m as (select k, """ + ", ".join(f"coalesce(max(pat) filter (g = '{g}'), '(?:[^\\s\\S])') {g}" for g in "fltean") + """ from x group by 1)
select nd_auto_increment_id, case when k is null then content else """ + _masked_by("content", [(g, m, "gi") for g, m in (("f", "((FIRST_NAME))"), ("l", "((LAST_NAME))"), ("t", "((PHONE))"), ("e", "((EMAIL))"), ("a", "((ADDRESS))"), ("n", "((NAME))"))]) + """ end as content
from encounter_notes left join m on nd_patient_id = k"""


@query(_N05)
def n05_n07_patient_masks(s, d):
    """Notes with the values of their patient's master record masked, single and combined."""
    pats = nt.patient_patterns(T(s, d, "pii_data_table"), "nd_patient_id", {"((FIRST_NAME))": ["ufname"], "((LAST_NAME))": ["ulname"], "((PHONE))": ["umobileno"], "((EMAIL))": ["uemail"], "((ADDRESS))": ["upaddress"]}, {"((NAME))": ["ufname", "ulname"]})
    masks = ["((FIRST_NAME))", "((LAST_NAME))", "((PHONE))", "((EMAIL))", "((ADDRESS))"]
    return nt.apply_patient_patterns(_notes(s, d), "content", "nd_patient_id", pats, masks, ["((NAME))"]).select("nd_auto_increment_id", "content")


@query("select nd_auto_increment_id, 'born ' || year(dob)::varchar || ' or ' || year(dob)::varchar || ' end' as content from pii_data_table where dob is not null")
def n06_birth_dates(s, d):
    p = T(s, d, "pii_data_table").where("dob is not null")
    text = F.concat(F.lit("born "), F.date_format("dob", "MM/dd/yyyy"), F.lit(" or "), F.date_format("dob", "yyyy-MM-dd"), F.lit(" end"))
    return p.select("nd_auto_increment_id", nt.birth_dates_to_year(text, F.col("dob")).alias("content"))


@query("select nd_auto_increment_id, regexp_replace(regexp_replace(content, '\\bDr\\. [A-Z][a-z]+', '((PROVIDER))', 'g'), '[0-9]+ percent', '((SHARE))', 'g') as content from encounter_notes")
def n09_regex(s, d):
    return _notes(s, d).select("nd_auto_increment_id", nt.patterns(F.col("content"), [(r" \bDr\. [A-Z][a-z]+", "((PROVIDER))"), (["[0-9]+ percent", "(broken"], "((SHARE))")]).alias("content"))


@query("select nd_auto_increment_id, regexp_replace(regexp_replace(content, '(?i)\\b(?:family present|family)\\b', '((RELATIVE))', 'g'), '(?i)\\b(?:clinic)\\b', '((PLACE))', 'g') as content from encounter_notes")
def n10_replace_value(s, d):
    return _notes(s, d).select("nd_auto_increment_id", nt.replace_values(F.col("content"), {"family": "((RELATIVE))", "family present": "((RELATIVE))", "clinic": "((PLACE))"}).alias("content"))


@query("select nd_auto_increment_id, try_cast(try_cast(case when trim(patientid) = '' then null else trim(patientid) end as double) as bigint) as pid from encounter_notes")
def n12_person_number(s, d):
    return _notes(s, d).select("nd_auto_increment_id", nt.person_number(F.trim("patientid")).alias("pid"))


@query("select event_id, 'from ((IPADDRESS)) to ((URL)) ok' as text from events")
def n21_n22_ip_url(s, d):
    t = F.concat(F.lit("from 10."), (F.col("user_id") % 250).cast("string"), F.lit(".3.4 to https://host.example/a"), F.col("event_id").cast("string"), F.lit(" ok"))
    return T(s, d, "events").select("event_id", nt.mask_url(nt.mask_ip(t)).alias("text"))


@query(r"""select nd_auto_increment_id, regexp_replace(content, '(?:\+?1[\s.-]?)?(?:\(\d{3}\)[\s.-]|\d{3}[\s.-])\d{3}[\s.-]\d{4}\b', '((PHONE_NUMBER))', 'g') as content from encounter_notes""")
def n23_phone(s, d):
    return _notes(s, d).select("nd_auto_increment_id", nt.mask_phone(F.col("content")).alias("content"))


@query("select doc_id, 'DL holder ((DRIVERSLICENSE)) and ((DRIVERSLICENSE)).' as text from documents")
def n25_licence(s, d):
    t = F.concat(F.lit("DL holder License No: B"), F.lpad(F.col("doc_id").cast("string"), 8, "1"), F.lit(" and A"), F.lpad(F.col("doc_id").cast("string"), 7, "2"), F.lit("."))
    return T(s, d, "documents").select("doc_id", nt.mask_licence(t).alias("text"))


@query(r"""select doc_id, trim(regexp_replace(text, '[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) as text from documents""")
def n20_squeeze(s, d):
    return T(s, d, "documents").select("doc_id", nt.squeeze_spaces(F.col("text")).alias("text"))


@query("select o_orderkey, 'seen  ' || strftime(o_orderdate::date + interval 10 day, '%Y-%m-%d') || '  and  ' || strftime(date_trunc('second', o_orderdate) + interval 10 day, '%Y-%m-%d %H:%M:%S') || '  end' as text from orders")
def n24_r15_dates_in_text(s, d):
    t = F.concat(F.lit("seen "), F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" and "), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" end"))
    return spread(T(s, d, "orders")).select("o_orderkey", nt.shift_dates_in_text(t, F.lit(10)).alias("text"))


#: The documents hold no dates in the notations that are shifted, so the SQL leaves that step out.
_N28 = _masked_by(r"trim(regexp_replace(text, '[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))", [("'" + p.replace("'", "''") + "'", token, "g") for token, ps in nt.GENERIC for p in ps])


@query(f"select doc_id, {_N28} as text from documents")
def n28_generic_chain(s, d):
    """The whole generic chain over all documents, dates shifted by the patient's offset."""
    docs, p = T(s, d, "documents", "patient_mapping_table")
    p = p.groupBy(F.col("nd_patient_id").alias("_p")).agg(F.min("offset_days").alias("off"))
    j = docs.join(p, F.col("nd_patient_id") == F.col("_p"), "left")
    return j.select("doc_id", nt.generic_chain(F.col("text"), F.coalesce("off", F.lit(34))).alias("text"))


#: Masks of the master table; what may hold a name (e-mail, address) comes before the names.
_MASTER = {"mask": {"((EMAIL))": ["uemail"], "((ADDRESS))": ["upaddress"], "((PHONE))": ["umobileno"], "((LAST_NAME))": ["ulname"], "((FIRST_NAME))": ["ufname"]}, "dob": ["dob"], "combine": {"((NAME))": ["ufname", "ulname"]}}


@query()
def r12_notes_plan(s, d):
    """All notes through a table plan: ids, the patient's values, birth dates, generic masks and date shifts; patient ids written as numbers."""
    n, p, e, m = T(s, d, "encounter_notes", "patient_mapping_table", "encounter_mapping_table", "pii_data_table")
    n = spread(n.withColumn("patientid", nt.person_number(F.col("patientid"))))
    plan = plans.TablePlan("encounter_notes", {"patientid": "PATIENT_ID", "encounterid": "ENCOUNTER_ID", "content": "NOTES"})
    return plan.apply(n, p, e, plans.NotePlan([_MASTER | {"table": m}]))[0].select("nd_auto_increment_id", "patientid", "encounterid", "content")


# --- documents --------------------------------------------------------------------------------


def _xml_texts(s, d):
    text = F.concat(F.lit("<root><DOB>"), F.date_format("dob", "MM/dd/yyyy"), F.lit("</DOB><Zip>90210-1234</Zip><PatientName>"), F.coalesce("ufname", F.lit("")), F.lit("</PatientName><note>a & b</note></root>"))
    return T(s, d, "pii_data_table").where("dob is not null").select("nd_auto_increment_id", "dob", text.alias("xml"))


@query("""select nd_auto_increment_id, '<?xml version=''1.0'' encoding=''utf-8''?>' || chr(10) || '<root><DOB>' || year(dob)::varchar || '</DOB><Zip>902</Zip><PatientName>((PATIENT_NAME))</PatientName><note>a &amp; b</note></root>' as xml
from pii_data_table where dob is not null""")
def n03_n04_xml_masks(s, d):
    return _xml_texts(s, d).select("nd_auto_increment_id", dc.mask_xml_udf("xml").alias("xml"))


@query("""select nd_auto_increment_id, '{"root": {"DOB": "' || strftime(dob, '%m/%d/%Y') || '", "Zip": "90210-1234", "PatientName": ' || case when coalesce(ufname, '') = '' then 'null' else '"' || ufname || '"' end || ', "note": "a & b"}}' as doc
from pii_data_table where dob is not null""")
def d05_xml_to_json(s, d):
    return _xml_texts(s, d).select("nd_auto_increment_id", dc.xml_to_json_udf("xml").alias("doc"))


@query("""select p_partkey, case k when 1000 then 'xml' when 1001 then 'pdf' when 1003 then 'txt' when 1004 then 'xml' when 1005 then 'xml' when 1007 then 'tif' end as extension
from (select p_partkey, 1000 + p_size % 10 k from part)""")
def d03_document_kind(s, d):
    return T(s, d, "part").select("p_partkey", dc.extension(1000 + F.col("p_size") % 10).alias("extension"))


@query("select doc_id, text as body from documents")
def d01_inflate(s, d):
    @F.pandas_udf(Ty.BinaryType())
    def deflate(t: pd.Series) -> pd.Series:
        return t.map(lambda x: None if x is None else zlib.compress(x.encode()))

    return T(s, d, "documents").select("doc_id", F.decode(dc.inflate_udf(deflate("text")), "UTF-8").alias("body"))


@query("""select event_id, unnest(json_keys(props)) as props_category, props->>unnest(json_keys(props)) as props from events""")
def d07_explode_pairs(s, d):
    return dc.explode_pairs(T(s, d, "events").select("event_id", "props"), "props")


@query("select doc_id, regexp_replace(text, '<[^>]+>', '', 'g') as text from documents")
def d10_strip_tags(s, d):
    return T(s, d, "documents").select("doc_id", dc.strip_tags(F.col("text")).alias("text"))


_DOC = '{"levelone": {"body": {"section": [{"caption": "Chief Complaint", "list": {"item": [{"content": "%s"}, {"content": "%s"}]}}, {"caption": "Social", "table": {"tr": [{"th": ["a"]}, {"td": ["Smoking", "never", "--"]}]}}]}}}'


@query("""select n_nationkey, '{"Chief Complaint": ["' || n_name || '", "' || n_regionkey::varchar || '"], "Social": {"Smoking": {"Status": "never"}}}' as sections,
'Chief Complaint:' || chr(10) || '    - ' || n_name || chr(10) || '    - ' || n_regionkey::varchar || chr(10) || 'Social:' || chr(10) || '    Smoking:' || chr(10) || '        Status: never' as text from nation""")
def d08_d09_sections(s, d):
    doc = F.format_string(_DOC, F.col("n_name"), F.col("n_regionkey").cast("string"))
    return T(s, d, "nation").select("n_nationkey", dc.document_udf(doc).alias("x")).select("n_nationkey", "x.sections", "x.text")


@query("select nd_auto_increment_id, facilityid, facility_name, content from encounter_notes join (select facilityid, min(facility_name) facility_name from facilities group by 1) using (facilityid) where facilityid in (101, 102, 103)")
def s26_document_scan(s, d):
    n, f = T(s, d, "encounter_notes", "facilities")
    bins = n.select(F.col("facilityid").alias("bintypeid"), F.col("facilityid").alias("documentid"), "nd_auto_increment_id", "content")
    docs = f.groupBy(F.col("facilityid").alias("documentid")).agg(F.min("facility_name").alias("facility_name"))
    return dc.scan_documents(bins, docs, [101, 102, 103]).select("nd_auto_increment_id", F.col("documentid").alias("facilityid"), "facility_name", "content")


# --- further masks and sections -----------------------------------------------------------------
@query("select nd_auto_increment_id, 'policy ((INSURANCE)) and ((INSURANCE)) of ((MEMBER))' as content from pii_data_table where nd_patient_id is not null")
def n08_secondary_masks(s, d):
    """Several rows of a secondary table per patient, all of whose values are masked."""
    p = T(s, d, "pii_data_table").where("nd_patient_id is not null")
    ids = p.select("nd_patient_id").distinct()
    number = lambda k: F.concat(F.lit(f"POL{k}"), F.col("nd_patient_id").cast("string"))
    sec = ids.select("nd_patient_id", number(1).alias("no"), F.lit("Family Plan").alias("plan")).unionByName(ids.select("nd_patient_id", number(2).alias("no"), F.lit("Family Plan").alias("plan")))
    pats = nt.patient_patterns(sec, "nd_patient_id", {"((INSURANCE))": ["no"], "((MEMBER))": ["plan"]})
    notes = p.select("nd_auto_increment_id", "nd_patient_id", F.concat(F.lit("policy "), number(2), F.lit(" and "), F.lower(number(1)), F.lit(" of FAMILY plan")).alias("content"))
    return nt.apply_patient_patterns(notes, "content", "nd_patient_id", pats, ["((INSURANCE))", "((MEMBER))"]).select("nd_auto_increment_id", "content")


@query("select p_partkey, 'see ((Address)) at ((FacilityLocation))' as text from part")
def n26_n27_configured_places(s, d):
    t = F.concat(F.lit("see "), (F.col("p_size") + 1).cast("string"), F.lit(" Elm Street at North Wing"))
    return T(s, d, "part").select("p_partkey", nt.generic_chain(t, address=[r"\b\d+ \w+ Street\b"], facility=["North Wing"]).alias("text"))


@query("select nd_auto_increment_id, '<a><b>' || replace(replace(replace(ufname, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</b></a>' as xml from pii_data_table where ufname is not null")
def d02_clean_xml(s, d):
    raw = F.concat(F.lit("<a>\x01<b>"), F.replace(F.replace(F.replace("ufname", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("</b></a>"))
    return T(s, d, "pii_data_table").where("ufname is not null").select("nd_auto_increment_id", dc.clean_xml_udf(F.encode(raw, "UTF-8")).alias("xml"))


def _sections(s, d, body: str):
    """Sections of documents made from the nations: %1$s is the name, %2$s the region's number."""
    doc = F.format_string('{"levelone": {"body": {"section": [' + body + "]}}}", F.col("n_name"), F.col("n_regionkey").cast("string"))
    return T(s, d, "nation").select("n_nationkey", dc.document_udf(doc).alias("x")).select("n_nationkey", "x.sections", "x.text")


@query("""select n_nationkey, '{"Assessment": [{"description": "' || n_name || '", "code": "E' || n_regionkey || '"}, {"description": "old", "code": "J1"}]}' as sections,
'Assessment:' || chr(10) || '    description: ' || n_name || chr(10) || '    code: E' || n_regionkey || chr(10) || '    description: old' || chr(10) || '    code: J1' as text from nation""")
def d19_assessment(s, d):
    return _sections(s, d, '{"caption": "Assessment", "list": {"item": [{"content": [{"coded_entry": {"coded_entry.value": {"@V": "E%2$s"}}, "#text": "%1$s"}, {"dxdesc": "old", "dxcode": "J1"}]}]}}')


@query("""select n_nationkey, '{"Review of Systems": {"' || n_name || '": {"Denies": ["pain"], "Admits": ["a", "b"]}}}' as sections,
'Review of Systems:' || chr(10) || '    ' || n_name || ':' || chr(10) || '        Denies:' || chr(10) || '            - pain' || chr(10) || '        Admits:' || chr(10) || '            - a' || chr(10) || '            - b' as text from nation""")
def d18_review_of_systems(s, d):
    return _sections(s, d, '{"caption": "Review of Systems", "section": [{"caption": {"#text": "%1$s"}, "list": {"item": [{"caption": "Denies", "content": "pain"}, {"caption": "Admits", "content": ["a", "b"]}, {"caption": "Region %2$s", "content": "x"}]}}]}')


@query("""select n_nationkey, '{"Physical Examination": {"Skin": {"Arm": {"Left": "' || n_name || '"}, "Leg": "' || n_regionkey || '"}}}' as sections,
'Physical Examination:' || chr(10) || '    Skin:' || chr(10) || '        Arm:' || chr(10) || '            Left: ' || n_name || chr(10) || '        Leg: ' || n_regionkey as text from nation""")
def d16_d17_examination(s, d):
    return _sections(s, d, '{"caption": "Physical Examination", "section": {"caption": "Skin", "list": {"item": [{"caption": "Arm", "content": {"list": {"item": {"caption": "Left", "content": "%1$s"}}}}, {"caption": "Leg", "content": "%2$s"}]}}}')


@query("""select n_nationkey, '{"Plan": {"Orders": ["' || n_name || '", "rest ' || n_regionkey || '"]}}' as sections, 'Plan:' || chr(10) || '    Orders:' || chr(10) || '        - ' || n_name || chr(10) || '        - rest ' || n_regionkey as text from nation""")
def d20_plan(s, d):
    return _sections(s, d, '{"caption": "Plan", "section": [{"caption": "Orders", "list": {"item": [{"content": {"#text": "%1$s"}}, {"content": "rest %2$s"}]}}]}')


@query("""select n_nationkey, '{"Social": {"Smoking": {"Status": "' || n_name || '", "Notes": "n"}, "Diet": null, "Pets": {"Status": "N/A"}}}' as sections,
'Social:' || chr(10) || '    Smoking:' || chr(10) || '        Status: ' || n_name || chr(10) || '        Notes: n' || chr(10) || '    Diet: None' || chr(10) || '    Pets:' || chr(10) || '        Status: N/A' as text from nation""")
def d13_table_section(s, d):
    return _sections(s, d, '{"caption": "Social", "table": {"tr": [{"th": ["h"]}, {"td": [{"#text": "Smoking"}, "%1$s", "--", "", "n"]}, {"td": ["Diet", "--", " -- "]}, {"td": "Pets"}]}}')


@query("""select n_nationkey, '{"Vitals": {"Date": "01/02/2020", "Time": "10:30 AM", "BP": "120/8' || n_regionkey || '", "Position": "Sitting", "TEMP( F)": "98.6", "L\\\\R": "L", "Cuff": "Adult", "WT": "150", "HT": null, "BMI": "24.2", "BSA": "1.8"}, "Other": {"Raw_Vitals": "x"}}' as sections from nation""")
def d14_vitals(s, d):
    out = _sections(s, d, '{"caption": "Vitals", "local_markup": "Date BP 01/02/2020 10:30 AM 120/8%2$s Sitting 98.6 L Adult 150 24.2 1.8"}')
    other = F.regexp_replace("sections", r"\}\}$", '}, "Other": {"Raw_Vitals": "x"}}')
    return out.select("n_nationkey", other.alias("sections"))


@query("""select n_nationkey, '{"History": "' || n_name || ' has pain"}' as sections, 'History: ' || n_name || ' has pain' as text from nation""")
def d15_markup_text(s, d):
    return _sections(s, d, '{"caption": "History", "local_markup": {"datahtml": ".c1 { color: red } %1$s&nbsp;has   pain"}}')


@query("""select n_nationkey, '{"Dear": "' || n_name || '", "Re": "Re: visit\\nmore", "Content_2": "closing ' || n_regionkey || '"}' as sections from nation""")
def d21_letter(s, d):
    return _sections(s, d, '{"caption": null, "paragraph": [{"@title": "Dear", "content": "%1$s"}, {"content": ["Re: visit", "more"]}, {"content": "closing %2$s"}]}').select("n_nationkey", "sections")


@query("""select n_nationkey, 'History' as sections_category, n_name as sections from nation union all select n_nationkey, 'Chief', '["a"]' from nation""")
def d23_batch_to_rows(s, d):
    """XML to JSON to sections to (category, value) rows in one plan."""
    xml = F.concat(F.lit("<levelone><body><section><caption>History</caption><content>"), "n_name", F.lit("</content></section><section><caption>Chief</caption><list><item><content>a</content></item></list></section></body></levelone>"))
    docs = T(s, d, "nation").select("n_nationkey", dc.document_udf(dc.xml_to_json_udf(xml)).alias("x")).select("n_nationkey", "x.sections")
    return dc.explode_pairs(docs, "sections")


_SPACES = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query(f"""with n as (select nd_auto_increment_id, trim(regexp_replace(regexp_replace(content, '<[^>]+>', '', 'g'), '{_SPACES}', ' ', 'g')) c, facilityid f from encounter_notes where content is not null)
select nd_auto_increment_id, 'History' as category, case when c = '' then '[]' else c end as value from n union all select nd_auto_increment_id, 'Chief', case when c = '' then 'null' else c end from n union all select nd_auto_increment_id, 'Plan', 'facility ' || coalesce(f::varchar, 'none') from n
union all select nd_auto_increment_id, null, null from encounter_notes where content is null""")
def d23_note_documents(s, d):
    """A document of every note, from XML over JSON to sections and rows: its text as markup and as a list item, and a plan."""
    n = T(s, d, "encounter_notes")
    text = F.replace(F.replace(F.replace("content", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    xml = F.concat(F.lit("<levelone><body><section><caption>History</caption><content>"), text, F.lit("</content></section><section><caption>Chief</caption><list><item><content>"), text,
                   F.lit("</content></item></list></section><section><caption>Plan</caption><section><caption>Orders</caption><list><item><content>facility "), F.coalesce(F.col("facilityid").cast("string"), F.lit("none")), F.lit("</content></item></list></section></section></body></levelone>"))
    docs = spread(n.select("nd_auto_increment_id", xml.alias("xml"))).select("nd_auto_increment_id", dc.document_udf(dc.xml_to_json_udf(F.col("xml"))).alias("x")).select("nd_auto_increment_id", "x.sections")
    rows = dc.explode_pairs(docs, "sections")
    value = F.when(F.col("sections_category") == "Chief", F.get_json_object("sections", "$[0]")).when(F.col("sections_category") == "Plan", F.get_json_object("sections", "$.Orders[0]")).otherwise(F.col("sections"))
    return rows.select("nd_auto_increment_id", F.col("sections_category").alias("category"), value.alias("value"))


@query("select nd_auto_increment_id, facilityid, facility_name, content from encounter_notes join (select facilityid, min(facility_name) facility_name from facilities group by 1) using (facilityid)")
def s26_document_scan_all(s, d):
    """The same scan with every kind that occurs."""
    n, f = T(s, d, "encounter_notes", "facilities")
    docs = f.groupBy(F.col("facilityid").alias("documentid")).agg(F.min("facility_name").alias("facility_name"))
    kinds = sorted(r[0] for r in docs.select("documentid").where("documentid is not null").collect())  # a table of fixed size
    bins = n.select(F.col("facilityid").alias("bintypeid"), F.col("facilityid").alias("documentid"), "nd_auto_increment_id", "content")
    return dc.scan_documents(bins, docs, kinds).select("nd_auto_increment_id", F.col("documentid").alias("facilityid"), "facility_name", "content")


@query("select n_nationkey, '{\"section\":[]}' as body from nation")
def d11_body(s, d):
    return T(s, d, "nation").select("n_nationkey", dc.body_json(F.lit('{"levelone": {"body": {"section": []}}}')).alias("body"))
