"""Configuration and table plans: what is done to which column, checked before anything runs."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import notes as nt
from ..functions.rules import DEFAULT_OFFSET, RULES, rule_of
from ..operators import resolve as rs

_VAR = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def interpolate(value, env: Mapping[str, str] | None = None):
    """``${NAME}`` and ``${NAME:-default}`` in texts, through maps and lists; a value that is JSON of a list or map becomes that."""
    env = os.environ if env is None else env
    if isinstance(value, dict):
        return {k: interpolate(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [interpolate(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def one(m: re.Match) -> str:
        got = env.get(m[1], m[2])
        if got is None:
            raise KeyError(f"no value for {m[1]}")
        return got

    out = _VAR.sub(one, value)
    if out != value and out[:1] in "[{":
        try:
            return json.loads(out)
        except ValueError:
            return out
    return out


def overlay(base: Mapping, over: Mapping) -> dict:
    """Deep merge; lists and scalars of ``over`` replace."""
    out = dict(base)
    for k, v in over.items():
        out[k] = overlay(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


#: What column names say about their rule; the first that fits counts.
NAME_RULES = [
    (r"^(patient_?id|pat_?id|pid)$", "PATIENT_ID"),
    (r"^(encounter_?id|enc_?id|visit_?id)$", "ENCOUNTER_ID"),
    (r"^(appo?intment_?id|appt_?id)$", "APPOINTMENT_ID"),
    (r"(^|_)(dob|date_?of_?birth|birth_?date|patientdob)($|_)", "PATIENT_DOB"),
    (r"(^|_)(date|datetime|_dt|_date|timestamp|_time|_ts)($|_)|(date|time)$", "DATE_OFFSET"),
    (r"(^|_)(zip|zip_?code|postal_?code|zipcode)($|_)", "ZIP_CODE"),
    (r"(^|_)(first_?name|last_?name|middle_?name|patient_?name|full_?name|fname|lname|mname|maiden_?name|preferred_?name|nick_?name|display_?name)($|_)", "MASK"),
    (r"(^|_)(ssn|social_?security|tax_?id|tin|phone|fax|cell|mobile|home_?phone|work_?phone|phone_?number|email|e_?mail|email_?address)($|_)", "MASK"),
    (r"(^|_)(address|addr|street|address_?line|city|state|county)($|_)", "MASK"),
    (r"(^|_)(notes?|comment|narrative|description|free_?text|remarks|memo|clinical_?notes?)($|_)", "NOTES"),
    (r"(^|_)(doc_?content|document_?text|document_?body|doc_?text|doc_?body|bin_?content|blob_?content|text_?content|content_?text|report_?text|clinical_?text|note_?text)($|_)", "NOTES"),
]
DATE_TYPES, LONG_TEXT_TYPES = r"(?i)(DATE|TIME)", r"(?i)(LONGTEXT|MEDIUMTEXT|NTEXT|NVARCHAR\s*\(\s*MAX\s*\)|\bTEXT\b)"


def snake(c: Column) -> Column:
    """camelCase and PascalCase to snake_case."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1_$2"), "([A-Z]+)([A-Z][a-z])", "$1_$2"))


def auto_rule(name: Column, kind: Column) -> Column:
    """Rule suggested by a column's name, else by its type, else empty."""
    n = snake(name)
    out = F.when(kind.rlike(DATE_TYPES), "DATE_OFFSET").when(kind.rlike(LONG_TEXT_TYPES), "GENERIC_NOTES").otherwise("")
    for p, rule in reversed(NAME_RULES):
        out = F.when(n.rlike(p), rule).otherwise(out)
    return out


@dataclass
class TableRoles:
    """Columns of a table by what they mean to quality control."""

    patient_col: str | None = None
    encounter_col: str | None = None
    note_cols: list[str] = field(default_factory=list)
    name_cols: list[str] = field(default_factory=list)
    date_cols: list[str] = field(default_factory=list)


def roles(rules: Sequence[tuple[str, str, str]]) -> dict[str, TableRoles]:
    """Roles per table of rows ``(table, column, rule)``; columns in lower case, the first id column counts."""
    out: dict[str, TableRoles] = {}
    for table, column, rule in rules:
        r, c, rule = out.setdefault(table, TableRoles()), column.lower(), (rule or "").upper()
        if rule in ("DATE_OFFSET", "STATIC_OFFSET") and c not in r.date_cols:
            r.date_cols.append(c)
        elif rule in ("NOTES", "GENERIC_NOTES") and c not in r.note_cols:
            r.note_cols.append(c)
        elif rule == "MASK" and "name" in c and c not in r.name_cols:
            r.name_cols.append(c)
        elif rule == "ENCOUNTER_ID":
            r.encounter_col = r.encounter_col or c
        elif rule_of(rule) == "PATIENT_ID":
            r.patient_col = r.patient_col or c
    return out


class UnsafePlan(ValueError):
    """A table can't be released as planned."""


@dataclass
class NotePlan:
    """What masking of NOTES columns needs.

    ``tables`` are master tables, the primary one first, each a map of ``table`` (rows by
    patient), ``key`` (surrogate, ``nd_patient_id`` if left out), ``mask`` and ``combine``
    (token to columns) and ``dob`` (columns).
    """

    tables: Sequence[Mapping]
    regex: Sequence[tuple[str | Sequence[str], str]] = ()
    replace: Mapping[str, str] | Sequence[Mapping[str, str]] = field(default_factory=dict)
    address: Sequence[str] = ()
    facility: Sequence[str] = ()

    def ready(self, table: str) -> list[dict]:
        """The master tables with columns in lower case; without one, without masks or with unknown columns the plan is unsafe."""
        out = []
        for m in self.tables:
            low = lambda cols: [c.lower() for c in cols]
            df = m["table"].toDF(*low(m["table"].columns))
            one = {"table": df, "key": m.get("key", "nd_patient_id").lower(), "dob": low(m.get("dob", [])), **{k: {t: low(c) for t, c in m.get(k, {}).items()} for k in ("mask", "combine")}}
            gone = sorted({one["key"], *one["dob"], *[c for k in ("mask", "combine") for cols in one[k].values() for c in cols]} - set(df.columns))
            if gone:
                raise UnsafePlan(f"table {table}: the master table of its notes lacks {', '.join(gone)}")
            out.append(one)
        if not out or not out[0]["mask"]:
            raise UnsafePlan(f"table {table} has notes but no masks of a master table")
        return out


@dataclass
class TablePlan:
    """Rules of one table: column to rule; ``tokens`` names masks (upper-case column name otherwise)."""

    table: str
    rules: Mapping[str, str]
    tokens: Mapping[str, str] = field(default_factory=dict)
    default_offset: int = DEFAULT_OFFSET

    def classify(self) -> dict[str, list[str]]:
        """Identifier columns by group: patient, encounter, referencepid, appointment, chart."""
        groups = {"ENCOUNTER_ID": "encounter", "REFERENCE_PID": "referencepid", "APPOINTMENT_ID": "appointment", "CHART_ID": "chart"}
        out: dict[str, list[str]] = {g: [] for g in ("patient", *groups.values())}
        for c, r in self.rules.items():
            r = (r or "").upper()
            if r in groups:
                out[groups[r]].append(c.lower())
            elif r not in ("PATIENT_DOB",) and rule_of(r) == "PATIENT_ID":
                out["patient"].append(c.lower())
        return out

    def check(self, columns: Sequence[str]) -> None:
        """Refuse a table without rules, with rules that don't exist, or with rules for columns it lacks."""
        if not any((r or "").strip() for r in self.rules.values()):
            raise UnsafePlan(f"table {self.table} has no rules")
        unknown = sorted(f"{r} of {c}" for c, r in self.rules.items() if (r or "").strip() and rule_of(r) is None)
        if unknown:
            raise UnsafePlan(f"table {self.table} has unknown rules: {', '.join(unknown)}")
        missing = sorted(c for c in self.rules if c.lower() not in {x.lower() for x in columns})
        if missing:
            raise UnsafePlan(f"table {self.table} lacks {', '.join(missing)}")

    def _key_ids(self, g: Mapping[str, Sequence[str]], df: DataFrame) -> list[tuple[Column, Column, str]]:
        """The row's ids as they may stand in its notes: encounters, appointments, charts, patients, references; a lone patient column stands for the row's patient."""
        out = []
        for kind in ("encounter", "appointment", "chart"):
            for c in g[kind]:
                nd = f"nd_{kind}_id_from_{c}"
                out.append((F.col(c).cast("string"), F.col(nd) if nd in df.columns else F.lit(None), f"(({kind.upper()}_ID))"))
        for c in [*g["patient"], *g["referencepid"]]:
            own = F.col(f"nd_patient_id_from_{c}")
            alone = c in g["referencepid"] or len(g["patient"]) == 1
            out.append((F.coalesce(nt.person_number(F.col(c)).cast("string"), F.trim(F.col(c).cast("string"))), F.coalesce(own, F.col("_resolved_nd_patient_id")) if alone else own, "((PATIENT_ID))"))
        return out

    def apply(self, df: DataFrame, patients: DataFrame, encounters: DataFrame | None = None, notes: NotePlan | None = None, appointments: DataFrame | None = None, charts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """(de-identified rows, rejects). Maps: patients(patientid, nd_patient_id, offset_days), encounters(encounter_id, nd_encounter_id, nd_patient_id), appointments and charts likewise.

        Excluded patients and inactive rows of the maps don't resolve. The patient of a
        row is asked of its reference (``reference_mapping`` of the patients), encounter,
        patient, appointment and chart columns in turn; rows without one are rejected as
        JSON with the reason. A reference that isn't mapped is the row's patient. Tables
        with appointment, chart or reference columns but without that map are refused, as are unknown rules. Columns keep
        their order. NOTES columns go through the whole chain of ``notes``; without it, or in a table without ids, they are refused.
        """
        df = df.toDF(*[c.lower() for c in df.columns])
        self.check(df.columns)
        g = self.classify()
        texts = [c.lower() for c, r in self.rules.items() if rule_of(r) == "NOTES"]
        masters = (notes or NotePlan([])).ready(self.table) if texts else []
        if texts and not any(g.values()):
            raise UnsafePlan(f"table {self.table} has notes but no id that tells whose they are")
        pats = rs.usable(patients)
        pats = pats.groupBy("patientid").agg(F.min("nd_patient_id").alias("nd_patient_id"), F.min("offset_days").alias("offset_days"))
        cur, src = df, g
        for c in g["patient"]:
            cur = rs.map_join(cur, pats, c, "patientid", f"_from_{c}")
        if g["referencepid"]:
            if "reference_mapping" not in patients.columns:
                raise UnsafePlan(f"table {self.table} has reference ids, but the patient map no reference_mapping")
            ref = rs.usable(patients).groupBy("reference_mapping").agg(F.min(F.struct("nd_patient_id", "offset_days")).alias("x")).select("reference_mapping", "x.*")
            for c in g["referencepid"]:
                cur = rs.map_join(cur, ref, c, "reference_mapping", f"_from_{c}")
        off = pats.groupBy(F.col("nd_patient_id").alias("_np")).agg(F.min("offset_days").alias("offset_days"))
        for kind, m in (("encounter", encounters), ("appointment", appointments), ("chart", charts)):
            if m is None:
                if kind != "encounter" and g[kind]:
                    raise UnsafePlan(f"table {self.table} has {kind} ids, but there is no {kind} map")
                continue
            m = rs.without_excluded(rs.usable(m), patients) if "excluded" in patients.columns else rs.usable(m)
            m = m.groupBy(f"{kind}_id").agg(F.min(f"nd_{kind}_id").alias(f"nd_{kind}_id"), F.min("nd_patient_id").alias("nd_patient_id"))
            m = m.join(off, F.col("nd_patient_id") == F.col("_np"), "left").drop("_np")
            for c in g[kind]:
                cur = rs.map_join(cur, m, c, f"{kind}_id", f"_from_{c}")
        cur = rs.resolve(cur, src, "nd_patient_id", "_resolved_nd_patient_id")
        cur = rs.resolve(cur, src, "offset_days", "_resolved_offset", self.default_offset)
        if any(g.values()):
            first = next(cols for k in ("patient", "encounter", "referencepid", "appointment", "chart") if (cols := g[k]))[0]
            good, bad = rs.split_unresolved(cur, "_resolved_nd_patient_id", first)
            bad = cur.where(F.col("_resolved_nd_patient_id").isNull()).select(
                F.concat(F.lit("unresolved_id:"), F.coalesce(F.col(first).cast("string"), F.lit("NULL"))).alias("reason"), F.to_json(F.struct(*df.columns)).alias("row_data"))
        else:
            good, bad = cur, cur.limit(0).select(F.lit("").alias("reason"), F.lit("").alias("row_data"))
        if texts:
            own = pats.select(F.col("nd_patient_id").alias("key"), F.col("patientid").alias("id"))
            good = nt.mask_notes(good, texts, "_resolved_nd_patient_id", "_resolved_offset", self._key_ids(g, good), own, masters, notes.regex, notes.replace, notes.address, notes.facility)
        out, kinds = [], dict(df.dtypes)
        by_name = {c.lower(): r for c, r in self.rules.items()}
        for c in df.columns:
            rule = rule_of(by_name.get(c, ""))
            if rule is None or rule == "NOTES":
                out.append(F.col(c))
                continue
            kind = {"ENCOUNTER_ID": "encounter", "APPOINTMENT_ID": "appointment", "CHART_ID": "chart"}.get(rule, "patient")
            got = f"nd_{kind}_id_from_{c}"
            resolved = F.col(got) if got in cur.columns else F.lit(None).cast("bigint")
            if rule == "REFERENCE_PID":
                resolved = F.coalesce(resolved, F.col("_resolved_nd_patient_id"))
            ctx = {"resolved": resolved, "offset": F.col("_resolved_offset"), "token": self.tokens.get(c, c.upper()), "typed": kinds[c].startswith(("timestamp", "date"))}
            out.append(RULES[rule][0](F.col(c), ctx).alias(c))
        return good.select(*out), bad
