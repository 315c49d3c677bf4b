"""Identifier settings, and configuration of personal-data tables from rules or schemas."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from . import NAME_RULES, UnsafePlan

#: What stands in for a personal-data column, by its name.
PII_TOKENS = [
    (r"(^|_)(first_?name|fname)($|_)", "((FIRST_NAME))"), (r"(^|_)(last_?name|lname)($|_)", "((LAST_NAME))"), (r"(^|_)(middle_?name|mname)($|_)", "((MIDDLE_NAME))"),
    (r"(^|_)(maiden_?name)($|_)", "((MAIDEN_NAME))"), (r"(^|_)(preferred_?name|nick_?name|display_?name)($|_)", "((NAME))"), (r"(^|_)(patient_?name|full_?name)($|_)", "((PATIENT_NAME))"),
    (r"(^|_)(ssn|social_?security|tax_?id|tin)($|_)", "((SSN))"), (r"(^|_)(phone|fax|cell|mobile|home_?phone|work_?phone|phone_?number)($|_)", "((PHONE))"),
    (r"(^|_)(email|e_?mail|email_?address)($|_)", "((EMAIL))"), (r"(^|_)(address|addr|street|address_?line)($|_)", "((ADDRESS))"),
    (r"(^|_)(city)($|_)", "((CITY))"), (r"(^|_)(state)($|_)", "((STATE))"), (r"(^|_)(county)($|_)", "((COUNTY))"),
]
_BIRTH = next(p for p, r in NAME_RULES if r == "PATIENT_DOB")
_FIRST, _LAST = PII_TOKENS[0][0], PII_TOKENS[1][0]


def snake_name(name: str) -> str:
    return re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)).lower()


def remap_single(rules: Mapping[str, str], identifiers: Sequence[str]) -> dict[str, str]:
    """With one identifier, the old names PATIENT_ID and PATIENT_DOB mean PATIENT_{X} and DOB."""
    names = {"PATIENT_ID": f"PATIENT_{identifiers[0].upper()}", "PATIENT_DOB": "DOB"} if len(identifiers) == 1 else {}
    return {c: names.get(r, r) for c, r in rules.items()}


def check_identifiers(identifiers: Sequence[str], map_columns: Sequence[str], rules: Mapping[str, Mapping[str, str]]) -> None:
    """Identifiers have no underscore and exist in the map; PATIENT_* rules name one of them."""
    bad = [c for c in identifiers if "_" in c]
    if bad:
        raise UnsafePlan(f"identifiers must not contain underscores: {bad}")
    gone = [c for c in identifiers if c not in map_columns]
    if gone:
        raise UnsafePlan(f"identifiers missing in the patient map: {gone}")
    if identifiers:
        ok = {f"PATIENT_{c.upper()}" for c in identifiers}
        wrong = [(t, c, r) for t, rs in rules.items() for c, r in rs.items() if r.startswith("PATIENT_") and r not in ok]
        if wrong:
            raise UnsafePlan(f"rules that match no identifier: {wrong}")


def id_columns(rules: Mapping[str, Mapping[str, str]]) -> dict[str, dict[str, list[str]]]:
    """Per table its patient, encounter, appointment and reference columns; tables without any are left out."""
    kinds = {"ENCOUNTER_ID": "encounter", "APPOINTMENT_ID": "appointment", "REFERENCE_PID": "reference"}
    out: dict[str, dict[str, list[str]]] = {}
    for t, rs in rules.items():
        for c, r in rs.items():
            kind = kinds.get(r) or ("patient" if r.startswith("PATIENT_") and r != "PATIENT_DOB" else None)
            if kind:
                out.setdefault(t, {}).setdefault(kind, []).append(c)
    return out


def pii_tables(rules: Mapping[str, Mapping[str, str]], schemas: Mapping[str, Sequence[str]] | None = None) -> dict:
    """Source tables of the master table: those with a patient id and masked columns, from the rules, else from names."""
    found = {}
    for t, rs in rules.items():
        pid = [c for c, r in rs.items() if r == "PATIENT_ID"]
        cols = [c for c, r in rs.items() if r in ("MASK", "PATIENT_DOB", "DOB")]
        if pid and cols:
            found[t] = {"primary_col": pid[-1], "other_required_columns": cols}
    if not found:
        for t, names in (schemas or {}).items():
            pid = next((c for c in names if re.search(NAME_RULES[0][0], snake_name(c))), None)
            cols = [c for c in names if c != pid and any(re.search(p, snake_name(c)) for p in [*[p for p, _ in PII_TOKENS], _BIRTH])]
            if pid and cols:
                found[t] = {"primary_col": pid, "other_required_columns": cols}
    return {"pii_data_table": {"primary_column_name": "nd_patient_id", "upsert_instead_of_append": True, "tables": found}} if found else {}


def pii_config(tables: Mapping) -> dict:
    """mask, dob and combine settings of a master table."""
    out: dict[str, dict] = {}
    for table in tables.values():
        for src, conf in table.get("tables", {}).items():
            pair: dict[str, str] = {}
            for c in conf.get("other_required_columns", []):
                n, key = snake_name(c), f"{src}_{c}"
                if re.search(_BIRTH, n):
                    out.setdefault("dob", {})[key] = {}
                    continue
                token = next((m for p, m in PII_TOKENS if re.search(p, n)), f"(({c.upper()}))")
                out.setdefault("mask", {})[key] = {"masking_value": token, "min_length": 2}
                for side, p in (("first", _FIRST), ("last", _LAST)):
                    if re.search(p, n):
                        pair.setdefault(side, key)
            if len(pair) == 2:
                out.setdefault("combine", {})[f"{src}_name"] = {"combine_columns": [pair["first"], pair["last"]], "masking_value": "((PATIENT_NAME))"}
    return out
