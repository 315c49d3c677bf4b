"""Column rules of structured de-identification.

Each rule is a function from a column (and what it needs) to a column, registered in
``RULES``; a table plan applies them in one projection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The notations of dates and times that are recognised, in order; where
#: a text fits several, the first counts, so the month comes first.
DATE_FORMATS = [
    "yyyy-M-d H:m:s", "yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d", "M/d/yyyy", "M-d-yyyy", "M/d/yy", "M-d-yy",
    "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s.SSSSSS", "d/M/yyyy", "d-M-yyyy", "M.d.yyyy", "yyyy/M/d",
]
#: Limits of a shifted date.
FIRST, LAST = "1000-01-01 00:00:00", "9999-12-31 23:59:59"
DEFAULT_OFFSET = 34
#: Years a two-digit year may lie ahead of today: none for births, ten elsewhere.
BIRTH_AHEAD, OTHER_AHEAD = 0, 10

_MONTHS = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:t)?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
_M, _D = "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12]\\d|3[01])"
#: Dates inside text: ISO with optional time, numeric with two- or four-digit year, named months.
DATE_IN_TEXT = (
    rf"\b\d{{4}}-{_M}-{_D}(?:\s\d{{2}}:\d{{2}}:\d{{2}}(?:\.\d{{1,9}})?)?\b|\b{_M}[/-]{_D}[/-]\d{{4}}\b|\b{_M}\.{_D}\.\d{{4}}\b|\b{_M}[/-]{_D}[/-]\d{{2}}\b"
    rf"|\b{_D}[/-]{_M}[/-]\d{{4}}\b|\b\d{{1,2}}\s(?:{_MONTHS})\s\d{{4}}\b|\b(?:{_MONTHS})[\s-]\d{{1,2}}(?:st|nd|rd|th)?[,/\s-]?\s?\d{{4}}\b|\b\d{{4}}/\d{{2}}/\d{{2}}\.\d{{2}}:\d{{2}}:\d{{2}}\b"
)
#: The same and compact digits, for whole cells.
DATE_IN_CELL = DATE_IN_TEXT + rf"|\b{_M}{_D}\d{{4}}\b|\b\d{{4}}{_M}{_D}\b|\b{_D}{_M}\d{{4}}\b"


def strip(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")


def century(ts: Column, today: Column, ahead: int) -> Column:
    """A date read from a two-digit year, a hundred years earlier if it lies too far ahead."""
    return F.when(F.year(ts) > F.year(today) + ahead, ts - F.expr("interval 100 year")).otherwise(ts)


def parse_any(c: Column, today: Column | None = None, ahead: int = OTHER_AHEAD) -> Column:
    """Timestamp without zone of a text in one of ``DATE_FORMATS``; null if none fits."""
    today = F.current_date() if today is None else today
    t = strip(c)
    tries = []
    for f in DATE_FORMATS:
        ts = F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz")
        tries.append(century(ts, today, ahead) if "yy" in f and "yyyy" not in f else ts)
    return F.coalesce(*tries)


def shift(c: Column, days: Column, today: Column | None = None, typed: bool = False) -> Column:
    """Date shifted by whole days, clamped, as ``yyyy-MM-dd HH:mm:ss``; blank or unreadable text gives null.

    ``typed`` says that the column is a date or timestamp and needs no parsing.
    """
    ts = (c.cast("timestamp_ntz") if typed else parse_any(c, today)) + F.make_dt_interval(F.coalesce(days, F.lit(0)).cast("int"))
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (FIRST, LAST))
    return F.substring(F.when(ts < low, low).when(ts > high, high).otherwise(ts).cast("string"), 1, 19)


def mapped_id(c: Column) -> Column:
    """A resolved surrogate as bigint."""
    return c.try_cast("bigint")


def mask(token: str = "<<>>") -> Column:
    """The literal mask in every row, null cells included."""
    return F.lit(f"<<{token}>>")


def birth_year(c: Column, today: Column | None = None) -> Column:
    """Year of the first date in a cell; two-digit years never lie in the future; no date gives null."""
    today = F.current_date() if today is None else today
    found = F.regexp_extract(c.cast("string"), f"(?i)({DATE_IN_CELL})", 1)
    compact = F.coalesce(*[F.try_to_timestamp(found, F.lit(f)).cast("timestamp_ntz") for f in ("MMddyyyy", "yyyyMMdd", "ddMMyyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy")])
    return F.year(F.coalesce(parse_any(F.nullif(found, F.lit("")), today, BIRTH_AHEAD), compact)).cast("int")


def zip3(c: Column) -> Column:
    """First three characters of a postal code; blank and null words give null, shorter texts stay."""
    t = strip(c)
    return F.when(F.lower(t).isin("", "nan", "none"), None).when(F.length(t) > 2, F.substring(t, 1, 3)).otherwise(t)


def shift_cell(c: Column, days: Column, typed: bool = False) -> Column:
    """A whole date shifted as by :func:`shift`; in other text the dates within it; text without a readable date gives null."""
    plain = shift(c, days, typed=typed)
    if typed:
        return plain
    from .notes import shift_dates_in_cell

    rest = F.when(plain.isNull() & c.cast("string").rlike(f"(?i){DATE_IN_CELL}"), c.cast("string"))
    return F.coalesce(plain, shift_dates_in_cell(rest, days))


def generic_note(c: Column, days: Column) -> Column:
    from .notes import generic_chain

    return generic_chain(c, days)


#: Rule name to (function of column and context, result type). The context holds
#: ``resolved`` (surrogate column), ``offset`` and ``token``.
RULES: dict[str, tuple[Callable[[Column, dict], Column], str]] = {
    **{r: (lambda c, x: mapped_id(x["resolved"]), "bigint") for r in ("PATIENT_ID", "ENCOUNTER_ID", "REFERENCE_PID", "APPOINTMENT_ID", "CHART_ID")},
    "MASK": (lambda c, x: mask(x.get("token", "<<>>")), "string"),
    "DATE_OFFSET": (lambda c, x: shift_cell(c, x["offset"], x.get("typed", False)), "string"),
    "STATIC_OFFSET": (lambda c, x: shift_cell(c, F.lit(DEFAULT_OFFSET), x.get("typed", False)), "string"),
    "DOB": (lambda c, x: birth_year(c), "int"),
    "PATIENT_DOB": (lambda c, x: birth_year(c), "int"),
    "ZIP_CODE": (lambda c, x: zip3(c), "string"),
    "GENERIC_NOTES": (lambda c, x: generic_note(c, x["offset"]), "string"),
}


def register_rule(name: str, f: Callable[[Column, dict], Column], kind: str = "string") -> None:
    """Add a rule of one's own: a function of a column and its context, and the type it gives."""
    n = name.strip().upper()
    if not n or n in RULES or n == "NOTES" or n.startswith("PATIENT_"):
        raise ValueError(f"rule {name!r} exists or means a patient id")
    RULES[n] = (f, kind)


def rule_of(name: str) -> str | None:
    """The registered rule a configured name stands for; unknown PATIENT_* names are patient ids, others nothing."""
    n = (name or "").strip().upper()
    return n if n in RULES or n == "NOTES" else "PATIENT_ID" if n.startswith("PATIENT_") else None
