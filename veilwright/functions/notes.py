"""Masking of free text with built-in expressions.

Patterns come from literals or from columns, so text is rewritten in the JVM; only the
arithmetic on dates inside text runs in Python, on Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import lru_cache
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rules import DATE_FORMATS, DATE_IN_CELL, DATE_IN_TEXT

#: What generic masking looks for and what it writes, in the order of application.
IP = r"\b((25[0-5]|2[0-4][0-9]|[0-1]?[0-9][0-9]?)\.){3}(25[0-5]|2[0-4][0-9]|[0-1]?[0-9][0-9]?)\b"
URL = r"""\b(?:https?:/+[\w-]+\.[^\s<>"']+|w{3,4}\.?\S+)"""
PHONE = r"(?:\+?1[\s.-]?)?(?:\(\d{3}\)[\s.-]|\d{3}[\s.-])\d{3}[\s.-]\d{4}\b"
LICENCES = [
    r"(?i)\b(?:DL|DL#|DL No\.?|License No\.?|Driver'?s License)\s*[:#]?\s*[A-Z]?\d{5,13}\b",
    r"\b[A-Z]\d{7}\b",
    r"\b[A-Z]\d{11}\b",
    r"\b[A-Z]\d{12}\b",
    r"\b[A-Z]{1,2}\d{6,12}[A-Z]?\b",
]
GENERIC: list[tuple[str, list[str]]] = [("((IPADDRESS))", [IP]), ("((URL))", [URL]), ("((PHONE_NUMBER))", [PHONE]), ("((DRIVERSLICENSE))", LICENCES)]


def literal(text: str) -> str:
    """A replacement text without special meaning of dollar and backslash."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def quoted(c: Column) -> Column:
    """A column's text as a pattern that matches exactly it."""
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def normalise(c: Column) -> Column:
    """Null to empty, white space and carets to one space, trimmed."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")
    return F.trim(F.replace(t, F.lit("^"), F.lit(" ")))


def squeeze_spaces(c: Column) -> Column:
    """White space to one space, trimmed; null stays null."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def person_number(c: Column) -> Column:
    """'9097.0' and 9097 to 9097; not a number gives null."""
    return c.cast("string").try_cast("double").try_cast("bigint")


def replace_number(text: Column, number: Column, by: Column | str) -> Column:
    """An id that isn't part of a longer number, replaced by the surrogate or, where null, by a token."""
    n = F.regexp_replace(number.cast("string"), r"\.0+$", "")
    repl = by if isinstance(by, Column) else F.lit(by)
    pattern = F.concat(F.lit(r"(?<!\d)"), quoted(n), F.lit(r"(?!\d)"))
    return F.when(n.isNull() | (n == ""), text).otherwise(F.regexp_replace(text, pattern, repl.cast("string")))


def key_ids(text: Column, ids: Sequence[tuple[Column, Column, str]]) -> Column:
    """Ids replaced in the order given: (id, surrogate, token when there is no surrogate)."""
    for number, nd, token in ids:
        text = replace_number(text, number, F.coalesce(nd.cast("string"), F.lit(token)))
    return text


def replace_pattern(text: Column, pattern: Column, by: str) -> Column:
    """A per-row pattern replaced by a literal; a null or empty pattern changes nothing."""
    return F.when(pattern.isNull() | (pattern == ""), text).otherwise(F.regexp_replace(text, pattern, F.lit(literal(by))))


def any_word(values: Column, min_length: int = 2) -> Column:
    """Pattern of the whole words of an array, any case, longest first, or null; only texts longer than ``min_length``."""
    vals = F.array_distinct(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.isNotNull() & (F.length(v) > min_length)))
    order = F.array_sort(vals, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.when(F.size(order) > 0, F.concat(F.lit(r"(?iU)\b(?:"), F.array_join(F.transform(order, quoted), "|"), F.lit(r")\b")))


def combined_words(cols: Sequence[Column]) -> Column:
    """Pattern of all orders of one or more of the columns' values joined by blanks. At most five columns."""
    if len(cols) > 5:
        raise ValueError("at most five columns can be combined")
    forms = []
    for r in range(1, len(cols) + 1):
        for p in permutations(cols, r):
            ok = F.lit(True)
            for c in p:
                ok = ok & c.isNotNull() & (F.trim(c) != "")
            forms.append(F.when(ok, F.concat_ws(" ", *[F.lower(F.trim(c)) for c in p])))
    return any_word(F.array(*forms))


def patterns(text: Column, rules: Sequence[tuple[str | Sequence[str], str]]) -> Column:
    """Configured patterns replaced one after another; those that aren't valid are skipped."""
    for pats, by in rules:
        for p in [pats] if isinstance(pats, str) else pats:
            try:
                re.compile(p)
            except re.error:
                continue
            text = F.regexp_replace(text, p.lstrip(), literal(by))
    return text


def replace_values(text: Column, values: Mapping[str, str] | Sequence[Mapping[str, str]]) -> Column:
    """Literal words replaced, any case, longest first per replacement; malformed entries are skipped."""
    pairs = list(values.items()) if isinstance(values, Mapping) else [(v["value"], v["replacement"]) for v in values if isinstance(v, Mapping) and v.get("value") and "replacement" in v]
    by: dict[str, list[str]] = {}
    for v, r in pairs:
        if isinstance(v, str) and v:
            by.setdefault(r, []).append(v)
    for r, words in by.items():
        body = "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))
        text = F.regexp_replace(text, rf"(?i)\b(?:{body})\b", literal(r))
    return text


def mask_ip(c: Column) -> Column:
    return F.regexp_replace(c, IP, "((IPADDRESS))")


def mask_url(c: Column) -> Column:
    return F.regexp_replace(c, URL, "((URL))")


def mask_phone(c: Column) -> Column:
    return F.regexp_replace(c, PHONE, "((PHONE_NUMBER))")


def mask_licence(c: Column) -> Column:
    for p in LICENCES:
        c = F.regexp_replace(c, p, "((DRIVERSLICENSE))")
    return c


def generic_chain(c: Column, offset: Column | None = None, address: Sequence[str] = (), facility: Sequence[str] = ()) -> Column:
    """Address, URL, phone, dates (with an offset), licence, then configured address and facility patterns; null stays null."""
    t = mask_phone(mask_url(mask_ip(squeeze_spaces(c))))
    if offset is not None:
        t = shift_dates_in_text(t, offset)
    t = mask_licence(t)
    for p in address:
        t = F.regexp_replace(t, p, "((Address))")
    for p in facility:
        t = F.regexp_replace(t, p, "((FacilityLocation))")
    return t


_PY_FORMATS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d", "%m/%d/%Y", "%m-%d-%Y", "%m/%d/%y", "%m-%d-%y", "%d/%m/%Y", "%d-%m-%Y", "%m.%d.%Y", "%Y/%m/%d", "%Y/%m/%d.%H:%M:%S", "%d %b %Y", "%d %B %Y", "%b %d %Y", "%B %d %Y", "%b-%d-%Y", "%m%d%Y", "%d%m%Y", "%Y%m%d"]
_DATE_RE, _CELL_RE = re.compile(DATE_IN_TEXT, re.I), re.compile(DATE_IN_CELL, re.I)
assert len(DATE_FORMATS) == 13


_SHAPES = {"%Y": "0000", "%m": "00?", "%d": "00?", "%y": "00", "%H": "00?", "%M": "00?", "%S": "00?", "%f": "0{1,6}", "%b": "aaa", "%B": "a+"}
_SHAPE_OF = {f: re.compile(re.sub("%.", lambda m: _SHAPES[m[0]], re.escape(f).replace("\\%", "%"))) for f in _PY_FORMATS}
_TO_SHAPE = str.maketrans(dict.fromkeys("0123456789", "0") | dict.fromkeys("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "a"))


@lru_cache(maxsize=10_000)
def _formats_of(shape: str) -> list[str]:
    """The formats that texts of a shape (digits as 0, letters as a) can have, in their order."""
    return [f for f, p in _SHAPE_OF.items() if p.fullmatch(shape)]


@lru_cache(maxsize=200_000)
def _read_date(token: str, year_now: int) -> datetime | None:
    plain = re.sub(r"(?<=\d)(?:st|nd|rd|th)\b|[,]", "", re.sub(r"(?i)\bsept\b", "Sep", token)).replace("  ", " ").strip()
    for f in _formats_of(plain.translate(_TO_SHAPE)):
        try:
            d = datetime.strptime(plain, f)
        except ValueError:
            continue
        if "%y" in f and d.year > year_now + 10:
            d = d.replace(year=d.year - 100)
        return d
    return None


def _shift_match(m: re.Match, days: int, year_now: int) -> str | None:
    d = _read_date(m[0], year_now)
    if d is None:
        return None
    try:
        d = d + timedelta(days=days)
    except OverflowError:
        d = datetime.max
    return f"{d:%Y-%m-%d %H:%M:%S}" if re.search(r"\d{2}:\d{2}:\d{2}", m[0]) else f"{d:%Y-%m-%d}"


def _shift_text(text: str, days: int, year_now: int) -> str:
    return _DATE_RE.sub(lambda m: m[0] if (d := _shift_match(m, days, year_now)) is None else f" {d} ", text)


def _shift_cell(text: str, days: int, year_now: int) -> str | None:
    """The text with its dates shifted; null if none can be read."""
    n = 0

    def one(m: re.Match) -> str:
        nonlocal n
        d = _shift_match(m, days, year_now)
        n += d is not None
        return m[0] if d is None else d

    out = _CELL_RE.sub(one, text)
    return out if n else None


def _each(text: pd.Series, days: pd.Series, f) -> pd.Series:
    now = datetime.now().year
    return pd.Series([t if t is None or not any(c.isdigit() for c in t) else f(t, 0 if d is None or d != d else int(d), now) for t, d in zip(text, days, strict=True)], dtype="object")


@F.pandas_udf(T.StringType())
def _shift_udf(text: pd.Series, days: pd.Series) -> pd.Series:
    return _each(text, days, _shift_text)


@F.pandas_udf(T.StringType())
def _shift_cell_udf(text: pd.Series, days: pd.Series) -> pd.Series:
    return _each(text, days, _shift_cell)


def shift_dates_in_text(text: Column, offset: Column) -> Column:
    """Each date in a text shifted by the row's days and set off by blanks, the time of day kept; unreadable ones stay."""
    return _shift_udf(text, F.coalesce(offset, F.lit(0)).cast("int"))


def shift_dates_in_cell(text: Column, offset: Column) -> Column:
    """Each date in a cell shifted where it stands; null if the cell holds none that can be read."""
    return _shift_cell_udf(text, F.coalesce(offset, F.lit(0)).cast("int"))


def birth_dates_to_year(text: Column, dob: Column) -> Column:
    """The patient's date of birth, in the usual numeric notations, becomes its year."""
    forms = ["yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "MM-dd-yyyy", "M-d-yyyy", "MM/dd/yy", "M/d/yy", "MM.dd.yyyy", "yyyy/MM/dd"]
    body = F.array_join(F.array_distinct(F.array(*[quoted(F.date_format(dob, f)) for f in forms])), "|")
    pattern = F.concat(F.lit(r"(?<!\d)(?:"), body, F.lit(r")(?!\d)"))
    return F.when(dob.isNull(), text).otherwise(F.regexp_replace(text, pattern, F.year(dob).cast("string")))


def patient_patterns(pii: DataFrame, key: str, groups: Mapping[str, Sequence[str]], combine: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per patient with a pattern column ``p0..`` per mask, built once however many notes follow.

    ``groups`` maps a mask to the columns whose values it hides; a patient may have
    several rows. ``combine`` maps masks to columns whose values also occur joined.
    """
    aggs = [any_word(F.flatten(F.collect_set(F.array(*[F.col(c).cast("string") for c in cols])))).alias(f"p{i}") for i, cols in enumerate(groups.values())]
    out = pii.where(F.col(key).isNotNull())
    for j, cols in enumerate((combine or {}).values()):
        out = out.withColumn(f"c{j}", combined_words([F.col(c) for c in cols]))
        aggs.append(F.array_join(F.collect_set(f"c{j}"), "|").alias(f"q{j}"))
    return out.groupBy(key).agg(*aggs)


def apply_patient_patterns(notes: DataFrame, text: str, key: str, pats: DataFrame, masks: Sequence[str], combine_masks: Sequence[str] = ()) -> DataFrame:
    """Notes with every value of their patient masked; notes without patient stay."""
    j = notes.join(pats.withColumnRenamed(key, "_pk"), F.col(key) == F.col("_pk"), "left")
    t = F.col(text)
    for i, m in enumerate(masks):
        t = replace_pattern(t, F.col(f"p{i}"), m)
    for i, m in enumerate(combine_masks):
        t = replace_pattern(t, F.col(f"q{i}"), m)
    return j.withColumn(text, t).select(*notes.columns)


def id_pattern(ids: Column) -> Column:
    """Pattern of the numbers of an array where they aren't part of longer ones, or null."""
    vals = F.array_distinct(F.filter(F.transform(ids, lambda v: F.regexp_replace(F.trim(v.cast("string")), r"\.0+$", "")), lambda v: v.isNotNull() & (v != "")))
    return F.when(F.size(vals) > 0, F.concat(F.lit(r"(?<!\d)(?:"), F.array_join(F.transform(vals, quoted), "|"), F.lit(r")(?!\d)")))


def mask_notes(rows: DataFrame, cols: Sequence[str], patient: str, offset: str, ids: Sequence[tuple[Column, Column, str]], own_ids: DataFrame, tables: Sequence[Mapping], regex: Sequence = (), replace: Mapping[str, str] | Sequence[Mapping[str, str]] = (), address: Sequence[str] = (), facility: Sequence[str] = ()) -> DataFrame:
    """The whole chain over note columns, in its order: normalising, ids, XML tags, the patient's values, generic masks.

    ``ids`` are the row's own ids as for :func:`key_ids`; ``own_ids(key, id)`` holds every
    id of a patient, so that those that only the text names are replaced as well.
    ``tables`` are master tables, the primary one first, each as ``table``, ``key``,
    ``mask``, ``dob`` and ``combine``; the patterns of ``regex`` and words of ``replace``
    come after the primary one. Each step is a projection of its own, as a step reads
    the text more than once.
    """
    from ..operators.documents import mask_xml_udf

    names, cur = rows.columns, rows
    step = lambda df, f: df.withColumns({c: f(F.col(c)) for c in cols})
    cur = step(cur, lambda t: normalise(t.cast("string")))
    for one in ids:
        cur = step(cur, lambda t, one=one: key_ids(t, [one]))
    own = own_ids.where(F.col("key").isNotNull()).groupBy(F.col("key").alias("_ik")).agg(id_pattern(F.collect_set("id")).alias("_ip"))
    cur = cur.join(own, F.col(patient) == F.col("_ik"), "left")
    cur = step(cur, lambda t: F.when(F.col("_ip").isNull(), t).otherwise(F.regexp_replace(t, F.col("_ip"), F.col(patient).cast("string"))))
    cur = step(cur.select(*names), mask_xml_udf)
    for i, m in enumerate(tables):
        mask, dob, combine = m.get("mask", {}), m.get("dob", []), m.get("combine", {})
        pats = patient_patterns(m["table"], m["key"], mask, combine).withColumnRenamed(m["key"], "_pk")
        cur = cur.join(pats, F.col(patient) == F.col("_pk"), "left")
        for k, token in enumerate(mask):
            cur = step(cur, lambda t, k=k, token=token: replace_pattern(t, F.col(f"p{k}"), token))
        if dob:
            days = m["table"].where(F.col(m["key"]).isNotNull()).select(F.col(m["key"]).alias("_dk"), F.explode(F.array(*[F.col(c).try_cast("date") for c in dob])).alias("_d"))
            cur = cur.join(days.groupBy("_dk").agg(F.collect_set("_d").alias("_days")), F.col(patient) == F.col("_dk"), "left")
            cur = step(cur, lambda t: F.when(F.col("_days").isNull(), t).otherwise(F.aggregate("_days", t, birth_dates_to_year)))
        for k, token in enumerate(combine):
            cur = step(cur, lambda t, k=k, token=token: replace_pattern(t, F.col(f"q{k}"), token))
        cur = cur.select(*names)
        if i == 0:
            cur = step(cur, lambda t: replace_values(patterns(t, regex), replace or {}))
    return step(cur, lambda t: generic_chain(t, F.col(offset), address, facility))
