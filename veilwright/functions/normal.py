"""Column expressions that bring dirty cells to one canonical form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The spellings of a set and of a cleared flag.
TRUE_WORDS = ["y", "yes", "true", "1"]
FALSE_WORDS = ["n", "no", "false", "0"]


def squeeze(c: Column) -> Column:
    """Text without white space (any Unicode kind) at its ends."""
    return F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")


def flag(c: Column) -> Column:
    """'Y' or 'N' for the known spellings, other text lower-cased, null for null."""
    t = F.lower(squeeze(c))
    return F.when(t.isin(TRUE_WORDS), "Y").when(t.isin(FALSE_WORDS), "N").otherwise(t)


def is_active(c: Column) -> Column:
    """An active flag: y, yes, 1, true in any spelling, or null."""
    return c.isNull() | F.lower(squeeze(c)).isin(TRUE_WORDS)


def id_text(c: Column) -> Column:
    """Canonical text of an id: '007', ' 7 ' and '7.0' all give '7'.

    Blank gives null; text that isn't a whole number stays as it is, trimmed.
    """
    t = squeeze(c)
    digits = F.regexp_extract(t, r"^([+-]?)0*(\d+?)(?:\.0*)?$", 2)
    sign = F.when(t.startswith("-") & (digits != "0"), "-").otherwise("")
    return F.when(t == "", None).when(digits != "", F.concat(sign, digits)).otherwise(t)


def id_long(c: Column) -> Column:
    """The id as bigint, null where ``id_text`` isn't a whole number of that range."""
    return id_text(c).try_cast("bigint")


def content_hash(cols: Iterable[str]) -> Column:
    """64-bit hash of the named columns in which nulls count.

    ``xxhash64`` skips nulls, so (null, 'a') and ('a', null) would be equal; a text
    of null marks is hashed along.
    """
    cols = list(cols)
    marks = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in cols]) if cols else F.lit("")
    return F.xxhash64(marks, *[F.col(f"`{c}`") for c in cols])
