"""Mixed timestamp texts to one UTC instant.

An ordered cascade of anchored patterns brings each notation to one canonical wall
time, which is parsed strictly; then the zone is applied: that in the text, else that
of the row's facility, else UTC. All of it is built-in expressions.
"""

from __future__ import annotations

import uuid
import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normal import squeeze

#: Minutes east of Greenwich of zone abbreviations, by the part of the
#: world (first part of the zone name) in which they have that meaning.
ABBREVIATIONS = {
    "America": {"EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "AST": -240, "ADT": -180, "NST": -210, "NDT": -150},
    "Pacific": {"HST": -600, "NZST": 720, "NZDT": 780},
    "Europe": {"WET": 0, "WEST": 60, "BST": 60, "IST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180},
    "Africa": {"WAT": 60, "CAT": 120, "SAST": 120, "EAT": 180},
    "Asia": {"IST": 330, "PKT": 300, "CST": 480, "HKT": 480, "JST": 540, "KST": 540},
    "Australia": {"AEST": 600, "AEDT": 660, "ACST": 570, "ACDT": 630, "AWST": 480, "EST": 600, "EDT": 660, "CST": 570, "CDT": 630, "WST": 480},
}
#: Zone words that mean UTC everywhere.
UTC_WORDS = ["Z", "UTC", "GMT", "UT"]

_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?"
_ZONE = r"\s*(Z|[+-]\d{2}:?\d{2}|[A-Za-z]{2,5})?"

#: The cascade: pattern and the template that brings its groups into the order
#: year | month | day | hour | minute | second | fraction | half of day | zone. Months and
#: days marked ``~`` are two numbers whose order is the facility's. The first pattern
#: that matches decides.
CASCADE = [
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})(?:[T\s]\s*{_TIME}{_ZONE}(?:\[[A-Za-z_+\-/0-9]+\])?)?$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}})(?:\s+{_TIME}{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:T?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d{{1,12}}))?{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    (rf"^(\d{{1,2}})([/.\-])(\d{{1,2}})\2(\d{{4}})(?:,?\s+{_TIME}\s*([ap]\.?m\.?)?{_ZONE})?$", "$4|~$1|~$3|$5|$6|$7|$8|$9|$10"),
    (rf"^(\d{{1,2}})([/.\-])(\d{{1,2}})\2(\d{{2}})(?:,?\s+{_TIME}\s*([ap]\.?m\.?)?{_ZONE})?$", "20$4|~$1|~$3|$5|$6|$7|$8|$9|$10"),
    (rf"^(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?(\d{{1,2}})[\s\-]({_MONTH})\.?[\s\-,]\s*(\d{{4}})(?:,?\s+(?:at\s+)?{_TIME}\s*([ap]\.?m\.?)?{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    (rf"^(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?({_MONTH})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{_TIME}\s*([ap]\.?m\.?)?{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
]
_EPOCH = r"^(?:/Date\((-?\d{1,14})(?:[+-]\d{4})?\)/|(\d{13})|(\d{10}))$"


def with_utc_text(df: DataFrame, text: str, tz_name: Column, date_order: Column, out: str = "utc_ts", ambiguous: str = "first", nonexistent: str = "forward") -> DataFrame:
    """``df`` with ``out``: YYYY-MM-DDTHH:MM:SS.ffffffZ of a time text, null where it names no real date.

    ``tz_name`` (IANA) is the zone of texts without one, null or unknown names mean UTC;
    ``date_order`` is MDY or DMY for numeric days and months, null means DMY. Two-digit
    years are 20xx, dates alone midnight, digits beyond microseconds are cut off. A wall
    time occurring twice is the ``first`` (or ``last``) of the two or ``null``; one that is
    skipped moves ``forward`` by the skipped length or gives ``null``. An abbreviation is
    read in the facility's part of the world; one that has no meaning there gives null.
    """
    if ambiguous not in ("first", "last", "null") or nonexistent not in ("forward", "null"):
        raise ValueError("unknown policy")
    t = squeeze(F.col(text))
    canon = F.lit(None).cast("string")
    for pattern, template in reversed(CASCADE):
        canon = F.when(F.col("__veil_t").rlike("(?i)" + pattern), F.regexp_replace("__veil_t", "(?i)" + pattern, template)).otherwise(canon)
    known = sorted(zoneinfo.available_timezones() & set(df.sparkSession._jvm.java.time.ZoneId.getAvailableZoneIds()))
    step = df.withColumns({"__veil_t": t, "__veil_tz": F.when(tz_name.isin(known), tz_name).otherwise("UTC"), "__veil_mdy": F.upper(F.trim(date_order)).eqNullSafe("MDY")})
    step = step.withColumn("__veil_p", F.split(canon, r"\|", -1))
    year, mon, day, hh, mi, sec, frac, half, zone = (F.col("__veil_p")[i] for i in range(9))
    swap = mon.startswith("~") & ~F.col("__veil_mdy")
    first, second = F.when(swap, day).otherwise(mon), F.when(swap, mon).otherwise(day)
    named = F.array_position(F.lit(_MONTHS), F.lower(F.substring(first, 1, 3)))
    month = F.when(named > 0, named.cast("string")).otherwise(F.ltrim(first, F.lit("~")))
    hour = hh.try_cast("int")
    noon = F.when(F.lower(half).startswith("p"), 12).otherwise(0)
    hour = F.when(hh == "", 0).when(half == "", hour).when(hour.between(1, 12), hour % 12 + noon)
    zero = lambda c: F.when(c == "", "00").otherwise(c)
    wall = F.concat(year, F.lit("-"), month, F.lit("-"), F.ltrim(second, F.lit("~")), F.lit(" "), hour.cast("string"), F.lit(":"), zero(mi), F.lit(":"), zero(sec), F.lit("."), F.substring(F.rpad(frac, 6, "0"), 1, 6))
    step = step.withColumns({"__veil_wall": F.when(year != "0000", wall.try_cast("timestamp_ntz")), "__veil_z": F.upper(zone)})

    wall, z, tz = F.col("__veil_wall"), F.col("__veil_z"), F.col("__veil_tz")
    local = F.convert_timezone(tz, F.lit("UTC"), wall)
    if ambiguous != "first" or nonexistent != "forward":
        step = step.withColumn("__veil_local", local)
        local = F.col("__veil_local")
        exists = F.convert_timezone(F.lit("UTC"), tz, local) == wall
        # Clocks go back by half an hour, an hour or two, depending on the zone.
        shifts = [local + F.expr(f"interval {m} minutes") for m in (30, 60, 120)]
        later = F.coalesce(*[F.when(F.convert_timezone(F.lit("UTC"), tz, x) == wall, x) for x in shifts])
        twice = exists & later.isNotNull()
        if nonexistent == "null":
            local = F.when(exists, local)
        if ambiguous != "first":
            local = F.when(twice, later if ambiguous == "last" else None).otherwise(local)
    offset = z.rlike(r"^[+-](?:0\d|1[0-7]):?[0-5]\d$")
    signed = F.when(offset, F.concat(F.substring(z, 1, 3), F.lit(":"), F.right(z, F.lit(2)))).otherwise("UTC")
    table = F.create_map(*[F.lit(x) for r, m in ABBREVIATIONS.items() for a, v in m.items() for x in (f"{r}/{a}", v)])
    minutes = F.when(z.isin(UTC_WORDS), 0).otherwise(F.try_element_at(table, F.concat(F.substring_index(tz, "/", 1), F.lit("/"), z)))
    instant = (
        F.when(z == "", local)
        .when(offset, F.convert_timezone(signed, F.lit("UTC"), wall))
        .otherwise(wall - F.make_dt_interval(F.lit(0), F.lit(0), minutes))
    )
    ms = F.coalesce(*[F.nullif(F.regexp_extract("__veil_t", _EPOCH, k), F.lit("")).try_cast("bigint") * f for k, f in ((1, 1), (2, 1), (3, 1000))])
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (ms.cast("decimal(20,0)") / 1000).cast("decimal(18,6)"))
    step = step.withColumn("__veil_i", F.when(F.col("__veil_t").rlike(_EPOCH), epoch).otherwise(instant).cast("string"))
    i = F.col("__veil_i")
    done = F.concat(F.substring(i, 1, 10), F.lit("T"), F.substring(i, 12, 8), F.lit("."), F.rpad(F.regexp_extract(i, r"\.(\d+)$", 1), 6, "0"), F.lit("Z"))
    return step.withColumn(out, done).select(*df.columns, out)


def normalise_times(
    df: DataFrame, id_col: str, text_col: str, place_col: str, places: DataFrame, place_key: str = "facilityid", tz: str = "tz_name", order: str = "date_order"
) -> DataFrame:
    """``(row_id, utc_ts)`` of every readable value, repeated rows once.

    A place listed repeatedly counts with its smallest zone; rows of unknown places read
    as UTC and DMY.
    """
    at = places.where(F.col(place_key).isNotNull()).groupBy(F.col(place_key).alias("_p")).agg(F.min(F.struct(F.col(tz).alias("tz"), F.col(order).alias("ord"))).alias("_at"))
    rows = df.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("_v"), F.col(place_col).alias("_f"))
    rows = rows.where(F.col("_v").rlike(r"\d")).join(at, F.col("_f") == F.col("_p"), "left")
    rows = with_utc_text(rows.select("row_id", "_v", "_at"), "_v", F.col("_at.tz"), F.col("_at.ord"))
    # The metrics tell how many values were readable; they also keep the optimizer from
    # copying the whole cascade into a pushed-down filter.
    rows = rows.select("row_id", "utc_ts").observe(f"times-{uuid.uuid4().hex[:8]}", F.count("*").alias("n_values"), F.count("utc_ts").alias("n_readable"))
    return rows.where("utc_ts is not null").distinct()
