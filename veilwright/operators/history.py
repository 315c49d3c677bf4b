"""History of changing entity attributes from snapshots (gaps and islands)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normal import content_hash

OPEN_END = "9999-12-31"


def attribute_history(
    snaps: DataFrame, entity: str, date_col: str, attrs: Sequence[str], loaded: str | None = None
) -> DataFrame:
    """One row per version: entity, attributes, ``valid_from``, ``valid_to`` (dates), ``n_snapshots``.

    For each entity and date the row loaded last counts; rows loaded at the same time are
    ordered by their attributes. A version starts at the first snapshot showing it and ends
    at the next snapshot of the table that shows another state or lacks the entity; without
    such a snapshot ``valid_to`` is null. An absence starts a new version. Nulls in
    attributes are values; rows without entity or date are left out. An entity has at
    most one row per snapshot date when it reaches the window, however often it was loaded.
    """
    rows = snaps.where(F.col(entity).isNotNull() & F.col(date_col).isNotNull()).select(
        F.col(entity).alias("_e"), F.col(date_col).alias("_d"), F.struct(*attrs).alias("_a"), (F.col(loaded) if loaded else F.lit(0)).alias("_l")
    )
    # Dates are few (one per calendar day at most), so one task can number them.
    day = Window.orderBy("_d")
    dates = rows.select("_d").distinct().select("_d", F.row_number().over(day).alias("_n"), F.lead("_d").over(day).alias("_next"))
    latest = rows.groupBy("_e", "_d").agg(F.max_by("_a", F.struct("_l", "_a")).alias("_a"))
    latest = latest.select("_e", "_d", "_a.*").withColumn("_h", content_hash(attrs)).join(dates, "_d")
    w = Window.partitionBy("_e").orderBy("_d")
    starts = F.coalesce((F.col("_n") != F.lag("_n").over(w) + 1) | (F.col("_h") != F.lag("_h").over(w)), F.lit(True))
    island = latest.withColumn("_s", starts.cast("int")).withColumn("_i", F.sum("_s").over(w))
    return (
        island.groupBy("_e", "_i")
        .agg(F.min("_d").alias("valid_from"), F.max_by("_next", "_d").alias("valid_to"), F.count("*").alias("n_snapshots"), *[F.first(a).alias(a) for a in attrs])
        .select(F.col("_e").alias(entity), *attrs, "valid_from", "valid_to", "n_snapshots")
    )
