"""Joins of data with mapping tables and the resolution of identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normal import is_active


def key_pair(left: DataFrame, l: str, right: DataFrame, r: str) -> tuple[Column, Column]:
    """Both keys in one type: text if either is text, else bigint (null where it doesn't fit)."""
    text = "string" in (dict(left.dtypes)[l], dict(right.dtypes)[r])
    return (left[l].cast("string"), right[r].cast("string")) if text else (left[l].try_cast("bigint"), right[r].try_cast("bigint"))


def map_join(left: DataFrame, right: DataFrame, l: str, r: str, suffix: str, how: str = "left") -> DataFrame:
    """Join by harmonised keys; the right columns but its key get the suffix.

    The optimizer broadcasts the right side when its size allows.
    """
    a, b = key_pair(left, l, right, r)
    ren = right.select(b.alias("_rk"), *[F.col(c).alias(f"{c}{suffix}") for c in right.columns if c != r])
    return left.withColumn("_lk", a).join(ren, F.col("_lk") == F.col("_rk"), how).drop("_lk", "_rk")


def usable(df: DataFrame) -> DataFrame:
    """Active and not excluded rows, as far as the columns exist."""
    cols = {c.lower() for c in df.columns}
    if "nd_activeflag" in cols:
        df = df.where(is_active(F.col("nd_activeflag")))
    if "excluded" in cols:
        df = df.where(~F.coalesce(F.col("excluded").cast("boolean"), F.lit(False)))
    return df


def without_excluded(df: DataFrame, patients: DataFrame, key: str = "nd_patient_id") -> DataFrame:
    """Rows whose patient isn't excluded; rows without patient stay."""
    bad = patients.where(F.coalesce(F.col("excluded").cast("boolean"), F.lit(False))).select(F.col(key).alias("_x")).distinct()
    return df.join(bad, F.col(key) == F.col("_x"), "left_anti")


def reference_chain(df: DataFrame, start: str, hops: Sequence[tuple[DataFrame, str, str]], out: str) -> DataFrame:
    """Follow ``start`` over hops ``(table, key, next)``; of several next keys the least counts, so rows never multiply."""
    cur = df.withColumn("_h", F.col(start))
    for table, key, nxt in hops:
        one = table.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(nxt).alias("_n"))
        a, b = key_pair(cur, "_h", one, "_k")
        cur = cur.withColumn("_a", a).join(one.select(b.alias("_k"), "_n"), F.col("_a") == F.col("_k"), "left").drop("_a", "_k", "_h").withColumnRenamed("_n", "_h")
    return cur.withColumnRenamed("_h", out)


#: Order in which identifiers are asked for a row's patient and offset.
PRIORITY = ["referencepid", "encounter", "patient", "appointment", "chart"]


def resolve(df: DataFrame, sources: dict[str, Sequence[str]], columns: str, out: str, default: object = None) -> DataFrame:
    """First non-null of the present columns ``{columns}_from_{source}``, by priority, then the default."""
    have = [f"{columns}_from_{s}" for p in PRIORITY for s in sources.get(p, [])]
    have = [F.col(c) for c in have if c in df.columns]
    if default is not None:
        have.append(F.lit(default))
    return df.withColumn(out, F.coalesce(*have) if have else F.lit(None))


def split_unresolved(df: DataFrame, resolved: str, original: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a patient, rejects as ``reason`` and JSON of the row)."""
    good = df.where(F.col(resolved).isNotNull())
    bad = df.where(F.col(resolved).isNull())
    reason = F.concat(F.lit("unresolved_id:"), F.coalesce(F.col(original).cast("string"), F.lit("NULL")))
    return good, bad.select(reason.alias("reason"), F.to_json(F.struct(*[c for c in df.columns if c != resolved])).alias("row_data"))


def conservation(source: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Counts in, out and rejected, and whether they agree."""
    parts = [df.select(F.lit(k).alias("side")) for k, df in (("n_in", source), ("n_out", kept), ("n_rejected", rejected))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    n = u.agg(*[F.count_if(F.col("side") == k).alias(k) for k in ("n_in", "n_out", "n_rejected")])
    return n.withColumn("balanced", F.col("n_in") == F.col("n_out") + F.col("n_rejected"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order`` (nulls first), ties by the other columns; one aggregation with map-side combine, so no key is sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)).alias("_r")
    return df.groupBy(*keys).agg(first).select(*[c if c in keys else F.col(f"_r.{c}") for c in df.columns])
