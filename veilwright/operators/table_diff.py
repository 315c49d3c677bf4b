"""Differences between two copies of data, field by field.

Both copies are reduced to one row per key, cogrouped by hash bucket as Arrow tables,
aligned by sorted search and compared with vectorised null-aware masks. Differing cells
come out masked: their shape shows, their content doesn't.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that one bucket should hold on either side.
BUCKET_ROWS = 50_000


def current_rows(df: DataFrame, key: str, fields: dict[str, Column], version: str | None) -> DataFrame:
    """One row per key: that of the latest version; ties go to the largest field values.

    Fields become text by the given expressions, so equal values compare equal however
    they were written. Copies combine before the shuffle. Rows without key are left out.
    Keys that are numbers become bigint, others text.
    """
    names = list(fields)
    whole = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint" if whole else "string").alias("k"), (F.col(version) if version else F.lit(0)).alias("v"), F.struct(*[fields[n].cast("string").alias(n) for n in names]).alias("a")
    )
    return rows.groupBy("k").agg(F.max_by("a", F.struct("v", "a")).alias("a")).select("k", "a.*")


def masked(cells: pa.Array) -> pa.Array:
    """Cells with every digit as 9 and every letter as x; separators, length and nulls stay."""
    return pc.replace_substring_regex(pc.replace_substring_regex(cells, r"\pL", "x"), r"\pN", "9")


def _compare(names: Sequence[str], cells: str, kind: str):
    arrow = pa.int64() if kind == "bigint" else pa.string()
    show = {"none": lambda a: pa.nulls(len(a), pa.string()), "masked": masked, "raw": lambda a: a}[cells]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        dtype = "int64" if kind == "bigint" else object
        lk, rk = (t.column("k").to_numpy(zero_copy_only=False).astype(dtype) if t.num_rows else np.empty(0, dtype) for t in (left, right))
        lo, ro = np.argsort(lk, kind="stable"), np.argsort(rk, kind="stable")
        ls, rs = lk[lo], rk[ro]
        at = np.searchsorted(rs, ls)
        hit = np.zeros(len(ls), bool)
        ok = at < len(rs)
        hit[ok] = rs[at[ok]] == ls[ok]
        back = np.ones(len(rs), bool)
        back[at[hit]] = False
        out = {"key": [], "kind": [], "field_name": [], "left_value": [], "right_value": []}

        def add(keys, kind, field, a=None, b=None):
            n = len(keys)
            out["key"].append(pa.array(keys, arrow))
            out["kind"].append(pa.array([kind] * n, pa.string()))
            out["field_name"].append(pa.array([field] * n, pa.string()))
            out["left_value"].append(a if a is not None else pa.nulls(n, pa.string()))
            out["right_value"].append(b if b is not None else pa.nulls(n, pa.string()))

        add(ls[~hit], "missing_right", "*")
        add(rs[back], "missing_left", "*")
        li, ri = pa.array(lo[hit]), pa.array(ro[at[hit]])
        keys = ls[hit]
        for n in names:
            a, b = (pc.take(t.column(n).combine_chunks(), i).cast(pa.string()) for t, i in ((left, li), (right, ri)))
            same = pc.fill_null(pc.equal(a, b), False)
            both_null = pc.and_(pc.is_null(a), pc.is_null(b))
            differ = pc.invert(pc.or_(same, both_null))
            d = differ.to_numpy(zero_copy_only=False).astype(bool)
            add(keys[d], "mismatch", n, *(show(pc.filter(x, differ)) for x in (a, b)))
        schema = pa.schema([("key", arrow), ("kind", pa.string()), ("field_name", pa.string()), ("left_value", pa.string()), ("right_value", pa.string())])
        return pa.table([pa.chunked_array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def diff_tables(
    left: DataFrame, right: DataFrame, key: str, left_fields: dict[str, Column], right_fields: dict[str, Column],
    version: str | None = None, bucket_rows: int = BUCKET_ROWS, cells: str = "none",
) -> DataFrame:
    """``(key, kind, field_name, left_value, right_value)``; kinds missing_right, missing_left, mismatch.

    Null equals only null. The number of buckets follows the row counts, so a bucket stays
    small whatever the size; keys are unique when they are bucketed, so none can be hot.
    ``cells`` says how differing values come out: none, masked or raw, as they may be personal.
    Both keys must be numbers or both text.
    """
    names = list(left_fields)
    if names != list(right_fields):
        raise ValueError("both sides need the same fields in the same order")
    n = left.select(F.lit(1)).unionAll(right.select(F.lit(1))).count()  # one pass over metadata
    buckets = max(1, -(-n // (2 * bucket_rows)))
    bucket = F.pmod(F.xxhash64("k"), F.lit(buckets)).alias("bucket")
    l, r = (current_rows(df, key, f, version).select(bucket, "k", *names) for df, f in ((left, left_fields), (right, right_fields)))
    kind = dict(l.dtypes)["k"]
    if kind != dict(r.dtypes)["k"]:
        raise ValueError("keys must be numbers on both sides or text on both")
    schema = f"key {kind}, kind string, field_name string, left_value string, right_value string"
    return l.groupBy("bucket").cogroup(r.groupBy("bucket")).applyInArrow(_compare(names, cells, kind), schema)
