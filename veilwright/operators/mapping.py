"""Mapping tables, surrogates and master tables of personal data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import StaleVersion, Versions, materialize

#: The band of offsets, 30 to 38 days either way.
BAND_LOW, BAND_HIGH = 30, 38
ENCOUNTER_BAND = 10_000


def banded_offset(key: Column, secret: str) -> Column:
    """Days within the band, the same for the same key and secret; without the secret they can't be told from the key."""
    n = BAND_HIGH - BAND_LOW + 1
    inner = F.sha2(F.concat(F.lit(f"{secret}:"), key.cast("string")), 256)
    v = F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(f"{secret}:"), inner), 256), 1, 8), 16, 10).cast("bigint"), F.lit(2 * n))
    return F.when(v < n, v - BAND_HIGH).otherwise(v - n + BAND_LOW).cast("int")


def numbered(df: DataFrame, order: Sequence[str], name: str, start: Column | int = 0, within: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``name`` = ``start`` + position in ``order`` (1 first), over any number of partitions.

    ``within`` names columns, the first of ``order``, for each of whose values numbers begin
    anew; they hold no nulls. Rows are range-partitioned by the whole order, so a value with
    most rows spreads over partitions, and numbered within their partition; the sizes
    before it make the numbers whole.
    """
    group = list(within)
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "numbered")
    sizes = ranged.groupBy("_part", *group).count()
    earlier = F.sum("count").over(Window.partitionBy(*group).orderBy("_part") if group else Window.orderBy("_part"))
    before = sizes.select("_part", *group, (earlier - F.col("count")).alias("_before"))
    w = Window.partitionBy("_part", *group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    out = ranged.withColumn("_rn", F.row_number().over(w)).join(before, ["_part", *group])
    return out.withColumn(name, (F.lit(start) if isinstance(start, int) else start) + F.col("_before") + F.col("_rn")).select(*df.columns, name)


def id_pool(frames: Sequence[tuple[DataFrame, str]], name: str = "id") -> DataFrame:
    """Distinct ids of several columns; null and blank ones are none."""
    out = None
    for df, c in frames:
        part = df.select(F.trim(F.col(c).cast("string")).alias(name)).where(F.col(name) != "")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def new_ids(source: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Ids of the source that the map lacks."""
    return source.select(key).distinct().join(existing.select(key).distinct(), key, "left_anti")


def populate_patient_map(existing: DataFrame, ids: DataFrame, secret: str, prefix: int = 10_000_000) -> DataFrame:
    """``(nd_patient_id, patientid, offset_days)``: the old rows, then new ids in order from the highest surrogate on; ``secret`` decides their offsets."""
    fresh = new_ids(ids, existing, "patientid").where("patientid is not null")
    top = existing.agg(F.coalesce(F.max("nd_patient_id"), F.lit(prefix)).alias("m")).first()["m"]
    rows = numbered(fresh, ["patientid"], "nd_patient_id", int(top))
    return existing.select("nd_patient_id", "patientid", "offset_days").unionByName(
        rows.select("nd_patient_id", "patientid", banded_offset(F.col("patientid"), secret).alias("offset_days"))
    )


class PatientMap:
    """A patient map in versions, each a folder of rows that it adds, so that several runs may add patients to it."""

    SCHEMA = "nd_patient_id bigint, patientid bigint, offset_days int"

    def __init__(self, spark: SparkSession, path: str, secret: str, prefix: int = 10_000_000):
        self.spark, self.versions, self.secret, self.prefix = spark, Versions(spark, path), secret, prefix

    def read(self) -> DataFrame:
        files = self.versions.current()[1].get("rows", [])
        return self.spark.read.schema(self.SCHEMA).parquet(*files) if files else self.spark.createDataFrame([], self.SCHEMA)

    def get_or_create(self, ids: DataFrame, tries: int = 5) -> DataFrame:
        """Rows of the patients in ``ids(patientid)``; those that the map lacks are added first.

        If another run adds patients meanwhile, this one looks again, so no patient gets two surrogates.
        """
        for _ in range(tries):
            base, files = self.versions.current()
            old = self.read()
            fresh = new_ids(ids, old, "patientid").where("patientid is not null")
            if fresh.isEmpty():
                break
            top = old.agg(F.coalesce(F.max("nd_patient_id"), F.lit(self.prefix)).alias("m")).first()["m"]
            rows = numbered(fresh, ["patientid"], "nd_patient_id", int(top)).withColumn("offset_days", banded_offset(F.col("patientid"), self.secret))
            path = self.versions.fresh("rows")
            rows.select("nd_patient_id", "patientid", "offset_days").write.parquet(path)
            try:
                self.versions.commit(base, {"rows": [*files.get("rows", []), path]})
                break
            except StaleVersion:
                continue
        else:
            raise StaleVersion("other runs kept adding patients")
        return self.read().join(ids.select("patientid").distinct(), "patientid", "left_semi").select("nd_patient_id", "patientid", "offset_days")


def first_pair(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key: the least."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def encounter_surrogates(enc: DataFrame, patients: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``enc(encounter_id, patientid, encounter_date)`` with ``nd_encounter_id`` = patient surrogate, then a
    running number by date and id, going on from the patient's highest one.

    Every patient has a band of numbers. Numbers of the band that other patients' encounters
    hold are skipped; what doesn't fit into the band gets numbers above every band and
    every number in use, in order of patient, date and id. So numbers are unique.
    """
    rows = enc.join(patients.select("patientid", "nd_patient_id"), "patientid").where("nd_patient_id is not null")
    own = F.col("nd_patient_id") * ENCOUNTER_BAND
    if existing is not None:
        rows = rows.join(existing.select("encounter_id"), "encounter_id", "left_anti")
        band = F.floor(F.col("nd_encounter_id") / ENCOUNTER_BAND)
        mine = F.when(band == F.col("nd_patient_id"), F.col("nd_encounter_id"))
        top = existing.groupBy("nd_patient_id").agg(F.max(mine).alias("_top"))
        foreign = existing.where(band != F.col("nd_patient_id")).groupBy(band.alias("nd_patient_id")).agg(F.array_sort(F.collect_set("nd_encounter_id")).alias("_taken"))
        most = existing.agg(F.max("nd_encounter_id").alias("m")).first()["m"] or 0
    rows = numbered(rows, ["nd_patient_id", "encounter_date", "encounter_id"], "_n", within=["nd_patient_id"])
    number = own + F.col("_n")
    if existing is not None:
        rows = rows.join(top, "nd_patient_id", "left").join(foreign, "nd_patient_id", "left")
        number = F.coalesce("_top", own) + F.col("_n")
        number = F.when(F.col("_taken").isNull(), number).otherwise(F.aggregate("_taken", number, lambda x, t: F.when((t > F.coalesce("_top", own)) & (t <= x), x + 1).otherwise(x)))
    rows = rows.withColumn("nd_encounter_id", number)
    cols = ["encounter_id", "patientid", "nd_patient_id", "nd_encounter_id", "encounter_date"]
    fits = F.col("nd_encounter_id") < own + ENCOUNTER_BAND
    rows = materialize(rows.select(*cols, fits.alias("_fits")), "encounters")
    over = rows.where("not _fits").select("encounter_id", "patientid", "nd_patient_id", "encounter_date")
    if over.isEmpty():
        return rows.select(*cols)
    last = patients.agg(F.max("nd_patient_id").alias("m")).first()["m"]
    above = max((last + 1) * ENCOUNTER_BAND, most if existing is not None else 0)
    over = numbered(over, ["nd_patient_id", "encounter_date", "encounter_id"], "nd_encounter_id", int(above))
    return rows.where("_fits").select(*cols).unionByName(over.select(*cols))


def mapping_delta(old: DataFrame, delta: DataFrame, at: Column, secret: str, prefix: int = 10_000_000) -> DataFrame:
    """Map ``(patientid, nd_patient_id, offset_days, registration_date, excluded, excluded_at)`` after a delta ``(patientid, registration_date, excluded)``.

    Known patients keep surrogate and offset; new ones get both, surrogates in order from
    the highest on; a null date never overwrites one; exclusion sticks and
    ``excluded_at`` is set only when it begins. Rows without patient are left out.
    """
    d = delta.where("patientid is not null").groupBy("patientid").agg(F.max("registration_date").alias("d_reg"), F.bool_or("excluded").alias("d_exc"))
    j = old.withColumn("_known", F.lit(True)).join(d, "patientid", "full")
    was = F.coalesce("excluded", F.lit(False))
    now = was | F.coalesce("d_exc", F.lit(False))
    rows = j.select(
        "patientid", "nd_patient_id", "offset_days", F.coalesce("d_reg", "registration_date").alias("registration_date"), now.alias("excluded"),
        F.when(now & ~was, at).otherwise(F.col("excluded_at")).alias("excluded_at"), F.coalesce("_known", F.lit(False)).alias("_known"),
    )
    top = old.agg(F.coalesce(F.max("nd_patient_id"), F.lit(prefix)).alias("m")).first()["m"]
    fresh = rows.where("not _known").drop("_known", "nd_patient_id", "offset_days")
    fresh = numbered(fresh, ["patientid"], "nd_patient_id", int(top)).withColumn("offset_days", banded_offset(F.col("patientid"), secret))
    return rows.where("_known").drop("_known").unionByName(fresh)


def exclusions(patients: DataFrame, visits: DataFrame, kinds: Sequence[str], answers: DataFrame | None = None) -> DataFrame:
    """``(nd_patient_id)`` of the patients to exclude: by a visit of one of the kinds (in any letter case), by an answer in ``answers(patientid)``, or already so."""
    by = visits.where(F.lower(F.trim("visittype")).isin([k.lower() for k in kinds])).select("patientid")
    if answers is not None:
        by = by.union(answers.select("patientid"))
    new = patients.join(by.distinct(), "patientid", "left_semi").select("nd_patient_id")
    return new.union(patients.where("excluded").select("nd_patient_id")).distinct()


def personal_values(master: DataFrame, key: str, columns: Sequence[str], patients: DataFrame | None = None) -> DataFrame:
    """``(key, <columns>)`` with the distinct values of each column per patient, of the given patients only."""
    rows = master.where(F.col(key).isNotNull())
    if patients is not None:
        rows = rows.join(patients.select(key).distinct(), key, "left_semi")
    return rows.groupBy(key).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns])


def upsert_keep(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both by key; a null of the new row never overwrites."""
    cols = [c for c in old.columns if c != key]
    n = new.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_n_{c}") if c in new.columns else F.lit(None).alias(f"_n_{c}") for c in cols])
    j = old.join(n, F.col(key) == F.col("_k"), "full")
    return j.select(F.coalesce(key, "_k").alias(key), *[F.coalesce(f"_n_{c}", c).alias(c) for c in cols])


def refresh_groups(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows of the keys in ``new`` are exchanged for its rows."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new.select(*old.columns))


def master_table(key: str, parts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per patient with columns ``table_column`` of each part; of several rows of a patient the greatest counts."""
    out = None
    for name, df in parts.items():
        cols = [c for c in df.columns if c != key]
        one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*cols)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(f"{name}_{c}") for c in cols])
        out = one if out is None else out.join(one, key, "full")
    return out
