"""Readers and writers for patient files, splits, landing zones and result tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.rules import nan_to_null
from vigil.operators.slices import join_per_key
from vigil.schema import HOUR, KEY, LABEL, psv_schema, record_schema
from vigil.session import settings

HOURS_PER_FILE = 100_000
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SPLITS = ("train", "val", "test")
#: Folders are listed by so many tasks at most; Spark would start one for each folder, up to 10,000.
LISTING_TASKS = 200
#: On a local disk patient files go without hidden checksum files, which double the files and the processes that set
#: permissions. Other file systems do not read these options.
NO_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def read_psv(
    spark: SparkSession, path: str, pattern="*.psv", id_from="stem", max_patients: int | None = None, schema=None
) -> DataFrame:
    """Pipe-separated patient files, ``NaN`` for missing; the id is the file's stem (or its folder's
    ``patient_id=`` value). Files below ``path`` count only when none lies directly in it."""
    options = {"sep": "|", "header": True, "nullValue": "NaN", "enforceSchema": False, "pathGlobFilter": pattern}
    reader = spark.read.schema(schema or psv_schema()).options(**options)
    try:
        df = reader.csv(f"{path}/{pattern}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        with settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTING_TASKS)}):
            df = reader.option("recursiveFileLookup", True).csv(path)
    place = r"([^/]+?)\.[^./]+$" if id_from == "stem" else r"patient_id=([^/]+)/"
    df = df.select(
        F.regexp_extract("_metadata.file_path", place, 1).alias(KEY), F.col("_metadata.file_path").alias("_path"), "*"
    )
    if max_patients:
        first = df.select("_path").distinct().orderBy("_path").limit(max_patients)
        df = df.join(first, "_path", "left_semi")
    ints = {c: F.col(c).try_cast("int") for c in (HOUR, LABEL) if c in df.columns}
    return nan_to_null(df.drop("_path")).withColumns(ints)


def write_psv(df: DataFrame, path: str, columns=None) -> None:
    """The same layout with a folder per patient, so that a long stay may spread over several files."""
    kept = columns or [f.name for f in psv_schema().fields]
    out = df.select(KEY, *kept).repartition(KEY, F.floor(F.col(HOUR) / HOURS_PER_FILE))
    writer = out.sortWithinPartitions(KEY, HOUR).write.partitionBy(KEY).options(**NO_CHECKSUM_FILES)
    writer.options(sep="|", header=True, nullValue="NaN").mode("overwrite").csv(path)


def write_splits(df: DataFrame, splits: DataFrame, path: str, **options) -> None:
    join_per_key(df, splits).write.options(**options).partitionBy("split").mode("overwrite").parquet(path)


def read_split(spark: SparkSession, path: str, split: str, required=True) -> DataFrame | None:
    """One split; only its folder is read. A missing one is an error, or None when not required."""
    try:
        return spark.read.parquet(f"{path}/split={split}")
    except AnalysisException:
        if required:
            raise FileNotFoundError(f"no split {split!r} under {path}") from None
        return None


def by_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)})


def write_landing(df: DataFrame, path: str, ts="event_ts", form="json") -> None:
    """Records as they came, in folders per day."""
    writer = by_day(df, ts).write.partitionBy("year", "month", "day").format(form).mode("append")
    writer.option("timestampNTZFormat", ISO_MICROS).save(path)


def read_landing(spark: SparkSession, path: str, form="json") -> DataFrame:
    schema = record_schema()
    for part in ("year", "month", "day"):
        schema = schema.add(part, T.IntegerType())
    return spark.read.schema(schema).format(form).load(path)


def prediction_archive(decisions: DataFrame, features: DataFrame | None = None, version="v1") -> DataFrame:
    """Predictions with day columns; with features, also a hash of the feature row."""
    out = decisions.select(
        KEY, HOUR, F.col("event_ts").alias("timestamp"), F.col("proba").alias("probability"),
        F.lit(version).alias("model_version"),
    )
    if features is not None:
        kept = [c for c in features.columns if c not in (KEY, HOUR)]
        hashed = features.select(KEY, HOUR, F.sha2(F.to_json(F.struct(*kept)), 256).alias("features_hash"))
        out = out.join(hashed, [KEY, HOUR], "left")
    return by_day(out, "timestamp")


def write_archive(archive: DataFrame, path: str) -> None:
    archive.write.partitionBy("year", "month", "day").mode("append").parquet(path)


def write_result(df: DataFrame, path: str, form="csv") -> None:
    """A result table as CSV with header, or as JSON lines."""
    df.write.mode("overwrite").format(form).options(**({"header": True} if form == "csv" else {})).save(path)


def as_json(df: DataFrame, name="summary") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(name))
