"""Structured Streaming jobs over hourly records: checks, features, decisions, alerts, landing."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from vigil.functions.rules import accepted, quarantined, whole_hours
from vigil.operators.rolling import feature_row
from vigil.schema import HOUR, KEY, LABEL, MODEL_DEMOGRAPHICS, PROBAS_KEPT, TIE, VITALS, record_schema
from vigil.session import settings
from vigil.sources.files import ISO_MICROS, by_day
from vigil.streaming.state import BUCKET, add_rolled, add_streaks, rolled_order

#: Patients share so many groups of state: a call works through all rows of a group at once, and a group holds a
#: two-thousandth of the batch. The number is part of what a checkpoint holds.
BUCKETS = 2048
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_records(spark: SparkSession, path: str, files_per_batch: int | None = None, schema=None) -> DataFrame:
    """JSON records dropped into a folder, in arrival order."""
    reader = spark.readStream.schema(schema or record_schema())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_queue(spark: SparkSession, form: str, value: str = "value", schema=None, **options) -> DataFrame:
    """The same from a message queue whose connector is on the class path; ``value`` holds the JSON."""
    raw = spark.readStream.format(form).options(**options).load()
    parsed = F.from_json(F.col(value).cast("string"), schema or record_schema())
    return raw.select(parsed.alias("r")).select("r.*")


def without_repeats(records: DataFrame, delay: str = "2 hours", ts="event_ts") -> DataFrame:
    """Optional: drop a repeated (patient, hour) that arrives within ``delay``."""
    timed = records.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark([KEY, HOUR]).drop("_at")


def checked(records: DataFrame) -> DataFrame:
    return accepted(records)


def refused(records: DataFrame) -> DataFrame:
    return quarantined(records)


def bucketed(rows: DataFrame) -> GroupedData:
    """The rows by the group of state their patient belongs to."""
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(BUCKETS))).groupBy(BUCKET)


def stream_features(records: DataFrame, extra=(TIE,)) -> DataFrame:
    """The 131 features of each arriving record."""
    needed = [KEY, HOUR, TIE, LABEL, "WBC", *VITALS, *MODEL_DEMOGRAPHICS]
    lean = records.select(*needed)
    schema = T.StructType([*lean.schema.fields, T.StructField("rolled", T.ArrayType(T.DoubleType()))])
    rolled = bucketed(lean).applyInPandasWithState(
        add_rolled, schema, "patients array<string>, held array<int>, values binary", "append", GroupStateTimeout.NoTimeout
    )
    columns = [f"nanvl(rolled[{i}], NULL) AS {name}" for i, name in enumerate(rolled_order())]
    return feature_row(rolled.selectExpr(*lean.columns, *columns), extra)


def stream_decisions(scored: DataFrame, threshold=0.05, min_consecutive=6, warmup_hours=0, history=PROBAS_KEPT):
    """One alarm decision per scored record; records without hour or probability are passed over."""
    lean = scored.select(KEY, HOUR, TIE, "event_ts", "proba", whole_hours().alias("iculos_hours"))
    lean = lean.filter("iculos_hours is not null and proba is not null")
    schema = T.StructType(
        [*lean.schema.fields, T.StructField("streak", T.IntegerType()), T.StructField("muted", T.BooleanType()),
         T.StructField("alarm", T.BooleanType())]
    )
    return bucketed(lean).applyInPandasWithState(
        add_streaks(threshold, min_consecutive, warmup_hours, history), schema, "patients array<string>, streaks array<int>",
        "append", GroupStateTimeout.NoTimeout,
    )


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None):
    """State store and number of state partitions while a query starts; settings come back after."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    with settings(spark, wanted):
        yield


def run_available(out: DataFrame, path: str, checkpoint: str, partitions=None, partition_by=(), form="parquet"):
    """Work through everything that has arrived and stop; started again, it goes on from the checkpoint."""
    with stream_settings(out.sparkSession, partitions):
        writer = out.writeStream.format(form).outputMode("append").trigger(availableNow=True)
        writer = writer.option("timestampNTZFormat", ISO_MICROS)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        query = writer.option("checkpointLocation", checkpoint).start(path)
        query.awaitTermination()
    return query.lastProgress


def run_batches(out: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, partitions=None):
    with stream_settings(out.sparkSession, partitions):
        writer = out.writeStream.foreachBatch(each).trigger(availableNow=True)
        query = writer.option("checkpointLocation", checkpoint).start()
        query.awaitTermination()
    return query.lastProgress


def land(records: DataFrame, path: str, checkpoint: str, ts="event_ts", form="json"):
    """Raw records into folders per day; the checkpoint keeps the tail safe."""
    return run_available(by_day(records, ts), path, checkpoint, partition_by=("year", "month", "day"), form=form)


def newest_version(spark: SparkSession, path: str) -> int:
    """The highest version that ``keep_latest`` has written; a run without new records writes none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return max(int(x.getPath().getName()[1:]) for x in listed if x.getPath().getName()[0] == "v")


def keep_latest(spark: SparkSession, path: str, order=(HOUR, TIE)) -> Callable[[DataFrame, int], None]:
    """A batch step that keeps the newest row per patient: version ``n + 1`` is the newest of version
    ``n`` and the batch. A repeated batch writes the same version again."""
    newest = F.struct(*order)

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if batch_id > 0:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/v{batch_id - 1}").unionByName(batch)
        one = rows.groupBy(KEY).agg(F.max_by(F.struct(*batch.columns), newest).alias("r")).select("r.*")
        one.write.mode("overwrite").parquet(f"{path}/v{batch_id}")

    return each
