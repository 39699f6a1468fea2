"""A stream over several batches and restarts gives what the batch operators give."""

import tempfile

from pyspark.sql import functions as F

from vigil.operators import alarms
from vigil.plans.queries import rounded
from vigil.schema import feature_names
from vigil.sources.files import ISO_MICROS
from vigil.streaming import jobs


def test_stream_decisions_over_batches_and_restart(spark, vitals):
    folder = tempfile.mkdtemp(prefix="vigil-stream-")
    rows = vitals.drop("second_proba")
    for low, high in ((1, 15), (16, 40), (41, 10_000)):
        part = rows.filter(F.col("ICULOS").between(low, high))
        part.write.mode("append").option("timestampNTZFormat", ISO_MICROS).json(f"{folder}/in")
        stream = jobs.stream_decisions(jobs.read_records(spark, f"{folder}/in"), 0.4, 3, 6)
        jobs.run_available(stream, f"{folder}/out", f"{folder}/checkpoint", partitions=4)
    names = ["patient_id", "ICULOS", "streak", "muted", "alarm"]
    got = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").select(*names).collect())
    made = alarms.online_decisions(vitals.drop("second_proba"), 0.4, 3, 6)
    assert got == sorted(tuple(r) for r in made.select(*names).collect())


def test_states_of_patients_are_shared_by_bucket(spark, vitals, monkeypatch):
    """Fewer groups than patients, every patient's rows as in batch: over restarts, with patients that come late or stay away."""
    from vigil.operators.rolling import features
    from vigil.streaming import state

    assert jobs.BUCKETS <= 4096
    monkeypatch.setattr(jobs, "BUCKETS", 3)
    monkeypatch.setattr(state, "ROWS_AT_ONCE", 7)
    folder = tempfile.mkdtemp(prefix="vigil-buckets-")
    ids = sorted(r[0] for r in vitals.select("patient_id").distinct().collect())[:9]
    rows = vitals.drop("second_proba").filter(F.col("patient_id").isin(ids) & ((F.col("ICULOS") >= 15) | (F.col("patient_id") > ids[4])))
    rows = rows.filter(~F.col("ICULOS").between(15, 30) | (F.col("patient_id") != ids[7]))
    for low, high in ((1, 14), (15, 30), (31, 10_000)):
        part = rows.filter(F.col("ICULOS").between(low, high))
        part.write.mode("append").option("timestampNTZFormat", ISO_MICROS).json(f"{folder}/in")
        records = jobs.read_records(spark, f"{folder}/in")
        for name, stream in (("features", jobs.stream_features(records)), ("decisions", jobs.stream_decisions(records, 0.4, 3, 6))):
            plan = stream._jdf.queryExecution().analyzed().toString()
            assert "xxhash64(patient_id" in plan
            jobs.run_available(stream, f"{folder}/{name}", f"{folder}/{name}-checkpoint", partitions=4)
    got, want = spark.read.parquet(f"{folder}/features"), features(rows)
    got, want = (rounded(x.select(sorted(want.columns))) for x in (got, want))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()
    names = ["patient_id", "ICULOS", "streak", "muted", "alarm"]
    got = spark.read.parquet(f"{folder}/decisions").select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, alarms.online_decisions(rows, 0.4, 3, 6).select(*names).collect()))


def test_stream_features_has_every_feature(spark):
    stream = jobs.stream_features(jobs.checked(jobs.read_records(spark, tempfile.mkdtemp())))
    assert stream.isStreaming and set(feature_names()) <= set(stream.columns)


def test_repeats_are_dropped_within_the_delay(spark, vitals):
    folder = tempfile.mkdtemp(prefix="vigil-repeats-")
    rows = vitals.drop("second_proba")
    rows.unionByName(rows.filter("event_id % 5 = 0")).write.option("timestampNTZFormat", ISO_MICROS).json(f"{folder}/in")
    stream = jobs.without_repeats(jobs.read_records(spark, f"{folder}/in"))
    jobs.run_available(stream, f"{folder}/out", f"{folder}/checkpoint", partitions=4)
    assert spark.read.parquet(f"{folder}/out").count() == rows.count()
