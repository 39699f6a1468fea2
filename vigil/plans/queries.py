"""The query catalogue: key -> callable(spark, sf_dir) -> DataFrame, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import rules
from vigil.operators import alarms, curves, drift, history, joins, labels, metrics, models, prep, quality, suppression
from vigil.operators import tuning, views
from vigil.operators.rolling import features, latest_features, rolling
from vigil.plans import inputs
from vigil.schema import DEMOGRAPHICS, HOUR, KEY, LABEL, LABS, STATS, TIE, VITALS
from vigil.session import shared_dir, written
from vigil.sources import files
from vigil.streaming import jobs

CATALOGUE: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The decision rule most queries use.
THRESHOLD, RUN, WARMUP = 0.4, 3, 6


def query(function):
    CATALOGUE[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, without negative zero, so that engines agree.

    ``round`` goes through the decimal digits of each value; values clear of a tie and small enough for a product that is
    exact to a thousandth are rounded in doubles instead, to the same result."""
    def exact(c):
        scaled = f"`{c}` * 1e{digits}D"
        clear = f"abs(`{c}`) < 1e{12 - digits}D AND abs(abs({scaled} - rint({scaled})) - 0.5D) > 1e-3D"
        return f"CASE WHEN {clear} THEN rint({scaled}) / 1e{digits}D ELSE round(`{c}`, {digits}) END + 0D AS `{c}`"

    return df.selectExpr(*[exact(c) if t == "double" else f"`{c}`" for c, t in df.dtypes])


def iso(df: DataFrame, *columns) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for c in columns})


def decisions(spark, sf_dir) -> DataFrame:
    return alarms.online_decisions(inputs.scores(spark, sf_dir), THRESHOLD, RUN, WARMUP)


def outcomes(spark, sf_dir) -> DataFrame:
    rows = inputs.scores(spark, sf_dir)
    return alarms.patient_outcomes(rows, rules.above("proba", THRESHOLD), RUN, WARMUP)


def alert_rows(spark, sf_dir) -> DataFrame:
    """Alerts under their event's number, which both engines know."""
    rows = decisions(spark, sf_dir).filter("alarm")
    return rows.select(
        F.col(TIE).alias("alert_id"), KEY, F.col("event_ts").alias("timestamp"), "proba", "iculos_hours",
        F.col("streak").cast("int").alias("consecutive_above"),
    )


def ack_rows(alerts: DataFrame) -> DataFrame:
    """Acknowledgements: every third alert, some of them twice, some of alerts nobody knows."""
    a = F.col("alert_id")
    user = F.element_at(F.array(*[F.lit(u) for u in ("ann", "bob", "eve")]), (a % 5 % 3 + 1).cast("int"))
    base = alerts.filter(a % 3 == 0)
    first = base.select(
        F.when(a % 30 == 0, a + 1_000_000_000_000).otherwise(a).alias("alert_id"), user.alias("username"),
        (F.col("timestamp") + F.expr("INTERVAL 10 MINUTES")).alias("ack_ts"), F.lit(1).alias("seq"),
    )
    again = base.filter(a % 6 == 0).select(
        "alert_id", F.lit("bob").alias("username"), (F.col("timestamp") + F.expr("INTERVAL 20 MINUTES")).alias("ack_ts"),
        F.lit(2).alias("seq"),
    )
    return first.unionByName(again)


def user_rows(spark) -> DataFrame:
    rows = [("ann", "admin", True), ("bob", "doctor", True), ("eve", "viewer", True)]
    return spark.createDataFrame(rows, "username string, role string, is_active boolean")


# ---- records -------------------------------------------------------------------------------------


@query
def coerce_numeric(spark, sf_dir):
    rows = inputs.events(spark, sf_dir)
    text = F.when(F.col(TIE) % 7 == 0, "n/a").when(F.col(TIE) % 11 == 0, "NaN").when(F.col(TIE) % 13 == 0, "Infinity")
    rows = rows.withColumn("raw", text.otherwise(F.col("value").cast("string")))
    return rounded(rows.select(TIE, rules.finite("raw").alias("number")))


@query
def validate_records(spark, sf_dir):
    return rules.check_records(inputs.vitals(spark, sf_dir)).select(KEY, HOUR, "is_valid", "reason")


@query
def quarantine_counts(spark, sf_dir):
    bad = rules.quarantined(inputs.vitals(spark, sf_dir))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def missing_indicators(spark, sf_dir):
    flags = [e.alias(n) for n, e in rules.missing_flags().items()]
    return inputs.vitals(spark, sf_dir).select(KEY, HOUR, *flags)


@query
def clinical_scores(spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir)
    return rows.select(KEY, HOUR, rules.qsofa().alias("qsofa_score"), rules.sirs().alias("sirs_count"))


@query
def iculos_normalize(spark, sf_dir):
    rows = inputs.events(spark, sf_dir)
    raw = F.when(F.col(TIE) % 9 == 0, None).otherwise(F.col("value") - 20)
    rows = rows.select(TIE, rules.whole_hours(raw).alias("iculos_hours"))
    return rows.withColumn("scored", F.col("iculos_hours").isNotNull())


@query
def risk_bands(spark, sf_dir):
    rows = inputs.scores(spark, sf_dir)
    return rows.groupBy(
        rules.risk_band("proba").alias("list_band"), rules.risk_band("proba", THRESHOLD).alias("detail_band")
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def severity(spark, sf_dir):
    rows = inputs.scores(spark, sf_dir).select(KEY, HOUR, rules.severity("proba").alias("severity"))
    return rows.filter("severity is not null")


@query
def news2(spark, sf_dir):
    return inputs.vitals(spark, sf_dir).select(KEY, HOUR, rules.news2().alias("news2"))


@query
def resolve_params(spark, sf_dir):
    """Parameters per patient: a stored artifact from the scores, an override now and then, else defaults."""
    rows = inputs.scores(spark, sf_dir).groupBy(KEY).agg(F.max("proba").alias("top"), F.count(F.lit(1)).alias("n"))
    odd = F.col("n") % 2 == 1
    rows = rows.select(
        KEY,
        F.when(F.col("n") % 5 == 0, 0.9).alias("override_threshold"), F.when(odd, F.col("top")).alias("artifact_threshold"),
        F.when(F.col("n") % 3 == 0, 2).alias("override_min_consecutive"),
        F.when(odd, (F.col("n") % 7).cast("int")).alias("artifact_min_consecutive"),
        F.lit(None).cast("int").alias("override_warmup_hours"),
        F.when(odd, (F.col("n") % 4).cast("int")).alias("artifact_warmup_hours"),
    )
    return rounded(rules.resolve_params(rows, rules.SERVING_DEFAULTS))


@query
def feature_map_roundtrip(spark, sf_dir):
    rows = features(inputs.vitals(spark, sf_dir))
    mapped = rows.select(TIE, rules.feature_map().alias("m")).withColumn("n_present", F.size("m"))
    return rounded(rules.from_feature_map(mapped, "m", models.default_inputs()))


# ---- sources and sinks ---------------------------------------------------------------------------


@query
def psv_scan(spark, sf_dir):
    path = shared_dir(spark, "psv")
    files.write_psv(inputs.vitals(spark, sf_dir), path)
    rows = files.read_psv(spark, path, pattern="*.csv", id_from="folder")
    return rounded(rows.select(KEY, HOUR, *VITALS, *LABS, *DEMOGRAPHICS, LABEL))


@query
def union_sources(spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir)
    with_labs = rows.filter(F.col("Unit1") == 1).select(KEY, HOUR, "HR", "WBC")
    without = rows.filter(F.col("Unit1") == 0).select(KEY, HOUR, "HR")
    return joins.union_all(with_labs, without)


@query
def split_roundtrip(spark, sf_dir):
    rows = inputs.scores(spark, sf_dir)
    path = shared_dir(spark, "splits")
    files.write_splits(rows, labels.patient_split(rows), path)
    parts = [
        files.read_split(spark, path, s).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(LABEL).alias("n_positive"))
        .select(F.lit(s).alias("split"), "n_rows", "n_positive")
        for s in files.SPLITS
    ]
    return joins.union_all(*parts)


@query
def raw_landing_partitions(spark, sf_dir):
    path = shared_dir(spark, "landing")
    files.write_landing(rules.accepted(inputs.vitals(spark, sf_dir)).drop("second_proba"), path)
    landed = files.read_landing(spark, path)
    return rounded(landed.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"), F.count("HR").alias("n_hr"), F.sum("HR").alias("sum_hr")
    ))


@query
def latest_features_table(spark, sf_dir):
    return rounded(latest_features(inputs.vitals(spark, sf_dir)))


CATALOGUE["latest_features"] = CATALOGUE.pop("latest_features_table")


@query
def vitals_history(spark, sf_dir):
    return iso(rounded(history.vitals_history(inputs.vitals(spark, sf_dir), hours=72)), "timestamp")


@query
def chart_series(spark, sf_dir):
    kept = history.vitals_history(inputs.vitals(spark, sf_dir), hours=24)
    lines = history.chart_vitals(kept).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_points"), F.max("hr").alias("max_hr"), F.min("map").alias("min_map")
    )
    temps = history.chart_temperature(kept).groupBy(KEY).agg(F.count(F.lit(1)).alias("n_temps"))
    return rounded(lines.join(temps, KEY, "left").fillna(0, ["n_temps"]))


@query
def proba_history(spark, sf_dir):
    return iso(rounded(history.prediction_log(decisions(spark, sf_dir))), "timestamp")


@query
def proba_window(spark, sf_dir):
    kept = history.proba_window(inputs.scores(spark, sf_dir))
    return rounded(kept.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), F.sum("proba").alias("sum_proba")))


@query
def alert_log(spark, sf_dir):
    return iso(rounded(alarms.alerts(decisions(spark, sf_dir)).drop("alert_id")), "timestamp")


@query
def prediction_archive(spark, sf_dir):
    path = shared_dir(spark, "archive")
    files.write_archive(files.prediction_archive(decisions(spark, sf_dir)), path)
    schema = "patient_id string, ICULOS int, timestamp timestamp_ntz, probability double, model_version string, "
    read = spark.read.schema(schema + "year int, month int, day int").parquet(path)
    return iso(rounded(read), "timestamp")


# ---- rolling windows -----------------------------------------------------------------------------


@query
def features_131(spark, sf_dir):
    return rounded(features(inputs.vitals(spark, sf_dir)))


def _rolling_stat(stat, spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir).select(KEY, HOUR, TIE, *VITALS)
    return rounded(rolling(rows, stats=(stat,)).drop(*VITALS))


for _stat in STATS:
    CATALOGUE[f"rolling_{_stat}"] = partial(_rolling_stat, _stat)


@query
def rolling_by_hour(spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir).select(KEY, HOUR, TIE, *VITALS)
    return rounded(prep.rolling_by_hour(rows).drop(*VITALS))


# ---- alarms and labels ---------------------------------------------------------------------------


@query
def first_alarm(spark, sf_dir):
    return alarms.first_alarm(inputs.scores(spark, sf_dir), rules.above("proba", THRESHOLD), RUN, WARMUP)


@query
def onset_rows(spark, sf_dir):
    return alarms.onset_rows(inputs.scores(spark, sf_dir))


@query
def alert_dedup(spark, sf_dir):
    return iso(rounded(suppression.suppress_repeats(alert_rows(spark, sf_dir))), "timestamp")


@query
def alert_dedup_day(spark, sf_dir):
    return iso(rounded(suppression.suppress_repeats(alert_rows(spark, sf_dir), gap_hours=24)), "timestamp")


@query
def online_decision(spark, sf_dir):
    return rounded(decisions(spark, sf_dir).select(KEY, HOUR, "proba", F.col("streak").cast("int").alias("streak"), "muted", "alarm"))


@query
def two_level_alarm(spark, sf_dir):
    return alarms.two_level_alarms(inputs.scores(spark, sf_dir)).select(KEY, HOUR, "level", "fired")


@query
def history_gate(spark, sf_dir):
    return prep.history_gate(inputs.scores(spark, sf_dir)).select(KEY, HOUR)


@query
def relabel_late(spark, sf_dir):
    return labels.relabel_late(inputs.scores(spark, sf_dir)).select(KEY, HOUR, LABEL, "relabelled")


@query
def relabel_stats(spark, sf_dir):
    return labels.relabel_stats(labels.relabel_late(inputs.scores(spark, sf_dir)))


@query
def patient_split(spark, sf_dir):
    return labels.patient_split(inputs.scores(spark, sf_dir))


@query
def split_stats(spark, sf_dir):
    rows = inputs.scores(spark, sf_dir)
    return rounded(labels.split_stats(rows, labels.patient_split(rows)))


@query
def leakage_check(spark, sf_dir):
    split = labels.patient_split(inputs.scores(spark, sf_dir))
    return labels.leakage(split.filter("split = 'train'"), split.filter("split <> 'train'"))


@query
def class_weights(spark, sf_dir):
    return rounded(labels.class_weights(inputs.scores(spark, sf_dir)))


@query
def split_membership(spark, sf_dir):
    rows = inputs.scores(spark, sf_dir)
    val = labels.patient_split(rows).filter("split = 'val'")
    return joins.keep_patients(rows, val).select(KEY, HOUR)


# ---- joins, sampling, sets -----------------------------------------------------------------------


@query
def join_scores(spark, sf_dir):
    first = inputs.scores(spark, sf_dir).select(KEY, HOUR, LABEL, "proba")
    return rounded(joins.join_scores(first, inputs.second_scores(spark, sf_dir)))


@query
def join_audit(spark, sf_dir):
    return joins.join_audit(inputs.scores(spark, sf_dir), inputs.second_scores(spark, sf_dir))


@query
def seeded_sample(spark, sf_dir):
    return joins.seeded_sample(inputs.events(spark, sf_dir).select(TIE, "user_id"), 500, 42, TIE)


# ---- evaluation ----------------------------------------------------------------------------------


@query
def patient_utility(spark, sf_dir):
    return rounded(metrics.patient_utility(outcomes(spark, sf_dir)).select(KEY, "t_onset", "t_alarm", "utility"))


@query
def normalized_utility(spark, sf_dir):
    return rounded(metrics.normalized_utility(outcomes(spark, sf_dir)))


@query
def utility_official(spark, sf_dir):
    return rounded(metrics.utility_official(outcomes(spark, sf_dir)))


@query
def hourly_confusion(spark, sf_dir):
    return metrics.confusion(inputs.scores(spark, sf_dir), THRESHOLD)


def _steps(spark, sf_dir):
    return curves.score_steps(inputs.scores(spark, sf_dir))


@query
def auroc(spark, sf_dir):
    return rounded(curves.auroc(_steps(spark, sf_dir)))


@query
def average_precision(spark, sf_dir):
    return rounded(curves.average_precision(_steps(spark, sf_dir)))


@query
def roc_curve(spark, sf_dir):
    return rounded(curves.roc_curve(_steps(spark, sf_dir)))


@query
def pr_curve(spark, sf_dir):
    return rounded(curves.pr_curve(_steps(spark, sf_dir)))


@query
def sens_at_spec(spark, sf_dir):
    return rounded(curves.sensitivity_at_specificity(_steps(spark, sf_dir)))


@query
def per_patient_results(spark, sf_dir):
    return rounded(metrics.per_patient_results(outcomes(spark, sf_dir)))


def _result_file(spark, sf_dir, form):
    """The results per patient as a file, read back."""
    rows, path = metrics.per_patient_results(outcomes(spark, sf_dir)), shared_dir(spark, "results")
    files.write_result(rows, path, form)
    options = {"header": True} if form == "csv" else {}
    return rounded(spark.read.schema(rows.schema).format(form).options(**options).load(path))


@query
def result_csv(spark, sf_dir):
    return _result_file(spark, sf_dir, "csv")


@query
def result_json(spark, sf_dir):
    return _result_file(spark, sf_dir, "json")


@query
def lead_time_stats(spark, sf_dir):
    return rounded(metrics.lead_times(metrics.per_patient_results(outcomes(spark, sf_dir))))


@query
def tune_grid(spark, sf_dir):
    return rounded(tuning.tune_grid(inputs.scores(spark, sf_dir)))


@query
def tune_best(spark, sf_dir):
    return rounded(tuning.best_params(tuning.tune_grid(inputs.scores(spark, sf_dir))))


@query
def apply_best_params(spark, sf_dir):
    """Tuned on the val split, applied to the test split."""
    rows = inputs.scores(spark, sf_dir)
    split = labels.patient_split(rows)
    best = tuning.best_params(tuning.tune_grid(joins.keep_patients(rows, split.filter("split = 'val'")))).first()
    params = (best["threshold"], best["min_consecutive"], best["warmup_hours"])
    test = joins.keep_patients(rows, split.filter("split = 'test'"))
    found = metrics.normalized_utility(alarms.patient_outcomes(test, rules.above("proba", params[0]), *params[1:]))
    return rounded(
        found.withColumns(
            {"threshold": F.lit(params[0]), "min_consecutive": F.lit(params[1]), "warmup_hours": F.lit(params[2])}
        )
    )


@query
def eval_summary(spark, sf_dir):
    return rounded(metrics.evaluation_summary(inputs.scores(spark, sf_dir), THRESHOLD, RUN, WARMUP))


@query
def metric_gate(spark, sf_dir):
    summary = metrics.evaluation_summary(inputs.scores(spark, sf_dir), THRESHOLD, RUN, WARMUP)
    return rounded(metrics.metric_gate(summary))


@query
def brier(spark, sf_dir):
    return rounded(metrics.brier(inputs.scores(spark, sf_dir)))


@query
def reliability_bins(spark, sf_dir):
    return rounded(metrics.reliability_bins(inputs.scores(spark, sf_dir)))


@query
def subgroup_metrics(spark, sf_dir):
    return rounded(metrics.subgroup_metrics(inputs.vitals(spark, sf_dir), THRESHOLD))


@query
def subgroup_gaps(spark, sf_dir):
    return rounded(metrics.subgroup_gaps(metrics.subgroup_metrics(inputs.vitals(spark, sf_dir), THRESHOLD)))


@query
def record_counters(spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir).withColumn("proba", F.when(F.col(TIE) % 40 != 0, F.col("proba")))
    made = alarms.online_decisions(rules.accepted(rows), THRESHOLD, RUN, WARMUP)
    return metrics.record_counters(rows, made)


# ---- telemetry -----------------------------------------------------------------------------------


@query
def event_rate(spark, sf_dir):
    return iso(rounded(metrics.event_rate(inputs.request_log(spark, sf_dir))), "window_start")


@query
def error_rate(spark, sf_dir):
    return iso(rounded(metrics.error_rate(inputs.request_log(spark, sf_dir))), "window_start")


@query
def status_counts(spark, sf_dir):
    return metrics.status_counts(inputs.request_log(spark, sf_dir))


@query
def latency_histogram(spark, sf_dir):
    return iso(metrics.latency_histogram(inputs.request_log(spark, sf_dir), "1 hour"), "window_start")


@query
def latency_p95(spark, sf_dir):
    table = metrics.latency_histogram(inputs.request_log(spark, sf_dir), "5 minutes")
    return iso(rounded(metrics.histogram_quantile(table)), "window_start")


# ---- drift, quality, preparation -----------------------------------------------------------------


def _drift_sides(spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir).select("event_ts", *VITALS)
    turn = F.lit("2024-01-16").cast("timestamp_ntz")
    return rows.filter(F.col("event_ts") < turn), rows.filter(F.col("event_ts") >= turn)


@query
def ks_drift(spark, sf_dir):
    return rounded(drift.ks_drift(*_drift_sides(spark, sf_dir)))


@query
def drift_columns(spark, sf_dir):
    return rounded(drift.drift_columns(*_drift_sides(spark, sf_dir)))


@query
def drift_summary(spark, sf_dir):
    return rounded(drift.drift_summary(*_drift_sides(spark, sf_dir)))


@query
def psi_drift(spark, sf_dir):
    return rounded(drift.psi(*_drift_sides(spark, sf_dir)))


@query
def psi_alert(spark, sf_dir):
    return drift.psi_alert(drift.psi(*_drift_sides(spark, sf_dir)))


@query
def dq_report(spark, sf_dir):
    return quality.quality_report(inputs.vitals(spark, sf_dir))


@query
def ffill_4h(spark, sf_dir):
    return rounded(prep.forward_fill(inputs.vitals(spark, sf_dir).select(KEY, HOUR, *VITALS)))


@query
def impute_group_mean(spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir).select(KEY, HOUR, *VITALS, "Age", "Gender")
    return rounded(prep.impute_group_mean(prep.forward_fill(rows)))


@query
def outlier_null(spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir).select(KEY, HOUR, "HR", "O2Sat", "Temp")
    return rounded(prep.forward_fill(prep.outliers_to_null(rows), ["HR", "O2Sat", "Temp"]))


@query
def lab_flags(spark, sf_dir):
    return prep.lab_flags(inputs.vitals(spark, sf_dir).select(KEY, HOUR, *LABS)).drop(*LABS)


@query
def hours_since_last(spark, sf_dir):
    return prep.hours_since_last(inputs.vitals(spark, sf_dir).select(KEY, HOUR, TIE, *VITALS)).drop(*VITALS)


@query
def interaction_features(spark, sf_dir):
    rows = inputs.vitals(spark, sf_dir).select(KEY, HOUR, "HR", "SBP", "Resp", "MAP")
    return rounded(prep.interactions(rows).drop("HR", "SBP", "Resp", "MAP"))


@query
def labs_long(spark, sf_dir):
    return rounded(prep.labs_long(inputs.vitals(spark, sf_dir)))


@query
def labs_wide(spark, sf_dir):
    wide = prep.labs_wide(prep.labs_long(inputs.vitals(spark, sf_dir)))
    return rounded(wide)


# ---- views ---------------------------------------------------------------------------------------


@query
def active_patients(spark, sf_dir):
    states = views.patient_states(decisions(spark, sf_dir))
    return views.by_risk(rounded(states.withColumn("band", rules.risk_band("latest_proba"))))


@query
def latest_state_join(spark, sf_dir):
    """The board from three stores; some patients have no prediction or no stored hours."""
    made = decisions(spark, sf_dir)
    predictions = made.filter(F.col("alarm") | F.col("muted"))
    meta = made.filter("iculos_hours >= 55")
    return rounded(views.joined_states(made, predictions, meta))


@query
def overlay_merge(spark, sf_dir):
    made = decisions(spark, sf_dir)
    polled = made.filter(F.col("event_ts") < F.lit("2024-01-25").cast("timestamp_ntz"))
    live = views.live_states(alert_rows(spark, sf_dir))
    return rounded(views.overlay(views.patient_states(polled), live))


def _folded(spark, sf_dir):
    found = alert_rows(spark, sf_dir)
    return views.fold_acks(found, ack_rows(found), user_rows(spark))


@query
def alert_ack_fold(spark, sf_dir):
    return iso(rounded(_folded(spark, sf_dir)), "timestamp", "acknowledged_at")


@query
def orphan_acks(spark, sf_dir):
    found = alert_rows(spark, sf_dir)
    return iso(views.orphan_acks(found, ack_rows(found)), "ack_ts")


@query
def alerts_feed(spark, sf_dir):
    newest = views.alert_feed(_folded(spark, sf_dir), acknowledged=False, limit=50)
    return iso(rounded(newest.drop("acknowledged_by", "acknowledged_at")), "timestamp")


@query
def live_feed(spark, sf_dir):
    return iso(rounded(views.live_feed(alert_rows(spark, sf_dir))), "timestamp")


@query
def board_counts(spark, sf_dir):
    states = views.patient_states(decisions(spark, sf_dir))
    return views.board_counts(states, _folded(spark, sf_dir), search="1")


# ---- streams -------------------------------------------------------------------------------------


def _arrivals(spark, sf_dir):
    """Hour bands of the records as JSON, handed over one after the other: yields the folder."""
    path = shared_dir(spark, "arrivals")
    rows = written(inputs.vitals(spark, sf_dir).drop("second_proba"), "arriving")
    for band in (F.col(HOUR) < 20, F.col(HOUR).between(20, 45), F.col(HOUR) > 45):
        rows.filter(band).write.mode("append").option("timestampNTZFormat", files.ISO_MICROS).json(path)
        yield path


def _streamed(spark, sf_dir, job, name) -> DataFrame:
    """Run a stream over the arrivals, stopped and started again between the bands."""
    out, checkpoint = shared_dir(spark, name), shared_dir(spark, f"{name}-checkpoint")
    for path in _arrivals(spark, sf_dir):
        stream = job(jobs.read_records(spark, path))
        jobs.run_available(stream, out, checkpoint, partitions=spark.sparkContext.defaultParallelism)
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_validated(spark, sf_dir):
    found = _streamed(spark, sf_dir, jobs.checked, "validated")
    return rounded(found.select(KEY, HOUR, *VITALS))


@query
def stream_quarantine(spark, sf_dir):
    found = _streamed(spark, sf_dir, jobs.refused, "refused")
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_features(spark, sf_dir):
    return rounded(_streamed(spark, sf_dir, lambda r: jobs.stream_features(jobs.checked(r)), "features"))


def _stream_decided(spark, sf_dir, alarms_only=False):
    def job(records):
        made = jobs.stream_decisions(records, THRESHOLD, RUN, WARMUP)
        return made.filter("alarm") if alarms_only else made

    return _streamed(spark, sf_dir, job, "decisions")


@query
def stream_decisions(spark, sf_dir):
    return rounded(_stream_decided(spark, sf_dir).select(KEY, HOUR, "proba", "streak", "muted", "alarm"))


@query
def stream_alerts(spark, sf_dir):
    found = _stream_decided(spark, sf_dir, alarms_only=True)
    kept = found.select(KEY, F.col("event_ts").alias("timestamp"), "proba", "iculos_hours", F.col("streak").alias("consecutive_above"))
    return iso(rounded(kept), "timestamp")


@query
def stream_landing(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "landed"), shared_dir(spark, "landed-checkpoint")
    for path in _arrivals(spark, sf_dir):
        jobs.land(jobs.checked(jobs.read_records(spark, path)), out, checkpoint)
    return files.read_landing(spark, out).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_latest(spark, sf_dir):
    """Newest checked record per patient, kept up to date batch by batch."""
    out, checkpoint = shared_dir(spark, "latest"), shared_dir(spark, "latest-checkpoint")
    for path in _arrivals(spark, sf_dir):
        stream = jobs.checked(jobs.read_records(spark, path))
        jobs.run_batches(stream, jobs.keep_latest(spark, out), checkpoint)
    newest = spark.read.schema(stream.schema).parquet(f"{out}/v{jobs.newest_version(spark, out)}")
    return rounded(newest.select(KEY, HOUR, TIE, *VITALS))


# ---- models --------------------------------------------------------------------------------------

#: The second learner's settings; the first one's are the defaults of ``train_trees``.
SECOND = {"rounds": 5000, "depth": 8, "rate": 0.03, "min_leaf": 1, "patience": 200, "l1": 0.0, "l2": 3.0, "bins": 128, "seed": 7}


def _training(spark, sf_dir):
    """Features with their split, written once: training reads them many times. Only the train part is relabelled."""
    rows = inputs.vitals(spark, sf_dir)
    path = shared_dir(spark, "training")
    files.write_splits(features(rows), labels.patient_split(rows), path, **models.ROW_GROUPS)
    parts = {s: files.read_split(spark, path, s) for s in files.SPLITS}
    parts["train"] = written(labels.relabel_late(parts["train"], split="train").drop("relabelled"), "training", **models.ROW_GROUPS)
    return parts


@query
def training_labels(spark, sf_dir):
    """Rows and positive labels of each split as training sees them; val and test keep their labels."""
    parts = [
        part.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(LABEL).cast("long").alias("n_positive")).select(F.lit(s).alias("split"), "*")
        for s, part in _training(spark, sf_dir).items()
    ]
    return joins.union_all(*parts)


def _trained(spark, sf_dir, **learner):
    splits = _training(spark, sf_dir)
    names = models.default_inputs()
    return models.train_trees(splits["train"], names, splits["val"], **learner), names, splits


@query
def train_gbt(spark, sf_dir):
    model, names, splits = _trained(spark, sf_dir)
    return curves.auroc(curves.score_steps(models.score(model, splits["val"], names)))


@query
def train_second(spark, sf_dir):
    model, names, splits = _trained(spark, sf_dir, **SECOND)
    return curves.auroc(curves.score_steps(models.score(model, splits["val"], names)))


@query
def score_rows(spark, sf_dir):
    """Scores of the test split by a model that was saved and loaded again."""
    model, names, splits = _trained(spark, sf_dir)
    path = shared_dir(spark, "bundle")
    models.save_bundle(model, names, {"threshold": THRESHOLD, "min_consecutive": RUN, "warmup_hours": WARMUP}, path)
    model, names, _ = models.load_bundle(spark, path)
    return models.score(model, splits["test"], names).select(KEY, HOUR, LABEL, "proba")


def _scored_chain(spark, sf_dir) -> DataFrame:
    """Checked records through features, a saved and loaded bundle and its decision rule."""
    model, names, _ = _trained(spark, sf_dir)
    path = shared_dir(spark, "bundle")
    models.save_bundle(model, names, {"threshold": THRESHOLD, "min_consecutive": RUN, "warmup_hours": WARMUP}, path)
    model, names, params = models.load_bundle(spark, path)
    rows = features(rules.accepted(inputs.vitals(spark, sf_dir)), extra=(TIE, "event_ts"))
    scored = models.score(model, rows, names).select(KEY, HOUR, TIE, "event_ts", "proba")
    return alarms.online_decisions(scored, **params)


@query
def scored_decisions(spark, sf_dir):
    made = _scored_chain(spark, sf_dir)
    return made.select(KEY, HOUR, TIE, "proba", F.col("streak").cast("int").alias("streak"), "muted", "alarm")


@query
def scored_chain_check(spark, sf_dir):
    """How many records were checked in, decided on, and decided on without a probability or against the rule."""
    made = written(_scored_chain(spark, sf_dir), "scored")
    odd = ~F.col("proba").between(0, 1) | (F.col("alarm") != ((F.col("streak") >= RUN) & ~F.col("muted")))
    counted = made.agg(F.count(F.lit(1)).alias("n_decided"), F.coalesce(F.sum(F.when(odd, 1).otherwise(0)), F.lit(0)).alias("n_odd"))
    checked = rules.accepted(inputs.vitals(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(checked.scalar().alias("n_checked"), "n_decided", "n_odd")


@query
def feature_importance(spark, sf_dir):
    model, names, _ = _trained(spark, sf_dir)
    return models.feature_importance(spark, model, names)


@query
def permutation_importance(spark, sf_dir):
    model, names, splits = _trained(spark, sf_dir)
    return models.permutation_importance(model, splits["val"], names, names)


@query
def stack_scores(spark, sf_dir):
    """Both learners' scores stacked: fitted on val, applied to test."""
    first = inputs.scores(spark, sf_dir).select(KEY, HOUR, LABEL, "proba")
    both = joins.join_scores(first, inputs.second_scores(spark, sf_dir))
    split = labels.patient_split(first)
    model = models.stack(joins.keep_patients(both, split.filter("split = 'val'")))
    return models.apply_stack(model, joins.keep_patients(both, split.filter("split = 'test'")))


@query
def isotonic(spark, sf_dir):
    return models.calibrate(inputs.scores(spark, sf_dir)).select(KEY, HOUR, "proba", "calibrated")
