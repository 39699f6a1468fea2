"""What a care team reads: patient board, alert feed, acknowledgements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.rules import risk_band
from vigil.operators.metrics import count_where
from vigil.schema import KEY, ORDER

MAY_ACKNOWLEDGE = ("admin", "doctor")


def _iso(ts):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def patient_states(decisions: DataFrame, ts="event_ts") -> DataFrame:
    """Latest probability, alarm, time and hours per patient from one decision log."""
    state = F.struct(
        F.col("proba").alias("latest_proba"), F.col("alarm").alias("latest_alarm"),
        _iso(ts).alias("last_update"), "iculos_hours",
    )
    newest = F.max_by(state, F.struct(*ORDER))
    return decisions.groupBy(KEY).agg(newest.alias("s")).select(KEY, "s.*")


def joined_states(probas: DataFrame, predictions: DataFrame, meta: DataFrame) -> DataFrame:
    """The same from three stores, each kept on its own: whoever has a probability is on the board.

    ``probas``: patient, order, proba. ``predictions``: patient, order, alarm, event_ts.
    ``meta``: patient, order, iculos_hours.
    """
    def newest(df, **columns):
        row = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
        return df.groupBy(KEY).agg(F.max_by(row, F.struct(*ORDER)).alias("s")).select(KEY, "s.*")

    out = newest(probas, latest_proba="proba")
    out = out.join(newest(predictions, latest_alarm="alarm", ts="event_ts"), KEY, "left")
    out = out.join(newest(meta, iculos_hours="iculos_hours"), KEY, "left")
    return out.select(
        KEY, "latest_proba", F.coalesce("latest_alarm", F.lit(False)).alias("latest_alarm"),
        F.coalesce(_iso("ts"), F.lit("")).alias("last_update"), F.coalesce("iculos_hours", F.lit(0)).alias("iculos_hours"),
    )


def by_risk(states: DataFrame) -> DataFrame:
    return states.orderBy(F.desc("latest_proba"), KEY)


def live_states(alerts: DataFrame) -> DataFrame:
    """What an open board learns from the alert stream alone."""
    state = F.struct(
        F.col("proba").alias("latest_proba"), F.lit(True).alias("latest_alarm"), _iso("timestamp").alias("last_update"),
        "iculos_hours",
    )
    return alerts.groupBy(KEY).agg(F.max_by(state, F.struct("timestamp", "iculos_hours")).alias("s")).select(KEY, "s.*")


def overlay(snapshot: DataFrame, live: DataFrame) -> DataFrame:
    """Live state replaces the polled one only when it is strictly newer; unknown patients are added."""
    columns = [c for c in snapshot.columns if c != KEY]
    both = snapshot.alias("s").join(live.alias("l"), KEY, "full_outer")
    take_live = F.col("s.last_update").isNull() | (F.col("l.last_update") > F.col("s.last_update"))
    return both.select(KEY, *[F.when(take_live, F.col(f"l.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in columns])


def alert_feed(alerts: DataFrame, patient=None, acknowledged=None, limit: int = 50) -> DataFrame:
    """Newest alerts first, optionally of one patient or one acknowledgement state (limit 1 to 200)."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be between 1 and 200")
    out = alerts
    if patient:
        out = out.filter(F.col(KEY) == patient)
    if acknowledged is not None:
        out = out.filter(F.col("acknowledged") == acknowledged)
    return out.orderBy(F.desc("timestamp"), KEY).limit(limit)


def live_feed(alerts: DataFrame, keep: int = 200) -> DataFrame:
    return alerts.orderBy(F.desc("timestamp"), KEY).limit(keep)


def fold_acks(alerts: DataFrame, acks: DataFrame, users: DataFrame) -> DataFrame:
    """Alerts with who acknowledged them last; only active admins and doctors count.

    ``acks``: alert_id, username, ack_ts, seq (order of arrival).
    """
    allowed = users.filter(F.col("is_active") & F.col("role").isin(*MAY_ACKNOWLEDGE)).select("username")
    last = F.max_by(F.struct("username", "ack_ts"), F.struct("ack_ts", "seq"))
    folded = acks.join(allowed, "username", "left_semi").groupBy("alert_id").agg(last.alias("a"))
    out = alerts.join(folded, "alert_id", "left")
    return out.select(
        *alerts.columns, F.col("a").isNotNull().alias("acknowledged"), F.col("a.username").alias("acknowledged_by"),
        F.col("a.ack_ts").alias("acknowledged_at"),
    )


def orphan_acks(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """Acknowledgements of alerts that do not exist."""
    return acks.join(alerts.select("alert_id"), "alert_id", "left_anti")


def board_counts(states: DataFrame, alerts: DataFrame, search: str = "") -> DataFrame:
    """Patients per risk band and alerts per acknowledgement state, for patients whose id matches."""
    like = F.col(KEY).contains(search)
    band = states.filter(like).select(risk_band("latest_proba").alias("band"))
    tabs = band.agg(
        F.count(F.lit(1)).alias("n_all"), *[count_where(F.col("band") == b).alias(f"n_{b}") for b in ("critical", "warn", "ok")]
    )
    marks = alerts.filter(like).agg(
        count_where(F.col("acknowledged")).alias("n_acknowledged"), count_where(~F.col("acknowledged")).alias("n_open")
    )
    return tabs.withColumns({n: marks.select(n).scalar() for n in marks.columns})
