"""Metric samples: the highest device per time bucket, and threshold alerts
with hysteresis. Samples are the events table: device = a name made of the user,
value = the event's value (it crosses 79 and 90 often)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.alerts import alert_events, argmax_per_bucket
from ledgerlens.plans.common import table


def samples_from_events(events: DataFrame) -> DataFrame:
    return events.select(F.concat(F.lit("vol-"), F.col("user_id").cast("string")).alias("device"), "ts", F.col("event_id").alias("seq"),
                         F.col("value").alias("pct"))


def q_metric_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return argmax_per_bucket(samples_from_events(table(spark, sf_dir, "events")))


def q_hysteresis_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_events(samples_from_events(table(spark, sf_dir, "events")))


HYSTERESIS_SQL = """
WITH s AS (
  SELECT 'vol-' || user_id AS device, ts, event_id, value AS pct,
    CASE WHEN value > 90 THEN 'ALERT' WHEN value <= 79 THEN 'NORMAL' END AS d
  FROM events),
w AS (
  SELECT *, row_number() OVER (PARTITION BY device ORDER BY ts, event_id) AS idx,
    coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY device ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'NORMAL') AS state,
    coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY device ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'NORMAL') AS prev_state
  FROM s),
e AS (
  SELECT *, max(CASE WHEN state = 'ALERT' AND prev_state = 'NORMAL' THEN idx END)
    OVER (PARTITION BY device ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start_idx
  FROM w)
SELECT device, ts, pct,
  CASE WHEN state = 'ALERT' AND prev_state = 'NORMAL' THEN 'ALERT'
       WHEN state = 'NORMAL' AND prev_state = 'ALERT' THEN 'NORMAL'
       ELSE 'REMINDER' END AS event
FROM e
WHERE state <> prev_state
   OR (state = 'ALERT' AND idx > start_idx AND (idx - start_idx) % 60 = 0)
"""

ORACLE = {
    "metric_argmax": """
SELECT date_trunc('hour', ts) AS bucket, 'vol-' || user_id AS max_device, value AS max_value,
  count(*) OVER (PARTITION BY date_trunc('hour', ts)) AS samples
FROM events
QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY value DESC, 'vol-' || user_id ASC) = 1""",
    "hysteresis_alert": HYSTERESIS_SQL,
}

QUERIES = {
    "metric_argmax": q_metric_argmax,
    "hysteresis_alert": q_hysteresis_alert,
}
