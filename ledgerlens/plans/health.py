"""Job health queries. Expected jobs are rendered from ``customer`` (one
script per customer, frequency, schedule and ETA by rule) and completion
records from the finished ``orders`` of each customer (start and end times
by rule, every 9th without a frequency)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.layouts import NO_PENDING_MESSAGE, OVERDUE_HOURS, PENDING_FIELD_SEP, PENDING_LINE_SEP, PENDING_MESSAGE_HEAD
from ledgerlens.operators.health import (
    completion_records, message_text, pending_all, pending_daily, pending_interval, pending_messages,
)
from ledgerlens.plans.common import RUN_DATE, RUN_TS, table

_FREQS = ["daily", "weekly(Mon)", "6hour", "3hour", "2hour", "hourly", "30min", "10min", "Daily"]


def render_expected(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey") % 10
    freq = F.try_element_at(F.array(*[F.lit(f) for f in _FREQS]), (k + 1).cast("int"))  # 10th: NULL
    minute_of_day = (F.col("c_custkey") * 7) % 1440
    eta = F.format_string("%02d:%02d:00", (minute_of_day / 60).cast("int"), (minute_of_day % 60).cast("int"))
    interval = k.between(2, 7)
    sched = (F.when(~interval, F.format_string("%02d:%02d:00", F.col("c_nationkey") % 24, F.lit(0)))
             .when(F.col("c_custkey") % 20 == 3, F.lit("01:00:00")))
    return customer.select(
        F.concat(F.lit("script_"), F.col("c_custkey").cast("string"), F.lit(".py")).alias("scriptname"),
        freq.alias("frequency"), sched.alias("schedule_time"), eta.alias("ETA"),
        F.concat(F.lit("D:\\jobs\\"), F.lower("c_mktsegment")).alias("scriptpath"))


def render_runs(orders: DataFrame) -> DataFrame:
    o = orders.where(F.col("o_orderstatus") == "F")
    start = F.lit(RUN_DATE).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("o_orderkey") % 540).cast("int"))
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("o_totalprice") % 100).cast("int"))
    return o.select(
        F.concat(F.lit("script_"), F.col("o_custkey").cast("string")).alias("script"),
        F.when(F.col("o_orderkey") % 9 != 0, F.lit("daily")).alias("freq"),
        F.lit("Marketplace").alias("process"),
        F.concat(F.lit("node-"), (F.col("o_orderkey") % 4).cast("string")).alias("server"),
        F.date_format(start, "yyyyMMddHHmmss").alias("start"),
        F.date_format(end, "yyyyMMddHHmmss").alias("end"))


def _inputs(spark: SparkSession, sf_dir: str):
    expected = render_expected(table(spark, sf_dir, "customer"))
    done = completion_records(render_runs(table(spark, sf_dir, "orders")))
    return expected, done


def q_job_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion records from run start/end text; runs may last days."""
    o = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("o_custkey") % 3000).cast("int"))
    runs = o.select(F.concat(F.lit("job_"), F.col("o_orderkey").cast("string")).alias("script"),
                    F.lit("daily").alias("freq"), F.lit("Marketplace").alias("process"),
                    F.lit("node-1").alias("server"),
                    F.date_format(start, "yyyyMMddHHmmss").alias("start"),
                    F.date_format(end, "yyyyMMddHHmmss").alias("end"))
    return completion_records(runs)


def q_job_pending_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, done = _inputs(spark, sf_dir)
    return pending_daily(expected, done, RUN_TS)


def q_job_pending_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, done = _inputs(spark, sf_dir)
    return pending_interval(spark, expected, done, RUN_TS, RUN_DATE)


def _pending(spark, sf_dir):
    expected, done = _inputs(spark, sf_dir)
    return pending_all(pending_daily(expected, done, RUN_TS),
                       pending_interval(spark, expected, done, RUN_TS, RUN_DATE))


def q_job_pending_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(spark, sf_dir)


def q_job_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_messages(_pending(spark, sf_dir), RUN_TS)


def q_job_message_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notification as the one text that is sent."""
    return message_text(pending_messages(_pending(spark, sf_dir), RUN_TS))


def q_job_pending_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval jobs whose last completion is overdue: one row a job."""
    expected, done = _inputs(spark, sf_dir)
    return pending_interval(spark, expected, done, RUN_TS, RUN_DATE, latest_only=True)


def q_job_message_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message at a quiet time when no job is pending: of the pending
    jobs only those without a script name are asked for, and there are none."""
    quiet = RUN_DATE + " 07:15:00"
    expected, done = _inputs(spark, sf_dir)
    return pending_messages(pending_daily(expected, done, quiet).where(F.col("scriptname").isNull()), quiet)


def q_job_pending_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval jobs before the gate's time: nothing is checked yet."""
    expected, done = _inputs(spark, sf_dir)
    return pending_interval(spark, expected, done, RUN_DATE + " 00:10:00", RUN_DATE)


_EXPECTED_SQL = """
expected AS (
  SELECT 'script_' || c_custkey || '.py' AS scriptname,
    CASE c_custkey % 10 """ + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(_FREQS)) + """ END AS frequency,
    CASE WHEN c_custkey % 10 NOT BETWEEN 2 AND 7 THEN printf('%02d:%02d:00', c_nationkey % 24, 0)
         WHEN c_custkey % 20 = 3 THEN '01:00:00' END AS schedule_time,
    printf('%02d:%02d:00', CAST(floor(((c_custkey * 7) % 1440) / 60) AS INTEGER), CAST((c_custkey * 7) % 1440 % 60 AS INTEGER)) AS ETA,
    'D:\\jobs\\' || lower(c_mktsegment) AS scriptpath,
    c_custkey % 10 AS k
  FROM customer),
done AS (
  SELECT 'script_' || o_custkey || '.py' AS scriptname,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'daily' END AS freq,
    TIMESTAMP '""" + RUN_DATE + """ 00:00:00' + to_minutes(CAST(o_orderkey % 540 AS BIGINT))
      + to_minutes(CAST(floor(o_totalprice % 100) AS BIGINT)) AS endtime
  FROM orders WHERE o_orderstatus = 'F'),
thr AS (SELECT * FROM (VALUES """ + ", ".join(f"('{f}', {h})" for f, h in OVERDUE_HOURS) + """) t(frequency, max_hours)),
daily AS (
  SELECT e.scriptname, e.schedule_time, e.frequency, e.scriptpath
  FROM expected e LEFT JOIN done d ON e.scriptname IS NOT DISTINCT FROM d.scriptname
  WHERE e.ETA < '""" + RUN_TS[11:] + """' AND coalesce(regexp_matches(e.frequency, '(?i)daily|weekly'), false)
    AND d.freq IS NULL),
interval_jobs AS (
  SELECT e.scriptname, e.schedule_time, e.frequency, e.scriptpath
  FROM expected e JOIN thr USING (frequency)
  LEFT JOIN done d ON e.scriptname IS NOT DISTINCT FROM d.scriptname
  WHERE epoch(coalesce(CAST('""" + RUN_DATE + """ ' || e.schedule_time AS TIMESTAMP), TIMESTAMP '""" + RUN_TS + """'))
        - epoch(d.endtime) > thr.max_hours * 3600
     OR d.endtime IS NULL)
"""

_MESSAGE_SQL = "WITH " + _EXPECTED_SQL + """,
p AS (SELECT * FROM daily UNION ALL SELECT * FROM interval_jobs)
SELECT '""" + PENDING_MESSAGE_HEAD.replace("\n", "' || chr(10) || '") + """' AS head,
  coalesce(scriptname, 'nan') || '""" + PENDING_FIELD_SEP + """' || coalesce(schedule_time, 'nan') || '""" + PENDING_FIELD_SEP + """' ||
  coalesce(frequency, 'nan') || '""" + PENDING_FIELD_SEP + """' || coalesce(scriptpath, 'nan') AS line
FROM p"""

ORACLE = {
    "job_completion": """
WITH r AS (
  SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS s,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + to_minutes(CAST(o_custkey % 3000 AS BIGINT)) AS e
  FROM orders)
SELECT 'job_' || o_orderkey || '.py' AS scriptname, 'daily' AS freq, 'Marketplace' AS process,
  'node-1' AS server, s AS starttime, e AS endtime,
  CAST(floor(((epoch(e) - epoch(s)) % 86400) / 3600) AS BIGINT) || ' hours ' ||
  CAST(floor(((epoch(e) - epoch(s)) % 3600) / 60) AS BIGINT) || ' minutes' AS total_completion_time,
  CAST(epoch(e) - epoch(s) AS BIGINT) AS duration_seconds
FROM r""",
    "job_pending_daily": "WITH " + _EXPECTED_SQL + "SELECT * FROM daily",
    "job_pending_interval": "WITH " + _EXPECTED_SQL + "SELECT * FROM interval_jobs",
    "job_pending_all": "WITH " + _EXPECTED_SQL + "SELECT * FROM daily UNION ALL SELECT * FROM interval_jobs",
    "job_message": _MESSAGE_SQL,
    "job_message_text": f"""
SELECT head || string_agg(line, '{PENDING_LINE_SEP[:-1]}' || chr(10) ORDER BY line) AS message FROM ({_MESSAGE_SQL}) m GROUP BY head""",
    "job_pending_latest": "WITH " + _EXPECTED_SQL.replace("thr AS (", "last AS (SELECT scriptname, max(endtime) AS endtime FROM done GROUP BY scriptname), thr AS (")
        .replace("""  FROM expected e JOIN thr USING (frequency)
  LEFT JOIN done d""", """  FROM expected e JOIN thr USING (frequency)
  LEFT JOIN last d""") + "SELECT * FROM interval_jobs",
    "job_message_empty": "WITH " + _EXPECTED_SQL + """
SELECT CAST(NULL AS VARCHAR) AS head, '""" + NO_PENDING_MESSAGE + """' AS line
WHERE NOT EXISTS (SELECT * FROM daily WHERE scriptname IS NULL)""",
    "job_pending_gate": "WITH " + _EXPECTED_SQL + "SELECT * FROM interval_jobs WHERE false",
}

QUERIES = {
    "job_completion": q_job_completion,
    "job_pending_daily": q_job_pending_daily,
    "job_pending_interval": q_job_pending_interval,
    "job_pending_all": q_job_pending_all,
    "job_message": q_job_message,
    "job_message_empty": q_job_message_empty,
    "job_message_text": q_job_message_text,
    "job_pending_latest": q_job_pending_latest,
    "job_pending_gate": q_job_pending_gate,
}
