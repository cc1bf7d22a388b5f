"""Job health: completion records, overdue detection and the message.

Expected jobs and completion records are joined on the script name with a
null-safe equality (two missing names count as equal, as the original
merge does). The thresholds table is a fixed six-row literal, broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import duration_seconds, duration_text
from ledgerlens.layouts import (
    DAILY_PATTERN, INTERVAL_GATE, NO_PENDING_MESSAGE, OVERDUE_HOURS, PENDING, PENDING_FIELD_SEP,
    PENDING_LINE_SEP, PENDING_MESSAGE_HEAD, QUIET_MESSAGE_TIMES,
)


def completion_records(runs: DataFrame, script: str = "script", freq: str = "freq",
                       process: str = "process", server: str = "server",
                       start: str = "start", end: str = "end") -> DataFrame:
    """Completion rows: '<script>.py', frequency, process, server, start and
    end (text 'yyyyMMddHHmmss' parsed), 'H hours M minutes' (whole days not
    shown) and the full duration in seconds."""
    st = F.to_timestamp_ntz(F.col(start), F.lit("yyyyMMddHHmmss"))
    en = F.to_timestamp_ntz(F.col(end), F.lit("yyyyMMddHHmmss"))
    return runs.select(
        F.concat(F.col(script), F.lit(".py")).alias("scriptname"), F.col(freq).alias("freq"),
        F.col(process).alias("process"), F.col(server).alias("server"),
        st.alias("starttime"), en.alias("endtime"),
        duration_text(st, en).alias("total_completion_time"),
        duration_seconds(st, en).alias("duration_seconds"))


def _join_done(expected: DataFrame, done: DataFrame) -> DataFrame:
    d = done.select(F.col("scriptname").alias("_done_name"), "freq", "endtime")
    return expected.join(d, F.col("scriptname").eqNullSafe(F.col("_done_name")), "left") \
        .drop("_done_name")


def pending_daily(expected: DataFrame, done: DataFrame, now: str) -> DataFrame:
    """Daily and weekly jobs due by now (ETA before the clock, compared as
    'HH:mm:ss' text) with no completion: a left join whose right side has no
    frequency (a completion row without a frequency counts as missing)."""
    clock = F.date_format(F.lit(now).cast("timestamp_ntz"), "HH:mm:ss")
    daily = F.coalesce(F.col("frequency").rlike("(?i)" + DAILY_PATTERN), F.lit(False))
    due = expected.where((F.col("ETA") < clock) & daily)
    return _join_done(due, done).where(F.col("freq").isNull()).select(*PENDING)


def thresholds(spark: SparkSession, hours: Sequence[tuple[str, int]] = OVERDUE_HOURS) -> DataFrame:
    return spark.createDataFrame(list(hours), "frequency string, max_hours int")


def pending_interval(spark: SparkSession, expected: DataFrame, done: DataFrame, now: str,
                     run_date: str, hours: Sequence[tuple[str, int]] = OVERDUE_HOURS,
                     gate: str | None = INTERVAL_GATE, latest_only: bool = False) -> DataFrame:
    """Jobs that run several times a day and whose last end is more than the
    frequency's hours before their scheduled time (the clock when none is
    set), or that never ended. A set schedule time is a time of day on the
    run date. Before ``gate`` ('HH:mm') nothing is checked. Every completion of
    a job is compared, or with ``latest_only`` its last one."""
    if latest_only:
        done = done.groupBy("scriptname").agg(F.max("endtime").alias("endtime"), F.max_by("freq", "endtime").alias("freq"))
    if gate is not None and now[11:16] <= gate:
        return expected.select(*PENDING).where(F.lit(False))
    sched = F.coalesce(
        F.try_to_timestamp(F.concat_ws(" ", F.lit(run_date), F.col("schedule_time")),
                           F.lit("yyyy-MM-dd H:m:s")).cast("timestamp_ntz"),
        F.try_to_timestamp(F.col("schedule_time"), F.lit("yyyy-MM-dd H:m:s")).cast("timestamp_ntz"),
        F.lit(now).cast("timestamp_ntz"))
    jobs = expected.join(F.broadcast(thresholds(spark, hours)), on="frequency", how="inner") \
        .withColumn("_sched", sched)
    j = _join_done(jobs, done)
    diff = duration_seconds(F.col("endtime"), F.col("_sched"))
    late = (diff > F.col("max_hours") * 3600) | diff.isNull()
    return j.where(late).select(*PENDING)


def pending_all(daily: DataFrame, interval: DataFrame) -> DataFrame:
    return daily.unionByName(interval, allowMissingColumns=True)


def pending_messages(pending: DataFrame, now: str,
                     quiet_times: Sequence[str] = QUIET_MESSAGE_TIMES) -> DataFrame:
    """The notification as lines: (head, line), one row per pending job
    ('name---time---freq---path') under the message's heading. The rows sort
    by ``line``; a sender writes the head once and the lines after it, so
    their shape does not depend on how many there are. With no pending job,
    one 'none pending' row without a head at the quiet-hours times, else none.
    """
    line = F.concat_ws(PENDING_FIELD_SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("nan"))
                                           for c in PENDING])
    rows = pending.select(F.lit(PENDING_MESSAGE_HEAD).alias("head"), line.alias("line"))
    if now[11:16] not in quiet_times:
        return rows
    none = pending.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit(None).cast("string").alias("head"), F.lit(NO_PENDING_MESSAGE).alias("line"))
    return rows.unionByName(none)


def message_text(rows: DataFrame) -> DataFrame:
    """The notification as one text, for a bounded number of pending jobs: it
    gathers all lines in one row."""
    return rows.groupBy("head").agg(F.array_sort(F.collect_list("line")).alias("l")).select(
        F.concat(F.coalesce("head", F.lit("")), F.array_join("l", PENDING_LINE_SEP)).alias("message"))
