"""Threshold alert with hysteresis over metric samples, per device.

A device enters ALERT on a sample above ``hi`` and leaves it on a sample at
or below ``lo``; samples in between keep the state. While in ALERT a
reminder is due every ``every`` samples after the entering one. The start
state is NORMAL.

Scale: a device's series is cut into time chunks (``chunk``, a date_trunc
unit). Windows run per (device, chunk) only; what crosses chunk borders (the
incoming state, sample offsets, the episode start) is carried by windows over
one small summary per chunk, joined back once. So a device with a third of
all samples is spread over many tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.layouts import ALERT_ABOVE, NORMAL_AT_OR_BELOW, REMIND_EVERY


def argmax_per_bucket(samples: DataFrame, bucket: str = "hour", device: str = "device",
                      ts: str = "ts", value: str = "pct") -> DataFrame:
    """Per time bucket: the device with the highest value (ties: the lowest
    device, a name or a number), that value, and how many samples the bucket
    holds. Samples without a value count, but never win."""
    b = F.date_trunc(bucket, F.col(ts)).alias("bucket")
    best = samples.groupBy(b).agg(
        F.min(F.when(F.col(value).isNotNull(), F.struct(
            (-F.col(value)).alias("nv"), F.col(device).alias("d"), F.col(value).alias("v")))).alias("_m"),
        F.count(F.lit(1)).alias("samples"))
    return best.select("bucket", F.col("_m.d").alias("max_device"), F.col("_m.v").alias("max_value"), "samples")


def alert_events(samples: DataFrame, device: str = "device", ts: str = "ts",
                 order: str = "seq", value: str = "pct", hi: float = ALERT_ABOVE,
                 lo: float = NORMAL_AT_OR_BELOW, every: int = REMIND_EVERY,
                 chunk: str = "hour") -> DataFrame:
    """(device, ts, pct, event) for every ALERT entry, NORMAL return and
    REMINDER. ``order`` breaks ties between samples with the same time; a
    device is a name or a number, and NULL is a device too."""
    decisive = F.when(F.col(value) > hi, F.lit("ALERT")).when(F.col(value) <= lo, F.lit("NORMAL"))
    s = samples.select(F.col(device).alias("device"), F.col(ts).alias("ts"),
                       F.col(order).alias("seq"), F.col(value).alias("pct"),
                       decisive.alias("_d"), F.date_trunc(chunk, F.col(ts)).alias("_chunk"))
    wc = Window.partitionBy("device", "_chunk").orderBy("ts", "seq")
    s = s.withColumns({
        "_rn": F.row_number().over(wc),
        "_d_incl": F.last("_d", ignorenulls=True).over(wc.rowsBetween(Window.unboundedPreceding, 0)),
        "_d_excl": F.last("_d", ignorenulls=True).over(wc.rowsBetween(Window.unboundedPreceding, -1)),
    })
    # One summary per chunk: samples, first and last decisive sample, and the
    # last entry that does not depend on the state the chunk starts in.
    at = F.when(F.col("_d").isNotNull(), F.struct(F.col("_rn").alias("n"), F.col("_d").alias("d")))
    inner = F.when((F.col("_d") == "ALERT") & (F.col("_d_excl") == "NORMAL"), F.col("_rn"))
    summ = s.groupBy("device", "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), F.min(at).alias("_first"), F.max(at).alias("_last"),
        F.max(inner).alias("_inner"))
    prev = Window.partitionBy("device").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select("device", "_chunk", "_first", "_inner",
                       F.coalesce(F.sum("_n").over(prev), F.lit(0)).alias("_offset"),
                       F.coalesce(F.last(F.col("_last.d"), ignorenulls=True).over(prev), F.lit("NORMAL")).alias("_in_state"))
    outer = F.when((F.col("_first.d") == "ALERT") & (F.col("_in_state") == "NORMAL"), F.col("_first.n"))
    entry = F.col("_offset") + F.coalesce("_inner", outer)
    summ = summ.select(F.col("device").alias("_sd"), F.col("_chunk").alias("_sc"), "_offset", "_in_state",
                       F.max(entry).over(prev).alias("_in_enter"))
    s = s.join(summ, F.col("device").eqNullSafe(F.col("_sd")) & (F.col("_chunk") == F.col("_sc")), "inner")
    s = s.select("device", "ts", "seq", "pct", "_chunk", "_in_enter",
                 F.coalesce("_d_incl", "_in_state").alias("_state"), F.coalesce("_d_excl", "_in_state").alias("_prev"),
                 (F.col("_offset") + F.col("_rn")).alias("_idx"))
    enter = (F.col("_state") == "ALERT") & (F.col("_prev") == "NORMAL")
    start = F.coalesce(F.max(F.when(enter, F.col("_idx"))).over(wc.rowsBetween(Window.unboundedPreceding, 0)),
                       F.col("_in_enter"))
    since = F.col("_idx") - start
    event = (F.when(enter, F.lit("ALERT"))
             .when((F.col("_state") == "NORMAL") & (F.col("_prev") == "ALERT"), F.lit("NORMAL"))
             .when((F.col("_state") == "ALERT") & (since > 0) & (since % every == 0), F.lit("REMINDER")))
    return s.select("device", "ts", "pct", event.alias("event")).where(F.col("event").isNotNull())
