"""Threshold alert with hysteresis as a stateful stream.

Per device the state (current level, samples seen, sample index of the
current alert episode's start) is kept between micro-batches with
``applyInPandasWithState``. A device's samples are handled as arrays (forward
fill of decisive levels), not row by row.

``hysteresis_stream`` takes samples that arrive in time order, as one sampler
emits them (within a batch they are sorted), and answers at once.
``ordered_hysteresis_stream`` takes samples in any order within a delay: it
holds them in the state until the watermark has passed them. A device's group
holds what the source admits per micro-batch: give the source a trigger limit
(``maxFilesPerTrigger`` or ``maxBytesPerTrigger``), which delays data but
drops none. A device is a name or a number, of the input's type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerlens.layouts import ALERT_ABOVE, NORMAL_AT_OR_BELOW, REMIND_EVERY

STATE_SCHEMA = "level string, seen long, start long"
START = ("NORMAL", 0, -1)


def advance(state: tuple[str, int, int], pct: np.ndarray, hi: float, lo: float, every: int) -> tuple[tuple, np.ndarray]:
    """The state after samples in time order, and each sample's event (or
    None)."""
    if not len(pct):
        return state, np.zeros(0, object)
    # Numbers only: a stream has many small groups, and frames cost each of them
    # far more than its samples do.
    level, seen, start = state
    n = len(pct)
    high = pct > hi
    last = np.maximum.accumulate(np.where(high | (pct <= lo), np.arange(n), -1))
    cur = np.where(last >= 0, high[last], level == "ALERT")
    prev = np.concatenate([[level == "ALERT"], cur[:-1]])
    idx = seen + np.arange(1, n + 1)
    enter, back = cur & ~prev, ~cur & prev
    entered = np.maximum.accumulate(np.where(enter, idx, -1))
    st = np.where(entered >= 0, entered, start)
    since = idx - st
    event = np.full(n, None, object)
    event[cur & (st >= 0) & (since > 0) & (since % every == 0)] = "REMINDER"
    event[back] = "NORMAL"
    event[enter] = "ALERT"
    return ("ALERT" if cur[-1] else "NORMAL", int(idx[-1]), int(st[-1])), event


def _handler(hi: float, lo: float, every: int):
    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "seq"], kind="stable")
        pct = pdf["pct"].to_numpy(dtype="float64")
        after, event = advance(state.get if state.exists else START, pct, hi, lo, every)
        state.update(after)
        mask = event != None  # noqa: E711  (elementwise test on an object array)
        yield pd.DataFrame({"device": pdf["device"].to_numpy()[mask], "ts": pdf["ts"].to_numpy()[mask],
                            "pct": pct[mask], "event": event[mask]})
    return step


def hysteresis_stream(samples: DataFrame, hi: float = ALERT_ABOVE, lo: float = NORMAL_AT_OR_BELOW,
                      every: int = REMIND_EVERY) -> DataFrame:
    """Streaming (device, ts, seq, pct) -> (device, ts, pct, event)."""
    kind = samples.schema["device"].dataType.simpleString()
    return samples.groupBy("device").applyInPandasWithState(
        _handler(hi, lo, every), f"device {kind}, ts timestamp_ntz, pct double, event string", STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout)


#: Samples that wait in the state: time in microseconds, number, value.
WAITING = np.dtype([("ts", "<i8"), ("seq", "<i8"), ("pct", "<f8")])


def _ordering_handler(hi: float, lo: float, every: int):
    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        after, before, held = START, -(1 << 62), np.zeros(0, WAITING)
        if state.exists:
            *after, before, raw = state.get
            held = np.frombuffer(raw, WAITING)
        new = [held]
        for pdf in batches:
            rows = np.empty(len(pdf), WAITING)
            rows["ts"] = pdf["ts"].to_numpy().astype("datetime64[us]").astype(np.int64)
            rows["seq"], rows["pct"] = pdf["seq"].to_numpy(), pdf["pct"].to_numpy(dtype="float64")
            # Its place has passed: answers after it are given already.
            new.append(rows[rows["ts"] > before])
        held = np.concatenate(new)
        held = held[np.lexsort((held["pct"], held["seq"], held["ts"]))]
        # Nothing at or before the watermark can come any more.
        passed = state.getCurrentWatermarkMs()
        before = max(before, passed * 1000)
        ready = int(np.searchsorted(held["ts"], before, "right"))
        done, held = held[:ready], held[ready:]
        after, event = advance(tuple(after), done["pct"], hi, lo, every)
        state.update((*after, before, held.tobytes()))
        if len(held):
            state.setTimeoutTimestamp(max(passed + 1, -(-int(held["ts"][0]) // 1000)))
        mask = event != None  # noqa: E711  (elementwise test on an object array)
        if mask.any():
            yield pd.DataFrame({"device": [key[0]] * int(mask.sum()), "ts": done["ts"][mask].astype("datetime64[us]"),
                                "pct": done["pct"][mask], "event": event[mask]})
    return step


def ordered_hysteresis_stream(samples: DataFrame, delay: str, hi: float = ALERT_ABOVE, lo: float = NORMAL_AT_OR_BELOW,
                              every: int = REMIND_EVERY) -> DataFrame:
    """Streaming (device, ts, seq, pct) in any order -> (device, ts, pct,
    event) as if the samples had come in order of (ts, seq).

    A sample may come up to ``delay`` after a later one was seen; the stream
    waits that long before it answers, by the samples' own time, also for
    devices that fall silent. Later ones are left out (most are counted by the
    stream's progress as numRowsDroppedByWatermark). The state of a device holds
    its samples of the last ``delay``. ``ts`` is taken as UTC."""
    kind = samples.schema["device"].dataType.simpleString()
    timed = samples.select("device", F.col("ts").cast("timestamp").alias("ts"), "seq", "pct").withWatermark("ts", delay)
    return timed.groupBy("device").applyInPandasWithState(
        _ordering_handler(hi, lo, every), f"device {kind}, ts timestamp_ntz, pct double, event string",
        f"{STATE_SCHEMA}, passed long, held binary", "append", GroupStateTimeout.EventTimeTimeout)
