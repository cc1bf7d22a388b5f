"""Structured Streaming: process reports as they land, and the threshold
alert as a stateful stream."""

from ledgerlens.streaming.arrival import on_arrival, wait_for_arrival  # noqa: F401
from ledgerlens.streaming.alerts import hysteresis_stream, ordered_hysteresis_stream  # noqa: F401
