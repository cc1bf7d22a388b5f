"""Streaming queries over the events table as a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import utc_to_pacific_text
from ledgerlens.plans.common import table
from ledgerlens.plans.metrics import HYSTERESIS_SQL, samples_from_events
from ledgerlens.session import scratch_path
from ledgerlens.streaming import hysteresis_stream, on_arrival, ordered_hysteresis_stream, wait_for_arrival


def q_stream_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events processed as they land: Pacific time text and value."""
    schema = table(spark, sf_dir, "events").schema
    root = scratch_path(spark, "arrival")

    def process(batch: DataFrame) -> DataFrame:
        return batch.select("event_id", utc_to_pacific_text(F.col("ts")).alias("ts_pacific"), "value")

    on_arrival(spark, sf_dir, schema, process, f"{root}/out", f"{root}/checkpoint",
               glob="events.parquet")
    return spark.read.parquet(f"{root}/out").select("event_id", "ts_pacific", "value")


def q_stream_hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold alert as a stateful stream; same events as the batch
    query."""
    schema = table(spark, sf_dir, "events").schema
    root = scratch_path(spark, "stream-alert")
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf_dir))
    alerts = hysteresis_stream(samples_from_events(stream))
    q = (alerts.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


#: How late samples of the shuffled stream may come.
LATENESS = "6 hours"


def q_stream_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold alert over samples that come up to six hours late: they
    land by arrival time in several files, one a micro-batch. A last sample of
    a device of its own, far ahead, lets the watermark pass the others. Same
    events as the batch query."""
    e = table(spark, sf_dir, "events")
    root = scratch_path(spark, "stream-late")
    late = F.pmod(F.xxhash64("event_id"), F.lit(6 * 3600)).cast("int")
    arrival = F.unix_timestamp(F.col("ts").cast("timestamp")) + late
    first, last = e.select(F.min(arrival), F.max(arrival)).first()
    batches = 5
    number = F.floor((arrival - first) * batches / (last - first + 1))
    for n in range(batches):
        samples_from_events(e.where(number == n)).coalesce(1).write.mode("append").parquet(f"{root}/in")
    ahead = spark.createDataFrame([("heartbeat", None, -1, 0.0)], "device string, ts timestamp_ntz, seq bigint, pct double")
    ahead.withColumn("ts", F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(ahead.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    alerts = ordered_hysteresis_stream(stream, LATENESS)
    q = (alerts.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def q_stream_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting for the events: once they are there, once nothing comes within
    the budget and an empty result is published."""
    e = table(spark, sf_dir, "events")
    root = scratch_path(spark, "wait")
    e.where(F.lit(False)).write.parquet(f"{root}/nothing")

    def process(batch: DataFrame) -> DataFrame:
        return batch.select("event_id", utc_to_pacific_text(F.col("ts")).alias("ts_pacific"), "value")

    out = None
    for case, folder, glob, budget in (("arrived", sf_dir, "events.parquet", 120), ("nothing came", f"{root}/nothing", "*.csv", 3)):
        sink = f"{root}/out/{case[:7]}"
        came = wait_for_arrival(spark, folder, e.schema, process, sink, f"{root}/checkpoint/{case[:7]}", budget, glob=glob)
        back = spark.read.parquet(sink)
        found = back.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")).select(
            F.lit(case).alias("case_name"), F.lit(came).alias("arrived"), "rows", "ids", F.lit(len(back.columns) - 1).alias("columns"))
        out = found if out is None else out.unionByName(found)
    return out


ORACLE = {
    "stream_arrival": """
SELECT event_id,
  strftime(timezone('America/Los_Angeles', date_trunc('second', ts) AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M:%S') AS ts_pacific,
  value
FROM events""",
    "stream_hysteresis": HYSTERESIS_SQL,
    "stream_shuffled": HYSTERESIS_SQL,
    "stream_wait": """
SELECT 'arrived' AS case_name, true AS arrived, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids, 3 AS columns FROM events
UNION ALL SELECT 'nothing came', false, 0, NULL, 3""",
}

QUERIES = {
    "stream_arrival": q_stream_arrival,
    "stream_hysteresis": q_stream_hysteresis,
    "stream_shuffled": q_stream_shuffled,
    "stream_wait": q_stream_wait,
}
