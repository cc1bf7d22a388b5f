"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir

#: Words are maximal runs of anything but these ASCII white-space characters.
SPACE_CLASS = r"\x20\x09-\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later
    jobs read the files, so a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text (null: empty) under names of our own, so
    other columns of the table never clash with an operator's columns."""
    return docs.select(F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


#: Equal-width bins of one histogram pass over the sort key (fixed, so the
#: driver sees at most this many rows per pass).
HISTOGRAM_BINS = 4096


def range_bounds(keyed: DataFrame, key: str, weight: str, target: int) -> list[int]:
    """Lower key bounds of shards of about ``target`` total weight each.

    The bounds come from an exact weight histogram of fixed-width key bins,
    not from a sample, so equal input gives equal shards whatever the
    partitioning. While some bin outweighs the target and is wider than one
    key, that bin alone is split into narrower bins in another pass. Shard k
    holds keys in [bounds[k], bounds[k+1]); shard 0 also takes null keys.
    """
    if target < 1:
        raise ValueError("target must be positive")
    k = F.col(key).cast("decimal(20,0)")
    lo, hi = keyed.agg(F.min(k), F.max(k)).first()
    if lo is None:
        return [0]
    todo, bins = [(int(lo), int(hi) + 1)], {}
    while todo:
        # One pass for up to 16 spans: each key falls in at most one of them.
        frames = [(a, b, -(-(b - a) // HISTOGRAM_BINS)) for a, b in todo[:16]]
        todo = todo[16:]
        start = F.lit(None).cast("decimal(20,0)")
        size = F.lit(None).cast("decimal(20,0)")
        for a, b, width in frames:
            inside = (k >= F.lit(a)) & (k < F.lit(b))
            start = F.when(inside, F.lit(a) + F.floor((k - F.lit(a)) / F.lit(width)) * F.lit(width)).otherwise(start)
            size = F.when(inside, F.lit(width)).otherwise(size)
        rows = (keyed.select(start.cast("decimal(20,0)").alias("a"), size.cast("decimal(20,0)").alias("w"),
                             F.col(weight).alias("v"))
                .filter("a IS NOT NULL").groupBy("a", "w").agg(F.sum("v").alias("v")).collect())
        for r in rows:
            a, w, v = int(r["a"]), int(r["w"]), int(r["v"] or 0)
            if v > target and w > 1:
                todo.append((a, a + w))
            else:
                bins[a] = v
    bounds, filled = [], 0
    for a in sorted(bins):
        if not bounds or (filled and filled + bins[a] > target):
            bounds.append(a)
            filled = 0
        filled += bins[a]
    return bounds


def small_arrow_batches(spark: SparkSession) -> None:
    """Bound the rows of one Arrow batch, so a run of very long texts does
    not meet in one Python worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
