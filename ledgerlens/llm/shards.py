"""Deterministic range shards written as files, committed through manifests.

``range_sorted`` cuts a table into shards of about equal weight by ranges of
an integer id and sorts inside each. ``commit`` publishes the files that the
tasks of a writing job left under temporary names: the job returns manifest
rows, the rows are stored as a table, every temporary file named there is
renamed, and only then is the manifest itself published. Attempts that failed
or were repeated leave files no manifest names; they go with the temporary
folder. Readers open only files of the published manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.common import range_bounds, small_arrow_batches


def file_system(uri: str):
    """(pyarrow file system, path) of a folder: local, HDFS, S3 and so on."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def range_sorted(rows: DataFrame, key: str, weight: str, target: int, order: list[str],
                 also: DataFrame | None = None) -> DataFrame:
    """``rows`` with a ``_shard`` column, each shard whole in one partition
    and sorted by ``order``. Bounds come from an exact weight histogram of
    ``rows`` (see range_bounds); ``also`` are further rows of the same columns
    that are placed by the same bounds. Null keys go to shard 0."""
    spark = rows.sparkSession
    small_arrow_batches(spark)
    bounds = np.array(range_bounds(rows.select(key, weight), key, weight, target), np.int64)
    n = len(bounds)
    places = np.array(partition_keys(spark, n), np.int64)

    @pandas_udf("shard long, place long")
    def shard(keys: pd.Series, known: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(bounds, keys.to_numpy(np.int64), side="right") - 1
        at = np.where(known.to_numpy(bool), np.maximum(at, 0), 0)
        return pd.DataFrame({"shard": at, "place": places[at]})

    if also is not None:
        rows = rows.unionByName(also)
    number = F.coalesce(F.col(key).cast("long"), F.lit(0))
    names = rows.columns
    placed = rows.withColumn("_at", shard(number, F.col(key).isNotNull())).select(
        *names, F.col("_at.shard").alias("_shard"), F.col("_at.place").alias("_place"))
    return placed.repartition(n, "_place").sortWithinPartitions("_shard", *order).drop("_place")


def partition_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` hash partitions a number that is dealt to it, so
    each shard gets a partition of its own instead of sharing one by chance.
    A partition no number was found for takes the shard's number itself."""
    if n == 1:
        return [0]
    found = (spark.range(16 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("k")).collect())
    keys = {r["p"]: r["k"] for r in found}
    return [keys.get(p, p) for p in range(n)]


def temporary_name(folder: str) -> str:
    return f"{folder}/_temporary/{uuid.uuid4().hex}"


def commit(manifest: DataFrame, folder: str) -> DataFrame:
    """Publish the files of ``manifest`` (columns ``temporary`` and ``file``
    are names below ``folder``) and return the stored manifest."""
    spark = manifest.sparkSession
    held = f"{folder}/_temporary/manifest"
    manifest.write.parquet(held)
    rows = spark.read.schema(manifest.schema).parquet(held)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        for batch in batches:
            for old, new in zip(batch["temporary"].to_pylist(), batch["file"].to_pylist()):
                # A repeated task finds some files renamed already.
                if files.get_file_info(f"{root}/{old}").type.name != "NotFound":
                    files.move(f"{root}/{old}", f"{root}/{new}")
                elif files.get_file_info(f"{root}/{new}").type.name == "NotFound":
                    raise FileNotFoundError(f"{root}/{old}")
            yield pa.RecordBatch.from_arrays([batch["file"]], names=["file"])

    moved = rows.select("temporary", "file").mapInArrow(rename, "file string")
    rows.join(moved, "file").select(*manifest.columns).write.parquet(f"{folder}/manifest")
    files, root = file_system(folder)
    files.delete_dir(f"{root}/_temporary")
    return read_manifest(spark, folder, manifest.schema)


def read_manifest(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def spread(manifest: DataFrame) -> DataFrame:
    """One file per partition as far as the parallelism allows, so several
    tasks read the files."""
    return manifest.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 2), "file")
