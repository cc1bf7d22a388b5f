"""Write results straight to any Hadoop path (object store or HDFS)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerlens.sinks.publication import read_published, replace_partitions
from ledgerlens.sources.objects import copied, list_files


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
              single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV with a header and no index. An empty DataFrame still yields one
    header-only file, so downstream readers always find the run's file.
    A quote inside a field is doubled, as CSV readers expect.
    ``single_file`` coalesces to one task: only for small outputs."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", header).option("sep", sep)
     .option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path))
    return path


def publish_partitioned(df: DataFrame, path: str,
                        partition_cols: Sequence[str] = ("run_date", "file_type"),
                        fmt: str = "parquet") -> str:
    """Replace only the partitions present in ``df`` (a run's folder), with
    dynamic partition overwrite; other runs' partitions stay."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))
    return path


def publish_or_blank(df: DataFrame, path: str, by: str, values: Sequence[str]) -> str:
    """CSV below one ``by=value`` folder per value, all in one pass over the
    data; a value of ``values`` that has no rows gets a header-only file."""
    (df.write.mode("overwrite").partitionBy(by).option("header", True)
     .option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path))
    found = {r[0] for r in df.sparkSession.read.option("header", True).csv(path).select(by).distinct().collect()} \
        if _has_rows(df.sparkSession, path) else set()
    blank = df.drop(by).where(F.lit(False))
    for v in values:
        if v not in found:
            write_csv(blank, f"{path}/{by}={v}")
    return path


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned write left any file (it makes no folder for an
    empty table)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any("=" in s.getPath().getName() for s in files.listStatus(root))


ZONE_FILES = "name string, length bigint, md5 string, object string, run_date string, zone string"


def publish_zones(spark: SparkSession, landing: str, path: str, run_date: str,
                  modified: str = "mod") -> DataFrame:
    """Publish a landing folder's files as they are, byte by byte: those whose
    name starts with ``modified`` to the zone 'modified', the others to 'raw'.

    Objects are copied by tasks and compared by digest; the run's listing of
    each zone then replaces the one before (``replace_partitions``), so a file
    gone from the landing folder is gone from the zone, and readers see the
    files of one run. Returns ``read_zones``."""
    run = uuid.uuid4().hex
    root = landing.rstrip("/").rsplit("/", 1)[-1]
    name = F.regexp_replace("path", "^.*/" + re.escape(root) + "/", "")
    files = list_files(spark, landing, recursive=True).select(
        "uri", name.alias("name"), F.concat(F.lit(f"{path.rstrip('/')}/objects/{run}/"), name).alias("target"))
    zone = F.when(F.element_at(F.split("name", "/"), -1).startswith(modified), "modified").otherwise("raw")
    rows = copied(files).select("name", "length", "md5", F.col("target").alias("object"),
                                F.lit(run_date).alias("run_date"), zone.alias("zone"))
    zones = spark.createDataFrame([(run_date, "raw"), (run_date, "modified")], "run_date string, zone string")
    replace_partitions(rows, f"{path.rstrip('/')}/listing", zones, ("run_date", "zone"))
    return read_zones(spark, path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """(name, length, md5, object, run_date, zone) of the files in force."""
    schema = StructType.fromDDL(ZONE_FILES)
    return read_published(spark, f"{path.rstrip('/')}/listing", schema, ("run_date", "zone"))


MARKER_SCHEMA = StructType([
    StructField("job", StringType(), False),
    StructField("file_type", StringType(), True),
    StructField("run_date", StringType(), False),
    StructField("rows", LongType(), False),
])


def write_marker(spark: SparkSession, counts: DataFrame, path: str) -> str:
    """Publication rows (job, file_type, run_date, rows), written after the
    data: the trigger a downstream loader waits for. Markers of the same run
    date and file type are replaced, so a run repeated leaves one each.

    ``counts`` is a small DataFrame (one row per published partition),
    computed by Spark from the written data."""
    (counts.select(*[F.col(f.name).cast(f.dataType) for f in MARKER_SCHEMA.fields])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date", "file_type").parquet(path))
    return path


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MARKER_SCHEMA).parquet(path).select(*MARKER_SCHEMA.names)


def write_lines(lines: DataFrame, path: str, order: Sequence[Column], line_col: str = "line",
                mark: bool = False) -> str:
    """Lines as text in ``order``, one line each; ``mark`` starts the text with
    a byte-order mark.

    The lines are range-sorted, so the parts in the order of their names are
    the text (``cat part-*``), written by as many tasks as its size asks for.
    The order should be total, else ties fall as they come."""
    ordered = lines.orderBy(*order)
    text = F.col(line_col)
    if mark:
        # The first row of the first part is the text's first line.
        text = F.when(F.monotonically_increasing_id() == 0, F.concat(F.lit("\ufeff"), text)).otherwise(text)
    ordered.select(text.alias("value")).write.mode("overwrite").text(path)
    return path
