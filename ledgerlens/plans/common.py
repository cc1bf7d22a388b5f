"""Shared pieces of the registered queries: table loading and the fixed run
parameters (a run's date and clock are job arguments, never read from the
machine clock, so results repeat)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlens.sources.objects import CHUNK, file_system

RUN_DATE = "2024-10-21"            # a Monday
RUN_TS = "2024-10-21 09:30:00"     # the job's 'now'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Characters of a text that place a row in a range; its order within the range is by all of them.
_RANGE_CHARS = 64


def land_files(lines: DataFrame, root: str, order: list[Column], name: str = "file", line: str = "line",
               codec: str | None = None) -> str:
    """Rendered lines as files: one text file per ``name`` (a path below
    ``root``, folders included), lines in ``order``.

    No task sorts a file: ranges of (``name``, ``order``) are sorted and written
    as compressed parts, and a file is its parts one after the other, streamed
    by a task that holds none of them. With ``codec`` (gzip, bzip2) the file
    stays compressed and its name ends in .gz or .bz2; readers cut a .bz2 file
    into ranges as they do plain text."""
    spark = lines.sparkSession
    staged, rendered = f"{root}/_staged", f"{root}/_rendered"
    # Finding the ranges reads the lines three times; they are rendered once.
    lines.write.option("compression", "zstd").parquet(rendered)
    lines = spark.read.schema(lines.schema).parquet(rendered)
    by = [F.substring(c, 1, _RANGE_CHARS) if f.dataType == StringType() else c
          for c, f in zip(order, lines.select(*order).schema)]
    (lines.repartitionByRange(F.col(name), *by).sortWithinPartitions(name, *order).select(lines[line].alias("value"), name)
     .write.partitionBy(name).option("compression", codec or "gzip").text(staged))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path(rendered), True)
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = []
    for folder in files.listStatus(path(staged)):
        if "=" not in folder.getPath().getName():
            continue
        target = f"{root}/{unescape(folder.getPath().getName().split('=', 1)[1])}"
        parts = sorted(p.getPath().getName() for p in files.listStatus(folder.getPath()))
        found.append((target + {"gzip": ".gz", "bzip2": ".bz2"}.get(codec, ""), folder.getPath().toString(),
                      [p for p in parts if p.startswith("part-")]))
    if found:
        joined = spark.createDataFrame(found, "target string, folder string, parts array<string>").repartition(len(found))
        joined.mapInArrow(_joined(None if codec else "gzip"), "target string").foreach(lambda row: None)
    files.delete(path(staged), True)
    return root


def _joined(compression: str | None):
    """Streams the parts of (target, folder, parts) into the target, read as
    they are or decompressed. The target gets its name when it is whole."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for target, folder, parts in zip(*(batch[c].to_pylist() for c in ("target", "folder", "parts"))):
                (to, path), (source, at) = file_system(target), file_system(folder)
                below, last = path.rsplit("/", 1)
                to.create_dir(below, recursive=True)
                held = f"{below}/_{uuid.uuid4().hex}"
                with to.open_output_stream(held, compression=None) as out:
                    for part in parts:
                        with source.open_input_stream(f"{at}/{part}", compression=compression) as data:
                            while chunk := data.read(CHUNK):
                                out.write(chunk)
                to.move(held, f"{below}/{last}")
            yield batch.select(["target"])

    return join
