"""Publishing: a run's partitions replaced in place, empty outputs still
published, and publication markers written after the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.plans.common import RUN_DATE, land_files, table
from ledgerlens.session import scratch_path
from ledgerlens.sinks import (
    publish_or_blank, publish_partitioned, publish_zones, read_manifest, read_markers, read_published, replace_partitions,
    write_marker,
)
from ledgerlens.sinks.publication import Folder
from ledgerlens.sources import digests

FILE_TYPES = ["USA", "CA", "Mexico"]


def _typed(orders: DataFrame) -> DataFrame:
    ft = F.element_at(F.array(*[F.lit(t) for t in FILE_TYPES]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                         F.year("o_orderdate").cast("string").alias("run_date"), ft.alias("file_type"))


def _spread(df: DataFrame) -> DataFrame:
    """Group rows of a partition into few files; adaptive execution splits a
    large partition over as many tasks as its measured size asks for."""
    return df.hint("rebalance", "run_date", "file_type")


def q_partition_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish orders by (run_date, file_type). A re-run of all CA partitions
    has finished orders only, so later years become empty; a re-run of Mexico
    1996 has no rows at all. Read back run dates from 1994 on (only their
    folders are read)."""
    o = _typed(table(spark, sf_dir, "orders"))
    path = scratch_path(spark, "published")
    keys = o.select("run_date", "file_type").distinct()
    replace_partitions(_spread(o), path, keys)
    rerun = o.where((F.col("file_type") == "CA") & (F.col("o_orderstatus") == "F")).withColumn("o_orderstatus", F.lower("o_orderstatus"))
    replace_partitions(_spread(rerun), path, keys.where("file_type = 'CA'"))
    replace_partitions(o.where(F.lit(False)), path, spark.createDataFrame([("1996", "Mexico")], "run_date string, file_type string"))
    return read_published(spark, path, o.schema).where(F.col("run_date") >= "1994").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "run_date", "file_type")


def q_publish_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest after a run and a re-run that only has every other file
    type's finished orders: published keys and their row counts, empty ones
    included."""
    o = _typed(table(spark, sf_dir, "orders"))
    path = scratch_path(spark, "published")
    keys = o.select("run_date", "file_type").distinct()
    replace_partitions(_spread(o), path, keys)
    replace_partitions(_spread(o.where("o_orderstatus = 'F' AND file_type <> 'CA'")), path, keys.where("file_type <> 'CA'"))
    return read_manifest(spark, path).select("run_date", "file_type", "rows")


def q_empty_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV per file type from the day's orders; a type with no rows
    still gets a header-only file. Returns the rows read back per type."""
    o = _typed(table(spark, sf_dir, "orders")).where(F.col("o_orderstatus") != "P")
    # Mexico has no reports this run: its output is empty but published.
    o = o.where(F.col("file_type") != "Mexico")
    root = scratch_path(spark, "empty-publish")
    publish_or_blank(o, root, "file_type", FILE_TYPES)
    counts = []
    for ft in FILE_TYPES:
        back = spark.read.option("header", True).csv(f"{root}/file_type={ft}")
        counts.append(back.agg(F.count(F.lit(1)).alias("rows"),
                               F.lit(len(back.columns)).alias("columns")).select(
            F.lit(ft).alias("file_type"), "rows", "columns"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def q_publish_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the data, then one marker row per published partition with its
    row count (counted from what was written); the marker step runs twice, as
    after a failure, and leaves one marker per partition."""
    o = _typed(table(spark, sf_dir, "orders"))
    root = scratch_path(spark, "marker")
    publish_partitioned(_spread(o), f"{root}/data")
    written = spark.read.parquet(f"{root}/data")
    counts = written.groupBy("file_type", F.col("run_date").cast("string").alias("run_date")) \
        .agg(F.count(F.lit(1)).alias("rows")).withColumn("job", F.lit("transactions"))
    write_marker(spark, counts, f"{root}/publications")
    write_marker(spark, counts, f"{root}/publications")  # a run repeated
    return read_markers(spark, f"{root}/publications")


def _land_orders(spark: SparkSession, sf_dir: str) -> str:
    """Per file type the orders as a raw and the finished ones as a modified
    file: CR LF lines (USA), Latin-1 letters (CA), a byte-order mark (Mexico)."""
    o = _typed(table(spark, sf_dir, "orders"))
    line = F.concat_ws(",", "o_orderkey", "o_orderstatus", F.lit("é"))
    each = o.select("o_orderkey", "file_type", line.alias("line"), F.explode(F.array_compact(F.array(
        F.concat(F.lit("orders_"), F.col("file_type"), F.lit(".csv")),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("mod_orders_"), F.col("file_type"), F.lit(".csv")))))).alias("file"))
    # One row per file, broadcast: no window holds a file's lines.
    starts = each.groupBy("file").agg(F.min("o_orderkey").alias("_start"))
    each = each.join(F.broadcast(starts), "file", "left")
    first = F.col("o_orderkey") == F.col("_start")
    raw = (F.when(F.col("file_type") == "USA", F.concat("line", F.lit("\r")).cast("binary"))
           .when(F.col("file_type") == "CA", F.encode("line", "ISO-8859-1"))
           .otherwise(F.when(first, F.concat(F.lit("\ufeff"), F.col("line"))).otherwise(F.col("line")).cast("binary")))
    return land_files(each.select("file", "o_orderkey", raw.cast("string").alias("line")), scratch_path(spark, "landing"),
                      [F.col("o_orderkey")])


def q_publish_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files published to their zones byte by byte. The next run of the
    day finds one file less, which is then gone from its zone."""
    landing, root = _land_orders(spark, sf_dir), scratch_path(spark, "zones")
    publish_zones(spark, landing, root, RUN_DATE)
    Folder(spark, landing).delete("mod_orders_CA.csv")
    published = publish_zones(spark, landing, root, RUN_DATE)
    # The digests are those of the published objects, read again.
    objects = digests(spark, f"{root}/objects", recursive=True).select(
        F.element_at(F.split("path", "/objects/"), -1).alias("_o"), F.col("length").alias("length_now"), F.col("md5").alias("md5_now"))
    here = F.element_at(F.split("object", "/objects/"), -1)
    return published.join(objects, here == F.col("_o")).select(
        "zone", "run_date", "name", F.col("length_now").alias("length"), F.col("md5_now").alias("md5"),
        ((F.col("length") == F.col("length_now")) & (F.col("md5") == F.col("md5_now"))).alias("equal"))


ORACLE = {
    "partition_sink": """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 3 = 1 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, CAST(year(o_orderdate) AS VARCHAR) AS run_date,
  ['USA', 'CA', 'Mexico'][o_orderkey % 3 + 1] AS file_type
FROM orders WHERE year(o_orderdate) >= 1994 AND (o_orderkey % 3 <> 1 OR o_orderstatus = 'F')
  AND NOT (o_orderkey % 3 = 2 AND year(o_orderdate) = 1996)""",
    "publish_manifest": """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS run_date, ['USA', 'CA', 'Mexico'][o_orderkey % 3 + 1] AS file_type,
  count(*) FILTER (o_orderkey % 3 = 1 OR o_orderstatus = 'F') AS rows
FROM orders GROUP BY ALL""",
    "empty_publish": """
SELECT t.file_type, coalesce(c.n, 0) AS rows, 5 AS columns
FROM (VALUES ('USA'), ('CA'), ('Mexico')) t(file_type)
LEFT JOIN (SELECT ['USA', 'CA', 'Mexico'][o_orderkey % 3 + 1] AS file_type, count(*) AS n
           FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 3 <> 2 GROUP BY 1) c
USING (file_type)""",
    "publish_marker": """
SELECT 'transactions' AS job, ['USA', 'CA', 'Mexico'][o_orderkey % 3 + 1] AS file_type,
  CAST(year(o_orderdate) AS VARCHAR) AS run_date, count(*) AS rows
FROM orders GROUP BY ALL""",
    "publish_zones": f"""
WITH l AS (
  SELECT *, o_orderkey || ',' || o_orderstatus || ',é' AS line, ['USA', 'CA', 'Mexico'][o_orderkey % 3 + 1] AS ft FROM orders),
t AS (
  SELECT zone, prefix || ft || '.csv' AS name, ft,
    string_agg(line || CASE WHEN ft = 'USA' THEN chr(13) || chr(10) ELSE chr(10) END, '' ORDER BY o_orderkey) AS text
  FROM l JOIN (VALUES ('raw', 'orders_'), ('modified', 'mod_orders_')) z(zone, prefix)
    ON zone = 'raw' OR (o_orderstatus = 'F' AND ft <> 'CA')
  GROUP BY ALL),
b AS (
  SELECT zone, name, CASE ft WHEN 'CA' THEN unhex(replace(hex(encode(text)), 'C3A9', 'E9'))
    WHEN 'Mexico' THEN encode(chr(65279) || text) ELSE encode(text) END AS bytes FROM t)
SELECT zone, '{RUN_DATE}' AS run_date, name, octet_length(bytes) AS length, md5(bytes) AS md5, true AS equal FROM b""",
}

QUERIES = {
    "partition_sink": q_partition_sink,
    "publish_manifest": q_publish_manifest,
    "empty_publish": q_empty_publish,
    "publish_marker": q_publish_marker,
    "publish_zones": q_publish_zones,
}
