"""Report catalogue: the listing pages of generated reports, landed as JSON
(the HTTP client that fetches them is not part of this library). Pick the
report to download per day, and label downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ledgerlens.layouts import CATALOGUE
from ledgerlens.operators import conform
from ledgerlens.plans.common import table
from ledgerlens.session import scratch_path

REPORT_SCHEMA = StructType(
    [StructField(c, ArrayType(StringType()) if c == "marketplaceIds" else StringType())
     for c in CATALOGUE])
PAGE_SCHEMA = StructType([StructField("page", LongType()), StructField("reports", ArrayType(REPORT_SCHEMA))])
PAGE_SIZE = 100   # reports per listing page; the last page may hold fewer


def read_catalogue(spark: SparkSession, path: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """All landed pages of a listing (one JSON object per page: its number
    and its reports; any number of pages per file) joined to one table.
    ``position`` is the report's place in the whole listing: the pages before
    its own are full."""
    pages = spark.read.schema(PAGE_SCHEMA).json(path)
    rows = pages.select("page", F.posexplode("reports").alias("_at", "_r"))
    return rows.select("_r.*", (F.col("page") * page_size + F.col("_at")).alias("position"))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """How many rows a run has, as one row to report."""
    return df.agg(F.count(F.lit(1)).alias(name))


def reverse_listing(cat: DataFrame) -> DataFrame:
    """The listing from its end: ``position`` counts from the last report.
    The listing's length is a scalar subquery, so nothing is joined."""
    last = cat.agg(F.max("position")).scalar()
    return cat.withColumn("position", last - F.col("position"))


def _utc(c: str):
    """ISO-8601 text with any offset -> UTC wall-clock timestamp_ntz."""
    return F.to_timestamp(F.col(c)).cast("timestamp_ntz")


def pick_ready(cat: DataFrame, status: str = "DONE") -> DataFrame:
    """Per day: the first report (listing order) whose data starts and ends
    on that day and whose status is ``status``. For a single day, filter the
    result on ``day``."""
    start, end = F.to_date(_utc("dataStartTime")), F.to_date(_utc("dataEndTime"))
    ready = cat.where((start == end) & (F.col("processingStatus") == status))
    best = ready.groupBy(start.alias("day")).agg(F.min(F.struct(
        "position", "reportDocumentId", "reportId")).alias("_b"))
    return best.select("day", "_b.reportDocumentId", "_b.reportId")


def label_downloads(cat: DataFrame, prefix: str = "settlement_report",
                    status: str = "DONE") -> DataFrame:
    """Reports to download, newest processing end first, each with its
    file name '<prefix>_<start>_<end>_<n>.csv'. ``n`` is the listing
    position + 1, i.e. numbering follows the listing, not the sort."""
    done = cat.where(F.col("processingStatus") == status)
    fmt = F.concat(F.date_format(_utc("dataStartTime"), "yyyyMMddHHmmss"), F.lit("_"),
                   F.date_format(_utc("dataEndTime"), "yyyyMMddHHmmss"))
    seq = F.col("position") + 1
    out = conform(done, CATALOGUE + ["position"]).select(
        "reportId", "reportDocumentId", _utc("processingEndTime").alias("processingEndTime"),
        F.element_at("marketplaceIds", 1).alias("marketplaceId"),
        fmt.alias("formattedTime"), seq.alias("seq"),
        F.concat(F.lit(prefix + "_"), fmt, F.lit("_"), seq.cast("string"), F.lit(".csv")).alias("filename"),
        F.replace(F.concat(F.lit("mod_" + prefix + "_"), fmt, F.lit(".csv")), F.lit("mod"),
                  F.lit("transformed")).alias("transformed_name"))
    return out.orderBy(F.col("processingEndTime").desc_nulls_last(), "seq")


# --------------------------------------------------------------- test render

def render_catalogue(orders: DataFrame) -> DataFrame:
    """One listed report per order: status from the order status, data
    window of the order day (some spanning two days), processing times in
    UTC or +02:00 text, a missing document id for every 50th."""
    o = F.col
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    start = o("o_orderdate") + F.make_dt_interval(F.lit(0), (o("o_orderkey") % 24).cast("int"))
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), (o("o_custkey") % 90).cast("int"))
    plus2 = o("o_orderkey") % 3 == 0
    end_txt = F.when(plus2, F.concat(F.date_format(end + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
                                     F.lit("+02:00"))) \
        .otherwise(F.concat(F.date_format(end, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    data_end_day = F.when(o("o_orderkey") % 7 == 0, F.date_format(F.date_add(F.to_date("o_orderdate"), 1), "yyyy-MM-dd")) \
        .otherwise(day)
    status = F.when(o("o_orderstatus") == "F", F.lit("DONE")).when(o("o_orderstatus") == "O", F.lit("IN_PROGRESS")) \
        .otherwise(F.lit("CANCELLED"))
    return orders.select(
        F.lit("SETTLEMENT_FLAT_FILE").alias("reportType"),
        F.concat(F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("processingStartTime"),
        end_txt.alias("processingEndTime"),
        F.concat(day, F.lit("T00:00:00+00:00")).alias("dataStartTime"),
        F.concat(data_end_day, F.lit("T23:59:59+00:00")).alias("dataEndTime"),
        F.concat(F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("createdTime"),
        status.alias("processingStatus"),
        F.array(F.lit("MKT-US")).alias("marketplaceIds"),
        F.when(o("o_orderkey") % 50 != 0, F.concat(F.lit("doc-"), o("o_orderkey").cast("string")))
        .alias("reportDocumentId"),
        o("o_orderkey").cast("string").alias("reportId"),
        o("o_orderkey").alias("position"))


def render_pages(orders: DataFrame) -> DataFrame:
    """The listing as pages of 100 reports in order of their position."""
    cat = render_catalogue(orders)
    report = F.struct("position", F.struct(*CATALOGUE).alias("r"))
    pages = cat.groupBy(F.floor(F.col("position") / PAGE_SIZE).alias("page")).agg(
        F.sort_array(F.collect_list(report)).alias("l"))
    return pages.select("page", F.transform("l", lambda x: x["r"]).alias("reports"))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "catalogue")
    render_pages(table(spark, sf_dir, "orders")).write.mode("overwrite").json(path)
    return read_catalogue(spark, path)


def q_catalogue_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pick_ready(_landed(spark, sf_dir))


def q_catalogue_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_downloads(_landed(spark, sf_dir))


def q_catalogue_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing from its end, with each report's place in that order."""
    return reverse_listing(_landed(spark, sf_dir)).select("reportId", "processingStatus", "position")


def q_catalogue_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many reports of the listing are ready to download."""
    return row_count(_landed(spark, sf_dir).where(F.col("processingStatus") == "DONE"))


_FMT = ("strftime(CAST(o_orderdate AS DATE), '%Y%m%d') || '000000_' || "
        "strftime(CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) + 1 ELSE CAST(o_orderdate AS DATE) END, "
        "'%Y%m%d') || '235959'")
ORACLE = {
    "catalogue_pick": """
SELECT CAST(o_orderdate AS DATE) AS day,
  CASE WHEN o_orderkey % 50 <> 0 THEN 'doc-' || o_orderkey END AS reportDocumentId,
  CAST(o_orderkey AS VARCHAR) AS reportId
FROM orders
WHERE o_orderstatus = 'F' AND o_orderkey % 7 <> 0
QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1""",
    "catalogue_label": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS reportId,
  CASE WHEN o_orderkey % 50 <> 0 THEN 'doc-' || o_orderkey END AS reportDocumentId,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + to_minutes(CAST(o_custkey % 90 AS BIGINT)) AS processingEndTime,
  'MKT-US' AS marketplaceId,
  {_FMT} AS formattedTime,
  o_orderkey + 1 AS seq,
  'settlement_report_' || {_FMT} || '_' || (o_orderkey + 1) || '.csv' AS filename,
  'transformed_settlement_report_' || {_FMT} || '.csv' AS transformed_name
FROM orders WHERE o_orderstatus = 'F'""",
    "catalogue_reverse": """
SELECT CAST(o_orderkey AS VARCHAR) AS reportId,
  CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'IN_PROGRESS' ELSE 'CANCELLED' END AS processingStatus,
  max(o_orderkey) OVER () - o_orderkey AS position
FROM orders""",
    "catalogue_count": "SELECT count(*) AS rows FROM orders WHERE o_orderstatus = 'F'",
}

QUERIES = {
    "catalogue_pick": q_catalogue_pick,
    "catalogue_label": q_catalogue_label,
    "catalogue_reverse": q_catalogue_reverse,
    "catalogue_count": q_catalogue_count,
}
