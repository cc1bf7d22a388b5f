"""Listings: modified file (9 columns, pipe CSV) and one row per product.

Registered queries render raw listing rows from ``part`` (brand as the
product id, type as the channel, size as the status) and write them as the
tab-delimited report; the job reads that file (bytes, encoding fallback,
fields by header name), publishes the modified pipe file, and reads it back
for the de-duplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.layouts import LISTING_DEDUP, LISTING_MOD
from ledgerlens.operators import conform, first_per_key, flag_duplicates, with_constants
from ledgerlens.plans.common import RUN_DATE, table
from ledgerlens.session import scratch_path
from ledgerlens.sinks import write_csv
from ledgerlens.sources import read_fields

# Channel first, then status, both NULLs last; the seller sku breaks ties so
# the choice never depends on input order.
DEDUP_ORDER = [("fulfillment-channel", True, True), ("status", True, True),
               ("seller-sku", True, True)]


def modify_listings(raw: DataFrame, run_date: str) -> DataFrame:
    """Raw listing report -> 9-column modified layout with the run date."""
    return conform(with_constants(raw, {"run_date": run_date}), LISTING_MOD)


def transform_listings(mod: DataFrame, run_date: str) -> DataFrame:
    """One row per asin1 (NULL asin1 is one group): the first by channel,
    status, sku; active_flag 0 and the run date added; 7-column layout."""
    cols = ["seller-sku", "asin1", "product-id", "fulfillment-channel", "status"]
    best = first_per_key(mod.select(*[f"`{c}`" for c in cols]), ["asin1"], DEDUP_ORDER)
    best = best.withColumns({"active_flag": F.lit(0).cast("bigint"),
                             "run_date": F.lit(run_date)})
    return conform(best, LISTING_DEDUP)


def split_duplicates(mod: DataFrame) -> DataFrame:
    """Every listing with a flag telling whether its asin1 occurs more than
    once (all copies flagged; NULL asin1 values count as equal)."""
    cols = ["seller-sku", "asin1", "product-id", "fulfillment-channel", "status"]
    return flag_duplicates(mod.select(*[f"`{c}`" for c in cols]), ["asin1"])


def duplicate_counts(mod: DataFrame) -> DataFrame:
    """How many listings are duplicated and how many are distinct."""
    per_key = mod.groupBy(F.col("asin1")).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy((F.col("_n") > 1).alias("is_duplicated")).agg(F.sum("_n").alias("listings"))


# --------------------------------------------------------------- test render

def render_listing_report(part: DataFrame, breaks: bool = False) -> DataFrame:
    """Raw listing rows (all text) from ``part``; every 11th part has no
    asin1, every 7th no channel, every 13th an empty first field, and every 5th
    an item name with quotes and a tab, with ``breaks`` also line breaks."""
    odd = '12" "black",\t\n|first "line"\n' if breaks else '12" "black",\t'
    return part.select(
        F.when(F.col("p_partkey") % 13 != 0, F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string"))).alias("seller-sku"),
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand")).alias("asin1"),
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit(odd), F.col("p_name")))
         .otherwise(F.col("p_name")).alias("item-name"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_size").cast("string").alias("quantity"),
        F.concat(F.lit("PID"), F.col("p_partkey").cast("string")).alias("product-id"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_type")).alias("fulfillment-channel"),
        F.when(F.col("p_size") % 3 == 0, F.lit("Inactive")).otherwise(F.lit("Active")).alias("status"),
        F.lit("x").alias("open-date"),   # an extra column the layout drops
    )


RAW_LISTING = ["seller-sku", "asin1", "item-name", "price", "quantity", "product-id",
               "fulfillment-channel", "status", "open-date"]


def read_raw_listings(spark: SparkSession, path: str) -> DataFrame:
    """Raw tab-delimited listing report(s): bytes decoded UTF-8 or Latin-1,
    fields taken by the names in each file's header line."""
    return read_fields(spark, path, RAW_LISTING, "\t")


def _published_modified(spark: SparkSession, sf_dir: str, breaks: bool = False) -> DataFrame:
    raw = render_listing_report(table(spark, sf_dir, "part"), breaks)
    raw_path = scratch_path(spark, "listings-raw")
    write_csv(raw, raw_path, sep="\t")
    mod_path = scratch_path(spark, "listings-mod")
    write_csv(modify_listings(read_raw_listings(spark, raw_path), RUN_DATE), mod_path, sep="|")
    return read_fields(spark, mod_path, LISTING_MOD, "|").select(*[f"`{c}`" for c in LISTING_MOD])


def q_listing_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_listings(_published_modified(spark, sf_dir), RUN_DATE)


def q_listing_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modified listings as they are read back: item names hold tabs, pipes,
    quotes and line breaks, in the raw and in the published file."""
    return _published_modified(spark, sf_dir, breaks=True).select("seller-sku", "asin1", "item-name", "product-id", "status")


def q_listing_dup_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_duplicates(_published_modified(spark, sf_dir))


def q_listing_dup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_counts(_published_modified(spark, sf_dir))


_LISTING_SQL = """
WITH l AS (
  SELECT CASE WHEN p_partkey % 13 <> 0 THEN 'SKU-' || p_partkey END AS "seller-sku",
         CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS asin1,
         'PID' || p_partkey AS "product-id",
         CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS "fulfillment-channel",
         CASE WHEN p_size % 3 = 0 THEN 'Inactive' ELSE 'Active' END AS status
  FROM part)
"""

ORACLE = {
    "listing_landed": """
SELECT CASE WHEN p_partkey % 13 <> 0 THEN 'SKU-' || p_partkey END AS "seller-sku",
  CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS asin1,
  CASE WHEN p_partkey % 5 = 0 THEN '12" "black",' || chr(9) || chr(10) || '|first "line"' || chr(10) || p_name ELSE p_name END AS "item-name",
  'PID' || p_partkey AS "product-id", CASE WHEN p_size % 3 = 0 THEN 'Inactive' ELSE 'Active' END AS status
FROM part""",
    "listing_dedup": _LISTING_SQL + """
SELECT "seller-sku", asin1, "product-id", "fulfillment-channel", status,
       CAST(0 AS BIGINT) AS active_flag, '2024-10-21' AS run_date
FROM l
QUALIFY row_number() OVER (PARTITION BY asin1 ORDER BY "fulfillment-channel" ASC NULLS LAST,
                           status ASC NULLS LAST, "seller-sku" ASC NULLS LAST) = 1
""",
    "listing_dup_split": _LISTING_SQL + """
SELECT "seller-sku", asin1, "product-id", "fulfillment-channel", status,
       count(*) OVER (PARTITION BY asin1) > 1 AS is_duplicated
FROM l
""",
    "listing_dup_counts": _LISTING_SQL + """
SELECT is_duplicated, count(*) AS listings
FROM (SELECT count(*) OVER (PARTITION BY asin1) > 1 AS is_duplicated FROM l) t
GROUP BY is_duplicated
""",
}

QUERIES = {
    "listing_landed": q_listing_landed,
    "listing_dedup": q_listing_dedup,
    "listing_dup_split": q_listing_dup_split,
    "listing_dup_counts": q_listing_dup_counts,
}
