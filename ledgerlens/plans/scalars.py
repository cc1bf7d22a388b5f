"""Registered queries for the cleaning expressions on their own: each renders
report-shaped text from a driver table, cleans it with the library's
expressions, and returns keys plus results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import (
    clean_text, int_or_zero, iso_date, localise_month, money, money_eu, percent_text,
    utc_to_pacific_text,
)
from ledgerlens.functions.dates import run_window, weekday_list
from ledgerlens.layouts import SPANISH_MONTHS
from ledgerlens.plans.common import table
from ledgerlens.session import scratch_path
from ledgerlens.sources.job_lists import jobs_of, read_job_lists, write_job_lists

_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def q_money_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'68,423.46', ' 23 ', '', 'nan', '1d' -> doubles (NULL when not a
    number); '68423,46' and '1.234,5' with a decimal comma."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_linenumber") % 5
    us = (F.when(k == 0, F.format_number("l_extendedprice", 2))
          .when(k == 1, F.concat(F.lit("  "), F.col("l_quantity").cast("bigint").cast("string"), F.lit(" ")))
          .when(k == 2, F.lit("nan"))
          .when(k == 3, F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit("d"))))
    eu_txt = F.replace(F.replace(F.replace(F.format_number("l_extendedprice", 2), F.lit(","), F.lit("#")),
                                 F.lit("."), F.lit(",")), F.lit("#"), F.lit("."))
    return li.select(*_KEYS, money(us).alias("amount"), money_eu(eu_txt).alias("amount_eu"))


def q_id_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and postal text -> bigint: decimals truncated toward zero, bad or
    blank text 0."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 6
    txt = (F.when(k == 0, F.col("o_orderkey").cast("string"))
           .when(k == 1, F.col("o_totalprice").cast("string"))
           .when(k == 2, F.concat(F.lit("-"), F.col("o_totalprice").cast("string")))
           .when(k == 3, F.lit("98101-1234"))
           .when(k == 4, F.concat(F.col("o_custkey").cast("string"), F.lit("d"))))
    return o.select("o_orderkey", int_or_zero(txt).alias("id_value"))


def q_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-width spaces and surrounding white space of any kind removed."""
    c = table(spark, sf_dir, "customer")
    name = F.concat(F.lit("\u200b  "), F.col("c_name"), F.lit("\t\u200b"))
    seg = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("\u3000 "))
    return c.select("c_custkey", clean_text(name).alias("c_name"),
                    clean_text(seg).alias("c_mktsegment"))


_MONTHS_ES = [es for es, _ in SPANISH_MONTHS]


def q_month_localise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spanish month tokens and short English ones that are tokens too
    become English names; full English names stay as written."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    es = F.concat_ws(" ", F.dayofmonth(d).cast("string"),
                     F.element_at(F.array(*[F.lit(m) for m in _MONTHS_ES]), F.month(d)),
                     F.year(d).cast("string"))
    k = F.col("o_orderkey") % 3
    txt = (F.when(k == 0, es).when(k == 1, F.date_format(d, "MMM d, yyyy"))
           .otherwise(F.date_format(d, "MMMM d, yyyy")))
    return o.select("o_orderkey", localise_month(txt).alias("date_text"))


def q_date_mdy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-form dates ('10/25/2024', '25.10.2024', ISO, month names, with a
    time, zone or weekday, junk) -> ISO text; month first when both readings
    are possible."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    d = d + F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 24).cast("int"), (F.col("o_orderkey") % 60).cast("int"))
    k = F.col("o_orderkey") % 19
    ordinal = F.when(F.dayofmonth(d).isin(1, 21, 31), "st").when(F.dayofmonth(d).isin(2, 22), "nd").when(F.dayofmonth(d).isin(3, 23), "rd").otherwise("th")
    txt = (F.when(k == 0, F.date_format(d, "MM/dd/yyyy"))
           .when(k == 1, F.date_format(d, "dd.MM.yyyy"))
           .when(k == 2, F.date_format(d, "yyyy-MM-dd"))
           .when(k == 3, F.lit("n/a"))
           .when(k == 4, F.date_format(d, "MMM d, yyyy"))
           .when(k == 5, F.date_format(d, "d MMM yyyy HH:mm"))
           .when(k == 6, F.date_format(d, "MM-dd-yyyy hh:mm a"))
           .when(k == 7, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .when(k == 8, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"))
           .when(k == 9, F.date_format(d, "EEE, d MMM yyyy HH:mm:ss 'GMT'"))
           .when(k == 10, F.date_format(d, "MMMM d, yyyy h:mm:ss a 'PDT'"))
           .when(k == 11, F.date_format(d, "d-MMM-yy"))
           .when(k == 12, F.date_format(d, "MMM-dd-yyyy"))
           .when(k == 13, F.replace(F.date_format(d, "MMM d yyyy"), F.lit("Sep"), F.lit("Sept")))
           .when(k == 14, F.concat(F.dayofmonth(d).cast("string"), ordinal, F.date_format(d, " MMMM yyyy")))
           .when(k == 15, F.date_format(d, "MM-dd-yyyy ha"))
           .when(k == 16, F.date_format(d, "yyyy-dd-MM"))
           .when(k == 17, F.date_format(d, "dd/MMM/yyyy"))
           .otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")))
    return o.select("o_orderkey", iso_date(txt).alias("Date"))


def q_tz_pacific(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTC event times -> US Pacific wall-clock text (daylight saving aware)."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", utc_to_pacific_text(F.col("ts")).alias("ts_pacific"))


def q_run_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run parameters from a run date: the days before and after, compact
    'yyyyMMdd' text and back, and a 'yyyyMMddHHmmss' start time parsed."""
    o = table(spark, sf_dir, "orders")
    start_txt = F.date_format(F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (F.col("o_orderkey") % 24).cast("int"), (F.col("o_custkey") % 60).cast("int")),
        "yyyyMMddHHmmss")
    return o.select(
        "o_orderkey", *[c.alias(n) for n, c in run_window("o_orderdate").items()],
        F.to_timestamp_ntz(start_txt, F.lit("yyyyMMddHHmmss")).alias("start_time"))


def q_weekday_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday number (Monday 0) of a run date and the job list it selects."""
    o = table(spark, sf_dir, "orders")
    wd = F.weekday("o_orderdate")
    return o.select("o_orderkey", wd.alias("weekday"),
                    weekday_list("o_orderdate").alias("list_file"))


def q_weekday_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected jobs of some run dates: job lists lie in a folder per
    weekday, and only the folders of the dates' weekdays are read."""
    c = table(spark, sf_dir, "customer")
    lists = scratch_path(spark, "job-lists")
    jobs = c.select(F.concat(F.lit("script_"), F.col("c_custkey")).alias("scriptname"),
                    F.when(F.col("c_custkey") % 3 == 0, "weekly").otherwise("daily").alias("frequency"),
                    F.explode(F.when(F.col("c_custkey") % 3 == 0, F.array((F.col("c_nationkey") % 7).cast("int")))
                              .otherwise(F.sequence(F.lit(0), F.lit(6)))).alias("weekday"))
    write_job_lists(jobs, lists)
    days = table(spark, sf_dir, "orders").where("year(o_orderdate) = 1995 AND month(o_orderdate) = 3 AND day(o_orderdate) <= 3")
    return jobs_of(days.select(F.to_date("o_orderdate").alias("run_date")).distinct(),
                   read_job_lists(spark, lists, "scriptname string, frequency string"))


def q_percent_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers -> '%' text; report file name and year split from text."""
    li = table(spark, sf_dir, "lineitem")
    fname = F.concat(F.lit("business_report_"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(".json"))
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return li.select(*_KEYS, percent_text("l_discount").alias("discount_pct"),
                     percent_text("l_tax").alias("tax_pct"),
                     percent_text("l_extendedprice").alias("price_pct"),
                     percent_text(F.col("l_tax") / 100).alias("small_pct"),
                     percent_text(F.col("l_discount") / 1000).alias("tiny_pct"),
                     F.split_part(fname, F.lit("."), F.lit(1)).alias("mod_name"),
                     F.split_part(day, F.lit("-"), F.lit(1)).alias("year"))


_K = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ORACLE = {
    "money_clean": f"""
SELECT {_K},
  CASE l_linenumber % 5 WHEN 0 THEN round(l_extendedprice, 2)
       WHEN 1 THEN CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) END AS amount,
  CASE WHEN l_extendedprice >= 1000 THEN NULL ELSE round(l_extendedprice, 2) END AS amount_eu
FROM lineitem""",
    "id_clean": """
SELECT o_orderkey,
  CASE o_orderkey % 6 WHEN 0 THEN o_orderkey WHEN 1 THEN CAST(trunc(o_totalprice) AS BIGINT)
       WHEN 2 THEN -CAST(trunc(o_totalprice) AS BIGINT) ELSE 0 END AS id_value
FROM orders""",
    "text_clean": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "month_localise": """
SELECT o_orderkey,
  CASE o_orderkey % 3
    WHEN 0 THEN CAST(day(o_orderdate) AS VARCHAR) || ' ' || strftime(o_orderdate, '%B') || ' ' || CAST(year(o_orderdate) AS VARCHAR)
    WHEN 1 THEN CASE WHEN month(o_orderdate) IN (2, 6, 7, 10, 11) THEN strftime(o_orderdate, '%B %-d, %Y')
                     ELSE strftime(o_orderdate, '%b %-d, %Y') END
    ELSE strftime(o_orderdate, '%B %-d, %Y') END AS date_text
FROM orders""",
    "date_mdy": """
SELECT o_orderkey,
  CASE
    WHEN o_orderkey % 19 IN (1, 16) THEN CASE WHEN day(o_orderdate) <= 12
                     THEN strftime(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)), '%Y-%m-%d')
                     ELSE strftime(o_orderdate, '%Y-%m-%d') END
    WHEN o_orderkey % 19 = 3 THEN NULL
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Date"
FROM orders""",
    "tz_pacific": """
SELECT event_id,
  strftime(timezone('America/Los_Angeles', date_trunc('second', ts) AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M:%S') AS ts_pacific
FROM events""",
    "run_window": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS run_date,
  CAST(o_orderdate AS DATE) - 1 AS previous_day, CAST(o_orderdate AS DATE) - 2 AS two_days_before,
  CAST(o_orderdate AS DATE) + 1 AS next_day, strftime(o_orderdate, '%Y%m%d') AS run_compact,
  strftime(o_orderdate, '%Y-%m-%d') AS run_iso,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + to_minutes(CAST(o_custkey % 60 AS BIGINT)) AS start_time
FROM orders""",
    "weekday_route": """
SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday,
  'list_files_' || (isodow(o_orderdate) - 1) || '.csv' AS list_file
FROM orders""",
    "weekday_jobs": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday, 'script_' || c_custkey AS scriptname,
  CASE WHEN c_custkey % 3 = 0 THEN 'weekly' ELSE 'daily' END AS frequency
FROM orders JOIN customer ON c_custkey % 3 <> 0 OR c_nationkey % 7 = isodow(o_orderdate) - 1
WHERE year(o_orderdate) = 1995 AND month(o_orderdate) = 3 AND day(o_orderdate) <= 3""",
    "percent_text": f"""
SELECT {_K}, CAST(l_discount AS VARCHAR) || '%' AS discount_pct, CAST(l_tax AS VARCHAR) || '%' AS tax_pct,
  CAST(l_extendedprice AS VARCHAR) || '%' AS price_pct,
  CAST(l_tax / 100 AS VARCHAR) || '%' AS small_pct, CAST(l_discount / 1000 AS VARCHAR) || '%' AS tiny_pct,
  'business_report_' || strftime(l_shipdate, '%Y-%m-%d') AS mod_name, strftime(l_shipdate, '%Y') AS year
FROM lineitem""",
}

QUERIES = {
    "money_clean": q_money_clean,
    "id_clean": q_id_clean,
    "text_clean": q_text_clean,
    "month_localise": q_month_localise,
    "date_mdy": q_date_mdy,
    "tz_pacific": q_tz_pacific,
    "run_window": q_run_window,
    "weekday_route": q_weekday_route,
    "weekday_jobs": q_weekday_jobs,
    "percent_text": q_percent_text,
}
