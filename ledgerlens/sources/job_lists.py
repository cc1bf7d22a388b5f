"""Job lists by weekday: which jobs a run date expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def write_job_lists(jobs: DataFrame, path: str) -> str:
    """Jobs with their ``weekday`` (Monday 0) as CSV, a folder per weekday."""
    jobs.write.mode("overwrite").partitionBy("weekday").option("header", True).option("escape", '"').csv(path)
    return path


def read_job_lists(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The lists' columns (``schema``) and ``weekday``, a partition column."""
    whole = StructType([*StructType.fromDDL(schema).fields, StructField("weekday", IntegerType())])
    return spark.read.schema(whole).option("header", True).option("escape", '"').csv(path)


def jobs_of(run_dates: DataFrame, lists: DataFrame, date_col: str = "run_date") -> DataFrame:
    """(run date, weekday, the list's columns): the jobs of each date's
    weekday. The dates are the small side; Spark prunes the folders of other
    weekdays by them when the query runs."""
    dates = run_dates.select(date_col, F.weekday(date_col).alias("_day"))
    rest = [c for c in lists.columns if c != "weekday"]
    return lists.join(dates, F.col("weekday") == F.col("_day")).select(date_col, "weekday", *rest)
