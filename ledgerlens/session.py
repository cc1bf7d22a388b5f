"""Spark session settings shared by jobs, tests and the bench.

Every setting that affects results is pinned here: the session zone is UTC so
timestamps print and compare the same on every executor, and ANSI mode stays
on so bad casts surface instead of silently turning into nulls (operators use
``try_*`` functions where a null is the wanted outcome).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job wants as well as a local run.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a shuffle join into a broadcast only when the measured
    # shuffle output of one side is below this size: a runtime size check.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM does not compile methods above 8,000 bytes of byte code; a stage
    # whose generated method is longer runs faster without whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # One JVM does everything in local mode; on a cluster these come
        # from the deployment, not from code.
        conf["spark.driver.memory"] = "16g"
        conf["spark.driver.maxResultSize"] = "4g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured (a shared file system path) and is
    used as is. Only when nothing is set and Spark runs in local mode, as in
    tests, a fresh local folder is created; on a cluster a machine-local
    folder would be seen by one machine only, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerlens/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back: branches of a plan
    read the files instead of computing it again, and a lost executor costs
    nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sf_dir_default() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
