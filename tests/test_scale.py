"""Landing, reading and streaming that must not grow with a single file or group."""

import glob
import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.common import land_files
from ledgerlens.sources.files import read_lines, read_sized_records
from ledgerlens.streaming.alerts import START, advance

MANY = 20_000


def _rows(spark):
    return spark.range(MANY, 0, -1, 4).select(
        F.concat(F.lit("d"), F.col("id") % 2, F.lit("/report.csv")).alias("file"), F.col("id").alias("no"),
        F.concat(F.lit("línea "), F.col("id")).alias("line"))


def test_no_task_sorts_a_landed_file(spark, tmp_path, monkeypatch):
    """One file's lines are sorted by several tasks; its parts are joined in order."""
    seen = []
    from ledgerlens.plans import common
    real = common._joined

    def watched(compression):
        for folder in glob.glob(f"{tmp_path}/one/_staged/file=*"):
            seen.append(len(glob.glob(f"{folder}/part-*")))
        return real(compression)

    monkeypatch.setattr(common, "_joined", watched)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land_files(_rows(spark).withColumn("file", F.lit("a.csv")), f"{tmp_path}/one", [F.col("no")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(seen) > 1
    with open(f"{tmp_path}/one/a.csv", encoding="utf-8") as f:
        assert f.read() == "".join(f"línea {i}\n" for i in range(1, MANY + 1))
    assert sorted(os.listdir(f"{tmp_path}/one")) == ["a.csv"]


def test_order_of_texts_longer_than_the_range_key(spark, tmp_path):
    rows = spark.range(500).select(F.lit("a.csv").alias("file"), F.concat(F.repeat(F.lit("x"), 100), F.lpad(499 - F.col("id"), 3, "0")).alias("line"))
    land_files(rows, f"{tmp_path}/long", [F.col("line")])
    with open(f"{tmp_path}/long/a.csv") as f:
        found = f.read().splitlines()
    assert found == sorted(found) and len(found) == 500


@pytest.mark.parametrize("codec,ending", [("bzip2", "bz2"), ("gzip", "gz")])
def test_compressed_files_read_as_plain_ones(spark, tmp_path, codec, ending):
    land_files(_rows(spark), f"{tmp_path}/plain", [F.col("no")])
    land_files(_rows(spark), f"{tmp_path}/packed", [F.col("no")], codec=codec)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        plain = read_lines(spark, f"{tmp_path}/plain/*")
        packed, sizes = read_sized_records(spark, f"{tmp_path}/packed/*", f"*.csv.{ending}")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    cut = F.regexp_extract("file_path", r"(d\d)/", 1)
    a = {tuple(r) for r in plain.select(cut, "file_name", "line_no", "line").collect()}
    b = {tuple(r) for r in packed.select(cut, "file_name", "line_no", "line").collect()}
    assert a == b and len(a) > 1000
    on_disk = {p.split("/")[-2]: os.path.getsize(p) for p in glob.glob(f"{tmp_path}/plain/*/*.csv")}
    assert {r.path.split("/")[-2]: r.length for r in sizes.collect()} == on_disk
    if ending == "gz":
        for p in glob.glob(f"{tmp_path}/packed/*/*.gz"):
            assert gzip.open(p).read() == open(p.replace("/packed/", "/plain/")[:-3], "rb").read()


def test_lines_are_not_shuffled_to_be_numbered(spark, tmp_path):
    """The table of ranges goes to the lines, not the lines to it."""
    land_files(_rows(spark), f"{tmp_path}/n", [F.col("no")])
    plan = read_lines(spark, f"{tmp_path}/n/*")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_entry_keeps_long_methods_from_the_interpreter(spark):
    import __spark_entry__ as entry
    old = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        entry._prepare(spark)
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", old)


def test_advance_answers_small_groups_without_frames(monkeypatch):
    """Per sample the same answers as a plain loop, and no pandas for it."""
    import ledgerlens.streaming.alerts as alerts
    monkeypatch.setattr(alerts, "pd", None)
    rng = np.random.default_rng(1)
    pct = np.where(rng.random(400) < 0.05, np.nan, rng.normal(88, 8, 400))
    level, seen, start, want = "NORMAL", 0, -1, []
    for x in pct:
        seen += 1
        new = "ALERT" if x > 90 else "NORMAL" if x <= 79 else level
        event = None
        if new == "ALERT" and level == "NORMAL":
            event, start = "ALERT", seen
        elif new == "NORMAL" and level == "ALERT":
            event = "NORMAL"
        elif new == "ALERT" and start >= 0 and (seen - start) % 3 == 0:
            event = "REMINDER"
        level = new
        want.append(event)
    got, state = [], START
    for part in np.array_split(pct, 37):
        state, event = advance(state, part, 90, 79, 3)
        got += list(event)
    assert got == want and state == (level, seen, start)
