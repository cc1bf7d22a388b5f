"""Rejects, damaged documents, bytes, job lists and streams on small files."""

from __future__ import annotations

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.text import money, money_eu
from ledgerlens.operators.rejects import Parse, split_rejects, with_rejects
from ledgerlens.plans.reports import flatten_traffic, traffic_schema
from ledgerlens.sinks import publish_zones, read_zones, write_lines
from ledgerlens.sources import (
    copied, digests, json_rejects, list_files, read_fields, read_json_documents, read_text_in_order,
)
from ledgerlens.sources.files import CORRUPT
from ledgerlens.sources.job_lists import jobs_of, read_job_lists, write_job_lists
from ledgerlens.streaming import ordered_hysteresis_stream, wait_for_arrival


def test_files_of_one_name_keep_their_own_columns(spark, tmp_path):
    for folder, text in (("a", "sku\tasin\nS1\tA1\n"), ("b", 'asin\tsku\textra\nA2\t"S\n2"\tx\n')):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "r.csv").write_text(text)
    df = read_fields(spark, [str(tmp_path / "a"), str(tmp_path / "b")], ["sku", "asin", "none"], "\t")
    got = {r.file_path.split("/")[-2]: (r.file_name, r.sku, r.asin, r.none) for r in df.collect()}
    assert got == {"a": ("r.csv", "S1", "A1", None), "b": ("r.csv", "S\n2", "A2", None)}


def test_rejects_beside_the_rows(spark):
    df = spark.createDataFrame([(1, "1,5", "2"), (2, "x", " "), (3, None, "y"), (4, "1.234,5", "")], "n int, eu string, us string")
    parses = [Parse("eu", money_eu("eu"), [(F.col("eu").contains("."), "dots"), (F.lit(True), "no number")]),
              Parse("us", money("us"), [(F.lit(True), "no number")])]
    rows, rejects = split_rejects(with_rejects(df, parses), ["n"])
    assert {(r.n, r.eu, r.us) for r in rows.collect()} == {(1, 1.5, 2.0), (2, None, None), (3, None, None), (4, None, None)}
    assert {tuple(r) for r in rejects.collect()} == {(2, "eu", "x", "no number"), (3, "us", "y", "no number"), (4, "eu", "1.234,5", "dots")}
    assert rejects.columns == ["n", "column", "raw", "reason"]


def test_damaged_documents(spark, tmp_path):
    good = {"salesAndTrafficByAsin": [{"parentAsin": "P", "childAsin": "C", "trafficByAsin": {"sessions": 3}}]}
    wrong = {"salesAndTrafficByAsin": [{"parentAsin": "P", "trafficByAsin": {"sessions": "many"}}]}
    for name, text in (("good", json.dumps(good, indent=2)), ("cut", json.dumps(good)[:60]), ("wrong", json.dumps(wrong)),
                       ("list", "[1, 2]"), ("empty items", '{"salesAndTrafficByAsin": []}'), ("no json", "<html>")):
        (tmp_path / f"report 2024-10-20 {name}.json").write_text(text)
    docs = read_json_documents(spark, str(tmp_path), traffic_schema())
    lost = {r.file_name.split(" ", 2)[2]: (r.n_chars > 0, r.reason) for r in json_rejects(docs).collect()}
    assert {"cut.json", "wrong.json", "no json.json"} <= set(lost) <= {"cut.json", "wrong.json", "no json.json", "list.json"}
    flat = flatten_traffic(docs.where(F.col(CORRUPT).isNull()).select("file_name", F.struct("salesAndTrafficByAsin").alias("doc")), "d")
    assert [(r.parentAsin, r.childAsin, r.file_date) for r in flat.collect()] == [("P", "C", "2024-10-20")]
    texts = spark.createDataFrame([("a 2024-10-20.json", json.dumps(good)), ("b.json", json.dumps(good)[:60])], "file_name string, doc string")
    assert [r.file_name for r in flatten_traffic(texts, "d").collect()] == ["a 2024-10-20.json"]


def test_digests_and_copies(spark, tmp_path):
    contents = {"a.bin": b"", "sub/b c.bin": os.urandom(70_000), "sub/d%20e.bin": b"x\r\n\xe9"}
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name, data in contents.items():
        (tmp_path / "in" / name).write_bytes(data)
    want = {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in contents.items()}
    place = F.element_at(F.split("path", "/in/"), -1)
    got = digests(spark, str(tmp_path / "in"), recursive=True, chunk=1000).withColumn("name", place).collect()
    assert {r.name: (r.length, r.md5) for r in got} == want
    files = list_files(spark, str(tmp_path / "in"), recursive=True).select("uri", F.concat(F.lit(f"{tmp_path}/out/"), place).alias("target"))
    assert {(r.length, r.md5) for r in copied(files, chunk=1000).collect()} == set(want.values())
    assert {n: (tmp_path / "out" / n).read_bytes() for n in contents} == contents
    assert not [f for _, _, names in os.walk(tmp_path / "out") for f in names if f.startswith("_")]


def test_zones_hold_the_bytes_of_the_last_run(spark, tmp_path):
    landing, zones = tmp_path / "landing", str(tmp_path / "zones")
    landing.mkdir()
    contents = {"r.csv": "a\r\nb".encode(), "mod_r.csv": "﻿x\n".encode(), "old.csv": b"\xe9"}
    for name, data in contents.items():
        (landing / name).write_bytes(data)
    publish_zones(spark, str(landing), zones, "2024-10-20")
    publish_zones(spark, str(landing), zones, "2024-10-21")
    (landing / "old.csv").unlink()
    (landing / "r.csv").write_bytes(b"new")
    publish_zones(spark, str(landing), zones, "2024-10-21")
    got = {(r.run_date, r.zone, r.name): open(r.object.removeprefix("file:"), "rb").read() for r in read_zones(spark, zones).collect()}
    day = {("modified", "mod_r.csv"): contents["mod_r.csv"], ("raw", "r.csv"): contents["r.csv"], ("raw", "old.csv"): contents["old.csv"]}
    want = {("2024-10-20", *k): v for k, v in day.items()}
    want |= {("2024-10-21", "modified", "mod_r.csv"): contents["mod_r.csv"], ("2024-10-21", "raw", "r.csv"): b"new"}
    assert got == want


def test_merged_text_is_in_order(spark, tmp_path):
    rows = [(i % 3, i, f"line {i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "f int, n int, line string").repartition(7)
    write_lines(df, str(tmp_path / "out"), order=[F.col("f").desc(), F.col("n")], mark=True)
    want = [line for _, _, line in sorted(rows, key=lambda r: (-r[0], r[1]))]
    parts = sorted(p for p in os.listdir(tmp_path / "out") if p.startswith("part-"))
    text = b"".join((tmp_path / "out" / p).read_bytes() for p in parts)
    assert text == ("﻿" + "\n".join([*want, ""])).encode()
    back = read_text_in_order(spark, str(tmp_path / "out")).orderBy("line_no").collect()
    assert [r.line for r in back] == want and [r.line_no for r in back] == list(range(5000))


def test_only_the_weekdays_lists_are_read(spark, tmp_path):
    jobs = spark.createDataFrame([(f"job {d}", d) for d in range(7)], "scriptname string, weekday int")
    lists = read_job_lists(spark, write_job_lists(jobs, str(tmp_path / "lists")), "scriptname string")
    days = spark.createDataFrame([("2024-10-21",), ("2024-10-23",)], "d string").select(F.to_date("d").alias("run_date"))
    df = jobs_of(days.where("run_date >= '2024-10-22'"), lists)
    assert [(str(r.run_date), r.weekday, r.scriptname) for r in df.collect()] == [("2024-10-23", 2, "job 2")]
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()


def test_a_wait_ends_with_a_report_or_blank(spark, tmp_path):
    schema = spark.createDataFrame([], "v int").schema
    (tmp_path / "in").mkdir()

    def wait(budget):
        return wait_for_arrival(spark, str(tmp_path / "in"), schema, lambda b: b.withColumn("w", F.col("v") + 1),
                                str(tmp_path / "out"), str(tmp_path / "checkpoint"), budget)
    assert wait(2) is False
    assert spark.read.parquet(str(tmp_path / "out")).select("v", "w").collect() == []
    spark.createDataFrame([(1,)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    assert wait(60) is True
    assert wait(2) is False  # the same report is not taken twice
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("v", "w").collect()] == [(1, 2)]


def test_a_failing_stream_does_not_use_up_the_wait(spark, tmp_path):
    schema = spark.createDataFrame([(1,)], "v int").schema
    spark.createDataFrame([(1,)], schema).write.parquet(str(tmp_path / "in"))

    def broken(batch):
        raise RuntimeError("cannot be processed")
    with pytest.raises(Exception, match="cannot be processed"):
        wait_for_arrival(spark, str(tmp_path / "in"), schema, broken, str(tmp_path / "out"), str(tmp_path / "checkpoint"), 300)


def test_late_samples_count_in_order(spark, tmp_path):
    """Samples of a device come last first, one file a batch; what comes later
    than the delay is left out."""
    schema = "device string, ts timestamp_ntz, seq bigint, pct double"
    values = [95.0, 85.0, 70.0, 96.0]

    def land(rows):
        df = spark.createDataFrame(rows, "device string, t string, seq bigint, pct double")
        df.select("device", F.col("t").cast("timestamp_ntz").alias("ts"), "seq", "pct").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for n in (3, 1, 2, 0):
        land([("d", f"2024-01-01 00:0{n}:00", n, values[n])])
    land([("e", "2024-01-01 02:00:00", 0, 0.0)])   # time goes on
    land([("e", "2024-01-01 02:00:01", 1, 0.0)])
    land([("d", "2024-01-01 00:02:30", 9, 95.0)])  # too late
    land([("e", "2024-01-02 00:00:00", 2, 0.0)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (ordered_hysteresis_stream(stream, "30 minutes").writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = sorted((r.device, str(r.ts), r.pct, r.event) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("d", "2024-01-01 00:00:00", 95.0, "ALERT"), ("d", "2024-01-01 00:02:00", 70.0, "NORMAL"),
                   ("d", "2024-01-01 00:03:00", 96.0, "ALERT")]
