"""Readers and writers on real files in a fresh temporary folder."""

import hashlib
import os
import tempfile

from pyspark.sql import functions as F

from ledgerlens.layouts import string_schema
from ledgerlens.sinks import publish_partitioned, write_csv
from ledgerlens.sources import read_binary_files, read_delimited, read_lines, read_text_files
from ledgerlens.streaming import on_arrival


def _folder(files: dict) -> str:
    d = tempfile.mkdtemp(prefix="ledgerlens-test-")
    for name, data in files.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    return d


def test_read_lines_bom_crlf_and_strip(spark):
    d = _folder({"a.csv": "\ufeffheader\r\n  x  \r\ny\n".encode("utf-8"),
                 "b.csv": b"one\rtwo", "skip.txt": b"not read"})
    rows = sorted((r.file_name, r.line_no, r.line) for r in read_lines(spark, d).collect())
    assert rows == [("a.csv", 0, "header"), ("a.csv", 1, "x"), ("a.csv", 2, "y"),
                    ("b.csv", 0, "one"), ("b.csv", 1, "two")]


def test_binary_files_md5_and_length(spark):
    payload = b"same bytes\n"
    d = _folder({"a.csv": payload, "b.csv": payload, "c.csv": b"other"})
    got = {os.path.basename(r.path): (r.length, r.md5) for r in read_binary_files(spark, d).collect()}
    assert got["a.csv"] == (len(payload), hashlib.md5(payload).hexdigest())
    assert got["a.csv"] == got["b.csv"] != got["c.csv"]


def test_decode_fallback_latin1_file(spark):
    d = _folder({"u.txt": "café".encode("utf-8"), "l.txt": "café".encode("latin-1")})
    got = {r.file_name: r.text for r in read_text_files(spark, d).collect()}
    assert got == {"u.txt": "café", "l.txt": "café"}


def test_read_delimited_glob_and_lineage(spark):
    d = _folder({"r.csv": b"a\tb\n1\t2\n", "r.json": b"{}", "mod_r.csv": b"a\tb\n3\t4\n"})
    df = read_delimited(spark, d, string_schema(["a", "b"]), sep="\t", glob="mod*",
                        with_file="file_name")
    assert [(r.a, r.b, r.file_name) for r in df.collect()] == [("3", "4", "mod_r.csv")]


def test_empty_csv_still_published(spark):
    out = tempfile.mkdtemp(prefix="ledgerlens-test-") + "/empty"
    empty = spark.createDataFrame([], "x string, y string")
    write_csv(empty, out)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert files, "a header-only file is written"
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["x", "y"] and back.count() == 0


def test_dynamic_partition_overwrite_keeps_other_partitions(spark):
    out = tempfile.mkdtemp(prefix="ledgerlens-test-") + "/pub"
    df = spark.createDataFrame([(1, "d1", "US"), (2, "d1", "CA")], "v int, run_date string, file_type string")
    publish_partitioned(df, out)
    publish_partitioned(spark.createDataFrame([(3, "d1", "CA")], df.schema), out)
    got = sorted((r.v, r.file_type) for r in spark.read.parquet(out).collect())
    assert got == [(1, "US"), (3, "CA")]


def test_on_arrival_processes_each_file_once(spark):
    src = tempfile.mkdtemp(prefix="ledgerlens-test-")
    root = tempfile.mkdtemp(prefix="ledgerlens-test-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string")
    df.write.mode("overwrite").parquet(src + "/in")
    schema = df.schema
    proc = lambda b: b.withColumn("s", F.upper("s"))
    on_arrival(spark, src + "/in", schema, proc, root + "/out", root + "/ckpt")
    on_arrival(spark, src + "/in", schema, proc, root + "/out", root + "/ckpt")  # nothing new
    got = sorted((r.id, r.s) for r in spark.read.parquet(root + "/out").collect())
    assert got == [(1, "A"), (2, "B")]


def test_json_documents_and_brace_glob(spark, tmp_path):
    import json
    from ledgerlens.sources import read_json_documents
    from ledgerlens.plans.reports import traffic_schema
    for n in range(2):
        doc = {"salesAndTrafficByAsin": [{"parentAsin": f"P{n}", "childAsin": "C", "trafficByAsin": {"sessions": 3}}]}
        (tmp_path / f"business_report_2024-10-2{n}.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "notes.txt").write_text("not json")
    docs = read_json_documents(spark, str(tmp_path), traffic_schema(), glob="*.{csv,json}")
    rows = docs.select("file_name", "salesAndTrafficByAsin").collect()
    assert {(r.file_name, r.salesAndTrafficByAsin[0].parentAsin) for r in rows} == {
        ("business_report_2024-10-20.json", "P0"), ("business_report_2024-10-21.json", "P1")}


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    import pytest
    from ledgerlens import session

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self): return None
        def getConf(self): return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_quotes_and_line_breaks_round_trip(spark, tmp_path):
    from ledgerlens.layouts import string_schema
    from ledgerlens.sinks import write_csv
    rows = [('12" pipe', "a, b"), ('"quoted"', "line\nbreak"), ("plain", None)]
    path = write_csv(spark.createDataFrame(rows, "a string, b string"), str(tmp_path / "out"))
    back = read_delimited(spark, path, string_schema(["a", "b"]), multi_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
