"""Frame operators on small fixtures (values invented)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import (
    conform, distinct_files, fill_from_first, first_per_key, flag_duplicates, merge_lines,
    pick_formats,
)
from ledgerlens.operators.alerts import alert_events
from ledgerlens.operators.delimited import fields_by_header, infer_delimiters
from ledgerlens.plans.listings import DEDUP_ORDER


def test_conform_idempotent(spark):
    df = spark.createDataFrame([(1, "a", "x")], "a int, b string, extra string")
    out = conform(df, ["b", "missing", "a"])
    assert out.columns == ["b", "missing", "a"]
    assert out.first() == ("a", None, 1)
    assert conform(out, ["b", "missing", "a"]).collect() == out.collect()


def test_first_per_key_nulls_last_and_ties(spark):
    rows = [("s3", "A1", None, "Active"), ("s2", "A1", "DEFAULT", "Inactive"),
            ("s1", "A1", "DEFAULT", "Inactive"), ("s4", "A2", "MARKETPLACE", "Active"),
            ("s5", None, "X", "Active"), ("s6", None, "W", "Active")]
    df = spark.createDataFrame(rows, "`seller-sku` string, asin1 string, `fulfillment-channel` string, status string")
    out = {r.asin1: r["seller-sku"] for r in first_per_key(df, ["asin1"], DEDUP_ORDER).collect()}
    assert out == {"A1": "s1", "A2": "s4", None: "s6"}


def test_flag_duplicates_null_keys_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    got = sorted((r.k or "", r.is_duplicated) for r in flag_duplicates(df, ["k"]).collect())
    assert got == [("", True), ("", True), ("a", True), ("a", True), ("b", False)]


def test_fill_from_first(spark):
    df = spark.createDataFrame([("f1", 0, "2024-01-01", "USD"), ("f1", 1, None, None),
                                ("f2", 5, None, "EUR"), ("f2", 3, None, None)],
                               "file string, n int, d string, c string")
    out = {(r.file, r.n): (r.d, r.c) for r in fill_from_first(df, ["d", "c"], "file", "n").collect()}
    assert out[("f1", 1)] == ("2024-01-01", "USD")
    assert out[("f2", 5)] == (None, None)     # the first row's NULLs are spread too


def test_pick_formats_per_file(spark):
    df = spark.createDataFrame([("a", "01-02-2024"), ("a", "25-02-2024"), ("b", "01-02-2024"),
                                ("b", "02-25-2024"), ("c", "nonsense")], "file string, d string")
    out = {(r.file, r.d) for r in pick_formats(df, ["d"], ["%d-%m-%Y", "%m-%d-%Y"], "file").collect()}
    assert ("a", "2024-02-01 00:00:00") in out          # day first fits all of file a
    assert ("b", "2024-01-02 00:00:00") in out          # only month first fits all of b
    assert ("c", "nonsense") in out                     # nothing fits: text kept


def test_merge_lines(spark):
    lines = [("big.csv", 0, "date,order,amount,marketplace"), ("big.csv", 1, "x"), ("big.csv", 2, "y"), ("big.csv", 3, "y"),
             ("small.csv", 0, "other header"), ("small.csv", 1, "x"), ("small.csv", 2, "z"),
             ("small.csv", 3, "z")]
    df = spark.createDataFrame(lines, "file_name string, line_no long, line string")
    out = sorted((r.file_name, r.line) for r in merge_lines(df).collect())
    assert out == [("big.csv", "date,order,amount,marketplace"), ("big.csv", "x"),
                   ("big.csv", "y"), ("big.csv", "y"), ("small.csv", "z"), ("small.csv", "z")]


def test_distinct_files(spark):
    df = spark.createDataFrame([("b.csv", 3, "m1"), ("a.csv", 3, "m1"), ("c.csv", 3, "m2")],
                               "path string, length long, md5 string")
    assert sorted(r.path for r in distinct_files(df).collect()) == ["a.csv", "c.csv"]


def test_delimiters_and_header_mapping(spark):
    lines = [("t.csv", 0, "Date\tASIN"), ("t.csv", 1, "10/11/2024\tB01"),
             ("s.csv", 0, "ASIN;Extra;Date"), ("s.csv", 1, "B02;x;25.10.2024"),
             ("u.csv", 0, "nothing here"), ("u.csv", 1, "at all")]
    df = spark.createDataFrame(lines, "file_name string, line_no long, line string")
    d = infer_delimiters(df)
    assert {r.file_name: r.delimiter for r in d.collect()} == {"t.csv": "\t", "s.csv": ";"}
    got = {r.file_name: (r.Date, r.ASIN, r.Location) for r in
           fields_by_header(df, d, ["Date", "ASIN", "Location"]).collect()}
    assert got == {"t.csv": ("10/11/2024", "B01", None), "s.csv": ("25.10.2024", "B02", None)}


def _samples(spark, values, device=1, chunk_hours=False):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(device, t0 + dt.timedelta(hours=i * (5 if chunk_hours else 1)), i, float(v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "device long, ts timestamp_ntz, seq long, pct double")


def test_hysteresis_events(spark):
    df = _samples(spark, [50, 95, 85, 92, 79, 80, 91, 90])
    got = [(r.pct, r.event) for r in alert_events(df).orderBy("ts").collect()]
    assert got == [(95.0, "ALERT"), (79.0, "NORMAL"), (91.0, "ALERT")]


def test_hysteresis_reminder_across_chunks(spark):
    # 1 alert sample then 60 more high samples: one reminder at the 60th;
    # samples are 5 h apart so the series spans many day chunks.
    df = _samples(spark, [95] + [85] * 60 + [70], chunk_hours=True)
    got = [(r.event) for r in alert_events(df, chunk="day").orderBy("ts").collect()]
    assert got == ["ALERT", "REMINDER", "NORMAL"]
    same = [(r.event) for r in alert_events(df, chunk="year").orderBy("ts").collect()]
    assert same == got


def test_hysteresis_null_device_kept(spark):
    df = _samples(spark, [50, 95, 70]).withColumn("device", F.lit(None).cast("long"))
    got = [(r.device, r.event) for r in alert_events(df).orderBy("ts").collect()]
    assert got == [(None, "ALERT"), (None, "NORMAL")]


def test_text_devices(spark):
    from ledgerlens.operators.alerts import argmax_per_bucket
    df = _samples(spark, [50, 95, 95, 40]).withColumn("device", F.concat(F.lit("disk"), F.col("seq") % 3))
    df = df.withColumn("ts", F.lit("2024-01-01 00:10:00").cast("timestamp_ntz"))
    (row,) = argmax_per_bucket(df).collect()
    assert (row.max_device, row.max_value, row.samples) == ("disk1", 95.0, 4)
    assert {r.device for r in alert_events(df).collect()} == {"disk1", "disk2"}


def test_wide_and_quoted_files(spark):
    from ledgerlens.operators.delimited import delimiter_rejects
    wide = [f"c{i}" for i in range(40)]
    lines = [("w.csv", 0, ",".join(wide)), ("w.csv", 1, ",".join(str(i) for i in range(40))),
             ("q.csv", 0, "Title,ASIN"), ("q.csv", 1, '"Lamp, black",B1'), ("q.csv", 2, '"12"" pipe",'),
             ("q.csv", 3, '12" rod,B3'), ("e.tsv", 0, "Title\tASIN"), ("e.tsv", 1, "\tB4"), ("e.tsv", 2, '""\tB5'),
             ("u.csv", 0, "nothing here"), ("u.csv", 1, "a;b, c"),
             *(("l.csv", i, "a,b" if i < 70 else "a,b,c") for i in range(80))]
    df = spark.createDataFrame(lines, "file_name string, line_no long, line string")
    assert {r.file_name for r in delimiter_rejects(df).collect()} == {"u.csv", "l.csv"}
    files = infer_delimiters(df)
    (w,) = fields_by_header(df, files, ["c0", "c39", "c32"]).where("file_name = 'w.csv'").collect()
    assert (w.c0, w.c39, w.c32) == ("0", "39", "32")
    got = [(r.Title, r.ASIN) for r in fields_by_header(df, files, ["Title", "ASIN"])
           .where("file_name in ('q.csv', 'e.tsv')").orderBy("file_name", "line_no").collect()]
    assert got == [(None, "B4"), ("", "B5"), ("Lamp, black", "B1"), ('12" pipe', None), ('12" rod', "B3")]


def test_merge_base_by_bytes(spark):
    lines = [("a.csv", 0, "h"), ("a.csv", 1, "ééééé"), ("b.csv", 0, "h"), ("b.csv", 1, "abcdef"), ("b.csv", 2, "ééééé")]
    df = spark.createDataFrame(lines, "file_name string, line_no long, line string")
    small = df.where("file_name = 'a.csv' OR line_no < 2")
    assert sorted((r.file_name, r.line) for r in merge_lines(small).collect()) == [
        ("a.csv", "h"), ("a.csv", "ééééé"), ("b.csv", "abcdef")]
    sizes = spark.createDataFrame([("a.csv", 1), ("b.csv", 9)], "f string, n long")
    assert {r.file_name for r in merge_lines(df, sizes=sizes).collect()} == {"b.csv"}


def test_no_job_runs_before_the_result(spark):
    import ledgerlens.plans.settlement as settlement
    import ledgerlens.plans.transactions as transactions
    from ledgerlens.plans.common import RUN_TS, table
    li = table(spark, "/root/testdata/sf0.001", "lineitem")
    rows = settlement.render_settlement_rows(li)
    lines = transactions.render_transaction_lines(li, "US")
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    settlement.settlement_job(rows, RUN_TS, order=["l_orderkey", "l_linenumber"])
    transactions.transactions_job(lines, "US", RUN_TS)
    alert_events(_samples(spark, [50, 95]))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext._jsc.getPersistentRDDs()
