"""What is shuffled, rendered and made for each row stays small."""

import random
import re

from pyspark.sql import functions as F

from ledgerlens.functions import localise_month, split_zone
from ledgerlens.functions.text import money, money_decimal
from ledgerlens.operators import merge_lines
from ledgerlens.operators.records import ends_open
from ledgerlens.operators.rejects import Parse, with_rejects
from ledgerlens.plans.common import land_files


def test_the_base_is_shuffled_as_digests(spark):
    rows = [("a", 0, "head"), ("a", 1, "x"), ("a", 2, "x"), ("a", 3, None), ("a", 4, "a longer line"),
            ("b", 0, "head"), ("b", 1, "x"), ("b", 2, "y"), ("b", 3, "y"), ("b", 4, None), ("b", 5, "X")]
    merged = merge_lines(spark.createDataFrame(rows, "file_name string, line_no bigint, line string"))
    assert sorted((r.file_name, r.line_no) for r in merged.collect()) == [("a", n) for n in range(5)] + [("b", n) for n in (2, 3, 4, 5)]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    made = re.findall(r"Aggregate \[_h#\d+\], \[(.*)\]", plan)
    assert made and all("line" not in m for m in made)


def test_lines_are_rendered_once_to_land(spark, tmp_path):
    rendered = spark.sparkContext.accumulator(0)

    def render(n):
        rendered.add(1)
        return f"line {n}"
    lines = spark.range(1000).select(F.lit("a.csv").alias("file"), F.col("id").alias("no"), F.udf(render)("id").alias("line"))
    land_files(lines, str(tmp_path / "out"), [F.col("no"), F.col("line")])
    assert (tmp_path / "out" / "a.csv").read_text() == "".join(f"line {n}\n" for n in range(1000))
    assert rendered.value == 1000 and [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == ["a.csv"]


def test_rows_without_rejects_have_an_empty_list(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), (" ",)], "m string")
    out = with_rejects(df, [Parse("m", money("m"), [(F.lit(True), "no number")])])
    assert [[tuple(x) for x in r._rejects] for r in out.collect()] == [[], [("m", "x", "no number")], [], []]
    assert "CASE WHEN" in out._jdf.queryExecution().analyzed().toString().split("AS _rejects")[0].split("array_compact")[0]


def test_months_zones_and_amounts_by_the_short_way(spark):
    texts = {"5 enero 2024": "5 enero 2024", "5 ENE 2024": "5 January 2024", "dic y ene": "December y January", "June jun": "June June",
             "octubre oct-Oct": "octubre October-October", "july": "july", "": "", "sept": "September"}
    df = spark.createDataFrame(list(texts), "string")
    assert {r[0]: r[1] for r in df.select("value", localise_month("value")).collect()} == texts
    zones = {"1:00 PM PDT": ("1:00 PM", "PDT"), "1:00 PM": ("1:00 PM", None), "x \t GMT+05:30": ("x", "GMT+05:30"), "x UTC\n": ("x\n", "UTC")}
    got = spark.createDataFrame(list(zones), "string").select("value", *split_zone("value")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == zones
    amounts = {"12.50": "12.50", "-1": "-1.00", "+.5": "0.50", "1.234": None, "1.2300": "1.23", "9999999999999999.99": "9999999999999999.99",
               "123456789012345678.1": None, "1e3": None, "5.": "5.00"}
    got = spark.createDataFrame(list(amounts), "string").select("value", money_decimal("value").cast("string")).collect()
    assert {r[0]: r[1] for r in got} == amounts


def test_open_fields_are_found_in_one_pass(spark):
    def is_open(text, delimiters):
        at = 0
        while True:
            if text[at:at + 1] == '"':
                at += 1
                while text[at:at + 1] != '"' or text[at + 1:at + 2] == '"':
                    if at >= len(text):
                        return True
                    at += 2 if text[at] == '"' else 1
                at += 1
            while at < len(text) and text[at] not in delimiters:
                at += 1
            if at >= len(text):
                return False
            at += 1
    r = random.Random(3)
    texts = sorted({"".join(r.choice('"",a|\t]^-') for _ in range(r.randint(0, 9))) for _ in range(3000)})
    df = spark.createDataFrame(texts, "string").coalesce(2)
    for delimiters in (",", "|\t", ",]^-"):
        got = df.select("value", ends_open(F.col("value"), list(delimiters)).alias("o")).collect()
        assert [x.value for x in got if x.o != is_open(x.value, delimiters)] == []
    assert "regexp_replace" not in df.select(ends_open(F.col("value"), [","]))._jdf.queryExecution().optimizedPlan().toString()
