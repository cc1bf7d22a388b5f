"""Inventory ledger, sales-and-traffic JSON, and the file-level operators
(encoding fallback, CSV round trip, conform, file dedup, line merge)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StringType, StructField, StructType,
)

from ledgerlens.functions import iso_date, percent_text
from ledgerlens.layouts import (
    INVENTORY_OUT, TRAFFIC_INT_FIELDS, TRAFFIC_OUT, TRAFFIC_PERCENT, TRAFFIC_PERCENT_FIELDS,
)
from ledgerlens.operators import conform, distinct_files, merge_lines, with_constants
from ledgerlens.operators.delimited import FILE_KEY, NO_DELIMITER, delimiter_rejects, fields_by_header, infer_delimiters
from ledgerlens.plans.common import RUN_DATE, land_files, table
from ledgerlens.session import scratch_path, stored
from ledgerlens.sinks import write_csv, write_lines
from ledgerlens.sources import (
    decode_fallback, digests, file_sizes, json_documents, json_parts, read_delimited, read_json_parts, read_lines, read_records,
    read_text_in_order,
)
from ledgerlens.sources.files import CORRUPT, DAMAGED, UNREADABLE

# ------------------------------------------------------------------ inventory


def inventory_job(records: DataFrame, by: Sequence[str] = ("file_name",)) -> DataFrame:
    """J-INV: records of ledger files with unknown delimiters -> 22 columns,
    'Date' as ISO text (month first when ambiguous), source file name. ``by``
    tells files apart (``FILE_KEY`` for files read from folders)."""
    delims = infer_delimiters(records, by=by)
    cols = [c for c in INVENTORY_OUT if c != "file_name"]
    df = fields_by_header(records, delims, cols, by, by)
    df = df.withColumn("Date", F.regexp_replace(F.col("Date"), "[./]", "-"))
    df = df.withColumn("Date", iso_date(F.col("Date")))
    return conform(df, INVENTORY_OUT)


_SEG_DELIM = {"AUTOMOBILE": ",", "BUILDING": "\t", "FURNITURE": ";", "HOUSEHOLD": "|",
              "MACHINERY": ","}
_INV_SRC = {  # ledger column -> customer expression (text)
    "FNSKU": "concat('X00', c_custkey)", "ASIN": "concat('B0', c_nationkey)",
    "MSKU": "concat('SKU-', c_custkey)", "Title": "c_name", "Disposition": "'SELLABLE'",
    "Starting Warehouse Balance": "cast(c_nationkey as string)",
    "Receipts": "cast(c_custkey % 10 as string)", "Customer Shipments": "'-1'",
    "Ending Warehouse Balance": "cast(c_nationkey + c_custkey % 10 - 1 as string)",
    "Location": "'US'",
}


def render_inventory_lines(customer: DataFrame, gap: str = " ") -> DataFrame:
    """One ledger file per market segment, each with its own delimiter; the
    FURNITURE file has no Location column and 21 extra columns, 20 of them
    first, so it is wider than 32; MACHINERY titles hold the delimiter, quotes
    and ``gap``; dates come as month-first, day-first, ISO or junk text. One more
    file has no delimiter at all."""
    seg = F.col("c_mktsegment")
    k = F.col("c_custkey") % 4
    d = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    date_txt = (F.when(k == 0, F.date_format(d, "MM/dd/yyyy")).when(k == 1, F.date_format(d, "dd.MM.yyyy"))
                .when(k == 2, F.date_format(d, "yyyy-MM-dd")).otherwise(F.lit("unknown")))
    names = [c for c in INVENTORY_OUT if c != "file_name"]
    furn = seg == "FURNITURE"
    vals = [date_txt if n == "Date" else F.expr(_INV_SRC.get(n, "'0'")) for n in names]
    vals[names.index("Title")] = F.when(seg == "MACHINERY", F.concat(
        F.lit(f'"Lamp, 12"" black{gap}'), F.col("c_name"), F.lit('"'))).otherwise(F.col("c_name"))
    fv = ([F.lit(f"x{i}") for i in range(20)] + [v for n, v in zip(names, vals) if n != "Location"] + [F.lit("note")])
    hv = [F.lit(n) for n in names]
    hfv = ([F.lit(f"Extra {i}") for i in range(20)] + [F.lit(n) for n in names if n != "Location"]
           + [F.lit("Extra Column")])
    delim = F.lit(None).cast("string")
    for sname, dl in _SEG_DELIM.items():
        delim = F.when(seg == sname, F.lit(dl)).otherwise(delim)
    # Only the titles of MACHINERY hold a delimiter or quote; they are quoted.
    data_arr = F.when(furn, F.array(*fv)).otherwise(F.array(*vals))
    head_arr = F.when(furn, F.array(*hfv)).otherwise(F.array(*hv))
    staged = customer.select("c_custkey", "c_mktsegment", delim.alias("_d"),
                             data_arr.alias("_a"), head_arr.alias("_h"), furn.alias("_f"))
    data_line = F.expr("array_join(_a, _d)")
    header_line = F.expr("array_join(_h, _d)")
    customer = staged
    fname = F.concat(F.lit("inventory_"), F.lower(seg), F.lit(".csv"))
    rows = customer.select(fname.alias("file_name"), (F.col("c_custkey") + 1).alias("line_no"),
                           data_line.alias("line"), header_line.alias("_header"), furn.alias("_f"))
    headers = rows.groupBy("file_name").agg(F.first("_header").alias("line")) \
        .select("file_name", F.lit(0).cast("bigint").alias("line_no"), "line")
    broken = customer.where(F.col("c_custkey") % 10 == 0).select(
        F.lit("inventory_broken.csv").alias("file_name"), (F.col("c_custkey") + 1).alias("line_no"),
        F.lit("export failed").alias("line"))
    return headers.unionByName(rows.select("file_name", "line_no", "line")).unionByName(broken)


def q_delimiter_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-INV over five ledger files rendered from customer."""
    return inventory_job(render_inventory_lines(table(spark, sf_dir, "customer")))


def q_inventory_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-INV over ledger files that all have the same name, each in a folder of
    its own; titles hold line breaks."""
    lines = render_inventory_lines(table(spark, sf_dir, "customer"), gap="\n")
    files = lines.select(F.regexp_replace("file_name", r"^inventory_(\w+)\.csv$", "$1/inventory.csv").alias("file"), "line_no", "line")
    folder = land_files(files, scratch_path(spark, "inventory"), [F.col("line_no")])
    return inventory_job(read_records(spark, f"{folder}/*"), FILE_KEY)


def q_delimiter_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger files whose delimiter cannot be told, with the reason."""
    return delimiter_rejects(render_inventory_lines(table(spark, sf_dir, "customer")))


# -------------------------------------------------------------------- traffic

def traffic_schema() -> StructType:
    traffic = []
    for f in TRAFFIC_INT_FIELDS:
        traffic += [StructField(f, LongType()), StructField(f + "B2B", LongType())]
    for f in TRAFFIC_PERCENT_FIELDS:
        traffic += [StructField(f, DoubleType()), StructField(f + "B2B", DoubleType())]
    amount = StructType([StructField("amount", DoubleType()),
                         StructField("currencyCode", StringType())])
    sales = StructType([
        StructField("unitsOrdered", LongType()), StructField("unitsOrderedB2B", LongType()),
        StructField("orderedProductSales", amount), StructField("orderedProductSalesB2B", amount),
        StructField("totalOrderItems", LongType()), StructField("totalOrderItemsB2B", LongType())])
    item = StructType([StructField("parentAsin", StringType()), StructField("childAsin", StringType()),
                       StructField("trafficByAsin", StructType(traffic)),
                       StructField("salesByAsin", sales)])
    return StructType([StructField("salesAndTrafficByAsin", ArrayType(item))])


def parsed_traffic(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """JSON text as structs; the field ``_corrupt_record`` holds the text of a
    damaged document."""
    whole = StructType([*traffic_schema().fields, StructField(CORRUPT, StringType())])
    return docs.withColumn(doc_col, F.from_json(F.col(doc_col), whole, {"columnNameOfCorruptRecord": CORRUPT}))


B2B_SESSIONS = "trafficByAsin.browserSessionPercentageB2B"


def flatten_traffic(docs: DataFrame, run_date: str, doc_col: str = "doc", file_col: str = "file_name",
                    b2b_session_percent: bool = False, file_date_only: str | None = None) -> DataFrame:
    """J-TRAFFIC: sales-and-traffic documents -> one row per item, nested
    fields as dotted column names, 15 percentages as '%' text, plus year,
    file date (from the file name), file name and run date (40 columns).

    ``docs`` holds parsed documents (``doc`` a struct of ``traffic_schema``)
    or JSON text, which is parsed with that schema; damaged documents give no
    rows. ``file_date_only`` publishes the report of one day.
    ``b2b_session_percent`` also writes the B2B share of browser sessions with
    '%', which the published layout keeps as a number."""
    if dict(docs.dtypes).get(doc_col) == "string":
        docs = parsed_traffic(docs, doc_col).where(F.col(f"{doc_col}.{CORRUPT}").isNull())
    items = docs.select(file_col, F.explode(f"{doc_col}.salesAndTrafficByAsin").alias("i"))
    file_date = F.regexp_extract(F.col(file_col), r"(\d{4}-\d{2}-\d{2})", 1)
    if file_date_only:
        # Only this day's report is published, of several that were made.
        items = items.where(file_date == file_date_only)
    cols = []
    for name in TRAFFIC_OUT[:-4]:
        e = F.col("i." + name)
        if name in TRAFFIC_PERCENT or (b2b_session_percent and name == B2B_SESSIONS):
            e = percent_text(e)
        cols.append(e.alias(name))
    return items.select(*cols, F.split_part(file_date, F.lit("-"), F.lit(1)).alias("year"),
                        file_date.alias("file_date"), F.col(file_col).alias("file_name"),
                        F.lit(run_date).alias("run_date"))


def render_traffic_docs(li: DataFrame) -> DataFrame:
    """One JSON document per line item: one item, two for every third line
    number, none for line 7; no traffic block for every fourth line."""
    L = F.col
    q = L("l_quantity").cast("bigint")
    ints = {"mobileAppSessions": q, "browserSessions": q + 1, "sessions": 2 * q + 1,
            "mobileAppPageViews": 2 * q, "browserPageViews": 3 * q, "pageViews": 5 * q}
    traffic = []
    for i, f in enumerate(TRAFFIC_INT_FIELDS):
        traffic += [ints[f].alias(f), (L("l_linenumber") + i).cast("bigint").alias(f + "B2B")]
    for i, f in enumerate(TRAFFIC_PERCENT_FIELDS):
        a, b = (L("l_discount"), L("l_tax")) if i % 2 == 0 else (L("l_tax"), L("l_discount"))
        traffic += [a.alias(f), F.when(L("l_linenumber") % 5 != 0, b).alias(f + "B2B")]

    def item(suffix: str):
        return F.struct(
            F.concat(F.lit("P"), L("l_partkey").cast("string")).alias("parentAsin"),
            F.concat(F.lit("C"), L("l_partkey").cast("string"), F.lit("-"), L("l_suppkey").cast("string"),
                     F.lit(suffix)).alias("childAsin"),
            F.when(L("l_linenumber") % 4 != 0, F.struct(*traffic)).alias("trafficByAsin"),
            F.struct(q.alias("unitsOrdered"), F.lit(0).cast("bigint").alias("unitsOrderedB2B"),
                     F.struct(L("l_extendedprice").alias("amount"), F.lit("USD").alias("currencyCode"))
                     .alias("orderedProductSales"),
                     F.struct(F.lit(0.0).alias("amount"), F.lit("USD").alias("currencyCode"))
                     .alias("orderedProductSalesB2B"),
                     L("l_linenumber").cast("bigint").alias("totalOrderItems"),
                     F.lit(0).cast("bigint").alias("totalOrderItemsB2B")).alias("salesByAsin"))
    items = F.when(L("l_linenumber") == 7, F.filter(F.array(item("")), lambda x: F.lit(False))) \
        .when(L("l_linenumber") % 3 == 0, F.array(item(""), item("-b"))) \
        .otherwise(F.array(item("")))
    doc = F.to_json(F.struct(items.alias("salesAndTrafficByAsin")))
    fname = F.concat(F.lit("business_report_"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(".json"))
    return li.select(fname.alias("file_name"), doc.alias("doc"))


def land_traffic(spark: SparkSession, sf_dir: str) -> str:
    """The documents of a month as one file, an array of items over many
    lines; of every fifth month the download was cut off, of February 1995 a
    number came as text."""
    docs = render_traffic_docs(table(spark, sf_dir, "lineitem"))
    month = F.concat(F.regexp_extract("file_name", r"(\d{4}-\d{2})", 1), F.lit("-01"))
    items = F.regexp_extract("doc", r'(?s)^\{"salesAndTrafficByAsin":\[(.*)\]\}$', 1)
    # Read three times below, rendered once.
    body = stored(docs.select(month.alias("day"), items.alias("line")).where("line <> ''"), "traffic-items")
    # The first item is empty, so each other one starts with a comma.
    wrong = F.lit('{"parentAsin":"P","trafficByAsin":{"sessions":"many"}}')
    head = body.select("day").distinct().select("day", F.lit(0).alias("part"), F.when(
        F.col("day") == "1995-02-01", F.concat(F.lit('{"salesAndTrafficByAsin":['), wrong)).otherwise(
        F.lit('{"salesAndTrafficByAsin":[{}')).alias("line"))
    tail = head.where("CAST(substring(day, 6, 2) AS INT) % 5 <> 0").select("day", F.lit(2).alias("part"), F.lit("]}").alias("line"))
    lines = head.unionByName(body.select("day", F.lit(1).alias("part"), F.concat(F.lit(","), F.col("line")).alias("line"))).unionByName(tail)
    return land_files(lines.withColumn("file", F.concat(F.lit("business_report_"), F.col("day"), F.lit(".json"))),
                      scratch_path(spark, "traffic"), [F.col("part"), F.col("line")], codec="gzip")


def q_traffic_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-TRAFFIC over landed monthly documents; damaged ones give no rows. The
    B2B share of browser sessions is written with '%' too."""
    docs, _ = read_json_parts(spark, land_traffic(spark, sf_dir), traffic_schema(), glob="*.json.gz")
    return flatten_traffic(docs, RUN_DATE, b2b_session_percent=True).where("childAsin IS NOT NULL")


def q_traffic_file_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several reports made, only one day's is published."""
    docs = render_traffic_docs(table(spark, sf_dir, "lineitem"))
    return flatten_traffic(docs, RUN_DATE, file_date_only="1996-03-13").select("parentAsin", "childAsin", "file_date", "file_name")


def q_traffic_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged documents: file, how the text begins, the reason."""
    parts = json_parts(spark, land_traffic(spark, sf_dir), traffic_schema(), glob="*.json.gz", sample_chars=28)
    return json_documents(parts).where("reason IS NOT NULL").select("file_name", "text", "reason")


def q_traffic_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_traffic(render_traffic_docs(table(spark, sf_dir, "lineitem")), RUN_DATE)


# ------------------------------------------------------------- file operators

def q_encoding_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document bytes in UTF-8 or Latin-1 (French and German ones) decoded
    with the fallback; the encoding used is returned too."""
    d = table(spark, sf_dir, "documents")
    latin = F.col("lang").isin("fr", "de")
    safe = F.regexp_replace("text", "[^\\x00-\\xFF]", "?")
    content = F.when(latin, F.encode(safe, "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    b = d.select("doc_id", content.alias("content"))
    utf8 = F.is_valid_utf8(F.col("content").cast("string"))
    return b.select("doc_id", decode_fallback(F.col("content")).alias("text"),
                    F.when(utf8, F.lit("UTF-8")).otherwise(F.lit("ISO-8859-1")).alias("encoding"))


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer published as CSV beside a JSON file, read back with a '*.csv'
    filter and an all-string schema, typed by rule, with file lineage. Every
    third name holds quotes, a separator and a line break."""
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv-roundtrip")
    odd = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('12" "pipe", a\nb '), F.col("c_name"))).otherwise(F.col("c_name"))
    write_csv(c.withColumn("c_name", odd).select([F.col(x).cast("string") for x in c.columns]), path)
    c.limit(5).write.mode("append").json(path)  # a neighbour the filter must skip
    from ledgerlens.layouts import string_schema
    back = read_delimited(spark, path, string_schema(c.columns), with_file="file_name", multi_line=True)
    return back.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment",
        F.col("file_name").endswith(".csv").alias("is_csv"))


def q_conform_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer conformed to a report layout: order set, extra columns
    dropped, a missing one NULL, constants added."""
    c = table(spark, sf_dir, "customer")
    c = with_constants(c, {"run_date": RUN_DATE, "active_flag": 0})
    return conform(c, ["c_custkey", "c_mktsegment", "c_name", "missing_column", "active_flag",
                       "run_date"])


def q_file_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: copies (same size and MD5) dropped, the first by
    path kept."""
    d = table(spark, sf_dir, "documents")
    content = F.encode("text", "UTF-8")
    files = d.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
                     F.length(content).cast("bigint").alias("length"), F.md5(content).alias("md5"))
    return distinct_files(files)


def q_file_dedup_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers of each nation as a file in two folders; the second copy
    of odd nations has its names in lower case. Of files with the same size and
    digest the first by path stays. Contents are streamed, not rows."""
    c = table(spark, sf_dir, "customer")
    lower = (F.col("folder") == "b") & (F.col("c_nationkey") % 2 == 1)
    lines = c.select("c_custkey", "c_nationkey", "c_name", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("folder")).select(
        F.concat("folder", F.lit("/nation "), F.col("c_nationkey"), F.lit(".csv")).alias("file"), "c_custkey",
        F.when(lower, F.lower("c_name")).otherwise(F.col("c_name")).alias("line"))
    folder = land_files(lines, scratch_path(spark, "nations"), [F.col("c_custkey")])
    files = digests(spark, f"{folder}/*", glob="*.csv")
    return distinct_files(files).select(F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("path"), "length", "md5")


def land_extracts(spark: SparkSession, sf_dir: str) -> str:
    """Each event type as an extract of 'day,user' lines with a header, all in
    a folder of their own under the same name; the purchase lines hold accented
    letters: fewer characters, more bytes. Lines are those of the events in
    order; every seventh is indented."""
    e = table(spark, sf_dir, "events")
    fname = F.concat(F.col("event_type"), F.lit("/extract.csv"))
    line = F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd"), F.col("user_id").cast("string"),
                       F.when(F.col("event_type") == "purchase", F.lit("ñññ")).otherwise(F.lit("nnnn")))
    data = e.select(fname.alias("file"), F.col("event_id").alias("no"),
                    F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("  "), line)).otherwise(line).alias("line"))
    header = data.select("file").distinct().select("file", F.lit(-1).cast("bigint").alias("no"), F.lit("\ufeffday,user").alias("line"))
    return land_files(header.unionByName(data), scratch_path(spark, "extracts"), [F.col("no")])


def merged_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = land_extracts(spark, sf_dir)
    lines = read_lines(spark, f"{folder}/*")
    return merge_lines(lines, file_col="file_path", sizes=file_sizes(spark, f"{folder}/*"))


def q_line_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracts read as files (told apart by path, numbered in ranges);
    the largest in bytes is the base, the others add only lines it lacks."""
    return merged_extracts(spark, sf_dir).select(
        F.element_at(F.split("file_path", "/"), -2).alias("extract"), "file_name", "line_no", "line")


def q_merged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged lines written as one text in order (largest extract first)
    with a byte-order mark, and read back by their number."""
    folder = land_extracts(spark, sf_dir)
    sizes = file_sizes(spark, f"{folder}/*")
    merged = merge_lines(read_lines(spark, f"{folder}/*"), file_col="file_path", sizes=sizes)
    out = scratch_path(spark, "merged-text")
    ordered = merged.join(sizes, merged["file_path"] == sizes["path"])
    write_lines(ordered, out, order=[F.col("length").desc(), F.col("file_path"), F.col("line_no")], mark=True)
    return read_text_in_order(spark, out).select("line_no", "line")


# --------------------------------------------------------------------- oracles

def _inventory_sql(landed: bool = False) -> str:
    gap = "chr(10)" if landed else "' '"
    names = [c for c in INVENTORY_OUT if c != "file_name"]
    date_sql = ("CASE c_custkey % 4 WHEN 0 THEN strftime(d, '%Y-%m-%d') "
                "WHEN 1 THEN CASE WHEN day(d) <= 12 THEN strftime(make_date(year(d), day(d), month(d)), '%Y-%m-%d') "
                "ELSE strftime(d, '%Y-%m-%d') END WHEN 2 THEN strftime(d, '%Y-%m-%d') END")
    cols = []
    for n in names:
        if n == "Date":
            e = date_sql
        elif n == "Title":
            e = f"CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Lamp, 12\" black' || {gap} || c_name ELSE c_name END"
        elif n == "Location":
            e = "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE 'US' END"
        else:
            e = _INV_SRC.get(n, "'0'").replace("concat('X00', c_custkey)", "'X00' || c_custkey") \
                .replace("concat('B0', c_nationkey)", "'B0' || c_nationkey") \
                .replace("concat('SKU-', c_custkey)", "'SKU-' || c_custkey")
            e = e.replace("cast(", "CAST(").replace(" as string)", " AS VARCHAR)")
        cols.append(f'{e} AS "{n}"')
    cols.append("'inventory.csv' AS file_name" if landed else "'inventory_' || lower(c_mktsegment) || '.csv' AS file_name")
    return ("SELECT " + ",\n  ".join(cols) +
            "\nFROM (SELECT *, DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS d FROM customer) c")


def _traffic_sql(landed: bool = False) -> str:
    ints = {"mobileAppSessions": "q", "browserSessions": "q + 1", "sessions": "2 * q + 1",
            "mobileAppPageViews": "2 * q", "browserPageViews": "3 * q", "pageViews": "5 * q"}
    val = {}
    for i, f in enumerate(TRAFFIC_INT_FIELDS):
        val[f"trafficByAsin.{f}"] = ints[f]
        val[f"trafficByAsin.{f}B2B"] = f"CAST(l_linenumber + {i} AS BIGINT)"
    for i, f in enumerate(TRAFFIC_PERCENT_FIELDS):
        a, b = ("l_discount", "l_tax") if i % 2 == 0 else ("l_tax", "l_discount")
        val[f"trafficByAsin.{f}"] = a
        val[f"trafficByAsin.{f}B2B"] = f"CASE WHEN l_linenumber % 5 <> 0 THEN {b} END"
    cols = []
    for name in TRAFFIC_OUT[:-4]:
        if name == "parentAsin":
            e = "'P' || l_partkey"
        elif name == "childAsin":
            e = "'C' || l_partkey || '-' || l_suppkey || sfx"
        elif name.startswith("trafficByAsin."):
            e = f"CASE WHEN l_linenumber % 4 <> 0 THEN {val[name]} END"
            if name in TRAFFIC_PERCENT or (landed and name == B2B_SESSIONS):
                e = f"CAST({e} AS VARCHAR) || '%'"
        else:
            e = {"salesByAsin.unitsOrdered": "q", "salesByAsin.unitsOrderedB2B": "CAST(0 AS BIGINT)",
                 "salesByAsin.orderedProductSales.amount": "l_extendedprice",
                 "salesByAsin.orderedProductSalesB2B.amount": "CAST(0.0 AS DOUBLE)",
                 "salesByAsin.totalOrderItems": "CAST(l_linenumber AS BIGINT)",
                 "salesByAsin.totalOrderItemsB2B": "CAST(0 AS BIGINT)"}[name]
        cols.append(f'{e} AS "{name}"')
    cols += ["strftime(l_shipdate, '%Y') AS year", "strftime(l_shipdate, '%Y-%m-%d') AS file_date",
             "'business_report_' || strftime(l_shipdate, '%Y-%m-%d') || '.json' AS file_name",
             f"'{RUN_DATE}' AS run_date"]
    if landed:
        cols = [c.replace("strftime(l_shipdate, '%Y-%m-%d')", "strftime(l_shipdate, '%Y-%m-01')") for c in cols]
    where = "WHERE month(l_shipdate) % 5 <> 0 AND strftime(l_shipdate, '%Y-%m') <> '1995-02'" if landed else ""
    return f"""
WITH items AS (
  SELECT *, CAST(l_quantity AS BIGINT) AS q, '' AS sfx FROM lineitem WHERE l_linenumber <> 7
  UNION ALL
  SELECT *, CAST(l_quantity AS BIGINT) AS q, '-b' AS sfx FROM lineitem
  WHERE l_linenumber <> 7 AND l_linenumber % 3 = 0)
SELECT {", ".join(cols)}
FROM items {where}"""


_MERGED_SQL = """
WITH e AS (
  SELECT event_type AS file, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS line_no,
         CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS indent,
         strftime(ts, '%Y-%m-%d') || ',' || CAST(user_id AS VARCHAR)
           || CASE WHEN event_type = 'purchase' THEN ',ñññ' ELSE ',nnnn' END AS line FROM events),
l AS (
  SELECT * FROM e UNION ALL SELECT DISTINCT event_type, 0, 3, 'day,user' FROM events),
s AS (SELECT file, sum(octet_length(encode(line)) + indent + 1) AS bytes FROM l GROUP BY file),
b AS (SELECT file FROM s ORDER BY bytes DESC, file LIMIT 1),
m AS (
  SELECT l.* FROM l JOIN b USING (file)
  UNION ALL
  SELECT l.* FROM l WHERE file <> (SELECT file FROM b) AND line_no > 0
    AND line NOT IN (SELECT line FROM l JOIN b USING (file)))
"""

ORACLE = {
    "delimiter_infer": _inventory_sql(),
    "inventory_landed": _inventory_sql(landed=True),
    "delimiter_rejects": f"""
SELECT DISTINCT 'inventory_broken.csv' AS file_name, 'export failed' AS first_line, '{NO_DELIMITER}' AS reason
FROM customer WHERE c_custkey % 10 = 0 AND c_custkey < 5000""",
    "traffic_flatten": _traffic_sql(),
    "traffic_landed": _traffic_sql(landed=True),
    "traffic_file_date": f"SELECT parentAsin, childAsin, file_date, file_name FROM ({_traffic_sql()}) t WHERE file_date = '1996-03-13'",
    "traffic_rejects": f"""
SELECT DISTINCT 'business_report_' || strftime(l_shipdate, '%Y-%m-01') || '.json' AS file_name,
  CASE WHEN strftime(l_shipdate, '%Y-%m') = '1995-02' THEN '{{"salesAndTrafficByAsin":[{{"' ELSE '{{"salesAndTrafficByAsin":[{{}}' END AS text,
  CASE WHEN strftime(l_shipdate, '%Y-%m') = '1995-02' THEN '{DAMAGED}' ELSE '{UNREADABLE}' END AS reason
FROM lineitem WHERE l_linenumber <> 7 AND (month(l_shipdate) % 5 = 0 OR strftime(l_shipdate, '%Y-%m') = '1995-02')""",
    "encoding_fallback": """
SELECT doc_id, text,
  CASE WHEN lang IN ('fr', 'de') AND regexp_matches(text, '[^\\x00-\\x7F]') THEN 'ISO-8859-1'
       ELSE 'UTF-8' END AS encoding
FROM documents""",
    "csv_roundtrip": """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '12" "pipe", a' || chr(10) || 'b ' || c_name ELSE c_name END AS c_name,
  c_nationkey, c_acctbal, c_mktsegment, true AS is_csv FROM customer""",
    "conform_layout": f"""
SELECT c_custkey, c_mktsegment, c_name, CAST(NULL AS VARCHAR) AS missing_column,
  0 AS active_flag, '{RUN_DATE}' AS run_date
FROM customer""",
    "file_dedup": """
SELECT min(path) AS path, length, md5
FROM (SELECT 'doc_' || doc_id || '.txt' AS path, CAST(octet_length(encode(text)) AS BIGINT) AS length,
             md5(text) AS md5 FROM documents) f
GROUP BY length, md5""",
    "file_dedup_landed": """
SELECT min(path) AS path, length, md5 FROM (
  SELECT path, octet_length(encode(text)) AS length, md5(text) AS md5 FROM (
    SELECT f || '/nation ' || c_nationkey || '.csv' AS path,
      string_agg(CASE WHEN f = 'b' AND c_nationkey % 2 = 1 THEN lower(c_name) ELSE c_name END || chr(10), '' ORDER BY c_custkey) AS text
    FROM customer, (VALUES ('a'), ('b')) v(f) GROUP BY f, c_nationkey) t) u
GROUP BY length, md5""",
    "line_merge": _MERGED_SQL + """
SELECT file AS extract, 'extract.csv' AS file_name, line_no, line FROM m""",
    "merged_text": _MERGED_SQL + """
SELECT row_number() OVER (ORDER BY bytes DESC, file, line_no) - 1 AS line_no, line FROM m JOIN s USING (file)""",
}

QUERIES = {
    "delimiter_infer": q_delimiter_infer,
    "inventory_landed": q_inventory_landed,
    "delimiter_rejects": q_delimiter_rejects,
    "traffic_flatten": q_traffic_flatten,
    "traffic_landed": q_traffic_landed,
    "traffic_file_date": q_traffic_file_date,
    "traffic_rejects": q_traffic_rejects,
    "encoding_fallback": q_encoding_fallback,
    "csv_roundtrip": q_csv_roundtrip,
    "conform_layout": q_conform_layout,
    "file_dedup": q_file_dedup,
    "file_dedup_landed": q_file_dedup_landed,
    "line_merge": q_line_merge,
    "merged_text": q_merged_text,
}
