"""File readers: delimited text, lines with their numbers, binary content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.functions.text import strip_text
from ledgerlens.layouts import DELIMITER_CANDIDATES
from ledgerlens.operators.delimited import FILE_KEY, fields_by_header, known_delimiter
from ledgerlens.operators.records import gathered, leaves_open
from ledgerlens.session import stored


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
                   sep: str = ",", header: bool = True, glob: str | None = "*.csv",
                   encoding: str = "UTF-8", with_file: str | None = None,
                   multi_line: bool = False) -> DataFrame:
    """Delimited text with an explicit all-string schema.

    ``glob`` restricts a folder read to matching names (``*.csv``,
    ``*.{csv,json}``, ``mod*``); sub-folders are not searched. With
    ``with_file`` the source file name is added as a lineage column. Quotes
    follow the CSV rule: a quote inside a quoted field is doubled. With
    ``multi_line`` a quoted field may hold line breaks; a file is then read
    by one task.
    """
    reader = (spark.read.schema(schema).option("header", header).option("sep", sep)
              .option("encoding", encoding).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"')
              .option("recursiveFileLookup", False))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    if with_file:
        df = df.withColumn(with_file, F.col("_metadata.file_name"))
    return df


def read_binary_files(spark: SparkSession, paths: str | Sequence[str],
                      glob: str | None = None) -> DataFrame:
    """(path, length, content, md5) per file. A file is one row, so one file
    must fit in a task (Spark's limit is 2 GB per file)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(list(paths) if not isinstance(paths, str) else paths)
    return df.select("path", "length", "content", F.md5("content").alias("md5"))


def file_sizes(spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv") -> DataFrame:
    """(path, length) of files, from their listing: no content is read. Paths
    are spelled as ``read_lines`` spells them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(list(paths) if not isinstance(paths, str) else paths)
    return listed.select(plain_path(F.col("_metadata.file_path")).alias("path"), "length")


def decode_fallback(content: Column) -> Column:
    """Bytes -> text: UTF-8 when the bytes are valid UTF-8, else Latin-1
    (which accepts every byte, so no further fallback is reachable)."""
    as_utf8 = content.cast("string")
    return F.when(F.is_valid_utf8(as_utf8), F.decode(content, "UTF-8")).otherwise(
        F.decode(content, "ISO-8859-1"))


def explode_lines(df: DataFrame, file_col: str, text_col: str,
                  keep: Sequence[str] = (), strip: bool = True) -> DataFrame:
    """Text of a file -> one row per line: (file, line_no, line).

    A leading byte-order mark is dropped, lines split on CR LF, CR or LF,
    and each line is stripped unless ``strip`` is off (delimited lines keep
    their leading blanks and tabs, which are fields). A final line break does
    not start another line, and an empty file has none. ``line_no`` counts
    from 0 in file order.

    The text is split once per file; nothing evaluated per output line looks
    at the whole text again (that would be quadratic in the file size).
    """
    t = F.col(text_col)
    t = F.when(t.startswith("\ufeff"), F.substring(t, 2, 2147483647)).otherwise(t)
    body = F.regexp_replace(t, "(\r\n|\r|\n)\\z", "")
    staged = df.select(*keep, F.col(file_col).alias("file_name"), t.alias("_t"), body.alias("_b"))
    exploded = staged.where(F.col("_t") != "").select(
        *keep, "file_name", F.posexplode(F.split("_b", "\r\n|\r|\n")).alias("line_no", "_raw"))
    return exploded.select(*keep, "file_name", F.col("line_no").cast("bigint").alias("line_no"),
                           (strip_text(F.col("_raw")) if strip else F.col("_raw")).alias("line"))


def plain_path(c: Column) -> Column:
    """A path of the scan's metadata, which is percent-encoded, as it is."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def held_name(c: Column) -> Column:
    """A file name of the scan's metadata; a compressed file goes by the name
    of what it holds."""
    return F.regexp_replace(plain_path(c), r"\.(gz|bz2)$", "")


def _numbered(spark: SparkSession, paths: str | Sequence[str], glob: str | None, strip: bool,
              delimiters: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """(lines, stored lines). With ``delimiters`` the lines also carry
    ``_odd``: a line of their file leaves a quoted field open.

    A line's place counts from the start of its task, so it holds only for the
    cut of the files that this one scan makes: the lines are stored with it, and
    everything else reads the stored lines."""
    reader = spark.read.option("recursiveFileLookup", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    opens = leaves_open(F.col("value"), delimiters) if delimiters else F.lit(False)
    raw = stored(reader.text(list(paths) if not isinstance(paths, str) else paths).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_block_start").alias("_range"), place.alias("_place"),
        F.is_valid_utf8("value").alias("_valid"), opens.alias("_opens"), F.col("value").cast("binary").alias("_raw")), "file-lines")
    ranges = raw.groupBy("_path", "_name", "_range").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"), F.bool_and("_valid").alias("_valid"),
        F.bool_or("_opens").alias("_opens"))
    by_file = Window.partitionBy("_path")
    before = by_file.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "_path", "_range", plain_path(F.col("_path")).alias("file_path"), held_name(F.col("_name")).alias("file_name"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.min("_valid").over(by_file).alias("_utf8"), F.max("_opens").over(by_file).alias("_odd"))
    text = F.when(F.col("_utf8"), F.col("_raw").cast("string")).otherwise(F.decode(F.col("_raw"), "ISO-8859-1"))
    lines = raw.select("_path", "_range", "_place", "_raw").join(F.broadcast(ranges), ["_path", "_range"]).select(
        "file_path", "file_name", (F.col("_place") + F.col("_shift")).alias("line_no"), text.alias("_text"), "_odd")
    unmarked = F.when((F.col("line_no") == 0) & F.col("_text").startswith("\ufeff"), F.substring("_text", 2, 2147483647)) \
        .when((F.col("line_no") == 0) & F.col("_text").startswith("\u00ef\u00bb\u00bf"), F.substring("_text", 4, 2147483647)) \
        .otherwise(F.col("_text"))
    return lines.select("file_path", "file_name", "line_no", (strip_text(unmarked) if strip else unmarked).alias("line"), "_odd"), raw


def read_lines(spark: SparkSession, paths: str | Sequence[str],
               glob: str | None = "*.csv", strip: bool = True) -> DataFrame:
    """(file_path, file_name, line_no, line) for every line of every file.

    Files of any size: Spark's text source reads a file in byte ranges, many
    tasks a file. A range's lines are numbered where they are read and stored;
    a small table of the ranges (first number and count of each) gives every
    range its offset by a running sum, and is broadcast to the lines. Lines end in CR LF,
    CR or LF; a byte-order mark is dropped; a final line break starts no
    further line. The files are read once, when this is called; later changes
    of them are not seen.

    A file whose bytes are not valid UTF-8 is read as Latin-1, all of it.
    ``file_path`` tells files apart; ``file_name`` is its last part, which files
    of several folders may share. ``strip`` cuts white space off each line.
    """
    return _numbered(spark, paths, glob, strip, None)[0].drop("_odd")


def read_text_in_order(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of a text that was written in order in several parts:
    the parts' lines numbered through, parts by name."""
    lines = read_lines(spark, path, glob="part-*", strip=False)
    ends = lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(F.col("file_name").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return lines.join(starts, F.col("file_name") == F.col("_part")).select(
        (F.col("line_no") + F.col("_start")).alias("line_no"), "line")


def read_records(spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv", strip: bool = False,
                 delimiters: Sequence[str] = DELIMITER_CANDIDATES) -> DataFrame:
    """``read_lines`` with the lines of a quoted field joined to one record:
    (file_path, file_name, line_no, line), see ``operators.join_records``.
    Which files need it is found in the pass that numbers the lines; the others
    are read as they are."""
    return read_sized_records(spark, paths, glob, strip, delimiters)[0]


def read_sized_records(spark: SparkSession, paths: str | Sequence[str], glob: str | None = "*.csv", strip: bool = False,
                       delimiters: Sequence[str] = DELIMITER_CANDIDATES) -> tuple[DataFrame, DataFrame]:
    """(``read_records``, (path, length)): the bytes of a file's lines as they
    were read, which for compressed files the listing does not tell."""
    lines, raw = _numbered(spark, paths, glob, strip, delimiters)
    sizes = raw.groupBy("_path").agg(F.sum(F.octet_length("_raw") + 1).alias("length")).select(
        plain_path(F.col("_path")).alias("path"), "length")
    if raw.where("_opens").isEmpty():
        return lines.drop("_odd"), sizes
    plain = lines.where(~F.col("_odd")).drop("_odd")
    return plain.unionByName(gathered(lines.where("_odd").drop("_odd"), "file_path", delimiters)), sizes


def read_fields(spark: SparkSession, paths: str | Sequence[str], layout: Sequence[str], delimiter: str,
                glob: str | None = "*.csv") -> DataFrame:
    """Delimited reports with a header line, each file's columns in its own
    order: (file_path, file_name, line_no, columns of ``layout`` as text).

    Files are read in ranges and may be of any size; fields may hold line
    breaks, delimiters and quotes; bytes are UTF-8 or Latin-1; files of
    several folders may share a name."""
    records = read_records(spark, paths, glob, delimiters=[delimiter])
    headers = known_delimiter(records.where("line_no = 0"), delimiter, FILE_KEY)
    return fields_by_header(records, headers, layout, FILE_KEY, FILE_KEY)


def read_text_files(spark: SparkSession, paths: str | Sequence[str],
                    glob: str | None = None) -> DataFrame:
    """(file_name, text) per file, decoded with the UTF-8 / Latin-1 fallback."""
    files = read_binary_files(spark, paths, glob)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                        decode_fallback(F.col("content")).alias("text"))


#: Column of a JSON row that could not be read whole.
CORRUPT = "_corrupt_record"


def read_json_documents(spark: SparkSession, paths: str | Sequence[str],
                        schema: StructType, multiline: bool = True,
                        glob: str | None = "*.json") -> DataFrame:
    """JSON documents with an explicit schema; absent fields read as NULL.

    (columns of ``schema``, _corrupt_record, file_path, file_name, _begun):
    _corrupt_record holds the text of a document that is damaged (cut off, or
    with a value of another type), of which nothing else is kept; _begun tells
    whether the reader got some of it. See ``json_rejects``."""
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(whole).option("multiLine", multiline).option("columnNameOfCorruptRecord", CORRUPT)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.json(list(paths) if not isinstance(paths, str) else paths)
    df = df.withColumns({"file_path": plain_path(F.col("_metadata.file_path")), "file_name": held_name(F.col("_metadata.file_name"))})
    begun = F.lit(False)
    for f in schema.fields:
        begun = begun | F.col(f"`{f.name}`").isNotNull()
    # Spark may give the fields before the damage; a part of a report is none.
    return df.withColumn("_begun", begun).withColumns({f.name: F.when(F.col(CORRUPT).isNull(), F.col(f"`{f.name}`")) for f in schema.fields})


DAMAGED = "a value of another type, or damage after the first fields"
UNREADABLE = "cut off, or no JSON document"


def json_rejects(documents: DataFrame, keys: Sequence[str] = ("file_path", "file_name"), sample_chars: int = 200) -> DataFrame:
    """(``keys``, n_chars, text, reason) of the damaged documents among those
    of ``read_json_documents``; ``text`` is how they begin."""
    return documents.where(F.col(CORRUPT).isNotNull()).select(
        *keys, F.length(CORRUPT).cast("bigint").alias("n_chars"), F.substring(CORRUPT, 1, sample_chars).alias("text"),
        F.when(F.col("_begun"), F.lit(DAMAGED)).otherwise(F.lit(UNREADABLE)).alias("reason"))
