"""Conform, de-duplicate, fill, format choice and merge operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from ledgerlens.functions.dates import strptime_to_spark, try_parse


def q(name: str) -> Column:
    """Column by exact name; names with dots, slashes or blanks are quoted."""
    return F.col(f"`{name}`")


def conform(df: DataFrame, layout: Sequence[str],
            types: dict[str, DataType] | None = None) -> DataFrame:
    """Order columns as ``layout``: extra columns dropped, missing ones NULL.

    Matching is exact and case-sensitive. ``types`` gives the type of a
    missing column (string by default).
    """
    types = types or {}
    have = set(df.columns)
    cols = [q(c) if c in have else F.lit(None).cast(types.get(c, StringType())).alias(c)
            for c in layout]
    return df.select(*cols)


def with_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Add constant columns (run date, report type, flags). Run times are
    passed in by the caller, never read from the clock inside a plan."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def order_key(spec: Sequence[tuple[str, bool, bool]]) -> list[Column]:
    """Sort key as struct fields: (name, ascending, nulls_last) per column.

    Spark orders NULL first inside a struct, so each column is preceded by a
    flag that puts NULLs where asked. Descending order is offered for numeric
    columns (the value is negated).
    """
    out = []
    for i, (name, asc, nulls_last) in enumerate(spec):
        c = q(name)
        flag = c.isNull() if nulls_last else c.isNotNull()
        out.append(flag.alias(f"_n{i}"))
        out.append((c if asc else -c).alias(f"_v{i}"))
    return out


def first_per_key(df: DataFrame, keys: Sequence[str],
                  order: Sequence[tuple[str, bool, bool]]) -> DataFrame:
    """One row per key: the first by ``order`` (a total order, so the result
    does not depend on input order). NULL keys form one group, as in pandas.

    Evaluated as ``min(struct(order, row))`` per key, a partial aggregate: each
    map task keeps one row per key before the shuffle, so a hot key costs no
    more than any other.
    """
    cols = df.columns
    packed = F.struct(*order_key(order), F.struct(*[q(c) for c in cols]).alias("row"))
    best = df.groupBy(*[q(k) for k in keys]).agg(F.min(packed).alias("_best"))
    return best.select(*[F.col(f"_best.row.`{c}`").alias(c) for c in cols])


def _null_safe_join(df: DataFrame, summary: DataFrame, keys: Sequence[str],
                    how: str = "left") -> DataFrame:
    renamed = summary
    for i, k in enumerate(keys):
        renamed = renamed.withColumnRenamed(k, f"_k{i}")
    cond = [q(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = df.join(renamed, cond, how)
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])


def flag_duplicates(df: DataFrame, keys: Sequence[str],
                    flag: str = "is_duplicated") -> DataFrame:
    """Mark every row whose key occurs more than once (all copies marked).

    NULL keys count as equal. Counts are a partial aggregate; the join back is
    null-safe.
    """
    counts = df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("_cnt"))
    out = _null_safe_join(df, counts, keys)
    return out.withColumn(flag, F.col("_cnt") > 1).drop("_cnt")


def fill_from_first(df: DataFrame, cols: Sequence[str], by: str,
                    order: str | Sequence[str]) -> DataFrame:
    """Give every row of a group the values its first row (by ``order``, one
    or more columns) has in ``cols``, NULLs included. Column order is kept.

    The first row is ``min(struct(order, values))`` per group, a partial
    aggregate, joined back on the group key.
    """
    order = [order] if isinstance(order, str) else list(order)
    okey = F.struct(*[q(o).alias(f"_o{i}") for i, o in enumerate(order)])
    first = (df.groupBy(q(by))
             .agg(F.min(F.struct(okey.alias("_o"),
                                 F.struct(*[q(c) for c in cols]).alias("v"))).alias("_f"))
             .select(q(by), *[F.col(f"_f.v.`{c}`").alias(f"_first_{i}")
                             for i, c in enumerate(cols)]))
    joined = df.join(first, by, "left")
    idx = {c: i for i, c in enumerate(cols)}
    return joined.select(*[F.col(f"_first_{idx[c]}").alias(c) if c in idx else q(c)
                           for c in df.columns])


def format_fits(columns: Sequence[str], formats: Sequence[str]) -> list[Column]:
    """Aggregates ``_ok<column>_<format>``: the format parses every non-NULL
    value of the column. Each test sits behind the format's shape."""
    return [F.bool_and(q(c).isNull() | try_parse(q(c), strptime_to_spark(f)).isNotNull()).alias(f"_ok{ci}_{fi}")
            for ci, c in enumerate(columns) for fi, f in enumerate(formats)]


def fitting_format(ci: int, formats: Sequence[str]) -> Column:
    """Number of the first format that fits column ``ci``, or NULL."""
    pick = F.lit(None).cast("int")
    for fi in reversed(range(len(formats))):
        pick = F.when(F.col(f"_ok{ci}_{fi}"), F.lit(fi)).otherwise(pick)
    return pick


def rewritten(text: Column, chosen: Column, formats: Sequence[str], out_pattern: str) -> Column:
    """``text`` read by the chosen format and written as ``out_pattern``; kept
    as it is when no format was chosen."""
    parsed = F.lit(None).cast("timestamp")
    for fi in reversed(range(len(formats))):
        parsed = F.when(chosen == fi, try_parse(text, strptime_to_spark(formats[fi]))).otherwise(parsed)
    return F.when(chosen.isNull(), text).otherwise(F.date_format(parsed, out_pattern))


def pick_formats(df: DataFrame, columns: Sequence[str], formats: Sequence[str],
                 by: str, out_pattern: str = "yyyy-MM-dd HH:mm:ss",
                 chosen_suffix: str | None = None) -> DataFrame:
    """Column-wide date format choice, per group (file) and column.

    For each column the first strptime format that parses every non-NULL
    value of the group wins (a column without any value takes the first); the
    column is then rewritten as ``out_pattern`` text. When no format fits,
    the text is left as it is. The choice is one aggregate per group, partial
    before the shuffle, and one join back; with ``chosen_suffix`` the chosen
    format is returned as a column.
    """
    fits = df.groupBy(q(by)).agg(*format_fits(columns, formats)).select(
        q(by), *[fitting_format(ci, formats).alias(f"_fmt_{ci}") for ci in range(len(columns))])
    joined = df.join(fits, by, "left")
    idx = {c: i for i, c in enumerate(columns)}
    out = [rewritten(q(c), F.col(f"_fmt_{idx[c]}"), formats, out_pattern).alias(c) if c in idx else q(c)
           for c in df.columns]
    if chosen_suffix:
        names = F.array(*[F.lit(f) for f in formats])
        out += [F.get(names, F.col(f"_fmt_{ci}")).alias(f"{c}{chosen_suffix}") for ci, c in enumerate(columns)]
    return joined.select(*out)


def merge_lines(lines: DataFrame, file_col: str = "file_name",
                no_col: str = "line_no", line_col: str = "line",
                header_lines: int = 1, dedupe: bool = False,
                sizes: DataFrame | None = None) -> DataFrame:
    """Merge overlapping extracts of one report.

    The largest file (by bytes, ties by name) is kept whole. From every other
    file the first ``header_lines`` lines are skipped and only lines the base
    file does not contain are added; repeated lines keep their multiplicity
    unless ``dedupe``. ``line_no`` counts from 0 in each file.

    ``sizes`` may give the files' bytes as (file, bytes), as a file listing
    does; else the bytes of the lines are summed. The base is one row, so it
    is broadcast. The membership test is an anti join on the SHA-256 of the
    lines, so the base's lines are shuffled as 32 bytes each, distinct ones
    combined on the map side, and not as texts; where one line of the other
    files is very frequent, AQE splits its partition. Nothing is persisted and
    no job runs before the result does.
    """
    if sizes is None:
        sizes = lines.groupBy(q(file_col)).agg(
            F.sum(F.octet_length(q(line_col)) + 1).alias("_bytes"))
    else:
        sizes = sizes.toDF(file_col, "_bytes")
    base = sizes.agg(F.min(F.struct(-F.col("_bytes"), q(file_col))).alias("_b")).select(
        F.col(f"_b.`{file_col}`").alias("_base_file"))
    in_base = q(file_col) == F.col("_base_file")
    base_lines = lines.join(F.broadcast(base), in_base, "left_semi")
    rest = lines.join(F.broadcast(base), in_base, "left_anti").where(q(no_col) >= header_lines)
    digest = F.unhex(F.sha2(q(line_col), 256))
    seen = base_lines.select(digest.alias("_h")).distinct()
    added = rest.withColumn("_h", digest).join(seen, "_h", "left_anti").select(*lines.columns)
    out = base_lines.unionByName(added)
    return out.dropDuplicates([line_col]) if dedupe else out


def distinct_files(files: DataFrame, path_col: str = "path",
                   length_col: str = "length", hash_col: str = "md5") -> DataFrame:
    """Drop files with the same size and content hash as another file; the
    first by path is kept. Only path, size and hash go through the aggregate;
    other columns (a file's content, say) stay on their row, which a semi
    join on the kept paths picks. The source files are never deleted."""
    keys = files.groupBy(q(length_col), q(hash_col)).agg(F.min(q(path_col)).alias(path_col))
    if set(files.columns) == {path_col, length_col, hash_col}:
        return keys.select(*[q(c) for c in files.columns])
    return files.join(keys.select(q(path_col)), path_col, "left_semi").select(*[q(c) for c in files.columns])
