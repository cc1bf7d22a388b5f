"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the whole text: no user function,
no shuffle, one narrow pass. ``measures`` adds the counts, ``RULES`` holds the
thresholds, and ``compile_rules`` turns the table into a single Boolean
column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACE_CLASS, id_and_text, read_table

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for it with as was be by are on this from at or an not have they which "
    "le la de les des et en un une du que qui est dans pour par sur au pas avec "
    "der die und das den von zu mit ist im dem nicht ein eine es auf sich für "
    "el los las y con no se su para del al lo como más").split()

#: (name, numerator, denominator, smallest ratio, largest ratio); None: open.
#: A ratio with an empty denominator passes.
RULES = [
    ("word_length", "word_chars", "n_words", 2.5, 12.0),
    ("symbols", "n_symbols", "n_words", None, 0.10),
    ("stop_words", "n_stop_words", "n_words", 0.05, None),
    ("repeated_lines", "n_dup_lines", "n_lines", None, 0.40),
    ("short_lines", "n_short_lines", "n_lines", None, 0.98),
]

#: The two fixed rules that come before the table.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: A line below this many code points counts as short.
SHORT_LINE = 20

MEASURES = ["n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines",
            "n_short_lines", "n_repeat_words"]


def _size(c: Column) -> Column:
    return F.size(c).cast("long")


def measures(rows: DataFrame) -> DataFrame:
    """The other columns of ``rows`` and MEASURES of ``_text`` (never null).

    Helper arrays are columns of their own projections, so each is built once
    for a row. The result leaves through a generator: a later filter on a
    measure then reads the finished number instead of being pushed below the
    projections, where every helper would be spelled out again."""
    text, others = F.col("_text"), [c for c in rows.columns if c != "_text"]
    rows = rows.withColumns({
        "_words": F.filter(F.split(text, f"[{SPACE_CLASS}]+", -1), lambda w: w != ""),
        "_lines": F.filter(F.split(text, "\n", -1), lambda x: F.ltrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long"),
    })
    # Three-word windows as (hash, position), sorted: equal windows are then
    # neighbours. Words hold no white space, so no two windows hash alike
    # but by a 64-bit collision inside one text.
    rows = rows.withColumn("_windows", F.expr(f"""
        CASE WHEN size(_words) >= 4 THEN sort_array(transform(sequence(1, size(_words) - 2), i ->
            struct(xxhash64(_words[i - 1], _words[i], _words[i + 1]) AS h, i AS i)))
        ELSE cast(array() AS array<struct<h: bigint, i: int>>) END"""))
    rows = rows.withColumn("_again", F.expr("""
        filter(_windows, (w, j) ->
            (j > 0 AND _windows[j - 1].h = w.h) OR
            (j + 1 < size(_windows) AND _windows[least(j + 1, size(_windows) - 1)].h = w.h))"""))
    rows = rows.withColumns({
        "n_words": _size(F.col("_words")),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_stop_words": _size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": _size(F.col("_lines")),
        "n_dup_lines": _size(F.col("_lines")) - _size(F.array_distinct("_lines")),
        "n_short_lines": _size(F.filter("_lines", lambda x: F.length(x) < SHORT_LINE)),
        "n_repeat_words": F.expr("""CASE WHEN size(_again) = 0 THEN 0L ELSE cast(size(array_distinct(
            flatten(transform(_again, w -> array(w.i, w.i + 1, w.i + 2))))) AS bigint) END"""),
    })
    return rows.select(F.inline(F.array(F.struct(*others, *MEASURES))))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")))


def compile_rules(rules=RULES) -> Column:
    """One Boolean column: every rule of the table holds."""
    held = []
    for _, above, below, least, most in rules:
        a, b = F.col(above), F.col(below)
        if least is not None:
            held.append(a >= F.lit(float(least)) * b)
        if most is not None:
            held.append(a <= F.lit(float(most)) * b)
    return reduce(lambda x, y: x & y, held, F.lit(True))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules=RULES) -> DataFrame:
    """One row per input row: id, MEASURES, base_failed and kept.

    A null or empty text has no words, so it fails the base rule. Ties and
    repeated rows are judged alike and all returned; an empty table gives no
    rows; other columns are ignored. Lines that hold no word are not lines.
    """
    found = measures(id_and_text(docs, id_col, text_col))
    return (found.withColumn("base_failed", base_failed())
            .select(F.col("_id").alias(id_col), *MEASURES, "base_failed",
                    (~F.col("base_failed") & compile_rules(rules)).alias("kept")))


def keep_good(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. The row itself
    is carried through the projection, so nothing is joined or shuffled."""
    cols = docs.columns
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"),
                          F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return (measures(carried).withColumn("base_failed", base_failed())
            .filter(~F.col("base_failed") & compile_rules(rules))
            .select(*[F.col(f"_row.`{c}`").alias(c) for c in cols]))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every whole text of ``documents``."""
    out = quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_stop_words", "n_lines", "n_short_lines")


QUERIES = {"op5_quality_rules": op5_quality_rules}

_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)
ORACLE = {"op5_quality_rules": f"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
g AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM t WHERE len(w) >= 3),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM g),
c AS (SELECT r, count(DISTINCT p) AS n FROM (
        SELECT r, unnest([i, i + 1, i + 2]) AS p FROM h WHERE n > 1) GROUP BY r),
m AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: lower(x) IN ({_LIST}))) AS BIGINT) AS n_stop_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(list_filter(l, lambda x: length(x) < {SHORT_LINE})) AS BIGINT) AS n_short_lines
  FROM t LEFT JOIN c ON t.r = c.r),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2.5 * n_words AND word_chars <= 12.0 * n_words
       AND n_symbols <= 0.10 * n_words AND n_stop_words >= 0.05 * n_words
       AND n_dup_lines <= 0.40 * n_lines AND n_short_lines <= 0.98 * n_lines AS kept,
       n_stop_words, n_lines, n_short_lines
FROM b
"""}
