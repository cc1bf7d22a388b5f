"""Exact deduplication by content hash, in DataFrame operations only.

Method: group by the 128-bit content hash and, inside each hash, by the text
itself (grouping keys compare byte by byte, so texts that merely collide stay
apart). Copies are combined on the map side before the shuffle, so a group
holding a third of all rows reaches the shuffle as one row per map task. The
row with the smallest (or largest) stable id is kept. The verdict is joined
back to slim (id, hash) rows; texts are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import id_and_text, read_table
from ledgerlens.session import ensure_checkpoint_dir


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(docs, id_col, text_col).select(
        "_id", "_text", F.unhex(F.md5("_text")).alias("_hash"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "min") -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256).

    Rows are copies when their texts are equal byte for byte; a null text
    counts as the empty text, with which it is grouped. ``keep`` chooses the
    smallest or largest id of a group. Ties: rows that repeat an id and its
    text are all reported as kept (``keep_one`` leaves one of them). A null id
    loses against any other; a group of null ids only has a null keep_id. An
    empty table gives no rows. Other columns are ignored.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    ensure_checkpoint_dir(docs.sparkSession)
    best = F.min if keep == "min" else F.max
    rows = _hashed(docs, id_col, text_col)
    groups = (rows.groupBy("_hash", "_text")
              .agg(best("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select("_hash", F.unhex(F.sha2("_text", 256)).alias("_sha"), "keep_id", "group_size")
              .checkpoint())
    slim = rows.select("_id", "_hash", F.unhex(F.sha2("_text", 256)).alias("_sha"))
    # Texts that share the 128-bit hash are told apart by the second hash in
    # the slim rows; if two different texts shared both, only the bytes could.
    clash = groups.groupBy("_hash", "_sha").count().filter("count > 1")
    if clash.isEmpty():
        found = slim.join(groups, ["_hash", "_sha"])
    else:
        whole = (rows.groupBy("_hash", "_text")
                 .agg(best("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
        found = (rows.join(whole, ["_hash", "_text"])
                 .withColumn("_sha", F.unhex(F.sha2("_text", 256))))
    return found.select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             keep: str = "min") -> DataFrame:
    """The rows of ``docs``, all columns, one for each distinct text.

    Of rows that repeat both id and text any one stays (they differ at most
    in other columns). The kept rows are found by (id, text hash), so a table
    with null or repeated ids loses no text.
    """
    cols = docs.columns
    verdict = (exact_groups(docs, id_col, text_col, keep).filter("kept")
               .select(F.col(id_col).alias("_k_id"), F.col("text_sha256").alias("_k_sha")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col(id_col).alias("_id"),
                       F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("_sha"))
    on = rows["_id"].eqNullSafe(verdict["_k_id"]) & (rows["_sha"] == verdict["_k_sha"])
    return (rows.join(verdict.hint("merge"), on, "left_semi").dropDuplicates(["_sha"])
            .select(*[F.col(f"_row.`{c}`").alias(c) for c in cols]))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among all whole ``documents`` texts; the largest doc_id stays."""
    return exact_groups(read_table(spark, sf_dir, "documents"), keep="max")


QUERIES = {"op7_exact_dedup": op7_exact_dedup}

ORACLE = {"op7_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""}
