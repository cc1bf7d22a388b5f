"""Exact top-k search by inner product in buckets of vectors of like length.

Candidates are ordered by falling length and cut into buckets of bounded
size. A query's k-th best score so far, over the query's length and the
bucket's greatest length, is a cosine that a vector of the bucket must reach.
Above one the whole bucket goes. Below ``COORDINATE_COSINE`` the bucket's
prefix of long enough vectors is scored (length pruning); from there on only
vectors whose coordinates lie in the intervals that the cosine leaves for the
query's largest coordinates (coordinate pruning). What is left is verified by
exact integer products.

All queries first meet one bucket of long vectors, which gives each a lower
bound of its k-th score. Blocks of queries are then sent to the buckets they
can still score in. A bucket and up to ``BLOCKS_A_TASK`` query blocks meet in
one group, so both sides of a group are bounded; pairs of rows never leave it,
only each query's k best of the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import read_table, written
from ledgerlens.llm.vectors import exact_product, matrix, scaled, stacked

#: Vectors of a bucket.
BUCKET = 32_768
#: Most parts of the range partitioning by length; the driver keeps one number
#: a part, whatever the number of vectors.
MAX_PARTS = 4096
#: Queries of a block, and blocks that meet a bucket in one group.
QUERIES_A_BLOCK = 512
BLOCKS_A_TASK = 64
#: Local cosine threshold from which coordinates prune better than lengths.
COORDINATE_COSINE = 0.9
#: Coordinates of a query that are looked at.
FOCUS = 3
#: Slack of the bounds against rounding; what it lets through is verified.
SLACK = 1e-9


class Bucket:
    """Distinct (id, vector) rows by falling length."""

    def __init__(self, ids: pa.Array, copies: np.ndarray, x: np.ndarray):
        self.known = np.asarray(ids.is_valid())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.copies, self.x = copies, x
        self.lengths = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        # Ties: ids in order, rows without one last.
        self.place = np.empty(len(x), np.int64)
        self.place[np.lexsort((self.ids, ~self.known))] = np.arange(len(x))
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def by_coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Coordinate f over the vector's length, sorted, and whose it is."""
        if f not in self.sorted:
            values = self.x[:, f] / np.maximum(self.lengths, 1e-300)
            order = np.argsort(values, kind="stable")
            self.sorted[f] = values[order], order
        return self.sorted[f]

    def own_rows(self, ids: pa.Array, q: np.ndarray) -> np.ndarray:
        """The row that holds each query's own id and vector, or -1."""
        at: dict[int, list[int]] = {}
        for r in np.flatnonzero(np.isin(self.ids, ids.drop_null().to_numpy()) & self.known).tolist():
            at.setdefault(int(self.ids[r]), []).append(r)
        return np.array([next((r for r in at.get(v, ()) if np.array_equal(self.x[r], x)), -1)
                         for v, x in zip(ids.to_pylist(), q)], np.int64)

    def in_reach(self, q: np.ndarray, length: float, cosine: float) -> np.ndarray:
        """Rows whose focus coordinates allow ``cosine`` with q."""
        unit = q / length
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            values, order = self.by_coordinate(int(f))
            wide = np.sqrt(max(0.0, 1 - unit[f] ** 2) * max(0.0, 1 - cosine ** 2))
            # Left of, and right of, the peak of the feasible arc every cosine
            # up to one is allowed.
            low, high = unit[f] * cosine - wide, unit[f] * cosine + wide
            if unit[f] >= cosine:
                high = 1.0
            if -unit[f] >= cosine:
                low = -1.0
            a, b = np.searchsorted(values, [low - SLACK, high + SLACK], "left")
            ranges.append((int(b - a), int(a), int(b), order, int(f), low, high))
        ranges.sort(key=lambda r: r[0])
        rows = ranges[0][3][ranges[0][1]:ranges[0][2]]
        for _, _, _, _, f, low, high in ranges[1:]:
            values = self.x[rows, f] / np.maximum(self.lengths[rows], 1e-300)
            rows = rows[(values >= low - SLACK) & (values <= high + SLACK)]
        return rows

    def best(self, rows: np.ndarray, scores: np.ndarray, own: int, k: int) -> list[tuple[int, int, int]]:
        """(row, score, copies) of the k best of ``rows``, the query's own
        row (``own``, or -1) once left out."""
        if len(rows) > k + 1:
            # k + 1 leave k whatever the query's own row is; all ties of the last stay.
            edge = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
            keep = scores >= edge
            rows, scores = rows[keep], scores[keep]
        order = np.lexsort((self.place[rows], -scores))
        found, have = [], 0
        for r, s in zip(rows[order].tolist(), scores[order].tolist()):
            copies = min(int(self.copies[r]) - (r == own), k - have)
            if copies > 0:
                found.append((r, s, copies))
                have += copies
                if have >= k:
                    break
        return found


def search(bucket: Bucket, q: np.ndarray, own: np.ndarray, least: np.ndarray, k: int,
           coordinate_cosine: float = COORDINATE_COSINE) -> list[list[tuple[int, int, int]]]:
    """For each query (row of ``q``) its k best of the bucket among those that
    can reach its bound ``least`` (-inf: none yet)."""
    lengths = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    reach = lengths * bucket.lengths[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(least == -np.inf, -np.inf, np.where(reach > 0, least / reach, np.where(least > 0, np.inf, 0.0)))
    # A bound below zero says nothing about lengths: all vectors are scored.
    cosine = np.where(cosine > 0, cosine * (1 - SLACK), -np.inf)
    found: list = [[] for _ in q]
    by_length = np.flatnonzero(cosine < coordinate_cosine)
    if len(by_length):
        # Falling lengths: the first vector too short ends the prefix.
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(cosine[by_length] > 0, cosine[by_length] * bucket.lengths[0], -np.inf)
        ends = np.searchsorted(-bucket.lengths, -need, "right")
        scores = exact_product(q[by_length], bucket.x[:int(ends.max())].T)
        every = np.arange(len(bucket.x))
        for i, end, row in zip(by_length.tolist(), ends.tolist(), scores):
            found[i] = bucket.best(every[:end], row[:end], int(own[i]), k)
    for i in np.flatnonzero((cosine >= coordinate_cosine) & (cosine <= 1)).tolist():
        rows = bucket.in_reach(q[i].astype(np.float64), lengths[i], float(cosine[i]))
        if len(rows):
            found[i] = bucket.best(rows, exact_product(q[i:i + 1], bucket.x[rows].T)[0], int(own[i]), k)
    return found


def _packed(rows: DataFrame, width: int, size: int, name: str) -> DataFrame:
    """Blocks of up to ``size`` rows in the order of their partition: (part,
    number, n, top, ids, copies, x); written to the shared folder."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, number = None, 0

        def close(t: pa.Table) -> pa.RecordBatch:
            x = matrix(t["_x"], width)
            top = float(np.sqrt((x.astype(np.float64) ** 2).sum(1)).max())
            ids = t["_id"].cast(pa.int64()).to_pylist()
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(t)], pa.int64()), pa.array([top]),
                pa.array([ids], pa.list_(pa.int64())), pa.array([t["_n"].to_pylist()], pa.list_(pa.int64())),
                pa.array([_small(x)], pa.binary())],
                names=["part", "number", "n", "top", "ids", "copies", "x"])

        for table in stacked(batches, size):
            held = table if held is None else pa.concat_tables([held, table])
            while len(held) >= size:
                yield close(held.slice(0, size))
                held, number = held.slice(size), number + 1
        if held is not None and len(held):
            yield close(held)

    return written(rows.mapInArrow(
        pack, "part int, number int, n long, top double, ids array<bigint>, copies array<bigint>, x binary"), name)


#: A query's number, its id and copies, and one found vector.
HITS = ["query", "query_id", "query_copies", "vec_id", "score", "copies"]
#: A score beyond a long is cut to its range.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _small(x: np.ndarray) -> bytes:
    """The matrix in the narrowest integers that hold it."""
    most = int(np.abs(x).max(initial=0))
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def _arrays(table: pa.Table, i: int, width: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    row = table.slice(i, 1)
    ids, copies = (row[c].combine_chunks().flatten() for c in ("ids", "copies"))
    raw = row["x"][0].as_py()
    x = np.frombuffer(raw, f"<i{len(raw) // (len(ids) * width)}").reshape(len(ids), width)
    return ids, copies.to_numpy(zero_copy_only=False), x.astype(np.int64)


def _meet(buckets: DataFrame, blocks: DataFrame, width: int, k: int, keys: list[str], block_rows: int) -> DataFrame:
    """One row per query block and bucket that share ``keys``: the block's
    number, each query's k-th score there, and the hits."""
    schema = pa.schema([("block", pa.int64()), ("kth", pa.list_(pa.float64())),
                        ("hits", pa.list_(pa.struct([(c, pa.int64()) for c in HITS])))])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            bucket = Bucket(*_arrays(left, 0, width))
            for i in range(right.num_rows):
                block, bounds = right["block"][i].as_py(), right["bounds"][i].as_py()
                ids, q_copies, q = _arrays(right, i, width)
                least = np.array([-np.inf if b is None else b for b in bounds or [None] * len(q)], float)
                hits = search(bucket, q, bucket.own_rows(ids, q), least, k)
                kth = [h[-1][1] if sum(c for *_, c in h) >= k else None for h in hits]
                names = ids.to_pylist()
                rows = [(block * block_rows + n, names[n], int(q_copies[n]), int(bucket.ids[r]) if bucket.known[r] else None,
                         min(HIGHEST, max(LOWEST, s)), c) for n, h in enumerate(hits) for r, s, c in h]
                out.append({"block": block, "kth": kth, "hits": [dict(zip(HITS, r)) for r in rows]})
        return pa.Table.from_pylist(out, schema)

    fields = ", ".join(f"{c}: bigint" for c in HITS)
    return (buckets.groupBy(*keys).cogroup(blocks.groupBy(*keys))
            .applyInArrow(meet, f"block bigint, kth array<double>, hits array<struct<{fields}>>"))


def top_k(table: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
          bucket_rows: int = BUCKET, block_rows: int = QUERIES_A_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which ``queries``
    holds, the ``k`` other rows with the highest integer inner product of
    floor(256 * component), or all others if fewer.

    Ties go to the smaller id, rows without an id come last among them.
    Vectors that are null, hold null or non-finite components or components
    beyond a long (times 256) take no part. Vectors shorter than the longest
    are taken to end in zeros. Every row is a candidate of all queries but
    itself: a row repeated with id and vector is a query of its own, and a
    candidate of its copies. An empty table gives no rows; other columns are
    ignored. Ids are longs.
    """
    if k < 1:
        raise ValueError("k must be positive")
    asked = table.select(F.struct(F.col(id_col).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("q")).alias("_both"),
                         F.col(vec_col).alias("_vec"))
    rows = scaled(asked, "_both", "_vec").select(F.col("_id.id").alias("_id"), F.col("_id.q").alias("_q"), "_x")
    # Equal rows become one with a count, on the map side already.
    rows = rows.groupBy("_id", "_x").agg(F.count(F.lit(1)).alias("_n"), F.max("_q").alias("_q"))
    length = F.aggregate("_x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    rows = written(rows.withColumn("_length", length), "topk-rows")
    count, width, n_queries = rows.agg(F.count(F.lit(1)), F.max(F.size("_x")), F.count(F.when(F.col("_q"), 1))).first()
    empty = table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not n_queries:
        return empty
    width = max(width, 1)
    parts = min(MAX_PARTS, -(-count // bucket_rows))
    # Equal lengths are spread by a hash, so no length can fill a partition.
    order = [F.col("_length").desc(), F.xxhash64("_id", "_x")]
    buckets = _packed(rows.select("_id", "_x", "_n", "_length").repartitionByRange(parts, *order)
                      .sortWithinPartitions(*order), width, bucket_rows, "topk-buckets")
    q_parts = min(MAX_PARTS, -(-n_queries // (4 * block_rows)))
    blocks = _packed(rows.where("_q").select("_id", "_x", "_n", "_length").repartitionByRange(q_parts, *order)
                     .sortWithinPartitions(*order), width, block_rows, "topk-queries")
    # A block's number: its part's first number and its place there.
    per_part = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, n_blocks = {}, 0
    for p in sorted(per_part):
        first[p] = n_blocks
        n_blocks += per_part[p]
    start = F.element_at(F.create_map(*[F.lit(int(v)).cast("bigint") for kv in first.items() for v in kv]), F.col("part").cast("bigint"))
    blocks = blocks.select((start + F.col("number")).alias("block"), "top", "ids", "copies", "x")
    salts = -(-n_blocks // BLOCKS_A_TASK)
    salted = blocks.withColumn("salt", F.col("block") % salts)
    each_salt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("salt")

    # A full bucket of the longest vectors gives every query its first bound.
    seed = buckets.orderBy((F.col("n") >= F.least(F.lit(bucket_rows), F.lit(4096))).desc(), F.col("top").desc(), "part", "number").limit(1)
    seed_part, seed_number = (lambda r: (r["part"], r["number"]))(seed.select("part", "number").first())
    is_seed = (F.col("part") == seed_part) & (F.col("number") == seed_number)
    no_bounds = F.lit(None).cast("array<double>").alias("bounds")
    seeded = written(_meet(buckets.where(is_seed).select("ids", "copies", "x", each_salt),
                           salted.select("block", "ids", "copies", "x", "salt", no_bounds), width, k, ["salt"], block_rows), "topk-seeded")

    spans = sorted((r["part"], r["top"], r["m"]) for r in buckets.groupBy("part").agg(
        F.max("top").alias("top"), F.max("number").alias("m")).collect())
    span_type = "array<struct<part:int,top:double,last:int>>"
    spans_column = F.from_json(F.lit("[" + ",".join(
        f'{{"part":{p},"top":{t!r},"last":{m}}}' for p, t, m in spans) + "]"), span_type)
    # The k-th score so far over the block's greatest length: the least length
    # a bucket must offer (a bound of zero or less rules none out).
    bounded = salted.join(seeded.select("block", F.col("kth").alias("bounds")), "block")
    lowest = F.when(F.exists("bounds", lambda b: b.isNull()), F.lit(None)).otherwise(F.array_min("bounds"))
    need = F.when((lowest > 0) & (F.col("top") > 0), lowest / F.col("top") * (1 - SLACK)).otherwise(F.lit(-1.0))
    sent = (bounded.withColumn("_need", need)
            .select("*", F.explode(F.filter(spans_column, lambda s: s["top"] >= F.col("_need"))).alias("_span"))
            .select("block", "ids", "copies", "x", "salt", "bounds", F.col("_span.part").alias("part"),
                    F.explode(F.sequence(F.lit(0), F.col("_span.last"))).alias("number"))
            .where(~is_seed))
    met = _meet(buckets.where(~is_seed).select("part", "number", "ids", "copies", "x", each_salt),
                sent, width, k, ["part", "number", "salt"], block_rows)

    hits = seeded.select("hits").unionByName(met.select("hits")).select(F.inline("hits"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    best = (hits.select("query", "query_id", "query_copies", "vec_id", "score", copies)
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    return best.select("query_id", "rank", "vec_id", "score",
                       F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("query_copies"))).alias("_copy")).drop("_copy")


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other rows for each ``embeddings`` row whose id is divisible by 50."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {"op13_topk_search": op13_topk_search}
