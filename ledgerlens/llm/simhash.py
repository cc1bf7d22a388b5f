"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's 64-bit fingerprint is the bitwise majority of its shingles' XXH64
values. Fingerprints link at up to two differing bits.

Candidate search: a fingerprint is cut into three segments. By the
pigeonhole principle two errors leave one segment untouched, which is taken
as it is; the segment after it may hold both errors and is decoded with the
binary Golay code: its keys are the indices of the codewords near it (one if
the nearest is within two bits, else the six codewords of its sextet). Two
segments at up to two differing bits always share a codeword: in the extended
code they lie at even distance, the six error patterns of a deep hole
partition the 24 positions into tetrads, and flipping two positions keeps the
codeword of either position's tetrad at distance four or less. So each
fingerprint gets up to 18 keys of 34 bits, an equi-join on the key finds the
candidates and ``bit_count`` of the exclusive or verifies them.

A key shared by very many fingerprints is not compared pairwise: its
fingerprints probe all 2,080 fingerprints within two bits by equality, which
is exact and linear.

Components: alternating large-star and small-star rounds over the links
between distinct fingerprints, each round written to the shared folder.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.common import id_and_text, read_table, small_arrow_batches, written

#: Seed of the shingle hash.
SEED = 42
#: Widest distance the keys cover.
MAX_BITS = 2
#: Generator polynomial of the binary (23, 12) Golay code (a fixed value).
GOLAY = 0b101011100011
#: (lowest bit, width) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: A key with more fingerprints than this is searched by probing.
BUSY_KEY = 1000
#: Shingle hashes whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: str, width: int = 3) -> int:
    """The unsigned 64-bit fingerprint; zero for a text without words.

    Lower-casing bytes changes A-Z only, and splitting them uses exactly the
    six ASCII white-space characters.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), BLOCK):
        part = hashes[a:a + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 3, hashed: bool = False) -> DataFrame:
    """(_id, _fp): the fingerprint of every row as a signed long; ``hashed``
    adds the text's MD5 as _hash."""
    small_arrow_batches(docs.sparkSession)
    extra = [F.unhex(F.md5("_text")).alias("_hash")] if hashed else []

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return id_and_text(docs, id_col, text_col).select("_id", of("_text").alias("_fp"), *extra)


@lru_cache(maxsize=1)
def codeword_keys() -> np.ndarray:
    """For each 22-bit word (wider segments do not occur), up to six indices
    of codewords near it (-1: none).

    Built from the generator: every error pattern of up to four bits is laid
    on every codeword; distance four counts only where no codeword is within
    two bits.
    """
    n, rows = 23, 1 << 22
    messages = np.arange(1 << 12, dtype=np.int64)
    code = np.zeros(1 << 12, np.int64)
    for i in range(12):
        code ^= np.where(messages >> i & 1, GOLAY << i, 0)
    near = np.full((rows, 6), -1, np.int16)
    depth = np.full(rows, 9, np.int8)
    used = np.zeros(rows, np.int8)
    for weight in range(5):
        for spots in combinations(range(n), weight):
            at = code ^ sum(1 << s for s in spots)
            index = messages[at < rows]
            at = at[at < rows]
            if weight == 4:
                take = depth[at] == 3
                at, index = at[take], index[take]
            else:
                depth[at] = weight
            near[at, used[at]] = index
            used[at] += 1
    return near


def keys_of(fps: np.ndarray) -> list[np.ndarray]:
    """The search keys of each fingerprint (unsigned)."""
    near = codeword_keys()
    parts = [(fps >> np.uint64(low)) & np.uint64((1 << width) - 1) for low, width in SEGMENTS]
    columns = []
    for a in range(3):
        index = near[parts[(a + 1) % 3].astype(np.int64)].astype(np.int64)
        key = (np.int64(a) << 34) | (parts[a].astype(np.int64)[:, None] << 12) | index
        columns.append(np.where(index >= 0, key, -1))
    table = np.concatenate(columns, axis=1)
    return [row[row >= 0] for row in table]


def _masks(bits: int) -> np.ndarray:
    flips = [0]
    for n in range(1, bits + 1):
        flips += [sum(1 << s for s in c) for c in combinations(range(64), n)]
    return np.array(flips[1:], np.uint64)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct ``_fp`` values within
    ``max_bits`` differing bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys cover 0 to {MAX_BITS} differing bits")

    @pandas_udf("array<long>")
    def keys(v: pd.Series) -> pd.Series:
        return pd.Series(keys_of(v.to_numpy(np.int64).view(np.uint64)))

    @pandas_udf("array<long>")
    def around(v: pd.Series) -> pd.Series:
        flips = _masks(max_bits)
        return pd.Series([(x ^ flips).view(np.int64) for x in v.to_numpy(np.int64).view(np.uint64)])

    keyed = written(fps.select("_fp", F.explode(keys("_fp")).alias("_key")), "simhash-keys")
    busy = written(keyed.groupBy("_key").count().filter(F.col("count") > BUSY_KEY).select("_key"),
                   "simhash-busy")
    rest = keyed
    if not busy.isEmpty():
        rest = keyed.join(busy, "_key", "left_anti")
    left = rest.select("_key", F.col("_fp").alias("a"))
    right = rest.select("_key", F.col("_fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    found = left.join(right, "_key").where((F.col("a") < F.col("b")) & near).select("a", "b")
    if not busy.isEmpty():
        crowded = keyed.join(busy, "_key", "left_semi").select("_fp").distinct()
        probes = crowded.select(F.col("_fp").alias("x"), F.explode(around("_fp")).alias("y"))
        found = found.unionByName(
            probes.join(fps.select(F.col("_fp").alias("y")), "y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges``.

    Large-star and small-star alternate until nothing changes; only a count
    and a checksum of each round reach the driver.
    """
    edges = written(edges.select("a", "b"), "simhash-links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").where("b <> m")
                 .select(F.col("m").alias("a"), "b").distinct())
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        edges = written(
            large.join(small, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(small.select(F.col("m").alias("a"), "b")).distinct(), "simhash-round")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                                F.countDistinct("b")).first())
        if state == seen and state[0] == state[2]:
            break
        seen = state
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: (id, fingerprint, component_id).

    A null text counts as empty; texts without words share fingerprint zero
    and link like any other. component_id is the smallest id whose text is
    reachable over links (null ids are passed over; null only if the whole
    component has no id). Repeated rows and ties share a component; an empty
    table gives no rows; other columns are ignored.
    """
    marked = written(fingerprints(docs, id_col, text_col, width), "simhash-marks")
    firsts = written(marked.groupBy("_fp").agg(F.min("_id").alias("_first")), "simhash-firsts")
    roots = components(links(firsts.select("_fp"), max_bits))
    linked = (firsts.join(roots, firsts["_fp"] == roots["node"])
              .select("_fp", "_first", "root"))
    linked = written(linked, "simhash-linked")
    groups = linked.groupBy("root").agg(F.min("_first").alias("_component"))
    moved = linked.join(groups, "root").select("_fp", "_component")
    final = (firsts.join(moved, "_fp", "left")
             .select("_fp", F.coalesce("_component", "_first").alias("_component")))
    return marked.join(final, "_fp").select(
        F.col("_id").alias(id_col),
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        F.col("_component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             width: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component, all columns: the row with the
    smallest id (any id before null), of rows that share that id the one with
    the smallest text hash.

    Of rows that repeat both id and text any one stays (they differ at most in
    other columns). Rows are chosen by (id, text hash), so null or repeated
    ids bring back no other row.
    """
    marked = written(fingerprints(docs, id_col, text_col, width, hashed=True), "simhash-marks")
    best = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_hash")
    firsts = written(marked.groupBy("_fp").agg(F.min(best).alias("_best")), "simhash-firsts")
    roots = components(links(firsts.select("_fp"), max_bits))
    # A lone fingerprint is its own root.
    chosen = (firsts.join(roots, firsts["_fp"] == roots["node"], "left")
              .groupBy(F.coalesce("root", "_fp").alias("_root")).agg(F.min("_best").alias("_best")))

    def key(i, h):
        """One column for (id, text hash), null ids apart."""
        return F.md5(F.concat(h, F.when(i.isNull(), F.lit("n")).otherwise(F.lit("v")).cast("binary"),
                              F.coalesce(i.cast("string"), F.lit("")).cast("binary")))

    stay = chosen.select(key(F.col("_best._id"), F.col("_best._hash")).alias("_key"))
    cols = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"),
        key(F.col(id_col), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))).alias("_key"))
    # Copies go on the map side, before the join.
    return (rows.dropDuplicates(["_key"]).join(stay, "_key", "left_semi")
            .select(*[F.col(f"_row.`{c}`").alias(c) for c in cols]))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every whole text of ``documents``."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {"op4_simhash": op4_simhash}
