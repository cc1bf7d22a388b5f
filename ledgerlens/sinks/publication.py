"""Replacing the partitions of a run: staged folders and a manifest switch.

A published table is a folder with

* ``data/version=<id>/...``: rows that one run wrote, partitioned by the keys;
* ``manifests/<id>/``: one row per key: the version that holds its rows (null:
  published without rows) and how many;
* ``commits/<n>``: the manifest in force after the n-th commit.

A run writes its version and a manifest, then creates the next commit, which
fails if another run has made it; the run then starts from that run's manifest
again. Readers take the last commit and join the data to its manifest, so they
see the state before or after a run and never a mix, and a key that the run
lists but has no rows for is empty afterwards. Folders without a commit are
left over from failed runs and never read; ``vacuum`` removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Commits another run may win before this one gives up.
MAX_ATTEMPTS = 20


class Folder:
    """A folder of any Hadoop file system, seen from the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.files = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        path = self._path(name)
        if not self.files.exists(path):
            return []
        found = [s.getPath().getName() for s in self.files.listStatus(path)]
        return sorted(n for n in found if n[0] not in "._")

    def create(self, name: str, content: str) -> bool:
        """A new file that is there whole or not at all; False if it exists.

        The content is written beside it first. Renaming onto an existing
        name fails (atomic on HDFS), which decides between two runs."""
        held = self._path(f"{name.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
        out = self.files.create(held, False)
        out.write(bytearray(content, "utf-8"))
        out.close()
        target = self._path(name)
        done = not self.files.exists(target) and self.files.rename(held, target)
        if not done:
            self.files.delete(held, False)
        return bool(done)

    def read(self, name: str) -> str:
        stream = self.files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def make(self, name: str) -> None:
        self.files.mkdirs(self._path(name))

    def delete(self, name: str) -> None:
        self.files.delete(self._path(name), True)


def _last(folder: Folder) -> tuple[int, str | None]:
    commits = folder.names("commits")
    return (int(commits[-1]), folder.read(f"commits/{commits[-1]}")) if commits else (0, None)


def _manifest_schema(keys: Sequence[str]) -> StructType:
    return StructType([*(StructField(k, StringType()) for k in keys), StructField("version", StringType()),
                       StructField("rows", LongType())])


def replace_partitions(df: DataFrame, path: str, run_keys: DataFrame, keys: Sequence[str] = ("run_date", "file_type")) -> str:
    """Publish a run: each key of ``run_keys`` holds exactly the run's rows
    afterwards, none if ``df`` has none for it; other keys stay as they are.

    ``keys`` are text columns of both; a row of ``df`` whose key is not listed
    stops the run before anything is published. Returns the version written.
    The rows are written once; a big partition may be written by many tasks.
    A run repeated replaces its own rows."""
    spark = df.sparkSession
    folder, version = Folder(spark, path), uuid.uuid4().hex
    for name in ("data", "manifests", "commits"):
        folder.make(name)
    data = df.withColumns({k: F.col(k).cast("string") for k in keys})
    data.write.partitionBy(*keys).parquet(f"{folder.root}/data/version={version}")
    whole = StructType([*(f for f in data.schema if f.name not in keys), *(data.schema[k] for k in keys)])
    counts = spark.read.schema(whole).parquet(f"{folder.root}/data/version={version}").groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    listed = run_keys.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct().withColumn("_listed", F.lit(True))
    # One row per partition of this run.
    found = listed.join(counts, list(keys), "full").select(*keys, "_listed", "rows").collect()
    if any(not r["_listed"] or any(r[k] is None for k in keys) for r in found):
        folder.delete(f"data/version={version}")
        raise ValueError("rows of a key that the run does not list, or a null key")
    own = spark.createDataFrame([(*(r[k] for k in keys), version if r["rows"] else None, r["rows"] or 0) for r in found],
                                _manifest_schema(keys))
    for _ in range(MAX_ATTEMPTS):
        number, before = _last(folder)
        manifest = own
        if before:
            old = spark.read.schema(_manifest_schema(keys)).parquet(f"{folder.root}/manifests/{before}")
            manifest = old.join(own, list(keys), "left_anti").unionByName(own)
        name = uuid.uuid4().hex
        manifest.write.parquet(f"{folder.root}/manifests/{name}")
        if folder.create(f"commits/{number + 1:020d}", name):
            return version
    raise RuntimeError("other runs kept committing first")


def read_manifest(spark: SparkSession, path: str, keys: Sequence[str] = ("run_date", "file_type")) -> DataFrame:
    """(keys, version, rows) of every published key, those without rows too."""
    folder = Folder(spark, path)
    _, name = _last(folder)
    schema = _manifest_schema(keys)
    return (spark.read.schema(schema).parquet(f"{folder.root}/manifests/{name}") if name
            else spark.createDataFrame([], schema))


def read_published(spark: SparkSession, path: str, schema: StructType,
                   keys: Sequence[str] = ("run_date", "file_type")) -> DataFrame:
    """The rows in force, columns in the order of ``schema``, keys as text.

    The data's version and keys are partition columns: a filter on a key and
    the join with the manifest prune the folders that are read."""
    folder = Folder(spark, path)
    live = read_manifest(spark, path, keys).where("version IS NOT NULL").select(*keys, "version")
    texts = [StructField(k, StringType()) for k in keys]
    whole = StructType([*(f for f in schema if f.name not in keys), StructField("version", StringType()), *texts])
    if not folder.names("data"):
        return spark.createDataFrame([], schema)
    data = spark.read.schema(whole).parquet(f"{folder.root}/data")
    return data.join(live, [*keys, "version"], "left_semi").select(*[F.col(f"`{f.name}`") for f in schema])


def vacuum(spark: SparkSession, path: str, keep: int = 2, keys: Sequence[str] = ("run_date", "file_type")) -> list[str]:
    """Delete the versions, manifests and commits that none of the last
    ``keep`` commits needs; returns the deleted versions. Not to be run while
    a run is writing, whose version no commit names yet."""
    if keep < 1:
        raise ValueError("at least the last commit is kept")
    folder = Folder(spark, path)
    commits = folder.names("commits")
    manifests = {folder.read(f"commits/{c}") for c in commits[-keep:]}
    used: set = set()
    for name in manifests:
        rows = spark.read.schema(_manifest_schema(keys)).parquet(f"{folder.root}/manifests/{name}")
        used |= {r["version"] for r in rows.select("version").distinct().collect()}
    gone = [n for n in folder.names("data") if n.split("=", 1)[1] not in used]
    for c in commits[:-keep]:
        folder.delete(f"commits/{c}")
    for n in folder.names("manifests"):
        if n not in manifests:
            folder.delete(f"manifests/{n}")
    for n in gone:
        folder.delete(f"data/{n}")
    return [n.split("=", 1)[1] for n in gone]
