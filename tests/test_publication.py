"""Replaced partitions: shrunken and empty re-runs, readers, failures."""

from __future__ import annotations

import os

import pytest

from ledgerlens.sinks import read_manifest, read_published, replace_partitions, vacuum
from ledgerlens.sinks.publication import Folder

ROWS = "v int, run_date string, file_type string"


def keys(spark, *pairs):
    return spark.createDataFrame(list(pairs), "run_date string, file_type string")


def publish(spark, path, rows, *pairs):
    df = spark.createDataFrame(rows, ROWS)
    return replace_partitions(df, path, keys(spark, *pairs))


def state(spark, path):
    schema = spark.createDataFrame([], ROWS).schema
    return sorted(map(tuple, read_published(spark, path, schema).collect()))


def test_a_rerun_replaces_its_keys_only(spark, tmp_path):
    path = str(tmp_path / "table")
    assert state(spark, path) == []
    publish(spark, path, [(1, "d1", "USA"), (2, "d1", "CA"), (3, "d1", "CA"), (4, "d2", "CA")], ("d1", "USA"), ("d1", "CA"), ("d2", "CA"))
    assert state(spark, path) == [(1, "d1", "USA"), (2, "d1", "CA"), (3, "d1", "CA"), (4, "d2", "CA")]
    # Fewer rows, and a key without any.
    publish(spark, path, [(5, "d1", "CA")], ("d1", "CA"), ("d2", "CA"))
    assert state(spark, path) == [(1, "d1", "USA"), (5, "d1", "CA")]
    publish(spark, path, [], ("d1", "USA"))
    assert state(spark, path) == [(5, "d1", "CA")]
    got = {(r.run_date, r.file_type): r.rows for r in read_manifest(spark, path).collect()}
    assert got == {("d1", "USA"): 0, ("d1", "CA"): 1, ("d2", "CA"): 0}
    publish(spark, path, [(6, "d1", "USA")], ("d1", "USA"))
    assert state(spark, path) == [(5, "d1", "CA"), (6, "d1", "USA")]


def test_an_open_reader_and_a_failed_run_see_no_mix(spark, tmp_path):
    path = str(tmp_path / "table")
    publish(spark, path, [(1, "d1", "USA"), (2, "d1", "CA")], ("d1", "USA"), ("d1", "CA"))
    schema = spark.createDataFrame([], ROWS).schema
    reader = read_published(spark, path, schema)
    publish(spark, path, [(7, "d1", "USA")], ("d1", "USA"), ("d1", "CA"))
    assert sorted(r.v for r in reader.collect()) == [1, 2]  # as of when it was opened
    # A run that stops before its commit leaves rows that nobody reads.
    spark.createDataFrame([(9, "d1", "USA")], ROWS).write.partitionBy("run_date", "file_type").parquet(f"{path}/data/version=left")
    assert state(spark, path) == [(7, "d1", "USA")]
    with pytest.raises(ValueError):
        publish(spark, path, [(8, "d9", "USA")], ("d1", "USA"))
    with pytest.raises(ValueError):
        publish(spark, path, [(8, None, "USA")], ("d1", "USA"))
    assert state(spark, path) == [(7, "d1", "USA")]
    gone = vacuum(spark, path, keep=1)
    assert "left" in gone and len(gone) == 2
    assert state(spark, path) == [(7, "d1", "USA")] and len(os.listdir(f"{path}/commits")) <= 2


def test_two_runs_at_once_both_land(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    publish(spark, path, [(1, "d1", "USA")], ("d1", "USA"))
    plain, raced = Folder.create, []

    def create(self, name, content):
        if not raced:  # another run commits between reading the manifest and the commit
            raced.append(1)
            publish(spark, path, [(2, "d1", "CA")], ("d1", "CA"))
        return plain(self, name, content)

    monkeypatch.setattr(Folder, "create", create)
    publish(spark, path, [(3, "d2", "USA")], ("d2", "USA"))
    assert state(spark, path) == [(1, "d1", "USA"), (2, "d1", "CA"), (3, "d2", "USA")]


def test_a_filter_on_a_key_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "table")
    publish(spark, path, [(n, f"d{n}", "USA") for n in range(6)], *[(f"d{n}", "USA") for n in range(6)])
    df = read_published(spark, path, spark.createDataFrame([], ROWS).schema).where("run_date = 'd3'")
    assert [r.v for r in df.collect()] == [3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan
