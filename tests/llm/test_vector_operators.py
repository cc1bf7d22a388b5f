"""Whitening and top-k search against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import topk_search, whitening

CLASH = ["_id", "_x", "_v", "_n", "_q", "rank", "score", "query_id", "component", "n", "part", "block", "_asked"]


def embeddings(spark, rows, parts: int = 3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASH]).repartition(parts)


def some_rows(n: int, width: int, seed: int, spread: float = 0.3) -> list[tuple]:
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, spread) * (1 + (j % 3)) for j in range(width)]) for i in range(n)]
    rows += [(500 + i, list(rows[3][1])) for i in range(4)]  # equal vectors
    rows += [rows[0], rows[0], (None, list(rows[7][1])), (None, None), (600, None), (650, [None] * width),
             (700, [float("nan")] * width), (750, [float("inf")] + [0.0] * (width - 1)), (800, rows[5][1][:2]),
             (850, [3e38] * width)]
    return rows


def integers(rows, width: int) -> list[tuple]:
    out = []
    for i, v in rows:
        if v is None or any(c is None or not math.isfinite(np.float32(c)) or abs(float(np.float32(c)) * 256) >= 2 ** 63 for c in v):
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        out.append((i, tuple(x + [0] * (width - len(x)))))
    return out


def brute_top(rows, k: int, asked) -> Counter:
    found = Counter()
    for n, (i, x) in enumerate(rows):
        if i is None or not asked(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j is None, j or 0, j) for m, (j, y) in enumerate(rows) if m != n)
        for rank, (s, _, _, j) in enumerate(scored[:k], 1):
            found[i, rank, j, -s] += 1
    return found


@pytest.mark.parametrize("width,k,bucket", [(6, 5, 40), (3, 2, 16), (1, 300, 7)])
def test_top_k(spark, width, k, bucket):
    rows = some_rows(150, width, width)
    got = topk_search.top_k(embeddings(spark, rows), F.col("vec_id") % 10 == 0, k=k, bucket_rows=bucket, block_rows=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute_top(integers(rows, width), k, lambda i: i % 10 == 0)


def test_top_k_of_nothing(spark):
    assert topk_search.top_k(embeddings(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert topk_search.top_k(embeddings(spark, [(50, [1.0, 2.0])]), F.col("vec_id") % 50 == 0).collect() == []
    zeros = topk_search.top_k(embeddings(spark, [(50, [0.0]), (3, []), (2, [0.0])]), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in zeros.orderBy("rank").collect()] == [(50, 1, 2, 0), (50, 2, 3, 0)]


@pytest.mark.parametrize("cosine", [0.0, 0.5, 0.99])
def test_pruning_loses_nothing(cosine):
    """Coordinate pruning from a low threshold on, length pruning otherwise."""
    r = np.random.default_rng(3)
    base = r.normal(size=(20, 8))
    x = np.floor(np.concatenate([base + 0.05 * r.normal(size=base.shape) for _ in range(30)]) * 100 * r.uniform(0.2, 3, (600, 1))).astype(np.int64)
    x = x[np.argsort(-(x ** 2).sum(1), kind="stable")]
    import pyarrow as pa
    bucket = topk_search.Bucket(pa.array(range(600)), np.ones(600, np.int64), x)
    for k in (1, 5):
        scores = x @ x[::7].T
        least = np.sort(scores, axis=0)[-k - 3].astype(float)
        found = topk_search.search(bucket, x[::7], np.full(len(least), -1), least, k, coordinate_cosine=cosine)
        for n, hits in enumerate(found):
            want = sorted(((-int(s), i) for i, s in enumerate(scores[:, n])))[:k]
            assert [(-s, i) for i, s, _ in hits] == want


def test_exact_products():
    for top in (100, 1 << 30, 1 << 50):
        a = np.array([[top, -top + 1], [top - 3, 5]], np.int64)
        assert topk_search.exact_product(a, a).tolist() == (a.astype(object) @ a.astype(object)).tolist()


def test_whitening(spark):
    width = 6
    rows = some_rows(200, width, 9)
    got = whitening.whiten(embeddings(spark, rows)).collect()
    mine = integers(rows, width)
    fit = np.array(sorted({x for _, x in mine}), object)
    n, total = len(fit), fit.sum(0)
    centred = (n * fit - total).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == 4 * len(mine) and {r["n"] for r in got} == {n}
    for k in range(4):
        part = [r for r in got if r["component"] == k + 1]
        want = {i: (sum(int(n * a - s) ** 2 for a, s in zip(x, total)),
                    float((np.array([(n * a - s) / n for a, s in zip(x, total)], float) @ vectors[:, k]) / np.sqrt(values[k])))
                for i, x in mine if i is not None}
        sign = math.copysign(1, sum(r["whitened"] * want[r["vec_id"]][1] for r in part if r["vec_id"] is not None))
        for r in part:
            if r["vec_id"] is not None:
                assert int(r["deviation"]) == want[r["vec_id"]][0]
                assert r["whitened"] * sign == pytest.approx(want[r["vec_id"]][1], abs=1e-9)
            assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-10)
            assert r["identity_error"] < 1e-9


def test_whitening_does_not_depend_on_partitions(spark):
    rows = some_rows(300, 5, 2)
    one, many = ({(r["vec_id"], r["component"], r["whitened"], r["explained"]) for r in whitening.whiten(embeddings(spark, rows, p)).collect()}
                 for p in (1, 17))
    assert one == many


def test_whitening_without_spread(spark):
    assert whitening.whiten(embeddings(spark, [])).collect() == []
    assert whitening.whiten(embeddings(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (None, None)])).collect() == []
    assert whitening.whiten(embeddings(spark, [(1, []), (2, None)])).collect() == []
    # All vectors on one line: one component.
    line = whitening.whiten(embeddings(spark, [(i, [i / 4, i / 2, 0.0]) for i in range(9)])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 9
    assert line[0]["explained"] == pytest.approx(1)


def test_huge_entries_are_exact(spark):
    rows = [(1, [2.0 ** 54, 1.0]), (2, [-2.0 ** 54, 0.0]), (3, [0.0, 3.0])]
    got = {r["vec_id"]: r for r in whitening.whiten(embeddings(spark, rows)).where("component = 1").collect()}
    x = [[int(256 * c) for c in v] for _, v in rows]
    total = [sum(c) for c in zip(*x)]
    for (i, _), v in zip(rows, x):
        want = sum((3 * a - s) ** 2 for a, s in zip(v, total))
        assert got[i]["deviation"] is None if want >= 10 ** 38 else int(got[i]["deviation"]) == want


@pytest.mark.parametrize("d,rank,seed", [(1, 1, 0), (2, 2, 1), (7, 7, 2), (40, 40, 3), (30, 11, 4)])
def test_principal_axes(d, rank, seed):
    r = np.random.default_rng(seed)
    a = r.normal(size=(d, rank)) * np.logspace(0, -3, rank)
    scatter = a @ a.T
    factor, order = whitening.pivoted_cholesky(scatter)
    assert factor.shape == (d, rank)
    assert np.abs(factor @ factor.T - scatter[np.ix_(order, order)]).max() <= 1e-13 * scatter.max()
    assert np.abs(np.triu(factor, 1)).max(initial=0) == 0
    values, axes = whitening.principal(scatter)
    want = np.linalg.eigvalsh(scatter)[::-1][:rank]
    assert np.allclose(values, want, rtol=1e-9, atol=1e-15)
    assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-12)
    assert np.allclose(axes * values @ axes.T, scatter, atol=1e-12 * scatter.max())
