"""Nearest neighbours on space-filling curves against brute force."""

import itertools
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from incident_analytics.llm import neighbours, queries

COLUMNS = "vec_id long, embedding array<float>"


def brute(rows, asked, k=10):
    """Rows of the search; rows with one id must have one vector."""
    good = {
        i: np.array(v, np.float64)
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = []
    for q in good:
        if asked(q):
            near = sorted((float(np.sqrt(((good[q] - x) ** 2).sum())), i) for i, x in good.items() if i != q and len(x) == len(good[q]))
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(near[:k])]
    return sorted(out)


def found(spark, rows, asked, **options):
    docs = spark.createDataFrame(rows, COLUMNS).repartition(6)
    return sorted(map(tuple, neighbours.nearest(docs, asked, **options).collect()))


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2), (8, 2)])
def test_curve_visits_each_cell_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = neighbours.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_window_that_holds_all_gives_all(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(900)]
    # As many probes as queries, and all their neighbours in the windows.
    got = found(spark, rows, F.col("vec_id") % 30 == 0, recall=1.0)
    assert got == brute([(i, np.float32(v).tolist()) for i, v in rows], lambda i: i % 30 == 0)


def test_copies_odd_vectors_and_few_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(200)]
    rows += [(1000 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(150)] + [(1000, [1.0, 0.0, 0.0, 0.0])] * 100
    rows += [(2000 + i, [float(i), 1.0]) for i in range(3)] + [(2100, [5.0])]
    rows += [(3000, None), (3100, [0.0] * 4), (3200, [1.0, None, 0.0, 0.0]), (3300, [1.0, math.nan, 0.0, 0.0]), (3400, [1.0, math.inf, 0.0, 0.0]), (3500, []), (None, [1.0] * 4)]
    got = found(spark, rows, F.col("vec_id") % 100 == 0, recall=1.0)
    assert got == brute(rows, lambda i: i % 100 == 0)
    assert found(spark, [], F.col("vec_id") % 100 == 0) == []
    assert found(spark, [(1, [1.0])], F.col("vec_id") % 100 == 0) == []
    assert found(spark, [(0, [1.0])], F.col("vec_id") % 100 == 0) == []


def test_blocks_windows_and_large_numbers(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16)) * 10
    points = (centres[np.arange(6000) % 40] + rng.normal(size=(6000, 16)) * 0.1).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(points)] + [(10_001, [1e38] * 16), (10_100, [-1e38] * 16)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(6)
    index, _ = neighbours.indexed(docs, F.col("vec_id") % 100 == 0)
    # Clusters keep windows short, whatever the number of all vectors.
    assert index.window() < 1500
    assert index.blocks.filter("line % 4 = 0").agg(F.sum("count")).first()[0] == 6002
    got = found(spark, rows, F.col("vec_id") % 100 == 0)
    want = brute(rows, lambda i: i % 100 == 0)
    assert len(got) == len(want) and len(set(got) & set(want)) >= 0.9 * len(want)


def test_clashing_columns_and_doubles(spark):
    rows = [(i, [i * 0.1, 1 / (i + 1)]) for i in range(50)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("node", "line", "key", "asked", "part", "same", "ids", "query", "score", "rank", "cell", "_rank"):
        docs = docs.selectExpr("*", f"'{name}' as `{name}`")
    got = sorted(map(tuple, neighbours.nearest(docs.select("vec_id", "embedding"), F.col("vec_id") % 10 == 0, recall=1.0).collect()))
    assert got == brute(rows, lambda i: i % 10 == 0)


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet'").fetchall()
    want = brute([(i, np.float32(v).tolist()) for i, v in rows], lambda i: i % 100 == 0)
    got = [tuple(r) for r in queries.nearest_vectors(spark, folder).collect()]
    assert len(got) == len(want)
    true = {(q, i): s for q, _, i, s in want}
    hits = [(q, i) for q, _, i, _ in got if (q, i) in true]
    assert len(hits) >= 0.9 * len(true)
    points = {i: np.float32(v).astype(np.float64) for i, v in rows}
    assert all(s == float(np.sqrt(((points[q] - points[i]) ** 2).sum())) for q, _, i, s in got)
