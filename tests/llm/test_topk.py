"""Exact top-k search against brute force and SQL."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from estate.llm import pivot_topk, queries
from estate.llm.oracles import ORACLE

SMALL = "/root/testdata/sf0.01"


def brute(rows, k, every):
    vecs = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vecs[i] = min(vecs.get(i, v), v)
    ints = {i: [math.floor(256 * x) for x in v] for i, v in vecs.items()}
    out = []
    for q, a in ints.items():
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints.items() if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    got = sorted(tuple(r) for r in queries.op4_pivot_topk(spark, SMALL).collect())
    assert got == sorted(con.execute(ORACLE["op4_pivot_topk"]).fetchall())


@pytest.mark.parametrize("n", [3, 400])
def test_brute_force_with_ties_and_odd_rows(spark, n, monkeypatch):
    monkeypatch.setattr(pivot_topk, "ANNULUS", 16)
    monkeypatch.setattr(pivot_topk, "BLOCK", 8)
    rng = random.Random(n)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 3.0]) for _ in range(4)]) for i in range(n)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(n, 2 * n)]                       # one very common vector
    rows += [(9000, None), (9001, [1.0, None]), (9002, [math.nan] * 4), (9003, [math.inf, 0.0]), (None, [1.0] * 4),
             (9004, [2.0]), (9005, []), (9006, [1.0] * 4), (9006, [0.0] * 4), (9006, [0.0] * 4)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    got = sorted(tuple(r) for r in pivot_topk.top_k(df, 5, F.col("vec_id") % 5 == 0, pivots=6).collect())
    assert got == brute(rows, 5, 5)


def test_empty(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert pivot_topk.top_k(df).collect() == []
    assert pivot_topk.top_k(df.limit(0)).collect() == []
