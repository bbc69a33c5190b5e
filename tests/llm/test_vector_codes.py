"""Vector codes against Lloyd's rounds without bounds, and SQL."""

import math
import random

import duckdb
import numpy as np
import pytest

from estate.llm import queries, vector_codes
from estate.llm.oracles import ORACLE

SMALL = "/root/testdata/sf0.01"


def brute(rows, parts, entries, rounds, scale):
    """Every distance of every round; rows are (id, vector), usable ones only."""
    width = math.ceil(max(len(v) for _, v in rows) / parts)
    x = np.array([[math.floor(scale * c) for c in v] + [0] * (parts * width - len(v)) for _, v in rows]).reshape(len(rows), parts, width)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, [math.floor(scale * c) for c in rows[i][1]]))
    book = x[order[:entries]].transpose(1, 0, 2).copy()
    for turn in range(rounds + 1):
        dist = ((x[:, :, None] - book[None]) ** 2).sum(-1)
        own = dist.argmin(2)
        if turn < rounds:
            for p in range(parts):
                for e in range(book.shape[1]):
                    mine = own[:, p] == e
                    if mine.any():
                        book[p, e] = x[mine, p].sum(0) // mine.sum()
    return [(rows[i][0], own[i].tolist(), int(dist[i].min(1).sum())) for i in range(len(rows))], book


@pytest.mark.parametrize("n", [1, 9, 600])
def test_equals_plain_rounds(spark, n, monkeypatch):
    monkeypatch.setattr(vector_codes, "ROWS", 64)
    rng = random.Random(n)
    rows = [(i, [rng.choice([rng.gauss(0, 1), -0.5, 0.25]) for _ in range(6)]) for i in range(n)]
    rows += [(i, [0.5] * 6) for i in range(n, n + n // 2)]                       # one very common vector
    rows += [(0, [9.0, -9.0, 1.0]), (0, [1.0] * 6), (None, [2.0] * 5), (n + 1, [])]
    bad = [(70001, None), (70002, [1.0, None]), (70003, [math.nan] * 6), (70004, [math.inf])]
    df = spark.createDataFrame([(i, v, "t", 1) for i, v in rows + bad], "vec_id long, embedding array<double>, error string, codes int").repartition(4)
    got = vector_codes.compress(df, parts=4, entries=5, rounds=4, scale=64)
    want, book = brute(rows, 4, 5, 4, 64)

    def key(r):
        return r[0] is None, r[0] or 0, r[1:]
    assert sorted(((r.vec_id, r.codes, r.error) for r in got.rows.collect()), key=key) == sorted(want, key=key)
    assert (got.history[-1] == book).all()
    assert {(r.part, r.entry): r.components for r in got.codebooks.collect()} == {
        (p, e): book[p, e].tolist() for p in range(4) for e in range(book.shape[1])}
    if n == 600:                                                               # bounds spare most distances
        assert got.measured[-1] < 0.7 * got.possible


def test_net_displacement_is_no_larger_than_drifts():
    rng = np.random.default_rng(0)
    history = np.cumsum(rng.integers(-5, 6, (7, 3, 4, 8)), 0)
    net = vector_codes.displacements(history)
    steps = np.sqrt((np.diff(history, axis=0) ** 2).sum(-1))
    for t in range(7):
        drift = steps[t:].sum(0)
        assert (net[t] <= drift * (1 + 1e-5)).all()
    assert net[0].sum() < 0.8 * steps.sum()


def test_empty(spark):
    df = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    for d in (df, df.limit(0)):
        out = vector_codes.compress(d, keep=("label",))
        assert out.rows.columns == ["vec_id", "label", "codes", "error"]
        assert out.rows.collect() == [] and out.codebooks.collect() == []


def test_empty_vectors_only(spark):
    df = spark.createDataFrame([(1, []), (2, [])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.codes, r.error) for r in vector_codes.compress(df).rows.collect()) == [(1, [0] * 8, 0), (2, [0] * 8, 0)]


def test_refuses_components_too_large(spark):
    df = spark.createDataFrame([(1, [1e9] * 8)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        vector_codes.compress(df, scale=1 << 20)


def test_group_error_null_label(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 6), (3, 1, 7)], "vec_id long, label int, error long")
    assert sorted((r.vec_id, r.label_error) for r in vector_codes.with_group_error(df, "label").collect()) == [(1, 11), (2, 11), (3, 7)]


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    got = sorted(tuple(r) for r in queries.op13_vector_codes(spark, SMALL).collect())
    assert got == sorted(con.execute(ORACLE["op13_vector_codes"]).fetchall())
