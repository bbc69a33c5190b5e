"""Ranked lexical search against brute force and SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from estate.llm import queries, ranked_search
from estate.llm.oracles import ORACLE

SMALL = "/root/testdata/sf0.01"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    texts = {}
    for i, t in items:
        if i is not None and t is not None:
            texts[i] = min(texts.get(i, t), t)
    out = []
    for i, t in texts.items():
        scored = []
        for d, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * c[w]) // (1000 * c[w] + 12 * m))
                    for w in words(t) if w in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=lambda x: x[:2])


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(60)] + ["ciónllta", "Ñé", "x1Y", "1234567", "漢字"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(k):
        return rng.choice([" ", ", ", "-", "\n"]).join(rng.choices(vocabulary, weights, k=k))
    docs = [(i, text(rng.choice([1, 3, 12, 80]))) for i in range(n)]
    docs += [(i, docs[n // 2][1]) for i in range(n, n + n // 2)]                   # a third are copies
    docs += [(7, text(9)), (7, docs[n // 3][1]), (None, text(30)), (90001, None), (90002, ""), (90003, " .,;-"),
             (90004, "W0" * 3 + " w1 " * 4000)]
    items = [(i, text(rng.choice([2, 5, 30]))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "nothing known here"), (None, "w0"), (3, "a w3 w59 w59"), (3, items[3][1]), (53, "w0 W0 w0")]
    return docs, items


@pytest.mark.parametrize("n,seed", [(4, 1), (150, 2), (400, 3)])
def test_brute_force(spark, n, seed, monkeypatch):
    monkeypatch.setattr(ranked_search, "BUCKET_ROWS", 16)
    monkeypatch.setattr(ranked_search, "PIECE_BYTES", 64)
    docs, items = corpus(n, seed)
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, score int, terms string").repartition(5)
    qs = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int").repartition(3)
    got = sorted((tuple(r) for r in ranked_search.search(df, qs, k=7).collect()), key=lambda x: x[:2])
    assert got == brute(docs, items, 7)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_QUERIES", 4)
    docs, items = corpus(60, 5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    qs = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in ranked_search.search(df, qs, k=3).collect()), key=lambda x: x[:2])
    assert got == brute(docs, items, 3)


def test_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "...")], "doc_id long, text string")
    qs = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    for d, q in ((df, qs), (df.limit(0), qs), (df, qs.limit(0))):
        out = ranked_search.search(d, q)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


def test_bounds_hold_and_prune():
    """No bound is below a score, and the coordinate bounds leave few rows."""
    rng = np.random.default_rng(4)
    size, rows = 300, 500
    weights = rng.integers(100, 9000, size)
    places = [np.sort(rng.choice(size, rng.integers(1, 60), replace=False)) for _ in range(rows)]
    impacts = [rng.integers(1, 900_000, len(p)) for p in places]
    norms = np.array([math.sqrt((weights[p] * i.astype(float) ** 2).sum()) for p, i in zip(places, impacts)])
    off = np.concatenate([[0], np.cumsum([len(p) for p in places])])
    bucket = ranked_search.Bucket(np.arange(rows), np.concatenate(places), off, np.concatenate(impacts), norms, size)
    mine = [np.sort(rng.choice(size, 20, replace=False)) for _ in range(10)]
    qs = ranked_search.Queries(mine, [rng.integers(1, 3, 20) for _ in mine], weights)
    dense, left = np.zeros(size, np.int64), 0
    for q in range(len(qs)):
        every = bucket.scores(qs, q, np.arange(rows), dense)
        assert bucket.bounds(qs)[q] >= every.max()
        tenth = np.sort(every)[-10]
        kept = bucket.survivors(qs, q, tenth)
        assert set(np.flatnonzero(every >= tenth)) <= set(kept)
        left += len(kept)
    assert left < 0.5 * rows * len(qs)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = sorted(tuple(r) for r in queries.op11_ranked_search(spark, SMALL).collect())
    assert got == sorted(con.execute(ORACLE["op11_ranked_search"]).fetchall())
