"""The weak-label quality classifier: held-out accuracy, EM, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from estate.llm import queries, weak_quality

DATA = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    got = (weak_quality.score_documents(docs, labels.filter(~held)).join(labels.filter(held), "doc_id").toPandas())
    assert len(got) > 600
    bad_low, bad_toxic = got.quality == 0, got.toxic == 1
    acc = {"low": ((got.p_low >= 0.5) == bad_low).mean(), "toxic": ((got.p_toxic >= 0.5) == bad_toxic).mean()}
    clean = got[~bad_low & ~bad_toxic]
    print(acc, clean.keep.mean(), got[bad_toxic].keep.mean(), got[bad_low].keep.mean())
    assert acc["low"] > 0.97 and acc["toxic"] > 0.97
    assert clean.keep.mean() > 0.99
    assert got[bad_toxic].keep.mean() < 0.1 and got[bad_low].keep.mean() < 0.05


def test_em_finds_the_good_labeller():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    def voter(right, speaks):  # noqa: E306
        v = np.where(rng.random(len(truth)) < right, truth, ~truth).astype(int)
        return np.where(rng.random(len(truth)) < speaks, v, weak_quality.ABSTAIN)
    votes = np.stack([voter(0.9, 0.8), voter(0.6, 0.9), voter(0.85, 0.5), voter(0.98, 0.2)], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    q, confusion = weak_quality.expectation_maximisation(patterns, counts, 3)
    right = confusion[:, [0, 1], [0, 1]] / confusion[:, :, :2].sum(2)
    assert right[3].min() == weak_quality.HUMAN_RIGHT
    assert right[0].min() > 0.8 and abs(right[1].mean() - 0.6) < 0.1
    post = {tuple(p): x for p, x in zip(patterns, q)}
    assert np.mean([(post[tuple(v)] >= 0.5) == t for v, t in zip(votes, truth)]) > 0.9


def test_query_returns_every_document(spark):
    got = queries.op3_weak_quality(spark, SMALL)
    assert got.columns == ["doc_id", "p_low", "p_toxic", "keep"]
    rows = got.collect()
    assert len(rows) == 1000 and 0.6 < np.mean([r.keep for r in rows]) < 0.95


def test_odd_rows(spark):
    good = "The quick brown fox jumps over the lazy dog and runs away. "
    rows = [(i, good * 2 + f"word{i}", "a") for i in range(40)] + [(100 + i, "### $$$ you idiot %%% " * 5, "b") for i in range(40)]
    rows += [(None, good, "c"), (500, None, "d"), (501, "", "e"), (1, good, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p_low string")
    labels = spark.createDataFrame([(0, 1, 0), (0, None, None), (100, 0, 1), (None, 0, 0), (101, 0, 1), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    kept = weak_quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {500, 501} <= set(ids) and not [i for i in ids if i and 100 <= i < 140]
    assert len([i for i in ids if i is not None and i < 40]) == 41
    none = weak_quality.keep_good(docs.limit(0), labels)
    assert none.collect() == []
    assert weak_quality.keep_good(docs, labels.limit(0)).count() > 0


def test_labellers_shape_the_scorer_at_any_size(spark):
    """With many human labels, a kind that only heuristics see is learned too,
    and so is one that only human labels show."""
    rng = np.random.default_rng(2)
    vocab = ["".join(rng.choice(list("abdeghiklmnoprstu"), 6)) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocab, n)) + "."
    good = [(i, prose(30)) for i in range(1300)]
    shown = [(2000 + i, f"{prose(15)} zorgle {prose(15)}") for i in range(120)]
    seen = [(3000 + i, f"{prose(15)} you stupid scum {prose(15)}") for i in range(120)]
    docs = spark.createDataFrame(good + shown + seen, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:1200]] + [(i, 1, 1) for i, _ in shown[:80]],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.keep for r in weak_quality.score_documents(docs, labels).collect()}
    kept = [np.mean([got[i] for i, _ in part]) for part in (good, shown, seen)]
    assert kept[0] > 0.97 and kept[1] < 0.05 and kept[2] < 0.05, kept
