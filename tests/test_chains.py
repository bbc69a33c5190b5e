"""Page chains followed by their tokens, against the loop."""

import random

import pytest
from pyspark.sql import functions as F

from estate.operators import chains

from conftest import SF_SMALL


def loop(pages, max_pages=None):
    """The source's loop, page by page: (chain, request, position)."""
    answers = {}
    for chain, request, answer, _ in pages:
        key = chain, request or ""
        answers[key] = min((a for a in (answers.get(key), answer or None) if a), default=None)
    out = set()
    for chain in {c for c, _ in answers}:
        token, no, seen = "", 1, set()
        while (chain, token) in answers and token not in seen and (max_pages is None or no <= max_pages + 1):
            out.add((chain, token, no))
            seen.add(token)
            token, no = answers[chain, token], no + 1
            if token is None:
                break
    return out


def dump(seed):
    """Chains of many lengths whose pages come in any order, some with cycles,
    dangling tokens, orphans, pages dumped twice, and no head."""
    rng = random.Random(seed)
    rows = []
    for n in range(30):
        chain = None if n == 7 else f"c{n}"
        length = rng.choice([1, 2, 3, 5, 8, 17, 40])
        tokens = [rng.choice([None, ""])] + [f"{rng.random()}" for _ in range(length - 1)]
        for i, t in enumerate(tokens):
            last = i == length - 1
            kind = rng.random()
            answer = tokens[i + 1] if not last else rng.choice([None, "", "gone", *[x for x in tokens if x], tokens[-1]])
            if not last and kind < 0.03:
                answer = rng.choice(["gone", None])
            if i or n % 9:                                   # some chains have no first page
                rows.append((chain, t, answer, i * 10 + n))
                if kind > 0.9:
                    rows.append((chain, t, answer, i * 10 + n))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,max_pages", [(1, None), (2, 6), (3, 0)])
def test_equals_the_loop(spark, seed, max_pages):
    rows = dump(seed)
    df = spark.createDataFrame([(c, r, a, [v], 99) for c, r, a, v in rows],
                               "chain string, request_token string, continuation_token string, value array<int>, page_no int").repartition(4)
    got = chains.linked_pages(df, ["chain"], max_pages=max_pages)
    assert got.columns == ["chain", "request_token", "continuation_token", "value", "page_no"]
    found = [(r.chain, r.request_token or "", r.page_no) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == loop(rows, max_pages)


def test_two_answers_and_empty_table(spark):
    rows = [("a", None, "t1"), ("a", "t1", "t3"), ("a", "t1", "t2"), ("a", "t2", None), ("a", "t3", None), ("a", "t1", None)]
    df = spark.createDataFrame(rows, "chain string, request_token string, continuation_token string")
    assert sorted((r.request_token or "", r.continuation_token, r.page_no) for r in chains.linked_pages(df, ["chain"]).collect()) == [
        ("", "t1", 1), ("t1", "t2", 2), ("t2", None, 3)]
    assert chains.linked_pages(df.limit(0), ["chain"]).collect() == []


def test_joins_are_on_the_token(spark):
    """A chain with all pages spreads by token: no exchange by the chain alone."""
    df = spark.createDataFrame([(1, None, "a"), (1, "a", None)], "chain int, request_token string, continuation_token string")
    plan = chains.linked_pages(df, ["chain"])._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "hashpartitioning(" in line:
            assert "_at" in line or "_to" in line, line
