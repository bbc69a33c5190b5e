"""MinHash near-dedup against brute force."""

import random
import re

import pytest

from estate.llm import components, minhash_forest, queries

SMALL = "/root/testdata/sf0.01"


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) or frozenset([tuple(words)])


def brute(docs, width, percent):
    """Rows' sets, and the least id reachable from each id."""
    sets = [shingle_set(t, width) for _, t in docs]
    up = {i: i for i, _ in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    inv = {}
    for k, s in enumerate(sets):
        for g in s:
            inv.setdefault(g, []).append(k)
    seen = set()
    for ks in inv.values():
        for x in ks:
            for y in ks:
                if x < y:
                    seen.add((x, y))
    for x, y in seen:
        a, b = sets[x], sets[y]
        if min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
            n = len(a & b)
            if 100 * n >= percent * (len(a) + len(b) - n):
                p, q = root(docs[x][0]), root(docs[y][0])
                up[max(p, q)] = min(p, q)
    return sets, {i: root(i) for i, _ in docs}


def check(rows, docs, width, percent):
    sets, comp = brute(docs, width, percent)
    got = sorted((r[0], r[1], r[2], r[3]) for r in rows)
    want = sorted((i, len(s), comp[i], comp[i] == i) for (i, _), s in zip(docs, sets))
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert len(got) == len(want) and not wrong, wrong[:5]
    return want


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = check(queries.op1_minhash_dedup(spark, SMALL).collect(), docs, 3, 85)
    assert sum(not w[3] for w in want) > 20


@pytest.mark.parametrize("seed", range(2))
def test_planted_near_copies(spark, seed):
    """A large group of near copies, boilerplate shared by many texts, chains,
    and pairs near the threshold."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    boiler, base, docs = text(60), text(120), []
    for i in range(260):
        kind = rng.randrange(4)
        if kind == 0:
            t = list(base)
            for _ in range(rng.randrange(0, 6)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
        elif kind == 1:
            t = boiler + text(rng.randrange(5, 40))
        elif kind == 2 and docs:
            t = (docs[-1][1] or "").split()
            if t:
                t[rng.randrange(len(t))] = rng.choice(vocab)
        else:
            t = text(rng.randrange(0, 90))
        docs.append((i, " ".join(t)))
    docs += [(300, None), (301, ""), (302, "One"), (303, "one"), (303, "a b"), (304, "A B")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, rep string").repartition(4)
    rows = minhash_forest.near_duplicates(df, width=3, percent=85).collect()
    check(rows, docs, 3, 85)


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, None), (4, "a b c d"), (None, "x")], "doc_id long, text string")
    rows = minhash_forest.near_duplicates(df).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    assert got == sorted([(None, 1, 4, False), (None, 0, None, True), (4, 1, 4, True), (None, 1, None, True)], key=str)
    assert minhash_forest.near_duplicates(df.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(300)]
    links += [(7, 7), (5, 4)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        if a != b:
            p, q = root(a), root(b)
            up[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def crowd(n, seed):
    """``n`` texts at similarity 0.75-0.84 to each other, and close copies of
    some of them just above 0.85; and all similarities, by one matrix product."""
    import numpy as np
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(240)]

    def changed(words, spots):
        words = list(words)
        for k in spots:
            words[k] = f"x{rng.randrange(10 ** 9)}"
        return words
    texts = [changed(base, rng.sample(range(5, 235), rng.choice((4, 5)))) for _ in range(n)]
    texts += [changed(t, (30 + 3 * k, 90, 130, 170, 200, 210)[:rng.choice((4, 5, 6))]) for k, t in enumerate(texts[:60])]
    sets = [shingle_set(" ".join(t), 3) for t in texts]
    place = {g: k for k, g in enumerate(sorted(set().union(*sets)))}
    m = np.zeros((len(sets), len(place)), np.float32)
    for k, s in enumerate(sets):
        m[k, [place[g] for g in s]] = 1
    both, sizes = m @ m.T, m.sum(1)
    near = 100 * both >= 85 * (sizes[:, None] + sizes - both)
    return [" ".join(t) for t in texts], np.argwhere(np.triu(near, 1))


def test_pairs_in_a_crowd(spark):
    """Close pairs among thousands of others that are nearly as close: their
    regions are all crowded, and every pair counts."""
    texts, near = crowd(2500, 3)
    want = {tuple(x) for x in near.tolist()}
    assert len(want) >= 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in minhash_forest.near_duplicates(df, width=3, percent=85).collect()}
    assert not [p for p in want if got[p[0]] != got[p[1]]]
    up = {i: i for i in range(len(texts))}
    for a, b in sorted(want):
        p, q = sorted((up[a], up[b]))
        up = {i: p if r == q else r for i, r in up.items()}
    assert got == up


def shuffle_bytes(spark):
    """Bytes of all shuffle files of the local executor."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    total = 0
    while files.hasNext():
        f = files.next()
        total += f.length() if f.getName().startswith("shuffle_") else 0
    return total


def test_texts_without_neighbours_are_not_shuffled(spark, monkeypatch):
    rng = random.Random(11)
    words = [" ".join(f"{rng.getrandbits(48):012x}" for _ in range(1500)) for _ in range(400)]
    docs = list(enumerate(words)) + [(1000 + k, words[k] + f" more{k}") for k in range(5)] + [(None, words[9]), (2000, None)]
    wrote, put = [], minhash_forest.stored

    def stored(df, label):
        before = shuffle_bytes(spark)
        out = put(df, label)
        if label == "minhash-texts":
            wrote.append((shuffle_bytes(spark) - before, out.count()))
        return out
    monkeypatch.setattr(minhash_forest, "stored", stored)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")        # as with more classes than Spark broadcasts
    try:
        rows = minhash_forest.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=3, percent=85).collect()
    finally:
        spark.conf.set(key, old)
    comp = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == len(docs) and all(comp[1000 + k] == k for k in range(5)) and comp[200] == 200 and comp[None] == 9
    (moved, chosen), = wrote
    assert chosen == 10 and moved < sum(map(len, words)) / 10


@pytest.mark.parametrize("chunks", [1, 4096])
def test_marks_lose_no_id(spark, monkeypatch, chunks):
    monkeypatch.setattr(minhash_forest, "CHUNKS", chunks)
    rows = spark.range(40_000).selectExpr("id", "CAST(id AS STRING) AS text").unionByName(
        spark.createDataFrame([(None, "x"), (3, "again"), (-7, "y")], "id long, text string"))
    ids = spark.range(0, 40_000, 4).selectExpr("id").unionByName(spark.createDataFrame([(-7,)], "id long"))
    got = minhash_forest._marked(rows, ids)
    assert got.columns == ["id", "text"]
    want = rows.join(ids, "id", "left_semi")
    assert want.exceptAll(got).isEmpty() and got.exceptAll(rows).isEmpty()
    if chunks > 1:
        assert got.count() < want.count() + 2_000
    assert minhash_forest._marked(rows, ids.limit(0)).isEmpty()
