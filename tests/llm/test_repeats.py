"""Suffix and substring dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from estate.llm import cover, queries, suffix_dedup, window_dedup

TINY = "/root/testdata/sf0.001"


def brute_bytes(texts, w):
    seen = collections.Counter()
    for t in texts:
        seen.update(t[i:i + w] for i in range(len(t) - w + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - w + 1):
            if seen[t[i:i + w]] > 1:
                gone[i:i + w] = b"\x01" * w
        out.append(gone)
    return out


def brute_words(docs, w):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", t) for _, t in docs]
    least = {}
    big = float("inf")
    for (i, _), ws in zip(docs, words):
        for k in range(len(ws) - w + 1):
            key = tuple(ws[k:k + w])
            least[key] = min(least.get(key, big), big if i is None else i)
    out = []
    for (i, _), ws in zip(docs, words):
        gone = [False] * len(ws)
        for k in range(len(ws) - w + 1):
            if least[tuple(ws[k:k + w])] < (big if i is None else i):
                gone[k:k + w] = [True] * w
        out.append((ws, gone))
    return out


@pytest.mark.parametrize("q", [2, 3, 5, 11])
def test_difference_cover(q):
    d, v = cover.difference_cover(q), q * q + q + 1
    assert len(d) == q + 1 and {(a - b) % v for a in d for b in d} == set(range(v))


def corpus(seed, n=120):
    rng = random.Random(seed)
    alphabet = "ab é\n" if seed % 2 else "abcdefgh .é\t"
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 80))) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 50)))
                 for _ in range(rng.randrange(0, 5))]
        docs.append((i, "".join(parts)))
    docs += [(n + 1, docs[3][1] + "x" * 40), (n + 1, docs[4][1]), (None, docs[5][1]), (n + 2, None), (n + 2, ""), (7, docs[7][1])]
    return docs


@pytest.mark.parametrize("seed", range(4))
def test_bytes_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, id string, copies int").repartition(5)
    got = sorted(((r.doc_id, bytes(r.kept), [tuple(s) for s in r.spans]) for r in suffix_dedup.remove_repeats(df, 12, 2).collect()), key=str)
    raw = [(t or "").encode() for _, t in docs]
    want = []
    for (i, _), t, gone in zip(docs, raw, brute_bytes(raw, 12)):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.uint8), [0]]).astype(int)))
        want.append((i, bytes(c for c, g in zip(t, gone) if not g), list(zip(edge[::2].tolist(), edge[1::2].tolist()))))
    assert got == sorted(want, key=str)
    assert any(s for _, _, s in want)


@pytest.mark.parametrize("seed", range(4))
def test_words_brute_force(spark, seed):
    docs = [(i, None if t is None else " ".join(t)) for i, t in corpus(seed)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, kept string").repartition(5)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept.encode()) for r in window_dedup.remove_earlier(df, 10, 2).collect()), key=str)
    raw = [(i, (t or "").encode()) for i, t in docs]
    want = [(i, len(ws), sum(gone), b" ".join(w for w, g in zip(ws, gone) if not g)) for (i, _), (ws, gone) in zip(raw, brute_words(raw, 10))]
    assert got == sorted(want, key=str)
    assert any(w[2] for w in want)


def test_window_counts_bytes_not_words(spark):
    rng = random.Random(1)

    def passage(size, letters):
        text = ""
        while len(text.encode()) < size - 12:
            text += "".join(rng.choice(letters) for _ in range(rng.randrange(2, 5))) + " "
        return text + "z" * (size - len(text.encode()))

    shared = [passage(399, "abcdefgh"), passage(400, "abcdefgh"), passage(400, "abcdéfgh")]
    assert all(len(p.split()) > 50 for p in shared) and len(shared[2]) < 400
    rows = [(10 * i + k, f"{k}{p}{5 + k}") for i, p in enumerate(shared) for k in range(2)]
    got = {r.doc_id: (bytes(r.kept).decode(), [tuple(s) for s in r.spans])
           for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert got[i] == ((t, []) if i < 10 else (t[0] + t[-1], [(1, 401)]))


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df).collect() == [] and window_dedup.remove_earlier(df).collect() == []


def test_queries_on_whole_table(spark):
    docs = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op8_suffix_dedup(spark, TINY).collect()}
    for (i, t), gone in zip(docs, brute_bytes([t for _, t in docs], 400)):
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = len(re.findall(b"\x01+", bytes(gone)))
        assert tuple(got[i]) == (i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    assert any(r.n_removed for r in got.values())
    got = {r.doc_id: r for r in queries.op9_substring_dedup(spark, TINY).collect()}
    for (i, t), (ws, gone) in zip(docs, brute_words(docs, 50)):
        kept = b" ".join(w for w, g in zip(ws, gone) if not g)
        assert tuple(got[i]) == (i, len(ws), sum(gone), hashlib.sha256(kept).hexdigest())
    assert any(r.n_removed for r in got.values())
