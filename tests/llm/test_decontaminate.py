"""Benchmark decontamination against brute-force edit distances."""

import random
import re

import numpy as np
import pytest

from estate.llm import decontaminate, queries

SMALL = "/root/testdata/sf0.01"


def norm(text):
    t = (text or "").lower()
    return re.sub(r"[\x00-\x7f]", lambda m: m.group() if m.group().isalnum() else " ", t)


def squeezed(text):
    return re.sub(" +", " ", norm(text)).strip()


def least_edits(segment, text):
    """Least edit distance of the segment to any substring of the text."""
    a, b = segment.encode(), np.frombuffer(text.encode(), np.uint8)
    row = np.zeros(len(b) + 1, int)
    ramp = np.arange(len(b) + 1)
    for c in a:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (b != c))
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row.min())


def segments(item):
    t = squeezed(item).encode()
    s = decontaminate.SEGMENT
    cuts = list(range(0, max(1, len(t) - s + 1), decontaminate.STRIDE))
    if len(t) > s and cuts[-1] + s < len(t):
        cuts.append(len(t) - s)
    return [t[c:c + s].decode(errors="replace") for c in cuts]


def brute(text, items):
    out = set()
    for i, t in items:
        n = squeezed(t)
        if len(n.encode()) < decontaminate.LEAST:
            if n and n == squeezed(text):
                out.add(i)
            continue
        for s in segments(t):
            k = min(int(decontaminate.SHARE * len(s.encode())), (len(s.encode()) - decontaminate.Q - 2) // decontaminate.Q)
            if s in squeezed(text) or least_edits(s, squeezed(text)) <= k:
                out.add(i)
                break
    return out


def test_edited_passages(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghinorst") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randrange(6, 60))) for i in range(12)] + [(90, "Too short"), (91, "x"), (92, None), (93, "")]
    docs = []
    for i in range(80):
        t = list(items[rng.randrange(12)][1])
        for _ in range(rng.randrange(0, 1 + len(t) // 8)):
            k, what = rng.randrange(len(t)), rng.randrange(3)
            if what == 0:
                t[k] = rng.choice("abcXYZ.,")
            elif what == 1:
                t.insert(k, rng.choice("ab !"))
            elif len(t) > 5:
                del t[k]
        passage = "".join(t)
        docs.append((i, f"{prose(rng.randrange(0, 40))}. {passage.upper() if i % 3 else passage}\n{prose(rng.randrange(0, 40))}"))
    docs += [(100, None), (101, ""), (102, " TOO--short!"), (102, "too short but not alone"), (None, items[0][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(df, bench).collect()
    assert len(got) == len(docs)
    some = 0
    for (i, t), r in zip(docs, got):
        assert r.doc_id == i and {x.item_id for x in r.leaks} == brute(t, items), i
        some += bool(r.leaks)
        for x in r.leaks:
            assert 0 <= x.start < x.end <= len(t)
            item = dict(items)[x.item_id]
            assert min(least_edits(s, squeezed(t[max(0, x.start - 1):x.end + 1])) for s in segments(item)) <= x.edits + 1 or x.edits == 0
    assert 20 < some < 75
    kept = decontaminate.drop_leaks(df, bench)
    assert kept.columns == df.columns and kept.count() == len(docs) - some
    assert decontaminate.find_leaks(df.limit(0), bench).collect() == []
    assert decontaminate.drop_leaks(df, bench.limit(0)).count() == len(docs)


def found(texts, items):
    data = [t.encode() for t in texts]
    off = np.cumsum([0] + [len(d) for d in data])
    return decontaminate.Index(items).leaks(np.frombuffer(b"".join(data), np.uint8), off)


@pytest.mark.parametrize("edits", [0, 6])
def test_quotes_at_every_offset(edits):
    """Every passage of the stated shortest length is found wherever it begins,
    also with edits; the brute force knows no segments."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghinorst") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    item = squeezed(prose(60))[:233].strip()
    least = decontaminate.SEGMENT + decontaminate.STRIDE - 1
    docs = []
    for at in range(len(item) - least + 1):
        quote = list(item[at:at + least])
        for k in rng.sample(range(len(quote)), edits):
            quote[k] = rng.choice("xyz")
        docs.append(f"{prose(20)} {''.join(quote)} {prose(20)}")
    got = found(docs, [(1, item)])
    assert all(got) and len(got) > 100
    # no passage as long as a segment is shared within the budget: nothing is found
    clean = [f"{prose(20)} {item[at:at + 60]} {prose(20)}" for at in range(0, len(item) - 60, 7)]
    budget = int(decontaminate.SHARE * decontaminate.SEGMENT)
    windows = [item[a:a + decontaminate.SEGMENT] for a in range(len(item) - decontaminate.SEGMENT + 1)]
    for text, leaks in zip(clean, found(clean, [(1, item)])):
        assert not leaks or min(least_edits(w, text) for w in windows) <= budget


def test_shared_phrase_in_many_items(monkeypatch):
    """A phrase of 200 items that a long text repeats: hits are built in
    stretches, and a stretch of any size gives the same result."""
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choice("abcdeinorst") for _ in range(6)) for _ in range(n))
    phrase = prose(10)
    items = [(i, f"{phrase} {prose(12)}") for i in range(200)]
    text = " ".join(f"{phrase} {prose(2)}" for _ in range(60)) + " " + items[7][1]
    most = []
    hits = decontaminate.Index.hits
    monkeypatch.setattr(decontaminate.Index, "hits", lambda self, raw: (most.append(len(h[0])) or h for h in hits(self, raw)))
    whole = found([text, items[9][1]], items)
    assert {m[0] for m in whole[0]} >= {7} and {m[0] for m in whole[1]} >= {9}
    assert len(most) > 1 and max(most) <= 2 * decontaminate.HITS
    for size in (1 << 8, 1 << 30):
        monkeypatch.setattr(decontaminate, "HITS", size)
        assert found([text, items[9][1]], items) == whole


def test_blocks_agree(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    one = {r.doc_id: {x.item_id for x in r.leaks} for r in decontaminate.find_leaks(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3000)
    many = {r.doc_id: {x.item_id for x in r.leaks} for r in decontaminate.find_leaks(docs, bench).collect()}
    assert one == many


def test_query_finds_every_contained_item(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in queries.op6_decontamination(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert got.keys() == {r.doc_id for r in docs}
    full = 0
    for r in docs:
        inside = {i for i, t in items if squeezed(t) in squeezed(r.text)}
        assert inside <= set(got[r.doc_id].item_ids)
        full += bool(inside)
        # nothing but the items' own text is reported
        assert all(brute(r.text, [(i, t) for i, t in items if i == x]) for x in got[r.doc_id].item_ids)
    assert full > 5 and sum(r.contaminated for r in got.values()) < 2 * full
