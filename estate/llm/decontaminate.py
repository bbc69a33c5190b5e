"""Benchmark decontamination by q-gram lemma filtering.

Texts are normalised: letters lower-cased (ASCII and Latin-1), every run of
other ASCII characters one space.  A benchmark item has overlapping segments of
``SEGMENT`` characters, one every ``STRIDE`` characters (the last one ends with
the item; a shorter item is one segment).  A document leaks an item if one of its
segments occurs in it with at most the segment's edit budget, ``SHARE`` of its
length.  So every passage of ``SEGMENT + STRIDE - 1`` normalised characters (111)
that a document quotes from an item is found, wherever it begins, and with up to
the budget (8) of edits in its segment; of shorter quotes those that hold a whole
segment.

A region with at most ``k`` edits shares at least ``m - q + 1 - k * q`` of the
segment's q-grams, and all of them within ``k + 1`` neighbouring diagonals
(text position minus segment position).  So the q-grams of a document are looked
up among those of the segments, hits are counted in bands of ``2 (k + 1)``
diagonals that overlap by half - every run of ``k + 1`` diagonals lies whole in
one of them - and only bands that reach the bound are verified by a banded
alignment, which also gives the region.

Hits are built for stretches of the text that give at most ``HITS`` of them, or
of ``STRETCH`` positions where a phrase shared by very many segments gives more;
neighbouring stretches overlap by more than a region, so no region is cut.

The benchmark is the bounded side: it is sent out in blocks of ``BLOCK_BYTES``
of text, one pass over the documents each, however large it is.

Defined results: a null or empty text leaks nothing.  Null item texts are
ignored.  An item of fewer than ``LEAST`` normalised characters would be found
in clean text by chance, so it is leaked only by a document that is nothing
else.  Repeated items and rows repeat their result; an item with a null id
makes a document contaminated but isn't named.  Other columns are kept by
:func:`drop_leaks`; empty tables give empty results or no leaks.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm._ship import ship, slices, string_parts, tables, tidy

Q = 10
SEGMENT = 96
STRIDE = 16
SHARE = 0.085
LEAST = 32
BLOCK_BYTES = 256 * 1024
HITS = 1 << 20
STRETCH = 1 << 10
SLICE_BYTES = 2 * 1024 * 1024
FILTER_BITS = 22
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _alphabet() -> np.ndarray:
    """Byte by byte: letters lower-cased, other ASCII a space, the rest kept."""
    out = np.arange(256, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalnum() else 32
    return out


_ALPHABET = _alphabet()


def normalise(raw: np.ndarray, off: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised documents with ``pad`` zero bytes before each and after the
    last, their starts (and the end), and each byte's place in the input."""
    low = _ALPHABET[raw]
    if len(raw):
        second = (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)      # A-grave to Thorn
        second[1:] &= raw[:-1] == 0xC3
        second[0] = False
        low = np.where(second, raw + 0x20, low).astype(np.uint8)
    space = low == 32
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    keep = ~space | ~(first[:-1] | np.concatenate([[False], space[:-1]])[:len(raw)])
    at = np.flatnonzero(keep)
    docs = np.searchsorted(at, off)
    n = len(off) - 1
    out = np.zeros(len(at) + pad * (n + 1), np.uint8)
    place = np.zeros(len(out), np.int64)
    to = np.arange(len(at)) + pad * (np.repeat(np.arange(n), np.diff(docs)) + 1)
    out[to], place[to] = low[at], at
    starts = docs + pad * (np.arange(n + 1) + 1)
    return out, starts, place


def _grams(raw: np.ndarray) -> np.ndarray:
    """One hash for the ``Q`` bytes from every position on."""
    n = len(raw) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = raw.tobytes()
    a = np.ndarray((n,), "<u8", data, 0, (1,)).copy()
    b = np.ndarray((n,), "<u8", data, Q - 8, (1,)).copy()
    h = (a * _A) ^ (b * _B)
    return (h ^ (h >> np.uint64(31))) * _A


class Index:
    """The segments of a block of items and their q-grams."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.item, self.text, self.budget, self.whole = [], [], [], {}
        for i, t in items:
            raw = np.frombuffer((t or "").encode(), np.uint8)
            out, starts, _ = normalise(raw, np.array([0, len(raw)]), 0)
            text = out.tobytes().strip()
            if len(text) < LEAST:
                if text:
                    self.whole.setdefault(text, []).append(i)
                continue
            cuts = list(range(0, max(1, len(text) - SEGMENT + 1), STRIDE))
            if len(text) > SEGMENT and cuts[-1] + SEGMENT < len(text):
                cuts.append(len(text) - SEGMENT)
            for c in cuts:
                part = text[c:c + SEGMENT]
                self.item.append(i)
                self.text.append(np.frombuffer(part, np.uint8))
                # as many edits as leave at least a few shared q-grams
                self.budget.append(min(int(SHARE * len(part)), (len(part) - Q - 2) // Q))
        self.length = np.array([len(t) for t in self.text], np.int64)
        self.budget = np.array(self.budget, np.int64)
        self.bound = self.length - Q + 1 - self.budget * Q
        self.most = int(self.budget.max(initial=0))
        grams = [_grams(t) for t in self.text]
        seg = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.seg, self.at = seg[order], at[order]
        self.gram, self.first = np.unique(h[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(h)))
        self.table = np.zeros((len(self.text), SEGMENT), np.uint8)
        for k, t in enumerate(self.text):
            self.table[k, :len(t)] = t
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.gram >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, raw: np.ndarray):
        """Text position, segment and segment position of all equal q-grams, in
        overlapping stretches of the text."""
        h = _grams(raw)
        pos = np.flatnonzero(self.filter[h >> np.uint64(64 - FILTER_BITS)])
        h = h[pos]
        k = np.searchsorted(self.gram, h)
        k[k == len(self.gram)] = 0
        ok = self.gram[k] == h if len(self.gram) else np.zeros(len(h), bool)
        pos, k = pos[ok], k[ok]
        n = self.count[k]
        total = np.concatenate([[0], np.cumsum(n)])
        lo, region = 0, SEGMENT + self.most               # positions that one region's q-grams span at most
        while lo < len(pos):
            hi = int(np.searchsorted(total, total[lo] + HITS, "right")) - 1
            hi = max(hi, int(np.searchsorted(pos, pos[lo] + STRETCH)))
            some, m = k[lo:hi], n[lo:hi]
            entry = np.repeat(self.first[some] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            yield np.repeat(pos[lo:hi], m), self.seg[entry], self.at[entry]
            if hi >= len(pos):
                return
            lo = max(lo + 1, int(np.searchsorted(pos, pos[hi] - region)))

    def bands(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segments and first diagonals of the bands that reach their bound."""
        wide = len(raw) + 2 * SEGMENT + 2                 # diagonals from 0 on
        full = [np.zeros(0, np.int64)]
        for pos, seg, at in self.hits(raw):
            band = (pos - at + SEGMENT) // (self.budget[seg] + 1)
            key = np.concatenate([seg * wide + band, (seg * wide + band - 1)[band > 0]])
            key, n = np.unique(key, return_counts=True)
            full.append(key[n >= self.bound[key // wide]])
        seg, band = np.divmod(np.unique(np.concatenate(full)), wide)
        return seg, band * (self.budget[seg] + 1) - SEGMENT

    def align(self, raw: np.ndarray, seg: np.ndarray, diag: np.ndarray):
        """Least edits of every segment within its band, and the region of the
        text, by one banded alignment for all pairs at once."""
        step = 1 << 10
        wide = 2 * (self.most + 1) + 2 * self.most
        d0 = diag - self.budget[seg]                      # an alignment may begin or end beside its shared q-grams
        column = np.arange(wide)
        length = self.length[seg]
        best = np.full(len(seg), np.iinfo(np.int64).max)
        best_at = np.zeros(len(seg), np.int64)
        cost = np.tile(column, (len(seg), 1)).astype(np.int64)   # edits * step + first column
        for j in range(int(length.max(initial=0))):
            i = j + d0[:, None] + column
            inside = (i >= 0) & (i < len(raw))
            same = inside & (raw[np.where(inside, i, 0)] == self.table[seg, j][:, None])
            new = cost + np.where(same, 0, step)
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + step)
            ramp = column * step
            new = np.minimum.accumulate(new - ramp, axis=1) + ramp
            cost = new
            ended = length == j + 1
            if ended.any():
                at = cost[ended].argmin(1)
                best[ended] = cost[ended, :][np.arange(len(at)), at]
                best_at[ended] = at + d0[ended] + j + 1
        edits, start = best // step, best % step + d0
        return edits, start, best_at

    def leaks(self, raw: np.ndarray, off: np.ndarray) -> list[list[tuple]]:
        """Per document ``(item id, start, end, edits)``, in bytes of the input."""
        pad = self.most + 2                              # crossing it costs more than any budget
        text, starts, place = normalise(raw, off, pad)
        out: list[list[tuple]] = [[] for _ in range(len(off) - 1)]
        if self.text:
            seg, diag = self.bands(text)
            for lo in range(0, len(seg), 4096):
                s, d = seg[lo:lo + 4096], diag[lo:lo + 4096]
                edits, a, b = self.align(text, s, d)
                ok = edits <= self.budget[s]
                for k, e, x, y in zip(s[ok].tolist(), edits[ok].tolist(), a[ok].tolist(), b[ok].tolist()):
                    doc = int(np.searchsorted(starts, y - 1, "right")) - 1
                    x = max(x, int(starts[doc]))
                    if x < y:
                        out[doc].append((self.item[k], int(place[x] - off[doc]), int(place[y - 1] - off[doc]) + 1, e))
        if self.whole:
            for doc, (a, b) in enumerate(zip(starts[:-1], starts[1:] - pad)):
                for i in self.whole.get(text[a:b].tobytes().strip(), ()):
                    out[doc].append((i, 0, int(off[doc + 1] - off[doc]), 0))
        return [sorted(set(x), key=lambda m: (m[1], m[2], m[0] is None, m[0] or 0, m[3])) for x in out]


def _index(items: list) -> Index:
    key = hashlib.sha256(repr(items).encode()).digest()
    built = tables("decontamination")
    if key not in built:
        built.clear()
        built[key] = Index(items)
    return built[key]


LEAKS = "array<struct<item_id:long,start:int,end:int,edits:int>>"
_LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))


def _leaks_udf(items: list):
    @F.arrow_udf(LEAKS)
    def leaks(texts: pa.Array) -> pa.Array:
        index, out = _index(items), []
        for b in slices([pa.RecordBatch.from_arrays([texts, texts], names=["a", "b"])], SLICE_BYTES):
            raw, off = string_parts(b.column(1))
            for d, found in enumerate(index.leaks(raw, off)):
                data = raw[off[d]:off[d + 1]].tobytes() if found else b""
                out.append([{"item_id": i, "start": len(data[:s].decode(errors="ignore")),
                             "end": len(data[:e].decode(errors="ignore")), "edits": k} for i, s, e, k in found])
        tidy()
        return pa.array(out, _LEAKS)
    return leaks


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """The items in blocks of about ``BLOCK_BYTES`` of text, one at a time."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t")).filter("t IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    for k in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k) if blocks > 1 else items
        yield sorted(((r.i, r.t) for r in mine.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def leaks(text: Column, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Column:
    """Array of ``item_id, start, end, edits`` of a text column; offsets in code
    points of the text as it stands."""
    ship(benchmark.sparkSession)
    text = F.coalesce(text.cast("string"), F.lit(""))
    found = [_leaks_udf(items)(text) for items in _blocks(benchmark, id_col, text_col)]
    return F.concat(*found) if len(found) > 1 else found[0]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, leaks`` of every row."""
    return docs.select(F.col(f"`{id_col}`"), leaks(F.col(f"`{text_col}`"), benchmark).alias("leaks"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns."""
    name = "_benchmark_leaks"
    return docs.withColumn(name, F.size(leaks(F.col(f"`{text_col}`"), benchmark))).filter(F.col(name) == 0).drop(name)
