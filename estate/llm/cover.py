"""Repeated windows through difference covers.

A difference cover ``D`` modulo ``v`` holds, for every ``d``, two members that
differ by ``d``; so for any two positions ``i`` and ``j`` some ``k < v`` puts
both ``i + k`` and ``j + k`` on cover positions.  If two windows of ``W``
symbols are equal, then so are the blocks of ``W - v + 1`` symbols at such an
aligned pair of cover positions, wherever the windows lie.  This is used in two
rounds, both dealt out by hash into buckets that are sorted one at a time:

1. *cover sample*: the blocks at all cover positions are named by their hash; a
   name held only once proves that no window around it repeats;
2. *windows*: the window starts that keep a repeated block within reach are
   named by a hash of the whole window and sorted within their bucket.

Only names of 4 bytes (round 1; a chance match costs work, not correctness) and
8 bytes plus the bucket number (round 2, two independent polynomials) travel,
never the texts, and a bucket's bytes are bounded by choosing the number of
buckets from the measured input.  Equal texts are one text: a slice sends each
text once, a bucket keeps one holder, and the final join gives every copy its
class's result.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm._ship import release, ship, slices, stored, string_parts

SLICE_BYTES = 2 * 1024 * 1024        # of text named at once
BUCKET_BYTES = 12 * 1024 * 1024      # of names sorted at once (the sort holds about ten times that)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: dict = {}


def difference_cover(q: int) -> np.ndarray:
    """A perfect difference set modulo ``q*q + q + 1`` for a prime ``q``: the
    exponents at which the powers of a root of a cubic over GF(q) lie in a
    plane (Singer's construction), checked before use."""
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, found = (1, 0, 0), []
                for i in range(v):
                    if x[2] == 0:
                        found.append(i)
                    x = (x[2] * c % q, (x[0] + x[2] * b) % q, (x[1] + x[2] * a) % q)
                if len(found) == q + 1 and len({(s - t) % v for s in found for t in found}) == v:
                    return np.array(found, np.int64)
    raise ValueError(f"no perfect difference set found for {q}")


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _power_table(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        base = _BASES[which]
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.ones(size, np.uint64)
            k = 1
            while k < size:                          # doubling: t[k:2k] = t[:k] * b^k
                t[k:2 * k] = t[:k] * np.uint64(pow(b, k, 1 << 64))
                k *= 2
            tables.append(t)
        _powers[which] = have = tuple(tables)
    return have


class Rolling:
    """Hashes of stretches of a sequence of 64-bit symbols, from prefix sums of
    ``symbol * base^position``."""

    def __init__(self, symbols: np.ndarray, which: int = 0):
        up, self.down = _power_table(which, len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[:len(symbols)], out=self.sums[1:])

    def at(self, start: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.down[start])


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def byte_symbols(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One symbol per byte; offsets of the documents."""
    return _BYTE[raw], off


def word_bounds(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of concatenated
    documents, and the documents' offsets among the words."""
    n = len(raw)
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[off] = True                                  # no word crosses a document's end
    before = np.concatenate([[False], word])
    after = np.concatenate([word, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, off)


def word_symbols(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One symbol per word; offsets of the documents among the words."""
    starts, ends, docs = word_bounds(raw, off)
    return Rolling(_BYTE[raw]).at(starts, ends - starts) + (ends - starts).astype(np.uint64), docs


@dataclass(frozen=True)
class Plan:
    """What repeats are looked for: windows of ``window`` symbols (bytes or
    words), over a cover from the prime ``q``; ``earlier``: a window counts only
    if it also starts in a document with a smaller id."""
    window: int
    q: int
    words: bool
    earlier: bool

    @property
    def period(self) -> int:
        return self.q * self.q + self.q + 1

    @property
    def block(self) -> int:
        return self.window - self.period + 1

    def symbols(self, raw, off):
        return word_symbols(raw, off) if self.words else byte_symbols(raw, off)

    def positions(self, lengths: np.ndarray, cover: np.ndarray) -> list[np.ndarray]:
        """Cover positions at which a block fits, for every document long
        enough to hold a window."""
        most = int(lengths.max(initial=0))
        every = (np.arange(0, most + 1, self.period)[:, None] + cover).ravel()
        return [every[:np.searchsorted(every, n - self.block, "right")] if n >= self.window else every[:0]
                for n in lengths.tolist()]


# -- what travels ------------------------------------------------------------

ENTRIES = "bucket int, k1 binary, k2 binary, ids binary, counts binary, names binary, places binary"
ENTRY_SCHEMA = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in
                          ("k1", "k2", "ids", "counts", "names", "places")]])


def _gaps(at: np.ndarray, first: np.ndarray) -> bytes:
    """Places, rising within each document, as squeezed differences."""
    d = np.diff(at, prepend=0)
    d[first] = at[first]
    kind = np.uint32 if d.max(initial=0) > 65535 else np.uint16
    return zlib.compress(bytes([np.dtype(kind).itemsize]) + d.astype(kind).tobytes(), 1)


def _differences(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    return np.frombuffer(raw[1:], f"u{raw[0]}").astype(np.int64)


def _places(data: bytes, counts: np.ndarray) -> np.ndarray:
    total = np.cumsum(_differences(data))
    ends = np.cumsum(counts)
    before = np.concatenate([[0], total[ends[:-1] - 1]]) if len(counts) else total[:0]
    return total - np.repeat(before, counts)


def _emit(bucket, names, doc, place, keys, buckets):
    """Batches of one row per bucket: its names, dealt by document."""
    order = np.argsort(bucket, kind="stable")
    bucket, names, doc = bucket[order], names[order], doc[order]
    place = None if place is None else place[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = {c: [] for c in ENTRY_SCHEMA.names}
    for b in range(buckets):
        lo, hi = cuts[b], cuts[b + 1]
        if lo == hi:
            continue
        d = doc[lo:hi]
        first = np.concatenate([[True], d[1:] != d[:-1]])
        at = np.flatnonzero(first)
        who = d[at]
        rows["bucket"].append(b)
        for c, k in zip(("k1", "k2", "ids"), keys):
            rows[c].append(k[who].tobytes())
        rows["counts"].append(np.diff(np.append(at, hi - lo)).astype(np.uint32).tobytes())
        rows["names"].append(names[lo:hi].tobytes())
        rows["places"].append(b"" if place is None else _gaps(place[lo:hi], first))
    yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in ENTRY_SCHEMA], schema=ENTRY_SCHEMA)


class Bucket:
    """All names of one bucket with one holder for each text."""

    def __init__(self, t: pa.Table, dtype):
        def cat(column, kind):
            return np.concatenate([np.frombuffer(x, kind) for x in t[column].to_pylist()] or [np.zeros(0, kind)])
        k1, k2, ids = cat("k1", np.int64), cat("k2", np.int64), cat("ids", np.int64)
        counts = cat("counts", np.uint32).astype(np.int64)
        names = cat("names", dtype)
        places = None
        if any(len(x) for x in t["places"].to_pylist()):
            places = np.concatenate([_places(p, np.frombuffer(c, np.uint32).astype(np.int64)).astype(np.uint32)
                                     for p, c in zip(t["places"].to_pylist(), t["counts"].to_pylist())])
        order = np.lexsort((ids, k2, k1))             # equal texts together, smallest id first
        a, b = k1[order], k2[order]
        keep = np.zeros(len(order), bool)
        keep[order[np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[:len(order)]]] = True
        row = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        held = keep[row]
        self.row, self.names = row[held], names[held]
        self.places = None if places is None else places[held]
        self.k1, self.k2, self.ids = k1, k2, ids

    def repeated(self, earlier: bool, final: bool) -> np.ndarray:
        """Mask of names that repeat: anywhere; or, for ``earlier``, in another
        document (round 1) or in one with a smaller id (final)."""
        order = np.argsort(self.names, kind="stable")
        s = self.names[order]
        new = np.concatenate([[True], s[1:] != s[:-1]])[:len(s)]
        group = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        if not len(s):
            return np.zeros(0, bool)
        if not earlier:
            hit = np.bincount(group)[group] > 1
        else:
            who = (self.ids if final else np.arange(len(self.ids)))[self.row][order]
            least = np.minimum.reduceat(who, at)[group]
            hit = who > least if final else np.maximum.reduceat(who, at)[group] > least
        out = np.zeros(len(s), bool)
        out[order] = hit
        return out


# -- the two rounds ----------------------------------------------------------

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"),
                       F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"))


def _docs(batch) -> tuple:
    """Distinct texts of a slice (the smallest id of each; a null id is the
    largest), as bytes, offsets and keys."""
    k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
    ids = batch.column(0).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
    order = np.lexsort((ids, k2, k1))
    a, b = k1[order], k2[order]
    keep = np.sort(order[np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])])
    if len(keep) < len(ids):
        batch = batch.take(pa.array(keep))
        k1, k2, ids = k1[keep], k2[keep], ids[keep]
    raw, off = string_parts(batch.column(1))
    return raw, off, (k1, k2, ids)


def _named(plan: Plan, cover, raw, off, buckets):
    """Cover positions of all documents with their names."""
    sym, docs = plan.symbols(raw, off)
    places = plan.positions(np.diff(docs), cover)
    doc = np.repeat(np.arange(len(places)), [len(p) for p in places])
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    h = Rolling(sym).at(docs[:-1][doc] + place, plan.block)
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    return sym, docs, doc, place, bucket, h.astype(np.uint32)


def _sample(plan: Plan, buckets: int):
    def run(batches):
        cover = difference_cover(plan.q)
        for b in slices(batches, SLICE_BYTES):
            raw, off, keys = _docs(b)
            _, _, doc, _, bucket, names = _named(plan, cover, raw, off, buckets)
            if len(names):
                yield from _emit(bucket, names, doc, None, keys, buckets)
    return run


REPLY = "part int, k1 binary, k2 binary, sizes binary, data binary"
REPLY_SCHEMA = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("k1", "k2", "sizes", "data")]])
MERGED_SCHEMA = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("found", pa.list_(pa.binary()))])


def _answer(k1: np.ndarray, k2: np.ndarray, data: list[bytes], parts: int) -> pa.Table:
    """What a bucket has to say to each document (``k1, k2``), packed by parts
    of the documents."""
    part = (mixed(k1.astype(np.uint64) ^ mixed(k2.astype(np.uint64))) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    rows = {c: [] for c in REPLY_SCHEMA.names}
    for at in np.split(order, cuts[1:]) if len(order) else []:
        mine = [data[i] for i in at]
        rows["part"].append(int(part[at[0]]))
        rows["k1"].append(k1[at].tobytes())
        rows["k2"].append(k2[at].tobytes())
        rows["sizes"].append(np.array([len(x) for x in mine], np.uint32).tobytes())
        rows["data"].append(b"".join(mine))
    return pa.table([pa.array(rows[f.name], f.type) for f in REPLY_SCHEMA], schema=REPLY_SCHEMA)


def _merged(t: pa.Table) -> pa.Table:
    """One row for each document of a part, with what all buckets said."""
    told: dict[tuple[int, int], list[bytes]] = {}
    for k1, k2, sizes, data in zip(*(t[c].to_pylist() for c in ("k1", "k2", "sizes", "data"))):
        at = 0
        for a, b, n in zip(np.frombuffer(k1, np.int64).tolist(), np.frombuffer(k2, np.int64).tolist(),
                           np.frombuffer(sizes, np.uint32).tolist()):
            told.setdefault((a, b), []).append(data[at:at + n])
            at += n
    return pa.table([pa.array([k[0] for k in told], pa.int64()), pa.array([k[1] for k in told], pa.int64()),
                     pa.array(list(told.values()), pa.list_(pa.binary()))], schema=MERGED_SCHEMA)


def _collected(entries: DataFrame, answer, parts: int, label: str) -> DataFrame:
    """``k1, k2, found``: every bucket's answers, merged for each document."""
    said = entries.groupBy("bucket").applyInArrow(answer, REPLY)
    return stored(said.groupBy("part").applyInArrow(_merged, "k1 long, k2 long, found array<binary>"), label)


def _sample_reply(plan: Plan, parts: int):
    def run(t: pa.Table) -> pa.Table:
        bucket = np.array([t["bucket"][0].as_py()], np.uint32).tobytes()
        b = Bucket(t, np.uint32)
        hit = b.repeated(plan.earlier, False)
        row, names = b.row[hit], b.names[hit]
        cuts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])[:len(row)])
        data = [bucket + np.unique(x).tobytes() for x in np.split(names, cuts[1:])] if len(cuts) else []
        ids = b.ids[row[cuts]]
        return _answer(ids, np.zeros_like(ids), data, parts)
    return run


def _windows(plan: Plan, buckets: int, out_buckets: int):
    """Window starts within reach of a repeated block, with their names."""
    def run(batches):
        cover = difference_cover(plan.q)
        for batch in slices(batches, SLICE_BYTES):
            raw, off = string_parts(batch.column(1))
            keys = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 0))
            sym, docs, doc, place, bucket, names = _named(plan, cover, raw, off, buckets)
            code = (bucket.astype(np.uint64) << np.uint64(32)) | names
            hit = np.zeros(len(code), bool)
            cuts = np.searchsorted(doc, np.arange(len(docs)))
            for d, found in enumerate(batch.column(4).to_pylist()):
                lists = [np.frombuffer(x, np.uint32).astype(np.uint64) for x in found]
                told = np.concatenate([x[1:] | (x[0] << np.uint64(32)) for x in lists])
                hit[cuts[d]:cuts[d + 1]] = np.isin(code[cuts[d]:cuts[d + 1]], told)
            doc, place = doc[hit], place[hit]
            last = docs[1:][doc] - plan.window                  # last start that fits
            lo = docs[:-1][doc] + np.maximum(place - (plan.window - plan.block), 0)
            hi = np.minimum(docs[:-1][doc] + place, last) + 1
            delta = np.zeros(len(sym) + 1, np.int32)
            ok = hi > lo
            np.add.at(delta, lo[ok], 1)
            np.add.at(delta, hi[ok], -1)
            start = np.flatnonzero(np.cumsum(delta[:-1]) > 0)
            if not len(start):
                continue
            h1, h2 = Rolling(sym, 0).at(start, plan.window), Rolling(sym, 1).at(start, plan.window)
            owner = np.searchsorted(docs, start, "right") - 1
            out = ((mixed(h1 + h2) >> np.uint64(32)) * np.uint64(out_buckets) >> np.uint64(32)).astype(np.int64)
            yield from _emit(out, h1 ^ (h2 * _M1), owner, start - docs[:-1][owner], keys, out_buckets)
    return run


def _window_reply(plan: Plan, parts: int):
    def run(t: pa.Table) -> pa.Table:
        b = Bucket(t, np.uint64)
        hit = b.repeated(plan.earlier, True)
        row, place = b.row[hit], b.places[hit]
        cuts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])[:len(row)])
        data = [_gaps(x.astype(np.int64), np.array([0])) for x in np.split(place, cuts[1:])] if len(cuts) else []
        return _answer(b.k1[row[cuts]], b.k2[row[cuts]], data, parts)
    return run


def covered(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal runs of positions covered by windows at ``starts`` (sorted)."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > window)
    return list(zip(starts[np.concatenate([[0], gap + 1])].tolist(),
                    (starts[np.concatenate([gap, [len(starts) - 1]])] + window).tolist()))


def starts_of(found: list[bytes] | None) -> np.ndarray:
    if not found:
        return np.zeros(0, np.int64)
    return np.sort(np.concatenate([np.cumsum(_differences(f)) for f in found]))


def repeated_windows(docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """Every document as ``id, text, copies, least_id, found``: how many rows
    hold its text, the smallest id among them, and the starts of its repeated
    windows (packed; see :func:`starts_of`)."""
    spark = docs.sparkSession
    ship(spark)
    keyed = _keyed(docs, id_col, text_col)
    classes = stored(keyed.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("id").alias("least_id"),
                                                   F.first(F.octet_length("text")).cast("long").alias("n")), "cover-classes")
    total = classes.agg(F.sum(F.col("n") * F.least("copies", F.lit(2)))).first()[0] or 0
    symbols = total / 6 if plan.words else total
    buckets = max(1, math.ceil(symbols * (plan.q + 1) / plan.period * 6 / BUCKET_BYTES))

    long = keyed.filter(F.octet_length("text") >= plan.window)
    entries = long.select("id", "text", "k1", "k2").mapInArrow(_sample(plan, buckets), ENTRIES)
    told = _collected(entries, _sample_reply(plan, buckets), buckets, "cover-sample").select(F.col("k1").alias("id"), "found")
    release(spark)

    hits = told.agg(F.sum(F.aggregate("found", F.lit(0), lambda n, x: n + F.octet_length(x))) / 4).first()[0] or 0
    buckets_2 = max(1, math.ceil(hits * plan.period / (plan.q + 1) * 12 / BUCKET_BYTES))
    # a null id stands as the largest number in the answers
    near = (long.withColumn("id", F.coalesce("id", F.lit(2 ** 63 - 1))).join(told, "id")
            .select("id", "text", "k1", "k2", "found"))
    windows = near.mapInArrow(_windows(plan, buckets, buckets_2), ENTRIES)
    runs = _collected(windows, _window_reply(plan, buckets_2), buckets_2, "cover-windows")
    release(spark)

    verdict = classes.join(runs, ["k1", "k2"], "left").select("k1", "k2", "copies", "least_id", "found")
    return keyed.join(verdict, ["k1", "k2"], "left").select("id", "text", "copies", "least_id", "found")
