"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is split by the tokenizer's pattern into pre-tokens, each encoded on its
own.  Tier one: a minimal perfect hash over the vocabulary (hash-and-displace:
one slot per entry, no empty slot) answers whether the whole pre-token is an
entry, with one hash, one displacement and one comparison.  Tier two, for
misses: the pre-token's bytes form a doubly linked list and a heap holds the
mergeable neighbours by (rank, position), so merges happen in the library's
order in O(n log n).  Results of both tiers are remembered per worker in a
bounded table of two generations.  Decoding gathers entry bytes with one vectorised take.

Long texts are split into segments at single spaces between two non-space
characters, where the pattern always starts a new pre-token, so the pre-tokens
held at once stay few.

The pattern's letter and digit classes depend on a Unicode version; characters
on which the installed ``regex`` module and ``tiktoken`` disagree are asked of
the library once per worker (:func:`_disagreements`).

Defined results: a null or empty text encodes to no ids; null ids decode to
null, and an id outside the vocabulary to U+FFFD.  Rows are judged one by one
(repeated rows and ids repeat their result); other columns are kept, and a
column named like the output is replaced; empty tables give empty results.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate.llm._ship import ship, tables, tidy

# fixed value: the pre-token pattern of the rank files
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SEGMENT_CHARS = 256 * 1024
SEGMENT_IDS = 256 * 1024         # ids decoded at once
TABLE_ENTRIES = 350_000          # of each of two generations
KEPT_BYTES = 48                  # longer pre-tokens are encoded but not remembered
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_TURN, _SPREAD, _HIGH = 0x9E3779B1, 0x85EBCA77, (1 << 30) - 1
_hash = xxhash.xxh32_intdigest


class PerfectHash:
    """Minimal perfect hash of byte strings: ``n`` keys, ``n`` slots.

    Keys are dealt into about ``n / 2`` groups by their hash; groups, largest
    first, get the least displacement that sends all their keys to free slots;
    groups of one key get a free slot directly (stored as ``-slot - 1``)."""

    def __init__(self, keys: list[bytes], seed: int = 0, shift: array | None = None):
        """``seed`` and ``shift``: of a hash built before over the same keys."""
        self.n = n = len(keys)
        self.groups = max(1, n // 2)
        self.seed = seed
        self.shift = shift
        while self.shift is None and not self._build(keys):
            self.seed += 1
        self.turn = [d * _TURN for d in range(max(self.shift, default=0) + 1)]
        self.keys = [b""] * n
        for k in keys:
            self.keys[self.slot(k)] = k

    def _build(self, keys: list[bytes]) -> bool:
        n = self.n
        shift = array("q", bytes(8 * self.groups))
        dealt: dict[int, list[int]] = {}
        for k in keys:
            h = _hash(k, self.seed)
            dealt.setdefault(h % self.groups, []).append(h)
        taken = bytearray(n)
        order = sorted(dealt, key=lambda g: -len(dealt[g]))
        for at, g in enumerate(order):
            hs = dealt[g]
            if len(hs) == 1:
                break
            if len(set(hs)) < len(hs):
                return False
            for d in range(1 << 20):
                slots = {self._place(h, d) for h in hs}
                if len(slots) == len(hs) and not any(taken[s] for s in slots):
                    break
            else:
                return False
            shift[g] = d
            for s in slots:
                taken[s] = 1
        else:
            at = len(order)
        free = (i for i in range(n) if not taken[i])
        for g in order[at:]:
            shift[g] = -next(free) - 1
        self.shift = shift
        return True

    def _place(self, h: int, d: int) -> int:
        return ((h ^ d * _TURN) * _SPREAD >> 24 & _HIGH) % self.n

    def slot(self, key: bytes) -> int:
        h = _hash(key, self.seed)
        d = self.shift[h % self.groups]
        return -d - 1 if d < 0 else self._place(h, d)

    def find(self, key: bytes) -> int:
        """The key's slot, or -1 if it isn't one of the keys."""
        h = _hash(key, self.seed)
        d = self.shift[h % self.groups]
        # the same place as `slot`, written out: this runs for every new pre-token
        s = -d - 1 if d < 0 else ((h ^ self.turn[d]) * _SPREAD >> 24 & _HIGH) % self.n
        return s if self.keys[s] == key else -1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}


def _characters(pattern: str) -> set[str]:
    """All characters that ``tiktoken`` takes for ``pattern``: what it doesn't
    match it leaves out of the encoding."""
    import tiktoken
    enc = tiktoken.Encoding("bytes", pat_str=pattern, special_tokens={},
                            mergeable_ranks={bytes([i]): i for i in range(256)})
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    return set(enc.decode_bytes(enc.encode_ordinary(every)).decode())


def _disagreements() -> dict[str, tuple[set[str], set[str]]]:
    """Per class, the characters only the library has and only ``regex`` has."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    out = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        theirs, ours = _characters(name), set(regex.findall(name, every))
        out[name] = (theirs - ours, ours - theirs)
    return out


def _listed(chars: set[str]) -> str:
    """Members of a character class, as ranges."""
    out, cps = [], sorted(map(ord, chars))
    for i, c in enumerate(cps):
        if i and cps[i - 1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in out)


# stretches of Unicode without rarer letters, digits or spaces (checked against
# the library in Splitter): up to U+0557, and the common typographic marks
_USUAL = "\\x00-\\u0557\\u2010-\\u2027\\u2030-\\u205e"


class Splitter:
    """The pre-token pattern as the library reads it: a fast form for texts of
    usual characters only, and the full form for all others."""

    def __init__(self, odd: dict):
        groups = {name: f"[[{name}{_listed(more)}]" + (f"--[{_listed(fewer)}]]" if fewer else "]")
                  for name, (more, fewer) in odd.items()}
        space = groups[r"\s"]
        full = PATTERN.replace(r"[^\s\p{L}\p{N}]", "OTHER").replace(r"\S", "NONSPACE")
        for name, g in groups.items():
            full = full.replace(name, g)
        self.full = regex.compile("(?V1)" + full.replace("OTHER", f"[^{''.join(groups.values())}]")
                                  .replace("NONSPACE", f"[^{space}]"))
        usual = "".join(c for c in map(chr, range(0x2060)) if re.match(f"[{_USUAL}]", c))
        letter, digit, blank = (_listed(set(regex.findall(g, usual, regex.V1))) for g in
                                (groups[r"\p{L}"], groups[r"\p{N}"], space))
        # the same pre-tokens: no two of its alternatives start alike except
        # those that keep their order
        self.fast = re.compile(f" [{letter}]+|[{letter}]+| ?[{digit}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{letter}{digit}{blank}]+"
                               f"|[{blank}]+(?![^{blank}])|[{blank}]+")
        self.unusual = re.compile(f"[^{_USUAL}]")

    def segments(self, text: str):
        pos = 0
        while len(text) - pos > SEGMENT_CHARS:
            m = _SAFE.search(text, pos + SEGMENT_CHARS)
            if not m:
                break
            yield text[pos:m.start()]
            pos = m.start()
        yield text[pos:] if pos else text

    def split(self, text: str) -> list[str]:
        fast = text.isascii() or not self.unusual.search(text)
        return (self.fast if fast else self.full).findall(text)


class Vocabulary:
    """One rank file, opened once per Python worker; ``prepared`` is what the
    driver worked out (:func:`prepare`)."""

    def __init__(self, path: str, prepared: tuple):
        self.ranks = read_ranks(path)
        seed, shift, odd = prepared
        self.hash = PerfectHash(list(self.ranks), seed, shift)
        self.ids = [self.ranks[k] for k in self.hash.keys]      # id by slot
        self.odd = odd
        self.splitter = None
        self.new: dict[str, bytes] = {}                         # ids of pre-tokens, in two generations
        self.old: dict[str, bytes] = {}
        size = max(self.ranks.values()) + 1
        words = [b"\xef\xbf\xbd"] * (size + 1)                     # the last stands for unknown ids
        for k, i in self.ranks.items():
            words[i] = k
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.blob = np.frombuffer(b"".join(words), np.uint8)
        self.unknown = size
        gaps = np.ones(size + 1, bool)
        gaps[list(self.ranks.values())] = False
        self.gaps = gaps

    def _ready(self) -> None:
        """What only encoding needs: the pattern, single bytes, and the rank of
        every mergeable pair of entries."""
        self.splitter = Splitter(self.odd)
        get = self.ranks.get
        self.bytes = [get(bytes([b])) for b in range(256)]
        self.bits = self.unknown.bit_length()
        self.pairs = {}
        for word, rank in self.ranks.items():
            for k in range(1, len(word)):
                x, y = get(word[:k]), get(word[k:])
                if x is not None and y is not None:
                    self.pairs[x << self.bits | y] = rank

    def encode_piece(self, piece: str) -> bytes:
        """The ids of one pre-token, 4 bytes each."""
        raw = piece.encode()
        slot = self.hash.find(raw)
        return array("i", (self.ids[slot],) if slot >= 0 else self.merge(raw)).tobytes()

    def merge(self, raw: bytes) -> list[int]:
        """Lowest rank first, leftmost among equals, until nothing merges.

        ``ids[i]`` is the entry that starts at byte ``i``, ``nxt`` and ``prv``
        link the starts, ``rank[i]`` is what the entry would merge to with the
        next one; a heap item packs that rank and the start, and is out of date
        if the rank has changed."""
        get, push, pop, n, bits = self.pairs.get, heapq.heappush, heapq.heappop, len(raw), self.bits
        single, wide = self.bytes, n.bit_length()
        low, ids = (1 << wide) - 1, [single[b] for b in raw]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n))
        rank = [get(x << bits | y, -1) for x, y in zip(ids, ids[1:])]
        rank.append(-1)
        heap = [r << wide | i for i, r in enumerate(rank) if r >= 0]
        heapq.heapify(heap)
        while heap:
            x = pop(heap)
            i = x & low
            r = x >> wide
            if rank[i] != r:
                continue
            j = nxt[i]
            e = nxt[j]
            ids[i] = r
            ids[j] = rank[j] = -1
            nxt[i] = e
            if e < n:
                prv[e] = i
                rank[i] = s = get(r << bits | ids[e], -1)
                if s >= 0:
                    push(heap, s << wide | i)
            else:
                rank[i] = -1
            p = prv[i]
            if p >= 0:
                rank[p] = s = get(ids[p] << bits | r, -1)
                if s >= 0:
                    push(heap, s << wide | p)
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> array:
        if self.splitter is None:
            self._ready()
        ids = array("i")
        for part in self.splitter.segments(text):
            pieces = self.splitter.split(part)
            if len(self.new) > TABLE_ENTRIES:
                self.old, self.new = self.new, {}
            new, old, long = self.new, self.old, []
            found = list(map(new.get, pieces))
            if None in found:
                for k, x in enumerate(found):
                    if x is None:
                        p = pieces[k]
                        x = new.get(p)             # it may have come up before in this part
                        if x is None:
                            new[p] = x = old.get(p) or self.encode_piece(p)
                            if len(p) > KEPT_BYTES:
                                long.append(p)
                        found[k] = x
            ids.frombytes(b"".join(found))
            for p in long:
                del new[p]
        return ids

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and the length that each gave."""
        ids = np.where((ids < 0) | (ids >= self.unknown), self.unknown, ids)
        ids = np.where(self.gaps[ids], self.unknown, ids)
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.starts[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return self.blob[at], n


_prepared: dict = {}


def prepare(path: str) -> tuple:
    """The displacements of the perfect hash and the characters on which the
    libraries disagree: worked out once on the driver, of the vocabulary's size."""
    if path not in _prepared:
        h = PerfectHash(list(read_ranks(path)))
        _prepared[path] = (h.seed, h.shift, _disagreements())
    return _prepared[path]


def vocabulary(path: str, prepared: tuple) -> Vocabulary:
    opened = tables("byte_bpe")
    if path not in opened:
        opened[path] = Vocabulary(path, prepared)
    return opened[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text_col`` in ``out_col``
    (array<int>); ``path``: a rank file at the same place on every executor."""
    ship(docs.sparkSession)
    prepared = docs.sparkSession.sparkContext.broadcast(prepare(path))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        v = vocabulary(path, prepared.value)
        values, offsets = array("i"), [0]
        for t in texts:
            t = t.as_py()
            if t:
                values.extend(v.encode(t))
            offsets.append(len(values))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(values, np.int32) if values else [], pa.int32()))
    return docs.withColumn(out_col, ids(F.col(f"`{text_col}`").cast("string")))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of ``ids_col`` in ``out_col`` (binary)."""
    ship(df.sparkSession)
    prepared = df.sparkSession.sparkContext.broadcast(prepare(path))

    @F.arrow_udf(T.BinaryType())
    def decoded(ids: pa.Array) -> pa.Array:
        v = vocabulary(path, prepared.value)
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        out, i = [], 0
        while i < len(ids):                        # a bounded number of ids at once, or one row
            j = max(i + 1, int(np.searchsorted(total, total[i] + SEGMENT_IDS, "right")) - 1)
            part = ids.slice(i, j - i)
            data, n = v.decode(pc.fill_null(pc.list_flatten(part), -1).to_numpy(zero_copy_only=False))
            ends = np.concatenate([[0], np.cumsum(n)])[total[i:j + 1] - total[i]]
            raw = data.tobytes()
            out += [None if null else raw[x:y] for null, x, y in zip(pc.is_null(part).to_pylist(), ends[:-1], ends[1:])]
            i = j
        tidy()
        return pa.array(out, pa.binary())
    return df.withColumn(out_col, decoded(F.col(f"`{ids_col}`").cast("array<int>")))


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
