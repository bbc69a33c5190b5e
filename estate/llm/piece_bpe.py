"""SentencePiece encoding and decoding that keeps source offsets.

A text is normalised by the model's compiled character map: at every position
the longest key of the map that is a prefix of the rest is replaced, all other
characters are copied.  Along with the normalised text goes its alignment, the
source byte that each normalised byte came from, so the byte spans in the
original text of all pieces are one lookup: piece ``k`` covers the bytes from
``cuts[k]`` to ``cuts[k + 1]`` of the text's UTF-8.  A space that the model puts in
front has an empty source; of a character that falls back to its bytes, the last
byte's piece has the span.

Pieces are then merged by score (best first, leftmost among equals): in short
segments by looking for the best pair, in long ones with a heap over linked
characters.  A merge never reaches across a space mark that follows
a character after which no piece of the vocabulary holds one, so a text falls
into segments, and the pieces of a segment are remembered per worker in a
bounded table of two generations.  Long texts are normalised and encoded in
bounded parts, cut in front of a space between two ASCII letters or digits,
which no key of the map spans (checked when the model is opened).

Decoding gathers piece bytes with one vectorised take; bytes that don't make up
a character become U+FFFD, one each, as in the library.

Models: BPE, with or without byte fallback, user-defined pieces and character
map.  Other kinds, and pieces marked unused, are refused.

Defined results: a null or empty text encodes to no ids; null ids decode to
null, and an id outside the vocabulary is an error in the library and U+FFFD
here.  Rows are judged one by one (repeated rows and ids repeat their result);
other columns are kept, and a column named like an output is replaced; empty
tables give empty results.
"""

from __future__ import annotations

import heapq
import re
import string
import struct
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate.llm._ship import ship, slices

MARK = "▁"                       # stands for a space in pieces
SLICE_BYTES = 4 * 1024 * 1024    # of texts encoded at once, or one text
SEGMENT_CHARS = 256 * 1024       # of one text normalised at once
SLICE_IDS = 1024 * 1024          # ids decoded at once, or one row
TABLE_ENTRIES = 350_000          # of each of two generations
SHORT = 64                       # characters of a segment merged without a heap
KEPT_CHARS = 48                  # longer segments are encoded but not remembered
_CUT = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")
_ENDS = string.digits + string.ascii_letters
_MARK_BYTES = len(MARK.encode())
_LOST = "�".encode()
_NONE = 1 << 62
_BITS = 22                       # of an id, also of characters that are no piece
# fixed values: kinds of pieces in a model file
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_open: dict = {}


def fields(raw: bytes):
    """``number, value`` of each field of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value
    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, raw[at:at + n]
            at += n


class CharMap:
    """A compiled character map: a double-array trie of keys (UTF-8) whose
    values are places in a block of zero-ended replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size:]
        keys = list(self._keys())
        starts = sorted({k.decode("utf-8", "ignore")[:1] for k, _ in keys} - {""})
        # where a replacement can begin
        self.begins = re.compile("[" + "".join(map(re.escape, starts)) + "]") if starts else None
        self.spaced = any(b" " in k and len(k) > 1 for k, _ in keys)

    def _child(self, base: int, byte: int) -> tuple[int, int | None] | None:
        """Base of the node reached by ``byte``, and its value if a key ends."""
        at = base ^ byte
        if at >= len(self.units):
            return None
        unit = self.units[at]
        if unit & 0x800000FF != byte:
            return None
        down = at ^ (unit >> 10 << ((unit & 512) >> 6))
        return down, self.units[down] & 0x7FFFFFFF if unit & 256 else None

    def _root(self) -> int:
        unit = self.units[0]
        return unit >> 10 << ((unit & 512) >> 6)

    def _keys(self):
        todo = [(b"", self._root())] if self.units else []
        units, every = np.array(self.units, np.uint32), np.arange(1, 256)
        while todo:
            key, base = todo.pop()
            at = base ^ every
            here = at < len(units)
            for byte in every[here][units[at[here]] & 0x800000FF == every[here]].tolist():
                down, value = self._child(base, byte)
                if value is not None:
                    yield key + bytes([byte]), value
                todo.append((key + bytes([byte]), down))

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key at ``raw[at:]`` and its replacement."""
        found, base = None, self._root()
        for end in range(at, len(raw)):
            step = self._child(base, raw[end])
            if step is None:
                break
            base, value = step
            if value is not None:
                found = end + 1 - at, value
        if found is None:
            return None
        n, value = found
        return n, self.texts[value:self.texts.index(0, value)]


class Model:
    """One model file, opened once per Python worker."""

    def __init__(self, raw: bytes):
        self.pieces, kinds, scores = [], [], []
        trainer, norm = {}, {}
        for number, value in fields(raw):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                norm = dict(fields(value))
        if trainer.get(3, 1) != 2 or UNUSED in kinds or trainer.get(24, 0) or not norm.get(5, 1):
            raise ValueError("only BPE models with space marks in front and no unused pieces are supported")
        self.fallback = bool(trainer.get(35, 0))
        self.lost = trainer.get(44, " ⁇ ".encode())
        self.prefix, self.squeeze = bool(norm.get(3, 1)), bool(norm.get(4, 1))
        self.map = CharMap(norm.get(2, b""))
        self.kinds = np.array(kinds, np.int8)
        self.unknown = kinds.index(UNKNOWN)
        # better scores come first; equal ones share their order
        order = {s: i for i, s in enumerate(sorted({s for s in scores}, reverse=True))}
        self.ids = {p: i for i, p in enumerate(self.pieces) if kinds[i] in (NORMAL, USER)}
        self.order = {p: order[scores[i]] for p, i in self.ids.items()}
        self.bytes = [self.unknown] * 256
        for i, p in enumerate(self.pieces):
            if kinds[i] == BYTE:
                self.bytes[int(p[1:-1], 16)] = i
        user = sorted((p for p in self.ids if kinds[self.ids[p]] == USER), key=len, reverse=True)
        self.user = re.compile("|".join(map(re.escape, user))) if user else None
        # characters after which a piece holds a space mark: no segment ends there
        glued = sorted({a for p in self.ids for a, b in zip(p, p[1:]) if b == MARK != a})
        inside = "".join(map(re.escape, [MARK, *glued]))
        self.segments = (re.compile(f"(?<=[^{inside}])(?={MARK})").split if glued
                         else re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall)
        self.plain = not glued and not user and self.prefix and not self.squeeze
        self.cut = (not self.map.spaced and not any(" " in p for p in user) and (self.fallback or MARK in self.ids)
                    and not any(c in glued for c in _ENDS))
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # characters that are no piece get ids of their own behind the pieces'
        self.single = {p: i for p, i in self.ids.items() if len(p) == 1}
        self.packed = [self._pack(p, i) for i, p in enumerate(self.pieces)]
        self.pairs = {}                                # two neighbours -> order and id of what they make
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = (self.ids.get(x, -1) if len(x) > 1 else self._char(x) for x in (p[:k], p[k:]))
                if a >= 0 and b >= 0:
                    self.pairs[a << _BITS | b] = self.order[p] << _BITS | i
        self.two = {p: self.order[p] << _BITS | i for p, i in self.ids.items() if len(p) == 2}
        seen: set[int] = set()
        self.tied = {o for o in self.order.values() if o in seen or seen.add(o)}
        self._decoder()

    def _pack(self, piece: str, i: int) -> bytes:
        """Pairs (id, normalised bytes) of a piece, 4 bytes each."""
        raw = piece.encode()
        if i != self.unknown or not self.fallback:
            return struct.pack("<2i", i, len(raw))
        out = [x for b in raw for x in (self.bytes[b], 0)]
        out[-1:] = [len(raw)]
        return struct.pack(f"<{len(out)}i", *out)

    def _char(self, c: str) -> int:
        i = self.single.get(c)
        if i is None:
            self.single[c] = i = len(self.packed)
            self.packed.append(self._pack(c, self.unknown))
        return i

    # -- normalisation ------------------------------------------------------

    def parts(self, text: str):
        """``text, is it the first, is it the last`` of bounded parts."""
        at = 0
        while self.cut and len(text) - at > SEGMENT_CHARS:
            m = _CUT.search(text, at + SEGMENT_CHARS)
            if not m:
                break
            yield text[at:m.start()], at == 0, False
            at = m.start()
        yield text[at:] if at else text, at == 0, True

    def normalise(self, text: str, first: bool = True, last: bool = True) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and, for each of them and the end, the source byte."""
        raw = text.encode()
        gone = len(raw)                                # first source byte that was replaced by nothing
        if self.user or self.map.begins and self.map.begins.search(text):
            out, sources, gone = self._replaced(text)
            out, source = b"".join(out), np.concatenate([*sources, np.zeros(0, np.int64)])
        else:
            out, source = raw, np.arange(len(raw))
        b = np.frombuffer(out, np.uint8)
        head, tail = 0, len(raw)
        if self.squeeze:
            space = b == 32
            drop = space.copy()
            drop[1:] &= space[:-1]                     # of spaces in a row the first stays, but
            if not first:
                drop[:1] = False
            elif len(b):
                head = min(gone, int(source[int(np.argmin(space))]) if not space.all() else tail)
            if last:                                   # none at the text's ends; marks at the end go, too
                end = len(out)
                while end and (out[end - 1] == 32 or out.endswith(MARK.encode(), 0, end)):
                    end -= 1 if out[end - 1] == 32 else _MARK_BYTES
                drop[end:] = True
                tail = int(source[end]) if end < len(source) else tail
            b, source = b[~drop], source[~drop]
            if not len(b):
                return b"", np.array([tail])
        source = np.repeat(source, np.where(b == 32, _MARK_BYTES, 1))
        done = b.tobytes().replace(b" ", MARK.encode())
        if first and self.prefix:
            done = MARK.encode() + done
            source = np.concatenate([np.full(_MARK_BYTES, head), source])
        return done, np.append(source, tail)

    def _replaced(self, text: str) -> tuple[list[bytes], list[np.ndarray], int]:
        """Copied stretches and replacements, each with its source bytes, and
        the first source byte that was replaced by nothing."""
        raw = text.encode()
        out, source, done, gone = [], [], 0, len(raw)
        # byte at which each character starts
        place = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))

        def copy(end: int):
            if end > done:
                out.append(raw[done:end])
                source.append(np.arange(done, end))
        at = 0
        while at < len(text):
            user = self.user.search(text, at) if self.user else None
            rule = self.map.begins.search(text, at) if self.map.begins else None
            if not user and not rule:
                break
            if user and (not rule or user.start() <= rule.start()):
                at = user.end()                        # copied as it is
                continue
            at = rule.start()
            hit = self.map.longest(raw, int(place[at]))
            if not hit:
                at += 1
                continue
            n, instead = hit
            start = int(place[at])
            copy(start)
            out.append(instead)
            source.append(np.full(len(instead), start))
            if not instead:
                gone = min(gone, start)
            done = start + n
            at = int(np.searchsorted(place, done))
        copy(len(raw))
        return out, source, gone

    # -- pieces -------------------------------------------------------------

    def merge(self, text: str) -> list[str]:
        """Best score first, leftmost among equals, until nothing merges.

        ``part[i]`` is the piece that starts at symbol ``i``, ``nxt`` and ``prv``
        link the starts, ``rank[i]`` is the order of what it makes with the next
        one; a heap item packs that order and the start, and is out of date if
        the order has changed."""
        if self.user and self.user.search(text):
            part, frozen, at = [], [], 0
            while at < len(text):
                m = self.user.match(text, at)
                part.append(m[0] if m else text[at])
                frozen.append(bool(m))
                at += len(part[-1])
        else:
            part, frozen = list(text), None
        get, n = self.order.get, len(part)
        wide = n.bit_length()
        low = (1 << wide) - 1
        nxt, prv = list(range(1, n + 1)), list(range(-1, n))

        def join(i: int, j: int) -> int:
            if frozen and (frozen[i] or frozen[j]):
                return -1
            return get(part[i] + part[j], -1)
        rank = [join(i, i + 1) for i in range(n - 1)] + [-1]
        heap = [r << wide | i for i, r in enumerate(rank) if r >= 0]
        heapq.heapify(heap)
        while heap:
            x = heapq.heappop(heap)
            i = x & low
            if rank[i] != x >> wide:
                continue
            j = nxt[i]
            part[i] += part[j]
            part[j] = ""
            rank[j] = -1
            nxt[i] = e = nxt[j]
            if e < n:
                prv[e] = i
                rank[i] = join(i, e)
                if rank[i] >= 0:
                    heapq.heappush(heap, rank[i] << wide | i)
            else:
                rank[i] = -1
            p = prv[i]
            if p >= 0:
                rank[p] = join(p, i)
                if rank[p] >= 0:
                    heapq.heappush(heap, rank[p] << wide | p)
        return [p for p in part if p]

    def encode_segment(self, text: str) -> bytes:
        """Pairs (id, normalised bytes), 4 bytes each."""
        if len(text) <= SHORT and not (self.user and self.user.search(text)):
            ids = self._short(text)
            if ids is not None:
                return b"".join(map(self.packed.__getitem__, ids))
        return b"".join([self._pack(p, self.ids.get(p, self.unknown)) for p in self.merge(text)])

    def _short(self, text: str) -> list[int] | None:
        """Ids of the merged text; None if pairs of one score compete."""
        get = self.pairs.get
        ids = list(map(self.single.get, text))
        if None in ids:
            ids = [self._char(c) for c in text]
        best = [x or _NONE for x in map(self.two.get, map(add, text, text[1:]))]
        while best:
            x = min(best)
            if x == _NONE:
                break
            if x >> _BITS in self.tied:
                return None
            i = best.index(x)
            ids[i] = x = x & (1 << _BITS) - 1
            del ids[i + 1], best[i]
            if i:
                best[i - 1] = get(ids[i - 1] << _BITS | x, _NONE)
            if i < len(best):
                best[i] = get(x << _BITS | ids[i + 1], _NONE)
        return ids

    def _paired(self, segments: list[str]) -> np.ndarray:
        if len(self.new) > TABLE_ENTRIES:
            self.old, self.new = self.new, {}
        new, old, long = self.new, self.old, []
        for x in set(segments).difference(new):
            new[x] = old.get(x) or self.encode_segment(x)
            if len(x) > KEPT_CHARS:
                long.append(x)
        pairs = np.frombuffer(b"".join(map(new.__getitem__, segments)), np.int32).reshape(-1, 2)
        for x in long:
            del new[x]
        if not self.fallback and len(pairs) > 1:       # unknown characters side by side are one piece
            lost = pairs[:, 0] == self.unknown
            begin = ~(lost & np.concatenate([[False], lost[:-1]]))
            at = np.flatnonzero(begin)
            pairs = np.column_stack([pairs[at, 0], np.add.reduceat(pairs[:, 1], at)])
        return pairs

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and the cuts between their spans, bytes of the text's UTF-8."""
        ids, cuts, base = [], [], 0
        for part, first, last in self.parts(text):
            done, source = self.normalise(part, first, last)
            if self.plain and first and "  " not in part and part[0] != " " and part[-1] != " " and MARK not in part \
                    and not (self.map.begins and self.map.begins.search(part)):
                segments = list(map(MARK.__add__, part.split(" ")))
            else:
                segments = self.segments(done.decode()) if done else []
            pairs = self._paired(segments)
            ids.append(pairs[:, 0])
            if not cuts:
                cuts.append(source[:1])
            cuts.append(source[np.cumsum(pairs[:, 1])] + base)
            base += len(part.encode())
        return np.concatenate(ids), np.concatenate(cuts)

    # -- decoding -----------------------------------------------------------

    def _decoder(self) -> None:
        words = []
        for i, p in enumerate(self.pieces):
            kind = self.kinds[i]
            words.append(b"" if kind == CONTROL else self.lost if kind == UNKNOWN
                         else bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(MARK, " ").encode())
        words.append(_LOST)                            # ids outside the vocabulary
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.blob = np.frombuffer(b"".join(words), np.uint8)
        marked = [p.startswith(MARK) for p in self.pieces] + [False]
        self.marked = np.array(marked) & np.append(np.isin(self.kinds, (NORMAL, USER)), False)

    def _front(self, ids: np.ndarray) -> int:
        """Bytes that go from the front: the space in front of the text."""
        gone = 0
        if not (self.prefix or self.squeeze):
            return 0
        for i in ids:                                  # seldom more than the first
            left = len(self.words[i])
            if self.marked[i]:
                gone, left = gone + 1, left - 1
                if not self.squeeze:
                    return gone
            if left:
                break
        return gone

    def _repaired(self, ids: list[int]) -> bytes:
        """Bytes of ids of which some don't make up characters."""
        byte = len(self.kinds)
        out, run = [], bytearray()

        def flush():
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + n]).decode().encode())
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append(_LOST)
                    n = 1
                at += n
            run.clear()
        for i in ids:
            if i < byte and self.kinds[i] == BYTE:
                run += self.words[i]
            else:
                flush()
                out.append(self.words[i])
        flush()
        return b"".join(out)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of rows of ids."""
        ids = np.where((ids < 0) | (ids >= len(self.pieces)), len(self.pieces), ids)
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.begin[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        data = self.blob[at].tobytes()
        cuts = np.concatenate([[0], ends])[offsets].tolist()
        out = []
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            lo, hi = offsets[k], offsets[k + 1]
            raw = data[a:b]
            front = self._front(ids[lo:hi])
            try:
                out.append(raw[front:].decode())
            except UnicodeDecodeError:
                out.append(self._repaired(ids[lo:hi].tolist())[front:].decode())
        return out


def model(path: str) -> Model:
    if path not in _open:
        with open(path, "rb") as f:
            _open[path] = Model(f.read())
    return _open[path]


def _with(df: DataFrame, added: list[T.StructField]) -> tuple[list[str], T.StructType]:
    """Columns of ``df`` that stay, and the schema with the added ones."""
    names = {f.name.lower() for f in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    return [f.name for f in kept], T.StructType(kept + added)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids", cuts_col: str = "cuts",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of ``text_col`` and the cuts between their byte
    spans in the text (arrays of int; a text has one cut more than pieces);
    ``path``: a model file at the same place on every executor.  With
    ``decoded_col`` the ids are decoded in the same pass."""
    ship(docs.sparkSession)
    ints = T.ArrayType(T.IntegerType())
    kept, schema = _with(docs, [T.StructField(c, ints) for c in (out_col, cuts_col)]
                         + ([T.StructField(decoded_col, T.StringType())] if decoded_col is not None else []))

    def run(batches):
        m, none = model(path), np.zeros(0, np.int32)
        for b in slices(batches, SLICE_BYTES, 0):
            coded = [m.encode(t) if t else (none, np.zeros(1, np.int64)) for t in b.column(0).to_pylist()]
            made = []
            for column in zip(*coded):
                at = np.cumsum([0, *map(len, column)])
                flat = np.concatenate(column).astype(np.int32)
                made.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)))
                if decoded_col is not None and len(made) == 1:
                    texts = pa.array(m.decode(flat, at), pa.string())
            if decoded_col is not None:
                made.append(texts)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *made], names=schema.names)
    return (docs.select(_quoted(text_col).cast("string").alias("_text"), *map(_quoted, kept))
            .mapInArrow(run, schema))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col`` in ``out_col`` (string)."""
    ship(df.sparkSession)
    kept, schema = _with(df, [T.StructField(out_col, T.StringType())])

    def run(batches):
        m = model(path)
        for whole in batches:
            sizes = pc.fill_null(pc.list_value_length(whole.column(0)), 0).to_numpy(zero_copy_only=False)
            total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            i = 0
            while i < whole.num_rows:                  # a bounded number of ids at once, or one row
                j = max(i + 1, int(np.searchsorted(total, total[i] + SLICE_IDS, "right")) - 1)
                b = whole.slice(i, j - i)
                ids = pc.fill_null(pc.list_flatten(b.column(0)), -1).to_numpy(zero_copy_only=False)
                texts = m.decode(ids, total[i:j + 1] - total[i])
                null = pc.is_null(b.column(0)).to_pylist()
                made = pa.array([None if z else t for z, t in zip(null, texts)], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns[1:], made], names=schema.names)
                i = j
    return (df.select(_quoted(ids_col).cast("array<int>").alias("_ids"), *map(_quoted, kept))
            .mapInArrow(run, schema))


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")


def covered(cuts: Column) -> Column:
    """Bytes of the text from the first piece's span to the last one's."""
    return (F.element_at(cuts, -1) - F.element_at(cuts, 1)).cast("long")
