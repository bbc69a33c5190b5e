"""Secret scans with a recursive decoding worklist.

Every text is scanned for three kinds of secret (:data:`KINDS`).  Secrets are
often wrapped - URL escapes, Unicode escapes, base64, compressed bytes, wide
characters, and these inside each other - so each text starts a worklist of
layers.  A layer is scanned as bytes, whatever they are, then unwrapped in every
way that applies, and each result not seen before in this text (a hash of its
bytes; this is also what stops cycles such as an archive that holds itself) joins
the worklist, until nothing new turns up.  Every span found is mapped back through
its layers to the original text: escapes map character by character, base64 and
compressed layers to the whole blob that holds them.

A base64 run is decoded from each of its first four characters, so whatever is
glued in front of a blob (a path, a name) can't hide it, and once more with the
lines of a wrapped block joined.  Compressed streams are looked for at every place
of a decoded layer, one after the other.  An escape of an escape (``%252541``) is
undone in one step however deep it is: the escape character belongs to no
pattern, so what the layers between would show is part of what the last one shows.

Scanning works on UTF-8 bytes - the patterns only name ASCII characters, so
matches are the same as on characters - and offsets become code points at the
end.  A decompressed layer is read in overlapping windows, one at a time.  An
overlap holds at least ``OVERLAP`` bytes and the whole of a base64 run that isn't
over yet, if that has at most ``CARRY`` bytes; of a longer run each window is
decoded by itself, so only a compressed stream inside of such a run is cut.

Defined results: a null or empty text has no spans.  Rows are judged one by
one, so repeated rows and repeated ids repeat their result; an empty table
gives an empty result.  Input columns besides the text and the id are ignored
by :func:`find_secrets` and kept by :func:`redact_secrets`.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate.llm._ship import ship, tables, tidy

# fixed values: the kinds in their order, their patterns and least lengths
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE)
ASSIGN_LEAST = 12
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")     # 18 characters or more
HEX = re.compile(rb"[0-9a-f]{16,}")            # a run is one match, so the least length can sit in the pattern
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api")

# escapes, with any number of escaped escape characters in front; the last group decides
_PERCENT = re.compile(rb"%(?:25)*([0-9A-Fa-f]{2})")
_UNICODE = re.compile(rb"\\(?:u005[cC]|x5[cC])*(u[0-9A-Fa-f]{4}|u\{[0-9A-Fa-f]{1,6}\}|x[0-9A-Fa-f]{2})"
                      rb"|&(?:#38;|#x26;)*(#x[0-9A-Fa-f]{1,6};|#[0-9]{1,7};)")
_WIDE = re.compile(rb"\x00+")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
_LINES = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)+={0,2}")
_BREAK = b"\r\n \t"
_PLAIN = bytes.maketrans(b"-_", b"+/")
_STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]")
_RUN = bytes(b for b in range(128) if chr(b).isalnum()) + b"+/_-=\r\n"
WINDOW = 8 * 1024 * 1024        # bytes of a decompressed layer that come out at once
OVERLAP = 64 * 1024             # of neighbouring windows, at least
CARRY = 4 * 1024 * 1024        # of an unfinished base64 run, at most
CHUNK = 4096                    # compressed bytes taken at once

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))


def scan(data: bytes) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` in bytes, leftmost non-overlapping per kind."""
    out = []
    low = data.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(0, *m.span()) for m in ASSIGN.finditer(data) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if b"AKIA" in data:
        out += [(1, *m.span()) for m in ACCESS.finditer(data)]
    out += [(2, *m.span()) for m in HEX.finditer(data)]
    return out


class Layer:
    """Bytes of one layer and the way back to the layer it came from."""

    def __init__(self, data: bytes, parent: "Layer | None" = None, back=None):
        self.data, self.parent, self.back = data, parent, back

    def origin(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.parent is not None:
            start, end = layer.back(start, end)
            layer = layer.parent
        return start, end


def _escapes(layer: Layer, pattern: re.Pattern, decode) -> "Layer | None":
    """The layer with every escape of one kind replaced, mapped piece by piece."""
    out, new_at, old_at, old_end = [], [], [], []
    pos = new = 0
    for m in pattern.finditer(layer.data):
        made = decode(m)
        if made is None:
            continue
        if m.start() > pos:                          # literal stretch
            new_at.append(new), old_at.append(pos), old_end.append(-1)
            out.append(layer.data[pos:m.start()])
            new += m.start() - pos
        new_at.append(new), old_at.append(m.start()), old_end.append(m.end())
        out.append(made)
        new += len(made)
        pos = m.end()
    if not out:
        return None
    if pos < len(layer.data):
        new_at.append(new), old_at.append(pos), old_end.append(-1)
        out.append(layer.data[pos:])

    def back(start: int, end: int) -> tuple[int, int]:
        i, j = bisect.bisect_right(new_at, start) - 1, bisect.bisect_right(new_at, end - 1) - 1
        a = old_at[i] + (start - new_at[i] if old_end[i] < 0 else 0)
        b = old_at[j] + (end - new_at[j]) if old_end[j] < 0 else old_end[j]
        return a, b
    return Layer(b"".join(out), layer, back)


def _percent(m: re.Match) -> bytes:
    return bytes.fromhex(m.group(1).decode())


def _code_point(m: re.Match) -> bytes | None:
    text = m.group(m.lastindex).decode()
    if text[0] == "#":
        cp = int(text[2:-1], 16) if text[1] == "x" else int(text[1:-1])
    else:
        cp = int(text[1:].strip("{}"), 16)
    if cp > 0x10FFFF or 0xD800 <= cp < 0xE000:
        return None
    return chr(cp).encode()


def _nothing(m: re.Match) -> bytes:
    return b""


def _blobs(run: bytes):
    """What a base64 run in either alphabet decodes to from each of its first
    four characters on."""
    body = run.rstrip(b"=").translate(_PLAIN)
    for skip in range(4):
        part = body[skip:len(body) - (len(body) - skip) % 4 if (len(body) - skip) % 4 == 1 else None]
        yield base64.b64decode(part + b"=" * (-len(part) % 4))


def _open_run(data: bytes) -> int:
    """Length of the base64 run, with its line breaks, that the data ends in (0
    beyond ``CARRY``)."""
    run = len(data) - len(data.rstrip(_RUN))
    return run if run <= CARRY else 0


def _windows(data: bytes, start: int):
    """Decompressed bytes of the stream that starts there, in overlapping
    windows, and at last the place where it ended (None: it is broken or cut off;
    what came out before is real)."""
    d, held, fresh = zlib.decompressobj(47), b"", []
    size, pos, rest, broken = 0, start, b"", False
    while not d.eof and not broken and (rest or pos < len(data)):
        if not rest:
            rest, pos = data[pos:pos + CHUNK], pos + CHUNK
        before = d.copy()
        try:
            piece = d.decompress(rest, WINDOW)
            rest = d.unconsumed_tail
        except zlib.error:
            piece, broken = _until_broken(before, rest), True
        fresh.append(piece)
        size += len(piece)
        if size >= WINDOW:
            window = held + b"".join(fresh)
            yield window
            held, fresh, size = window[-max(OVERLAP, _open_run(window)):], [], 0
            del window
    if size:
        yield held + b"".join(fresh)
    yield min(pos, len(data)) - len(d.unused_data) if d.eof else None


def _until_broken(d, rest: bytes) -> bytes:
    """What comes out of a stream byte by byte before its error."""
    out = []
    try:
        for k in range(len(rest)):
            out.append(d.decompress(rest[k:k + 1]))
    except zlib.error:
        pass
    return b"".join(out)


def _streams(layer: Layer):
    """The layers that compressed streams inside of a decoded layer give."""
    data, whole = layer.data, (lambda s, e, n=len(layer.data): (0, n))
    starts = [m.start() for m in _STREAM.finditer(data)]
    if len(data) > 2 and data[0] & 15 == 8 and (data[0] * 256 + data[1]) % 31 == 0 and starts[:1] != [0]:
        starts.insert(0, 0)
    done = 0
    for start in starts:
        if start < done:
            continue                                 # inside of a stream that has been read to its end
        for part in _windows(data, start):
            if isinstance(part, bytes):
                yield Layer(part, layer, whole)
            elif part is not None:
                done = part


def _unwrap(layer: Layer):
    """Every layer that one unwrapping step gives, one at a time."""
    data = layer.data
    for pattern, decode, marks in ((_PERCENT, _percent, (b"%",)), (_UNICODE, _code_point, (b"\\", b"&#")),
                                   (_WIDE, _nothing, (b"\0",))):
        if any(mark in data for mark in marks):
            made = _escapes(layer, pattern, decode)
            if made is not None:
                yield made
    for pattern in (_BASE64, _LINES):
        for m in pattern.finditer(data):
            run = m.group() if pattern is _BASE64 else m.group().translate(None, _BREAK)
            for raw in _blobs(run):
                yield Layer(raw, layer, lambda s, e, at=m.span(): at)
    if layer.parent is not None:
        yield from _streams(layer)


def find(data: bytes) -> list[tuple[int, int, int, bool]]:
    """All spans of one text: ``(start, kind number, end, base)`` in code
    points, by start, then kind, then end."""
    base = scan(data)
    found = {(s, k, e): True for k, s, e in base}
    seen = set()
    work = [_unwrap(Layer(data))]                    # one layer of each step is held
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        # equal bytes under another blob are another place, so a layer repeats
        # only an equal one at the same place or one of those it came from
        where = (hashlib.sha256(layer.data).digest(), layer.origin(0, max(1, len(layer.data))))
        if where in seen or _repeats(layer.parent, layer.data):
            continue
        seen.add(where)
        for k, s, e in scan(layer.data):
            a, b = layer.origin(s, e)
            found.setdefault((a, k, b), False)
        work.append(_unwrap(layer))
    if not found:
        return []
    return _code_points(data, found)


def _repeats(layer: "Layer | None", data: bytes) -> bool:
    while layer is not None:
        if layer.data == data:
            return True
        layer = layer.parent
    return False


def _code_points(data: bytes, found: dict) -> list[tuple[int, int, int, bool]]:
    at, chars, pos = {}, 0, 0
    for p in sorted({x for s, _, e in found for x in (s, e)}):
        chars += sum(1 for c in data[pos:p] if c & 0xC0 != 0x80) if not data[pos:p].isascii() else p - pos
        at[p], pos = chars, p
    return [(s, k, e, b) for (s, k, e), b in sorted(((at[s], k, at[e]), b) for (s, k, e), b in found.items())]


def _spans_udf():
    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        tables("secrets")
        rows = []
        for data in texts.cast(pa.binary()).to_pylist():
            rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in find(data or b"")])
        tidy()
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                                  ("end", pa.int32()), ("base", pa.bool_())])))
    return spans


def secret_spans(text: Column) -> Column:
    """Array of ``kind, start, end, base`` of one text column; ``base`` marks
    spans found in the text as it stands."""
    return _spans_udf()(text)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` for every row."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`"), secret_spans(F.col(f"`{text_col}`")).alias("spans"))


def redact_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (overlapping and
    touching spans together); a null text stays null."""
    ship(docs.sparkSession)

    @F.arrow_udf(T.StringType())
    def clean(texts: pa.Array) -> pa.Array:
        tables("secrets")
        rows = []
        for text in texts.to_pylist():
            spans = find(text.encode()) if text else []
            if spans:
                out, pos = [], 0
                for s, _, e, _ in spans:
                    if s > pos or (s == 0 and pos == 0):
                        out += [text[pos:s], mask]
                    pos = max(pos, e)
                text = "".join([*out, text[pos:]])
            rows.append(text)
        tidy()
        return pa.array(rows, pa.string())
    return docs.withColumn(text_col, clean(F.col(f"`{text_col}`")))
