"""Vector code compression: product codes trained with norm-of-sum bounds.

Component ``x`` becomes the integer ``floor(scale * x)``; a vector is cut into
``parts`` equal consecutive parts, and every part position has a codebook of
``entries`` entries, at first those of the vectors with the smallest ids.  A
round assigns every part to its nearest entry (squared distance, ties to the
lower index) and moves every entry to the componentwise ``floor(sum / count)``
of its parts; an entry without parts stays.

Most distances are never computed.  Each part keeps, for each entry, the
distance last computed (rounded down) and that round's stamp, and the history of
all codebooks is kept.  An entry that was at ``c`` in the stamped round and is
at ``c'`` now is at least ``bound - |c' - c|`` away: the norm of the net
displacement, which is at most the sum of the drifts of the rounds between and
mostly well below it.  An entry whose bound exceeds the distance to the part's own
entry can't be nearer (nor tie); all others are measured exactly, and their
bounds and stamps renewed.

One round is one pass over the state (vector, bounds, stamps, assignment), which
is written to the cluster's shared folder, and one partial sum per task and
entry; the driver sees codebooks and sums only (``parts * entries * width``
numbers).  The state of a round is dropped once the next one is written.

Defined results: vectors that are null or hold null or non-finite components
take no part.  Vectors shorter than the longest, and a longest that the parts
don't divide, count as padded with zeros.  Rows of one id are rows of their own,
ordered by their vector; null ids come last.  With fewer vectors than entries
the codebooks are as long as there are vectors.  Columns named in ``keep`` are
carried along, others are ignored; an empty table gives an empty result and
empty codebooks.  Distances are exact while ``width * (4 * scale * max|x|)^2 <
2^62``, which is checked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate.llm._ship import dropped, ship, stored
from estate.llm.pivot_topk import _usable, matrix, quantised

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
ROWS = 4096              # vectors handled at once inside a task
SLACK = 1e-6             # relative, for bounds kept and compared in floats
FAR = np.iinfo(np.int64).max


@dataclass
class Codes:
    """``rows``: id, ``codes`` (array<int>, in part order), ``error`` (squared
    distances summed over parts) and the kept columns; ``codebooks``: part,
    entry, ``components``; ``history``: codebooks of all rounds (arrays);
    ``measured``: distances computed in each pass, and ``possible`` in each."""
    rows: DataFrame
    codebooks: DataFrame
    history: list
    measured: list
    possible: int


def displacements(history: np.ndarray) -> np.ndarray:
    """``|now - then|`` for every earlier round, part and entry."""
    return np.sqrt(((history[-1] - history) ** 2).sum(-1).astype(np.float64)) * (1 + SLACK)


def assign(x: np.ndarray, history: np.ndarray, bounds: np.ndarray, stamps: np.ndarray, own: np.ndarray):
    """Nearest entries of parts ``x`` (n, parts, width) under the last codebook;
    bounds, stamps (n, parts, entries) and own (n, parts) are those of the pass
    before and are renewed in place.  Returns squared distances and how many
    distances were computed."""
    now, moved = history[-1], displacements(history)
    n, parts, entries = bounds.shape
    p = np.arange(parts)
    mine = ((x - now[p, own]) ** 2).sum(-1)                              # (n, parts), exact
    low = bounds - moved[stamps, p[:, None], np.arange(entries)]
    near = low <= (np.sqrt(mine.astype(np.float64)) * (1 + SLACK) + SLACK)[..., None]
    np.put_along_axis(near, own[..., None].astype(np.int64), False, 2)
    i, q, j = np.nonzero(near)
    again = ((x[i, q] - now[q, j]) ** 2).sum(-1)
    dist = np.full(bounds.shape, FAR)
    dist[i, q, j] = again
    np.put_along_axis(dist, own[..., None].astype(np.int64), mine[..., None], 2)
    known = dist < FAR
    root = np.sqrt(dist[known].astype(np.float64)) * (1 - SLACK)
    bounds[known] = np.nextafter(root.astype(np.float32), np.float32(-1))
    stamps[known] = len(history) - 1
    own[...] = dist.argmin(2)                                            # ties: the lowest index
    return dist.min(2), len(i) + mine.size


def _sums(x: np.ndarray, own: np.ndarray, entries: int) -> np.ndarray:
    """Per part and entry the sum of its parts and, last, their count."""
    n, parts, width = x.shape
    out = np.zeros((parts, entries, width + 1), np.int64)
    for p in range(parts):
        order = np.argsort(own[:, p], kind="stable")
        keys, at = np.unique(own[order, p], return_index=True)
        out[p, keys, :width] = np.add.reduceat(x[order, p], at)
        out[p, keys, width] = np.diff(np.append(at, n))
    return out


def _pass(history: np.ndarray, first: bool, parts: int, width: int):
    """One pass over batches of (vec, bounds, stamps, own, kept columns...)."""
    entries = history.shape[2]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                n = b.num_rows
                x = matrix(b.column(0), parts * width).astype(np.int64).reshape(n, parts, width)
                if first:
                    # nothing is known yet: bounds of 0 ask for every distance
                    bounds = np.zeros((n, parts, entries), np.float32)
                    stamps = np.zeros((n, parts, entries), np.uint8)
                    own = np.zeros((n, parts), np.uint8)
                else:
                    raw = [np.frombuffer(b"".join(b.column(c).to_pylist()), kind) for c, kind in
                           ((1, np.float32), (2, np.uint8), (3, np.uint8))]
                    bounds = raw[0].reshape(n, parts, entries).copy()
                    stamps = raw[1].reshape(n, parts, entries).copy()
                    own = raw[2].reshape(n, parts).copy()
                dist, measured = assign(x, history, bounds, stamps, own)
                # the count of distances computed stands in the batch's first row
                counts = np.zeros(n, np.int64)
                counts[0] = measured
                blobs = [pa.array([r.tobytes() for r in a], pa.binary()) for a in (bounds, stamps, own)]
                yield pa.RecordBatch.from_arrays([b.column(0), *blobs, pa.array(dist.sum(1)), pa.array(counts), *b.columns[4:]],
                                                 names=["vec", "bounds", "stamps", "own", "error", "measured", *b.schema.names[4:]])
    return run


def _summed(parts: int, width: int, entries: int):
    """One row per task: its sums, as a flat array."""
    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                x = matrix(b.column(0), parts * width).astype(np.int64).reshape(b.num_rows, parts, width)
                own = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, parts)
                total += _sums(x, own, entries)
        flat = total.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], names=["at", "s"])
    return run


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", keep: tuple = (), parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of all usable vectors and the codebooks they refer to."""
    spark = vectors.sparkSession
    ship(spark)
    if not 0 < entries <= 256 or not 0 < rounds < 255:
        raise ValueError("up to 256 entries and 254 rounds: codes and stamps are bytes")
    vec, kept = F.col(f"`{vec_col}`"), [f"_k{i}" for i in range(len(keep))]
    clean = stored(vectors.filter(_usable(vec)).select(
        quantised(vec, scale).alias("vec"), F.col(f"`{id_col}`").alias("_id"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)]), "codes-vectors")
    longest, most = clean.agg(F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", F.abs)))).first()
    width = math.ceil((longest or 0) / parts)
    if width * (4 * (most or 0)) ** 2 >= 2 ** 62:
        raise ValueError("components too large for exact squared distances in 64-bit integers")
    least = clean.select("vec", "_id").orderBy(F.col("_id").asc_nulls_last(), "vec").limit(entries).collect()
    book = np.array([list(r.vec) + [0] * (parts * width - len(r.vec)) for r in least], np.int64)
    book = book.reshape(len(least), parts, width).transpose(1, 0, 2)                    # (parts, entries, width)
    history, measured, n = [book], [], clean.count()
    ids = clean.schema["_id"].dataType
    carried = [T.StructField("_id", ids), *[clean.schema[k] for k in kept]]
    schema = T.StructType([clean.schema["vec"], *[T.StructField(c, T.BinaryType()) for c in ("bounds", "stamps", "own")],
                           T.StructField("error", T.LongType()), T.StructField("measured", T.LongType()), *carried])
    nothing = F.lit(None).cast("binary")
    state = clean.select("vec", nothing.alias("bounds"), nothing.alias("stamps"), nothing.alias("own"), "_id", *kept)
    before = clean
    for turn in range(rounds + 1 if least else 0):
        run = _pass(np.array(history), turn == 0, parts, width)
        done = stored(state.mapInArrow(run, schema), f"codes-{turn}")
        dropped(before)
        before, state = done, done.drop("error", "measured")
        measured.append(done.agg(F.sum("measured")).first()[0])
        if turn < rounds:
            flat = np.zeros(parts * len(least) * (width + 1), np.int64)
            sums = (done.select("vec", "own").mapInArrow(_summed(parts, width, len(least)), "at int, s long")
                    .groupBy("at").agg(F.sum("s").alias("s")))
            for r in sums.collect():                       # at most parts * entries * (width + 1) rows
                flat[r.at] = r.s
            total = flat.reshape(parts, len(least), width + 1)
            count = total[..., -1:]
            history.append(np.where(count > 0, total[..., :-1] // np.maximum(count, 1), history[-1]))
    if least:
        codes = F.transform(F.sequence(F.lit(1), F.lit(parts)), lambda i: F.conv(F.hex(F.substring("own", i, 1)), 16, 10).cast("int"))
        rows = before.select("_id", *kept, codes.alias("codes"), "error")
    else:
        rows = clean.select("_id", *kept, F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
    rows = rows.select(F.col("_id").alias(id_col), *[F.col(k).alias(c) for k, c in zip(kept, keep)], "codes", "error")
    final = history[-1]
    books = spark.createDataFrame([(p, e, final[p, e].tolist()) for p in range(parts) for e in range(final.shape[1])],
                                  "part int, entry int, components array<long>")
    return Codes(rows, books, history, measured, n * parts * len(least))


def code_text(codes):
    """Indexes in part order, two hex digits each."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 2, "0")), ""))


def with_group_error(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``label_error``, the error summed over rows of equal ``by``
    (nulls together): partial sums, joined back null-safely."""
    total = rows.groupBy(F.col(f"`{by}`").alias("_g")).agg(F.sum("error").alias("label_error"))
    return rows.join(total, F.col(f"`{by}`").eqNullSafe(F.col("_g")), "left").drop("_g")


def codebooks_sha256(codes: Codes) -> str:
    """Digest of all final components by part, entry and position."""
    import hashlib
    return hashlib.sha256(",".join(map(str, codes.history[-1].reshape(-1).tolist())).encode()).hexdigest()
