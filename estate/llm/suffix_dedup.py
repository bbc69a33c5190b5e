"""Suffix-array dedup: removes bytes covered by long repeated strings.

A string of ``window`` bytes that starts at two places (in one text or in two)
is a repeated prefix of two suffixes.  Sorting all suffixes of a corpus at once
isn't possible in bounded memory, so the order is built blockwise over a
difference cover (:mod:`estate.llm.cover`): the cover sample's suffixes are
ranked first by their hashed blocks, one bucket at a time; suffixes whose
aligned cover ranks are all alone can have no equal prefix of that length and
drop out; the others are dealt into suffix buckets by the hash of their prefix
and each bucket is sorted alone.  Long ties need no character comparison: equal
prefixes are equal names.  The order within the result is that of hashes, not
of bytes, which equality doesn't need.

Defined results: a null or empty text, or one shorter than the window, keeps
all its bytes; matches never cross texts, but overlaps within a text count;
every copy of a text of at least the window's length is removed whole.  Texts
with equal ids are separate texts.  Null ids, repeated rows and other columns
are allowed; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.cover import Plan, covered, repeated_windows, starts_of

WINDOW = 400
Q = 11           # cover modulo 133, 12 positions; blocks of 268 bytes

SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _cut(window: int, id_col: str):
    def run(batches):
        for b in batches:
            kept, spans = [], []
            for text, copies, found in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(),
                                           b.column(4).to_pylist()):
                n = len(text)
                if copies > 1 and n >= window:
                    runs = [(0, n)]
                else:
                    runs = covered(starts_of(found), window)
                pos, out = 0, []
                for s, e in runs:
                    out.append(text[pos:s])
                    pos = e
                kept.append(b"".join([*out, text[pos:]]))
                spans.append([{"start": s, "end": e} for s, e in runs])
            n = pa.array([len(t) for t in b.column(1).cast(pa.binary()).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n, pa.array(spans, SPANS), pa.array(kept, pa.binary())],
                                             names=[id_col, "n_bytes", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, q: int = Q, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id, n_bytes, spans, kept``: the maximal removed byte runs of every
    document and the bytes that are left."""
    rows = repeated_windows(docs, Plan(window, q, words=False, earlier=False), id_col, text_col)
    return rows.mapInArrow(_cut(window, id_col), f"`{id_col}` long, n_bytes long, "
                           "spans array<struct<start:int,end:int>>, kept binary")
