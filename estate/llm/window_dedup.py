"""Substring dedup: removes words covered by long earlier word sequences.

Anchors are hashes of word blocks at difference-cover positions modulo a
period: any two equal windows share an aligned anchor (:mod:`estate.llm.cover`).
Anchors seen in two texts are extended to every window start within their
reach, and those windows are compared by name; a window is removed where its
words also start in a document with a smaller id.

Defined results: words are maximal runs of characters other than space and
``\\x09``-``\\x0D``; a null or empty text has none.  Windows never cross
documents and are judged on the input.  Of equal texts the one with the
smallest id stays, a null id counting as the largest; rows that share an id
never remove each other.  Other columns are ignored, and an empty table gives
an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from estate.llm.cover import Plan, covered, repeated_windows, starts_of

WINDOW = 50
Q = 5            # cover modulo 31, 6 positions; anchors of 20 words
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _cut(window: int, id_col: str):
    def run(batches):
        for b in batches:
            total, removed, kept = [], [], []
            for i, text, least, found in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(),
                                             b.column(3).to_pylist(), b.column(4).to_pylist()):
                words = _WORD.findall(text)
                if len(words) >= window and least is not None and (i is None or i > least):
                    runs = [(0, len(words))]
                else:
                    runs = covered(starts_of(found), window)
                pos, out = 0, []
                for s, e in runs:
                    out += words[pos:s]
                    pos = e
                out += words[pos:]
                total.append(len(words))
                removed.append(len(words) - len(out))
                kept.append(b" ".join(out))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=[id_col, "n_words", "n_removed", "kept"])
    return run


def remove_earlier(docs: DataFrame, window: int = WINDOW, q: int = Q, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id, n_words, n_removed, kept``: the kept words joined by one space."""
    rows = repeated_windows(docs, Plan(window, q, words=True, earlier=True), id_col, text_col)
    return rows.mapInArrow(_cut(window, id_col), f"`{id_col}` long, n_words long, n_removed long, kept string")
