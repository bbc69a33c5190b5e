"""Token counts: batch encoding inside Arrow functions that return lengths only.

A vocabulary file is opened once per Python worker.  Texts are cut at safe
boundaries - a single space between two non-space characters, where the
tokenizer's own pattern always starts a new piece, so counts of the pieces add
up to the count of the text - and every distinct piece is encoded once, in
batches balanced by bytes.  Piece counts are kept in a bounded table, so the
common words of a corpus are looked up and only new pieces are encoded.  No
text is truncated; a run without a safe boundary is encoded whole.

The cut holds for byte-level ``.json`` vocabularies of the ``tokenizers``
library (checked when the file is opened).  Other kinds, and ``.model`` files
of ``sentencepiece``, encode whole texts.

Defined results: a null or empty text has 0 bytes and 0 tokens.  Rows are
judged one by one: repeated rows and ids repeat their result, other columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm._ship import ship, slices

LIMIT = 512
BATCH_BYTES = 256 * 1024         # of pieces encoded in one call
SLICE_BYTES = 4 * 1024 * 1024    # of texts held as pieces at once
TABLE_PIECES = 400_000           # piece counts kept per worker
KEPT_PIECE = 64                  # longer pieces are counted but not kept

_UNEVEN = re.compile(r"\s\s|^\s|\s$")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_open: dict = {}


class Counter:
    """Counts tokens of texts with one vocabulary."""

    def __init__(self, path: str):
        self.table: dict[str, int] = {}
        self.cut = False
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            tk = Tokenizer.from_file(path)
            tk.no_truncation()
            tk.no_padding()
            self.encode = lambda texts: [len(x) for x in tk.encode_batch_fast(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            self.cut = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and all(" " not in a["content"] and not (a["lstrip"] or a["rstrip"] or a["single_word"])
                                for a in spec.get("added_tokens", [])))

    def pieces(self, text: str) -> list[str]:
        """The text cut at safe boundaries; joined, they give the text."""
        if not self.cut or not text:
            return [text] if text else []
        cut = _SAFE.split(text) if _UNEVEN.search(text) else text.split(" ")
        return [cut[0], *map(" ".__add__, cut[1:])]

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pieces(t) for t in texts]
        if len(self.table) > TABLE_PIECES:
            self.table.clear()
        table = self.table
        new = set(chain.from_iterable(split)).difference(table)
        lengths, batch, size = {}, [], 0
        for p in new:
            batch.append(p)
            size += len(p)
            if size >= BATCH_BYTES:
                lengths.update(zip(batch, self.encode(batch)))
                batch, size = [], 0
        if batch:
            lengths.update(zip(batch, self.encode(batch)))
        table.update(lengths)
        out = [sum(map(table.__getitem__, s)) for s in split]
        for p in lengths:                          # long pieces seldom come back
            if len(p) > KEPT_PIECE:
                del table[p]
        return out


def counter(path: str) -> Counter:
    if path not in _open:
        _open[path] = Counter(path)
    return _open[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row, with the vocabulary
    file at ``path`` (at the same place on every executor)."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        c = counter(path)
        for b in slices(batches, SLICE_BYTES):
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            n = pa.array(c.count(texts), pa.int64())
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, n], names=[id_col, "n_bytes", "n_tokens"])

    return (docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))
            .mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
