"""Page chains linked by continuation tokens.

A dumped page knows the token it was asked with (``request_token``, none for the
first page of a listing) and the token it answered with (``continuation_token``).
The source's loop starts without a token and asks with each answer's token until
one has none.  :func:`linked_pages` finds the pages that the loop reads and their
positions without a loop over pages: by pointer doubling.  After round ``k`` the
first ``2^k`` pages of every chain are known, and every page knows the page that
is ``2^k`` further on; the next round joins both.  A chain of ``n`` pages
takes ``log2 n`` rounds, all chains at once, and the joins are on (chain, token),
so one chain that holds a third of all pages spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.operators.joins import materialized

CHAIN = ("workspace_name", "dataset", "day")


def _name(column: str) -> str:
    return "_j" + column if column.startswith("_") else "_j_" + column


def _same(columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).eqNullSafe(F.col(_name(c)))
    return cond


def _renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: _name(c) for c in columns})


def linked_pages(pages: DataFrame, chain: Sequence[str] = CHAIN, request: str = "request_token",
                 answer: str = "continuation_token", number: str = "page_no",
                 max_pages: int | None = None) -> DataFrame:
    """The pages that the token loop reads, with their position (from 1) in
    ``number`` (replaced if the dump has such a column: numbers aren't trusted).

    A null and an empty token are the same: none.  A token that no dumped page was
    asked with ends its chain, and so does one that leads back to a page already
    read (the loop would never end).  Pages of a chain without a first page, and
    pages that no read page leads to, aren't read.  A page dumped more than once is
    read once, with its smallest answer.  ``max_pages`` reads at most that many
    pages of a chain after the first."""
    chain = list(chain)
    kept = [c for c in pages.columns if c != number or c in chain]
    asked = pages.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(request, F.lit("")).alias("_at"),
                         F.nullif(F.col(answer), F.lit("")).alias("_to"))
    tokens = asked.groupBy(*chain, "_at").agg(F.min("_to").alias("_to"))
    ends = _renamed(tokens.select(*chain, "_at"), [*chain, "_at"])
    # jumps: the page `step` further on, for every page that has one
    jumps = materialized(tokens.join(ends, _same(chain) & (F.col("_to") == F.col("_j_at")), "left_semi"))
    read = materialized(tokens.filter("_at = ''").select(*chain, "_at", F.lit(1).alias("_no")))
    known, step = read.count(), 1
    while known and (max_pages is None or step <= max_pages):
        ahead = _renamed(jumps, [*chain, "_at"])
        landed = (read.join(ahead, _same(chain) & (F.col("_at") == F.col("_j_at")))
                  .select(*chain, F.col("_to").alias("_at"), (F.col("_no") + step).alias("_no")))
        read = materialized(read.unionByName(landed).groupBy(*chain, "_at").agg(F.min("_no").alias("_no")))
        now = read.count()
        if now == known:                     # nothing new behind any page: all chains are read
            break
        known, step = now, 2 * step
        further = _renamed(jumps.withColumnRenamed("_to", "_j_to"), [*chain, "_at"])
        jumps = materialized(jumps.join(further, _same(chain) & (F.col("_to") == F.col("_j_at")))
                             .select(*chain, "_at", F.col("_j_to").alias("_to")))
    if max_pages is not None:
        read = read.filter(F.col("_no") <= max_pages + 1)
    found = _renamed(read.join(_renamed(tokens, [*chain, "_at"]), _same(chain) & (F.col("_at") == F.col("_j_at")))
                     .select(*chain, "_at", "_to", "_no"), [*chain, "_at", "_to"])
    out = asked.join(found, _same(chain) & (F.col("_at") == F.col("_j_at")) & F.col("_to").eqNullSafe(F.col("_j_to")))
    return (out.dropDuplicates([*chain, "_at"])
            .select(*[F.col(f"`{c}`") for c in kept], F.col("_no").alias(number)))
