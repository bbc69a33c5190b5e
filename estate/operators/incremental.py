"""Incremental appends by high-water mark.

The mark is computed per key (by default per workspace and pool) as a grouped
maximum over the staged data - a partial aggregate, one small row per key.
New rows are kept when strictly above their key's mark; keys without a mark
keep everything (the predicate is omitted, as on a first run).  The marks
table, one row per key, is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "_hw_mark"


def high_water(staged: DataFrame, col: str, keys: Sequence[str] = ("pool_name",),
               scope: str = "key") -> DataFrame:
    """A3: the maximum of ``col`` per key (``scope='key'``) or over the whole
    dataset (``scope='global'``, the reference behaviour that applies one
    mark to every pool)."""
    if scope == "global":
        return staged.agg(F.max(col).alias(MARK))
    return staged.groupBy(*keys).agg(F.max(col).alias(MARK))


def newer_than(new: DataFrame, col: str, marks: DataFrame | None,
               keys: Sequence[str] = ("pool_name",), lateness: str | None = None) -> DataFrame:
    """Rows with ``col`` strictly above their key's mark.

    ``marks`` comes from :func:`high_water`; ``None`` means no previous run.
    The marks are joined back null-safely (a null key has its own mark; a key
    without one keeps everything), whatever their number; Spark broadcasts
    them if they turn out small.  ``lateness`` (an interval string such as
    ``'10 minutes'``) lowers the mark to re-read rows that finished late (T2);
    :func:`not_staged` removes the rows that this reads again.
    """
    if marks is None:
        return new
    mark_keys = [c for c in marks.columns if c != MARK]
    small = marks.select(*[F.col(c).alias(f"_m_{c}") for c in mark_keys], MARK)
    cond = F.lit(True)
    for c in mark_keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_m_{c}"))
    mark = F.col(MARK) - F.expr(f"INTERVAL {lateness}") if lateness else F.col(MARK)
    joined = new.join(small, cond, "left") if mark_keys else new.crossJoin(F.broadcast(small))  # one global row
    return joined.filter(F.col(MARK).isNull() | (F.col(col) > mark)).drop(MARK, *[f"_m_{c}" for c in mark_keys])


def not_staged(new: DataFrame, staged: DataFrame | None, col: str, marks: DataFrame | None,
               key: Sequence[str], keys: Sequence[str] = ("pool_name",), lateness: str | None = None) -> DataFrame:
    """The rows of ``new`` that are not staged yet in the same version.

    Only staged rows inside the lateness window can be read again, so the
    anti-join looks at those alone (their key, ``col`` and the mark columns), not
    at all staged history.  A request that was running when staged and has
    finished since has another ``col`` and is kept as its newer version.
    """
    if staged is None or marks is None:
        return new
    seen = newer_than(staged.select(*dict.fromkeys([*key, *keys, col])), col, marks, keys, lateness)
    cond = F.lit(True)
    for c in (*key, col):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    seen = seen.select(*[F.col(c).alias(f"_s_{c}") for c in (*key, col)])
    return new.join(seen, cond, "left_anti")


def keep_newest(df: DataFrame, key: Sequence[str], order_col: str) -> DataFrame:
    """One row per key, the one with the greatest ``order_col`` (nulls -
    still running - lose to any finished version).  A grouped ``max_by`` with
    partial aggregation, no window over a hot key."""
    others = [c for c in df.columns if c not in key]
    packed = F.struct(*[F.col(c) for c in others])
    agg = (df.groupBy(*key)
           .agg(F.max_by(packed, F.struct(F.col(order_col).isNotNull(), F.col(order_col)))
                .alias("_row")))
    return agg.select(*key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)
