"""Projections and predicates.

Filters are plain Catalyst predicates, so against Parquet they appear as
``PushedFilters`` and against JDBC they are sent to the source.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.functions.timefns import local_date

DEFAULT_EXCLUDED_DATABASES = ("default",)  # fixed value: default exclusion list


def project(df: DataFrame, keep: Iterable[str] = (), remove: Iterable[str] = ()) -> DataFrame:
    """The columns named in ``keep`` (all, if it is empty) without those in
    ``remove``, in their original order.  Names are compared in lower case
    against the lists as given, so entries are expected in lower case."""
    wanted, unwanted = frozenset(keep), frozenset(remove)
    by_name = {name: name.lower() for name in df.columns}
    if wanted:
        by_name = {name: low for name, low in by_name.items() if low in wanted}
    return df.select(*[F.col(f"`{name}`") for name, low in by_name.items() if low not in unwanted])


def as_variant(df: DataFrame, *columns: str) -> DataFrame:
    """Free-form JSON text columns (API properties whose shape varies) as
    ``VARIANT`` values, queried with ``variant_get`` / ``:`` paths."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.parse_json(F.col(c)) for c in present}) if present else df


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case top-level column names; names that then collide (differ
    only by case) get ``_2``, ``_3`` ... in column order.  Staged data thus
    never needs a case-sensitive session."""
    seen: dict[str, int] = {}
    cols = []
    for c in df.columns:
        low = c.lower()
        seen[low] = seen.get(low, 0) + 1
        cols.append(F.col(f"`{c}`").alias(low if seen[low] == 1 else f"{low}_{seen[low]}"))
    return df.select(*cols)


def user_sessions(df: DataFrame, login_col: str = "login_name") -> DataFrame:
    """Drop sessions whose lower-cased login contains 'system' (and,
    as in the source, sessions without a login)."""
    return df.filter(~F.lower(F.col(login_col)).contains("system"))


def started_requests(df: DataFrame) -> DataFrame:
    """Requests that have a start time and a command."""
    return df.filter(F.col("start_time").isNotNull() & F.col("command").isNotNull())


def user_process(df: DataFrame, flag_col: str = "is_user_process") -> DataFrame:
    """P5: sessions of user processes."""
    return df.filter(F.col(flag_col) == F.lit(True))


def in_scope(df: DataFrame, col: str, include: Iterable[str] = (),
             exclude: Iterable[str] = ()) -> DataFrame:
    """(include empty or value in include) and value not in exclude."""
    include, exclude = list(include), list(exclude)
    cond = F.lit(True)
    if include:
        cond = cond & F.col(col).isin(include)
    if exclude:
        cond = cond & ~F.col(col).isin(exclude)
    return df.filter(cond)


def not_master(df: DataFrame, name_col: str = "name") -> DataFrame:
    """Every database but 'master'."""
    return df.filter(F.col(name_col) != "master")


def online(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Pools whose status is exactly 'Online'."""
    return df.filter(F.col(status_col) == "Online")


def day_list(run_date: _dt.date, days: int = 59) -> list[_dt.date]:
    """The ``days`` calendar days before ``run_date``, yesterday first
    (the run-history days a profile run requests)."""
    return [run_date - _dt.timedelta(days=i) for i in range(1, days + 1)]


def day_partitions(df: DataFrame, ts_col: str, tz, run_date, days: int = 59,
                   out_col: str = "last_upd") -> DataFrame:
    """P10: rows last updated on one of the ``days`` local days before
    ``run_date`` (yesterday back, today excluded) in time zone ``tz``; the
    local day becomes the partition column ``out_col``.

    ``run_date`` is a date or a date Column (e.g. derived from the data), ``tz`` a
    zone name or a Column of names.
    """
    day = local_date(ts_col, tz)
    run = F.lit(run_date) if not hasattr(run_date, "alias") else run_date
    first = F.date_sub(run, days)
    return (df.withColumn(out_col, day)
            .filter((F.col(out_col) >= first) & (F.col(out_col) < run)))


def local_windows(zones: DataFrame, run_utc: _dt.datetime, days: int = 59, key: str = "workspace_name",
                  zone: str = "time_zone") -> DataFrame:
    """P10 for many workspaces: per workspace the ``days`` local days before the
    day that ``run_utc`` (UTC wall clock) falls on in its time zone, as
    ``first_day`` (included) and ``run_day`` (excluded).  Workspaces of different
    zones may be on different days.  A null zone counts as UTC; of a workspace
    listed twice one zone (the smaller) counts."""
    run_day = local_date(F.lit(run_utc.isoformat(sep=" ")), F.col("_zone"))
    return (zones.groupBy(key).agg(F.coalesce(F.min(zone), F.lit("UTC")).alias("_zone"))
            .select(key, F.col("_zone").alias(zone), F.date_sub(run_day, days).alias("first_day"), run_day.alias("run_day")))


def in_local_window(df: DataFrame, windows: DataFrame, day: str, key: str = "workspace_name") -> DataFrame:
    """Rows whose local day lies in their workspace's window; workspaces without a
    window have none.  The windows, one row per workspace, are joined."""
    bounds = windows.select(F.col(key).alias("_w_key"), "first_day", "run_day")
    inside = F.col(key).eqNullSafe(F.col("_w_key")) & (F.col(day) >= F.col("first_day")) & (F.col(day) < F.col("run_day"))
    return df.join(bounds, inside, "left_semi")
