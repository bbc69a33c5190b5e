"""Time helpers: whole elapsed units (F12), run stamp (F9), local day (P10)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_UNIT_MICROS = {"MICROSECOND": 1, "MILLISECOND": 1_000, "SECOND": 1_000_000,
                "MINUTE": 60_000_000, "HOUR": 3_600_000_000, "DAY": 86_400_000_000,
                "WEEK": 604_800_000_000}


def _wall_micros_sql(c: str) -> str:
    """Microseconds since 1970-01-01 00:00 of a wall-clock timestamp, from its
    date and time fields only - no time zone is involved."""
    c = f"`{c}`"
    return (f"(CAST(datediff(to_date({c}), DATE'1970-01-01') AS BIGINT) * 86400000000"
            f" + CAST(hour({c}) AS BIGINT) * 3600000000 + CAST(minute({c}) AS BIGINT) * 60000000"
            f" + CAST(date_part('SECOND', {c}) * 1000000 AS BIGINT))")


def whole_units(unit: str, start: Column | str, end: Column | str) -> Column:
    """number of whole ``unit`` elapsed from start to end (truncated
    toward zero), not the number of unit boundaries crossed.

    For timestamps without time zone given by column name, the difference is
    taken on the wall clock from date and time fields with integer division,
    so it never depends on the session time zone (no DST gap can shift it).
    Columns are passed to Spark's ``timestamp_diff``."""
    unit = unit.upper()
    if isinstance(start, str) and isinstance(end, str) and unit in _UNIT_MICROS:
        return F.expr(f"({_wall_micros_sql(end)} - {_wall_micros_sql(start)}) div {_UNIT_MICROS[unit]}")
    return F.timestamp_diff(unit, _col(start), _col(end))


def run_stamp(ts: _dt.datetime | None = None) -> Column:
    """one constant extract timestamp per run (reproducible when given)."""
    ts = ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    # Through text: a Python datetime literal would pass the client's zone.
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def day_start(ts: Column | str) -> Column:
    """Midnight of the timestamp's day, as timestamp without time zone (via
    the calendar date, so no session time zone is involved)."""
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def local_date(ts_utc: Column | str, tz: str | Column) -> Column:
    """Calendar day of a UTC wall-clock timestamp in time zone ``tz`` (a name, or a
    column of names)."""
    zone = F.lit(tz) if isinstance(tz, str) else tz
    local = F.convert_timezone(F.lit("UTC"), zone, _col(ts_utc).cast("timestamp_ntz"))
    return F.to_date(local)


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def wall_from_instant(ts: Column | str) -> Column:
    """UTC wall clock (timestamp without time zone) of an instant
    (``TIMESTAMP``), computed from its epoch microseconds - exact and
    independent of the session time zone, even in a DST overlap."""
    micros = F.unix_micros(_col(ts))
    secs = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(secs=secs)


def instant_from_wall(ts: Column | str) -> Column:
    """The instant whose UTC wall clock is the given timestamp without time
    zone (inverse of :func:`wall_from_instant`), also zone-free."""
    wall = _col(ts)
    micros = ((F.datediff(F.to_date(wall), F.lit("1970-01-01").cast("date")).cast("long")
               * 86_400_000_000)
              + F.hour(wall).cast("long") * 3_600_000_000
              + F.minute(wall).cast("long") * 60_000_000
              + (F.date_part(F.lit("SECOND"), wall) * 1_000_000).cast("long"))
    return F.timestamp_micros(micros)


def utc_wall_clock(df):
    """Every top-level ``TIMESTAMP`` (instant) column as its UTC wall clock
    (``TIMESTAMP_NTZ``); other columns unchanged.  API objects carry zoned
    times; staged data keeps zone-free ones."""
    from pyspark.sql import types as T
    inst = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: wall_from_instant(F.col(f"`{c}`")) for c in inst}) if inst else df
