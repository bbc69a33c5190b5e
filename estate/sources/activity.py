"""Activity extracts: sessions, requests, query statistics, request history
and data processed (S9-S11, S18-S22, J2, F11).

Each function takes the raw relation - a JDBC scan of the source view (see
:mod:`estate.sources.jdbc`) or any DataFrame of the same columns - and
returns the staged form.  Predicates are DataFrame filters, so against JDBC
Catalyst sends them to the source; against Parquet they prune row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from estate.functions.identity import hash_client, pseudonymise_logins
from estate.functions.sqltext import classify, redact, statement_slice
from estate.functions.timefns import run_stamp
from estate.operators import filters, incremental


def stamp(df: DataFrame, run_ts=None) -> DataFrame:
    """one extract timestamp per run, unless the rows already carry one."""
    return df if "extract_ts" in df.columns else df.withColumn("extract_ts", run_stamp(run_ts))


def _newer(df, col, marks, keys):
    return df if marks is None else incremental.newer_than(df, col, marks, keys)


def dedicated_sessions(raw: DataFrame, marks: DataFrame | None = None,
                       keys=("pool_name",), run_ts=None, keep_clear: bool = True) -> DataFrame:
    """S9 = P3 + P6(login_time) + F9 + F5-F8."""
    df = _newer(filters.user_sessions(raw), "login_time", marks, keys)
    df = stamp(df, run_ts)
    return hash_client(pseudonymise_logins(df, keep_clear=keep_clear))


def dedicated_requests(raw: DataFrame, redact_text: bool = False,
                       marks: DataFrame | None = None, keys=("pool_name",),
                       run_ts=None, transactions_first: bool = False) -> DataFrame:
    """S10 = P4 + P6(end_time) + F9 + F1-F4 + F10.  Redaction comes after
    classification, so the words and the type survive it."""
    df = _newer(filters.started_requests(raw), "end_time", marks, keys)
    df = classify(stamp(df, run_ts), "command", transactions_first=transactions_first)
    return redact(df, "command") if redact_text else df


def dedicated_query_stats(raw: DataFrame, run_ts=None) -> DataFrame:
    """Node query statistics with the extract stamp."""
    return stamp(raw, run_ts)


def serverless_sessions(raw: DataFrame, marks: DataFrame | None = None,
                        keys=("pool_name",), keep_clear: bool = True) -> DataFrame:
    """S18 = P5 + P6(last_request_start_time) + F5-F7 (no client hash, no stamp)."""
    df = _newer(filters.user_process(raw), "last_request_start_time", marks, keys)
    return pseudonymise_logins(df, keep_clear=keep_clear)


def serverless_requests(raw: DataFrame, marks: DataFrame | None = None,
                        keys=("pool_name",)) -> DataFrame:
    """S19 = P6(start_time) only."""
    return _newer(raw, "start_time", marks, keys)


def query_statements(stats: DataFrame, texts: DataFrame, marks: DataFrame | None = None,
                     keys=("pool_name",), handle: str = "sql_handle") -> DataFrame:
    """S20 = P6(last_execution_time) + J2 + F11.

    Inner join of statistics to batch texts by handle (statistics without a
    text row are dropped, as with CROSS APPLY), then the statement is cut out
    of the text by its offsets.  Both sides are large, so this is a shuffle
    join on the handle; AQE splits a skewed handle.
    """
    st = _newer(stats, "last_execution_time", marks, keys)
    joined = st.join(texts.select(handle, "text"), handle, "inner")
    return (joined
            .withColumn("statement_text",
                        statement_slice("text", "statement_start_offset", "statement_end_offset"))
            .drop("text"))


def requests_history(raw: DataFrame, marks: DataFrame | None = None,
                     keys=("pool_name",)) -> DataFrame:
    """S21 = P6(end_time)."""
    return _newer(raw, "end_time", marks, keys)


def data_processed(raw: DataFrame) -> DataFrame:
    """Full scan."""
    return raw
