"""Storing a relation once, in the cluster's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialized(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored with a reliable checkpoint in the
    session's checkpoint folder (which :func:`estate.session.shared_dir`
    guarantees is set)."""
    from estate.session import shared_dir
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
