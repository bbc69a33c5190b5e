"""Warehouse-estate assessment on Spark.

Reads catalog objects, sessions, requests, query statistics, storage figures,
paged API listings and nested metric series as DataFrames, applies the
assessment transforms (pseudonymisation, SQL comment stripping, statement
classification, redaction), stages typed tables incrementally and answers the
assessment questions over the staged data.  Every operator is a DataFrame
transformation planned by Catalyst; there are no row-wise Python functions.
"""

from estate.session import get_session, shared_dir  # noqa: F401

__all__ = ["get_session", "shared_dir"]
