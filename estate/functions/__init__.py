"""Scalar functions (native Catalyst expressions, no Python per row)."""

from estate.functions.identity import hash_client, pseudonymise_logins  # noqa: F401
from estate.functions.sqltext import (  # noqa: F401
    classify, redact, statement_slice, statement_type, strip_comments)
from estate.functions.timefns import whole_units  # noqa: F401
