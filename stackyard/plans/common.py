"""Shared helpers for registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 6


def r6(c, name: str | None = None) -> Column:
    """Round a double to 6 digits for comparison with the SQL oracle."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), DIGITS)
    return out.alias(name) if name else (out.alias(c) if isinstance(c, str) else out)
