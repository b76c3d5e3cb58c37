"""Text expressions: symbols and file-safe names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_symbol(col: Column) -> Column:
    return F.upper(F.trim(col))


def safe_name(col: Column) -> Column:
    """Blanks and characters that file systems refuse become underscores."""
    return F.regexp_replace(col, r'[\x00-\x1f<>:"/\\|?* ]', "_")
