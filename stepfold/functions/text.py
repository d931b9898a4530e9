"""Column expressions for text fields of logs and dumps.

Every helper returns a ``Column`` built from built-in functions only, so it
stays inside whole-stage codegen and needs no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
# ANSI escape sequence (CSI and two-character escapes).
ANSI_ESCAPE = r"\x1B[@-_][0-?]*[ -/]*[@-~]"
# Number that may carry thousands separators, e.g. "1,234.5".
COMMA_NUMBER = r"[0-9,]+(?:\.[0-9]+)?"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ansi(c) -> Column:
    return F.regexp_replace(col_(c), ANSI_ESCAPE, "")


def comma_number(c) -> Column:
    """'1,234.5' -> 1234.5; NULL when the text is not a number."""
    return _to_double(F.regexp_replace(col_(c), ",", ""))


def _to_double(c: Column) -> Column:
    return F.when(c == "", F.lit(None).cast("double")).otherwise(c.try_cast("double"))


def to_double(c) -> Column:
    return _to_double(col_(c))


def to_long(c) -> Column:
    c = col_(c)
    return F.when(c == "", F.lit(None).cast("long")).otherwise(c.try_cast("long"))


def to_int(c) -> Column:
    c = col_(c)
    return F.when(c == "", F.lit(None).cast("int")).otherwise(c.try_cast("int"))


def extract(c, pattern: str, group: int = 1) -> Column:
    """regexp_extract that yields NULL instead of '' when nothing matches."""
    v = F.regexp_extract(col_(c), pattern, group)
    return F.when(v == "", F.lit(None).cast("string")).otherwise(v)


def log_time(c) -> Column:
    """'20240101 00:00:07' -> TIMESTAMP_NTZ (1 s resolution of the logger)."""
    return F.to_timestamp_ntz(col_(c), F.lit("yyyyMMdd HH:mm:ss"))
