"""Output normalisation of registered queries.

Doubles are rounded on a grid that depends on their magnitude (8 decimals
below 1e4, 5 below 1e7, 2 below 1e10, tens above: about 12 significant
digits, far above double noise). Before rounding, 3.3e-3 of a grid step is
added: sums in another order differ in the last bits, and a mean of short
decimals can end exactly on a rounding tie (Spark rounds ties up on the
decimal text, DuckDB on the binary value). The offset moves every exact tie
clearly to one side, is tens of ulps wide and far below the grid, so Spark
and the DuckDB oracle agree bit for bit. ``normalize_sql`` applies the same
rule to every ``round(x, 8)`` of the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# (upper bound of |x|, decimals kept)
BANDS = ((1e4, 8), (1e7, 5), (1e10, 2), (None, -1))


def _offset(d: int) -> float:
    return 3.3 * 10.0 ** (-d - 3)


def sql_norm(expr: str) -> str:
    v = f"({expr})"
    parts = []
    for bound, d in BANDS:
        r = f"round({v} + {_offset(d)!r}, {d})"
        parts.append(f"WHEN abs({v}) < {bound!r} THEN {r}" if bound else f"ELSE {r}")
    return "(CASE " + " ".join(parts) + " END)"


def norm(c: Column) -> Column:
    expr = None
    for bound, d in reversed(BANDS):
        r = F.round(c + F.lit(_offset(d)), d)
        expr = r if expr is None else F.when(F.abs(c) < F.lit(bound), r).otherwise(expr)
    return expr


def normalize_sql(sql: str) -> str:
    """Rewrite ``round(expr, 8)`` into the banded rounding of ``norm``."""
    out, i, key = [], 0, "round("
    low = sql.lower()
    while True:
        j = low.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        d, cut = 0, -1
        for n, ch in enumerate(inner):  # last top-level comma
            d += {"(": 1, ")": -1}.get(ch, 0)
            if ch == "," and d == 0:
                cut = n
        expr, digits = (inner[:cut], inner[cut + 1:].strip()) if cut >= 0 else (inner, "")
        expr = normalize_sql(expr)
        if digits == "8":
            out.append(sql[i:j] + sql_norm(expr))
        else:
            out.append(sql[i:j] + "round(" + expr + (", " + digits if cut >= 0 else "") + ")")
        i = k


def rounded(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(norm(F.col(f.name).cast("double")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
