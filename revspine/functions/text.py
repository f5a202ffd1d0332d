"""Report text (X1-X5): the dashboard's number formats as column expressions.

Rounding is done with ``round`` (half away from zero, as the browser does) on
an integer scale before any text is built, so ``format_number``'s half-even
rule never decides a digit (trap T24).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder for a missing value, and the trend words.
MISSING = "—"
TREND_NONE, TREND_UP, TREND_DOWN = "none", "up", "down"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sign(x: Column) -> Column:
    return F.when(x < 0, F.lit("-")).otherwise(F.lit(""))


def fmt_currency(col) -> Column:
    """``$7,680`` - dollars, no decimals, thousands separators, sign in front."""
    x = _c(col)
    whole = F.round(F.abs(x)).cast("bigint")
    return F.when(x.isNotNull(), F.concat(_sign(x), F.lit("$"), F.format_number(whole, 0)))


def fmt_pct(col) -> Column:
    """``+7.4%`` - signed (``+`` only above zero), one decimal; NULL -> the dash."""
    x = _c(col)
    tenths = F.abs(F.round(x * 10)).cast("bigint")
    sign = F.when(x > 0, F.lit("+")).when(x < 0, F.lit("-")).otherwise(F.lit(""))
    body = F.concat(sign, (tenths / 10).cast("bigint").cast("string"), F.lit("."),
                    (tenths % 10).cast("string"), F.lit("%"))
    return F.when(x.isNull(), F.lit(MISSING)).otherwise(body)


def trend(col) -> Column:
    """``none`` for NULL, ``up`` for >= 0, else ``down``."""
    x = _c(col)
    return (F.when(x.isNull(), F.lit(TREND_NONE))
             .when(x >= 0, F.lit(TREND_UP))
             .otherwise(F.lit(TREND_DOWN)))


def fmt_delta(col, suffix: str = " from last month") -> Column:
    """``+3 from last month`` (``+`` when >= 0)."""
    d = _c(col)
    return F.when(d.isNotNull(), F.concat(F.when(d >= 0, F.lit("+")).otherwise(F.lit("")),
                                          d.cast("bigint").cast("string"), F.lit(suffix)))


def fmt_axis_k(col) -> Column:
    """``$7k`` - thousands, no decimals."""
    v = _c(col)
    return F.when(v.isNotNull(), F.concat(F.lit("$"), F.round(v / 1000).cast("bigint").cast("string"),
                                          F.lit("k")))
