"""Numeric column expressions with the rounding and division rules the metrics need."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

_SPLIT = "134217729D"  # 2**27 + 1, Dekker's splitting constant


def py_round(x: str, digits: int) -> Column:
    """Round the SQL expression ``x`` to ``digits`` by its exact binary value, ties to even.

    Spark's ``round`` works on the shortest decimal text (0.145 -> 0.15), Python's on the
    binary value (0.145 -> 0.14). The scaled value is held as an exact product p + e
    (Dekker 1971); only when p lands on a tie does the sign of e decide. One SQL text, so that
    the expression is built in one step.
    """
    scale = f"{10 ** digits}D"
    x = f"CAST({x} AS DOUBLE)"
    high = f"({x} * {_SPLIT} - ({x} * {_SPLIT} - {x}))"
    p = f"({x} * {scale})"
    e = f"(({high} * {scale} - {p}) + ({x} - {high}) * {scale})"
    tie = f"({p} - floor({p}) = 0.5D)"
    return F.expr(
        f"(CASE WHEN {tie} AND {e} > 0 THEN floor({p}) + 1D "
        f"WHEN {tie} AND {e} < 0 THEN CAST(floor({p}) AS DOUBLE) ELSE rint({p}) END) / {scale}")


def round_columns(df: DataFrame, names: Iterable[str], digits: int = 4) -> DataFrame:
    return df.withColumns({name: py_round(name, digits) for name in names})


def fixed_text(x: str, digits: int) -> Column:
    """Like Python's ``f'{x:.2f}'``."""
    return F.format_string(f"%.{digits}f", py_round(x, digits))


def shortest_text(value: Column) -> Column:
    """Like Python's ``str`` for a number already rounded to 4 places (0.12, 1.0, 0.0001)."""
    return F.regexp_replace(F.format_string("%.4f", value), r"(\.\d+?)0+$", "$1")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0.0 where the denominator is zero or null."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def rating_bin(value: Column, low: int = 1, high: int = 5) -> Column:
    """Nearest integer (half to even) clipped to the rating range."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.rint(value).cast("int")))
