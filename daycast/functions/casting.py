"""Type cleaning: SAFE_CAST semantics, DECIMAL → DOUBLE, NaN → NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType


def safe_cast_double(c: str | Column) -> Column:
    """``SAFE_CAST(x AS FLOAT64)``: anything unparseable becomes NULL.

    ANSI mode is on by default in Spark 4, where a plain ``cast`` raises on
    bad strings, so this is ``try_cast``."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def decimal_to_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to DOUBLE in a single projection."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, DecimalType) for f in fields):
        return df
    return df.selectExpr(*[f"CAST({_q(f.name)} AS DOUBLE) AS {_q(f.name)}"
                           if isinstance(f.dataType, DecimalType) else _q(f.name) for f in fields])


def nan_expr(name: str) -> str:
    return f"CASE WHEN isnan({_q(name)}) THEN NULL ELSE {_q(name)} END"


def nan_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """NaN → NULL in the named floating columns (others are left as they are)."""
    fields = df.schema.fields
    wanted = set(cols) & {f.name for f in fields if isinstance(f.dataType, (DoubleType, FloatType))}
    if not wanted:
        return df
    return df.selectExpr(*[f"{nan_expr(f.name)} AS {_q(f.name)}" if f.name in wanted else _q(f.name)
                           for f in fields])
