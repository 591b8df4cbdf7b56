"""Calendar features: cyclical encodings, month edges, trend index.

``*_exprs`` functions return Spark SQL expression strings (for
``selectExpr``); the others return Columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi

# Fixed values (must equal the reference): zero-based calendar helpers and
# their cycle lengths.  dow: Sunday=0, period 7; doy: period 365;
# month: period 12; woy: ISO week minus one, period 53.
CALENDAR_PERIODS = {"dow": 7, "doy": 365, "month": 12, "woy": 53}
CALENDAR_HELPERS = ["dow", "doy", "month", "woy"]
CALENDAR_FEATURES = [f"{h}_{f}" for h in CALENDAR_HELPERS for f in ("sin", "cos")]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def helper_exprs(date: str = "date") -> dict[str, str]:
    """Zero-based day-of-week, day-of-year, month and ISO-week, as doubles."""
    d = _q(date)
    return {
        "dow": f"CAST(dayofweek({d}) - 1 AS DOUBLE)",
        "doy": f"CAST(dayofyear({d}) - 1 AS DOUBLE)",
        "month": f"CAST(month({d}) - 1 AS DOUBLE)",
        "woy": f"CAST(weekofyear({d}) - 1 AS DOUBLE)",
    }


def cyclical_exprs(value: str, period: float, prefix: str) -> list[str]:
    """``sin/cos(2π·v/period)`` of a double-valued SQL expression."""
    arg = f"{TWO_PI!r}D * {value} / {float(period)!r}D"
    return [f"sin({arg}) AS {_q(prefix + '_sin')}", f"cos({arg}) AS {_q(prefix + '_cos')}"]


def calendar_exprs(date: str = "date") -> list[str]:
    """The eight cyclical columns, computed straight from the date."""
    h = helper_exprs(date)
    out: list[str] = []
    for name in CALENDAR_HELPERS:
        out += cyclical_exprs(h[name], CALENDAR_PERIODS[name], name)
    return out


def month_edge_exprs(date: str = "date") -> list[str]:
    """``is_month_start`` / ``is_month_end`` as 1.0/0.0 doubles."""
    d = _q(date)
    return [f"CASE WHEN dayofmonth({d}) = 1 THEN 1.0D ELSE 0.0D END AS `is_month_start`",
            f"CASE WHEN {d} = last_day({d}) THEN 1.0D ELSE 0.0D END AS `is_month_end`"]


def time_index_expr(date: str, first_date: str) -> str:
    """Days since the first date (a SQL expression), as a double."""
    return f"CAST(datediff({_q(date)}, {first_date}) AS DOUBLE) AS `t`"


# --- Column API ----------------------------------------------------------------

def cyclical(base: str, period: float, prefix: str) -> list[Column]:
    return [F.expr(e) for e in cyclical_exprs(f"CAST({_q(base)} AS DOUBLE)", period, prefix)]


def calendar_features(date: str = "date") -> list[Column]:
    return [F.expr(e) for e in calendar_exprs(date)]


def month_edges(date: str = "date") -> list[Column]:
    return [F.expr(e) for e in month_edge_exprs(date)]


def add_calendar(df: DataFrame, date: str = "date", keep_helpers: bool = True) -> DataFrame:
    """Add the raw helpers (optional) and the cyclical columns in one select."""
    h = helper_exprs(date)
    extra = [f"{h[n]} AS {_q(n)}" for n in CALENDAR_HELPERS] if keep_helpers else []
    return df.selectExpr("*", *extra, *calendar_exprs(date))


def drop_helpers(df: DataFrame) -> DataFrame:
    """Remove the raw calendar helpers when present."""
    return df.drop(*[c for c in CALENDAR_HELPERS if c in df.columns])
