"""Row-based window features over an ordered (per-series) window.

Every frame is ``ROWS BETWEEN`` over ``ORDER BY date``: a missing day shifts
a lag to an older date, and partial frames at the start count (no minimum
number of rows).

The builders return Spark SQL expression strings (``"<expr> AS name"``) so
a plan can hand a whole level to one ``selectExpr`` — one JVM call instead of
several per column — and Spark evaluates all window expressions of the level
in one Window operator behind one shuffle and sort."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

# Fixed values (must equal the reference): frame sizes, lag depths and the
# derived columns whose lags are features.
N_LAGS = 3
MA_SIZES = (7, 14, 28)
STD_SIZES = (7, 14)
RANGE_SIZES = (14, 28)
LONG_LAGS = (7, 14, 28)
DELTA_LAGS = (1, 7)
TREND_SIZES = (7, 14)
DERIVED_TX = [
    "tx_log_std7", "tx_log_std14",
    "tx_log_z7", "tx_log_z14",
    "delta1", "delta7",
    "trend7", "trend14",
    "tx_log_rng14", "tx_log_rng28",
]
PRICE_DERIVED = ["price_log", "price_ret_1d", "price_ret_7d", "price_volatility_7d"]


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Win:
    """An ordered window, optionally per series (a SQL window specification)."""

    def __init__(self, series: Sequence[str] = (), order: str = "date"):
        part = f"PARTITION BY {', '.join(q(s) for s in series)} " if series else ""
        self.spec = f"{part}ORDER BY {q(order)}"
        self.part = part.strip()

    def over(self) -> str:
        return f"OVER ({self.spec})"

    def frame(self, size: int) -> str:
        """The last ``size`` rows up to and including the current one."""
        return f"OVER ({self.spec} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"

    def running(self) -> str:
        return f"OVER ({self.spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def ordered_window(series: Sequence[str] = (), order: str = "date") -> Win:
    return Win(series, order)


def _lag(c: str, k: int, w: Win) -> str:
    return f"lag({q(c)}, {k}) {w.over()}"


# --- W1 / W2 / W3 / W4 ------------------------------------------------------

def lead_label(value: str, w: Win, name: str = "label") -> str:
    """Next row's value."""
    return f"lead({q(value)}, 1) {w.over()} AS {q(name)}"


def lags(cols: Iterable[str], w: Win, depths: Iterable[int] = range(1, N_LAGS + 1),
         fmt: str = "{c}_lag{k}") -> list[str]:
    """``lag(c, k)`` for every column and depth."""
    depths = list(depths)
    return [f"{_lag(c, k, w)} AS {q(fmt.format(c=c, k=k))}" for c in cols for k in depths]


def long_lags(x: str, w: Win, depths: Iterable[int] = LONG_LAGS) -> list[str]:
    return [f"{_lag(x, k, w)} AS {q(f'{x}_lag{k}')}" for k in depths]


# --- W5 / W6 / W8 -----------------------------------------------------------

def rolling_mean(x: str, w: Win, sizes: Iterable[int] = MA_SIZES) -> list[str]:
    return [f"avg({q(x)}) {w.frame(n)} AS {q(f'{x}_ma{n}')}" for n in sizes]


def rolling_std(x: str, w: Win, sizes: Iterable[int] = STD_SIZES) -> list[str]:
    """Sample standard deviation; a one-row frame (NULL) becomes 0.0."""
    return [f"coalesce(stddev_samp({q(x)}) {w.frame(n)}, 0.0D) AS {q(f'{x}_std{n}')}" for n in sizes]


def rolling_min_max(x: str, w: Win, sizes: Iterable[int] = RANGE_SIZES) -> list[str]:
    out = []
    for n in sizes:
        out.append(f"min({q(x)}) {w.frame(n)} AS {q(f'{x}_min{n}')}")
        out.append(f"max({q(x)}) {w.frame(n)} AS {q(f'{x}_max{n}')}")
    return out


def rolling_range(x: str, sizes: Iterable[int] = RANGE_SIZES) -> list[str]:
    """``max − min`` from the columns made by :func:`rolling_min_max`."""
    return [f"{q(f'{x}_max{n}')} - {q(f'{x}_min{n}')} AS {q(f'{x}_rng{n}')}" for n in sizes]


# --- W7 / W9 / W10 / W11 ----------------------------------------------------

def rolling_zscore(x: str, sizes: Iterable[int] = STD_SIZES) -> list[str]:
    """``(x − ma)/std`` when std > 0, else 0.0 (never divides by zero)."""
    out = []
    for n in sizes:
        s, m = q(f"{x}_std{n}"), q(f"{x}_ma{n}")
        out.append(f"CASE WHEN {s} > 0.0D THEN ({q(x)} - {m}) / {s} ELSE 0.0D END AS {q(f'{x}_z{n}')}")
    return out


def trend(x: str, w: Win, sizes: Iterable[int] = TREND_SIZES) -> list[str]:
    """``ma_k − lag(ma_k, k)``: a lag over a window result."""
    return [f"{q(f'{x}_ma{n}')} - {_lag(f'{x}_ma{n}', n, w)} AS {q(f'trend{n}')}" for n in sizes]


def regime_flag(x: str, fast: int = 7, slow: int = 28) -> str:
    return f"CASE WHEN {q(f'{x}_ma{fast}')} > {q(f'{x}_ma{slow}')} THEN 1.0D ELSE 0.0D END AS `regime_up`"


def deltas(x: str, w: Win, depths: Iterable[int] = DELTA_LAGS) -> list[str]:
    return [f"{q(x)} - {_lag(x, k, w)} AS {q(f'delta{k}')}" for k in depths]


# --- W12 / W13 --------------------------------------------------------------

def price_returns(w: Win, price_log: str = "price_log") -> list[str]:
    return [f"{q(price_log)} - {_lag(price_log, 1, w)} AS `price_ret_1d`",
            f"{q(price_log)} - {_lag(price_log, 7, w)} AS `price_ret_7d`"]


def price_volatility(w: Win, price_log: str = "price_log", size: int = 7) -> str:
    return f"coalesce(stddev_samp({q(price_log)}) {w.frame(size)}, 0.0D) AS `price_volatility_7d`"
