"""Column-level building blocks (all JVM-side expressions)."""

from daycast.functions.casting import (decimal_to_double, nan_to_null,
                                       safe_cast_double)
from daycast.functions.calendar import (add_calendar, calendar_exprs,
                                        calendar_features, cyclical,
                                        drop_helpers, month_edge_exprs,
                                        month_edges, time_index_expr)
from daycast.functions.transforms import label_diff, reconstruct

__all__ = [
    "safe_cast_double", "decimal_to_double", "nan_to_null",
    "cyclical", "calendar_features", "calendar_exprs", "month_edges", "month_edge_exprs",
    "time_index_expr", "add_calendar", "drop_helpers",
    "reconstruct", "label_diff",
]
