"""DuckDB oracle SQL for the correctness gate (independent of the Spark code:
plain SQL text over the driver's pre-registered views)."""
