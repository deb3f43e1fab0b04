"""Named queries over the driver's tables, built from the operators, and
their DuckDB oracle SQL."""
