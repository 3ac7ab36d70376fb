"""A PySpark engine for time-series market bars."""
