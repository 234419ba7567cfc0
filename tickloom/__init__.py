"""Market-data tables, validation, indicators and monitoring on PySpark."""
