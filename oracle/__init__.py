"""DuckDB statements that state each query's expected result independently of the Spark code."""
