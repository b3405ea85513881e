"""DuckDB oracle for the registered queries (independent SQL over the driver tables)."""
