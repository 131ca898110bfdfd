"""The registered queries over derived tables and the SQL that gives the same rows in DuckDB."""
