"""Table-in, table-out analytics operators for PySpark."""
