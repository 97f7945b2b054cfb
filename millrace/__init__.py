"""millrace: analytics and data-engineering operators for PySpark."""
