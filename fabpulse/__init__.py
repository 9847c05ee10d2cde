"""Machine-telemetry lake on PySpark: landing, typing, star schema, reports."""
