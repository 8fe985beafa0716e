"""flightlake: flight-delay analytics on tables and streams, written for PySpark."""
