"""PySpark library for watching streams of market ticks."""
