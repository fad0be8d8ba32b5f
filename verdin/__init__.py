"""Spark-native analytics operators for contact-centre, student-lifecycle and social data."""

from verdin.session import prepare, read_table

__all__ = ["prepare", "read_table"]
