"""millrace: a PySpark-native engine for preparing and analysing versioned relational snapshots."""

__version__ = "0.1.0"
