"""Snapshot lakehouse analytics on Spark: bronze -> silver -> gold, insights,
data tests, retention and incremental refresh, all as DataFrame jobs."""

__version__ = "0.1.0"
