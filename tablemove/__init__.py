"""Moving, synchronising and reconciling tables between catalogs with Spark."""

__version__ = "0.1.0"
