"""Versioned company-registry data on PySpark: ingest, clean, merge, serve, search."""
