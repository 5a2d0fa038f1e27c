"""Screening of large document collections as Spark table work."""
