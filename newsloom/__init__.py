"""News analytics on Spark DataFrames: ingest, clean, validate, load, learn."""

__version__ = "0.1.0"
