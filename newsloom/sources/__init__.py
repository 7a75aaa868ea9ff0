"""Readers: files, payloads, text trees, snapshots and database tables as DataFrames."""
