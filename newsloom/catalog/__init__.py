"""Registered queries over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from importlib import import_module

AREAS = ["text", "ids", "tables", "quality", "profiles", "learning", "jobs", "files", "models"]


def load() -> tuple[dict, dict]:
    """All queries and all SQL texts."""
    queries, sql = {}, {}
    for area in AREAS:
        book = import_module(f"newsloom.catalog.{area}").BOOK
        queries.update(book.queries)
        sql.update(book.sql)
    return queries, sql
