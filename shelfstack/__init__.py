"""Layered retail analytics on PySpark: Bronze files, Silver tables, Gold aggregates."""

from shelfstack.settings import Settings

__all__ = ["Settings"]
