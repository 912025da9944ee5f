"""Ingestion of loosely documented tabular files as Spark DataFrame operators."""

from quillgrid.session import session

__all__ = ["session"]
