"""Vintage and account-by-month panel analytics as PySpark DataFrame operators."""

from .session import get_spark

__all__ = ["get_spark"]
