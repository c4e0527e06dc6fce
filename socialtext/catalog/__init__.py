"""The named queries, one module per field."""

from socialtext.catalog import models, selecting, texts  # noqa: F401
from socialtext.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
