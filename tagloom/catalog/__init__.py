"""Ready-made queries over the standard tables, each with its SQL twin where SQL can say the same."""

from tagloom.catalog import jobs, labels, metrics, sampling, texts, training, vectors  # noqa: F401
from tagloom.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
