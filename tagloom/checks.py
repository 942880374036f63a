"""Argument and column checks shared by every job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every column it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns {missing} in {what}. Available columns: {df.columns}")
    return df


def require_names(**names: str) -> None:
    """Every keyword must hold a non-empty name."""
    for key, value in names.items():
        if not value:
            raise ValueError(f"{key} must be provided")


def require_positive(**values: int | None) -> None:
    for key, value in values.items():
        if value is not None and value <= 0:
            raise ValueError(f"{key} must be positive")


def require_non_negative(**values: float) -> None:
    for key, value in values.items():
        if value < 0:
            raise ValueError(f"{key} must be non-negative")


def require_choice(value: str, choices: Iterable[str], name: str) -> None:
    choices = sorted(choices)
    if value not in choices:
        raise ValueError(f"Invalid {name} '{value}'. Must be one of {choices}")


def require_classes(classes: list[str], width: int | None = None) -> list[str]:
    """A class list has no blank names and as many names as the model has outputs."""
    if not classes:
        raise ValueError("no class names were given")
    if any(not isinstance(c, str) or not c.strip() for c in classes):
        raise ValueError("every class needs a name that is not blank")
    if width is not None and len(classes) != width:
        raise ValueError(f"{len(classes)} classes given for a model with {width} outputs")
    return classes


def require_in_range(df: DataFrame, columns: Iterable[str], num_classes: int) -> DataFrame:
    """Raise when any class id in ``columns`` lies outside ``0..num_classes-1``."""
    for name in columns:
        c: Column = F.col(name)
        outside = c.isNull() | (c < 0) | (c >= num_classes)
        if not df.filter(outside).select(name).isEmpty():
            raise ValueError(f"Some values of '{name}' are out of range 0..{num_classes - 1}")
    return df
