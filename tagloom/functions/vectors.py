"""Column functions over ``ARRAY`` vectors and probability arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.binding import bind

NORM_FLOOR = 1e-12


def _total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def _each_with(c: Column, scalar: Callable[[Column], Column], combine: Callable[[Column, Column], Column]) -> Column:
    """Combine every element with one scalar drawn from the array, both computed once per row."""
    return bind(c, lambda xs: bind(scalar(xs), lambda s: F.transform(xs, lambda x: combine(x, s))))


def is_valid_vector(c: Column, dim: int) -> Column:
    """Non-null, exactly ``dim`` wide, every element a finite number."""

    def unfit(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.coalesce((F.size(c) == dim) & ~F.exists(c, unfit), F.lit(False))


def dot(a: Column, b: Column) -> Column:
    """Inner product; equals the cosine for unit vectors, which it does not re-normalise."""
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_distance(a: Column, b: Column) -> Column:
    def squared(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_total(F.zip_with(a, b, squared)))


def l2_normalize(c: Column) -> Column:
    """Divide by the Euclidean norm, floored at 1e-12 so that a zero vector stays zero."""

    def norm(xs: Column) -> Column:
        squares = F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x * x)
        return F.greatest(F.sqrt(squares), F.lit(NORM_FLOOR))

    return _each_with(F.transform(c, lambda x: x.cast("double")), norm, lambda x, n: x / n)


def max_prob(c: Column) -> Column:
    """Largest probability; null for a missing or empty array and for any missing or NaN element."""

    def largest(xs: Column) -> Column:
        broken = F.exists(xs, lambda x: x.isNull() | F.isnan(x))
        return F.when((F.size(xs) > 0) & ~broken, F.array_max(xs)).cast("double")

    return bind(c, largest)


def softmax(logits: Column) -> Column:
    raised = _each_with(logits, F.array_max, lambda x, peak: F.exp(x - peak))
    return _each_with(raised, _total, lambda x, total: x / total)


def argmax(c: Column) -> Column:
    """Zero-based position of the largest element, the first one on ties."""
    return bind(c, lambda xs: F.array_position(xs, F.array_max(xs)) - 1).cast("bigint")


def class_name(index: Column, classes: list[str], fallback_to_index: bool = False) -> Column:
    """Name of a class index; optionally the index itself as text where no name exists."""
    names = F.array(*[F.lit(name) for name in classes])
    name = F.get(names, index.cast("int"))
    return F.coalesce(name, index.cast("string")) if fallback_to_index else name
