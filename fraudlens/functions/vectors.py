"""Dense feature arrays (ARRAY<DOUBLE>) built from columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def padded(values: Sequence[Column], start: int, dim: int) -> Column:
    """Array of length ``dim`` holding ``values`` from position ``start`` (0-based), zero elsewhere."""
    if start + len(values) > dim:
        raise ValueError(f"{len(values)} values from slot {start} do not fit into {dim}")
    body = F.array(*[v.cast("double") for v in values])
    tail = dim - start - len(values)
    parts = ([zeros(start)] if start else []) + [body] + ([zeros(tail)] if tail else [])
    return F.concat(*parts)


def or_zeros(vec: Column, dim: int) -> Column:
    """The vector, or zeros for an unseen entity."""
    return F.coalesce(vec.cast("array<double>"), zeros(dim))


def first_dims(vec: Column, n: int) -> Column:
    return F.slice(vec, 1, n)


def squared_error(a: Column, b: Column) -> Column:
    """Sum over positions of (a-b)^2."""
    diff = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(diff, F.lit(0.0), lambda acc, x: acc + x)


def spread(vec: Column, dim: int, stem: str = "h") -> list[Column]:
    """One column per dimension, so that sums use ordinary hash aggregation."""
    return [F.get(vec, F.lit(i)).alias(f"{stem}{i}") for i in range(dim)]
