"""Array helpers for work inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Use a computed value several times: as a lambda's argument it is computed
    once per row, also where it is used for every element of another array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
