"""Small helpers for writing column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
