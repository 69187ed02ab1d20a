"""Values that are computed once, however often an expression uses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    The optimizer puts the expression of a column in place of its name, also inside of a lambda, where it
    would be computed for every element. A lambda's own variable is computed before.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
