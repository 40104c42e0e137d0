"""Give a value a name inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``.

    Optimizer rules which inline a column copy its expression once per use; a bound value keeps the plan
    small however often ``body`` refers to it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
