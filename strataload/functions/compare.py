"""Row comparison predicates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataload.functions.text import fold_null


def any_distinct(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True if any pair differs; two NULLs are equal, NULL and a value differ."""
    return reduce(or_, [~left.eqNullSafe(right) for left, right in pairs])


def any_changed_folded(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """Like ``any_distinct``, but a stored NULL counts as the unknown text."""
    return reduce(or_, [fold_null(stored) != incoming for stored, incoming in pairs], F.lit(False))
