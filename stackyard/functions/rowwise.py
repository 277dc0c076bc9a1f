"""Row-wise reducers across columns (A21, A22, O5), built from
``least``/``greatest`` and array expressions; nulls are skipped like the
source's NaN-skipping reducers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _present(cols):
    return F.filter(F.array(*[F.col(c).cast("double") for c in cols]), lambda x: x.isNotNull())


def row_sum(cols: list[str]) -> Column:
    return F.aggregate(_present(cols), F.lit(0.0), lambda a, x: a + x)


def row_count(cols: list[str]) -> Column:
    return F.size(_present(cols))


def row_mean(cols: list[str]) -> Column:
    return F.try_divide(row_sum(cols), row_count(cols).cast("double"))


def row_min(cols: list[str]) -> Column:
    return F.least(*[F.col(c) for c in cols])


def row_max(cols: list[str]) -> Column:
    return F.greatest(*[F.col(c) for c in cols])


def row_range(cols: list[str]) -> Column:
    return row_max(cols) - row_min(cols)


def row_nulls(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])


def row_sorted(cols: list[str]) -> Column:
    """The row's values sorted ascending (nulls dropped)."""
    return F.array_sort(_present(cols))


def mean_of_smallest(cols: list[str], k: int) -> Column:
    """Mean of the ``k`` smallest values of the row."""
    s = F.slice(row_sorted(cols), 1, k)
    return F.aggregate(s, F.lit(0.0), lambda a, x: a + x) / F.size(s)


def mean_of_largest(cols: list[str], k: int) -> Column:
    """Mean of the ``k`` largest values of the row."""
    s = F.slice(F.reverse(row_sorted(cols)), 1, k)
    return F.aggregate(s, F.lit(0.0), lambda a, x: a + x) / F.size(s)


def middle(cols: list[str]) -> Column:
    """Middle value of the row (median of an odd count)."""
    s = row_sorted(cols)
    return F.element_at(s, F.floor((F.size(s) + 1) / 2).cast("int"))
