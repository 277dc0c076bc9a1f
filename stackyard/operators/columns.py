"""Projection, filters and set operations on rows and column sets
(P1-P13, P19, P21, U1-U4). Column-set logic runs on the schema only; row
work is plain Catalyst projection/filter, so pruning and pushdown reach the
Parquet scan."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackyard.operators.ordering import row_index


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop a list (names absent from the frame are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def keep_complement(df: DataFrame, exclude: list[str]) -> DataFrame:
    """Keep every column not in ``exclude``, in frame order."""
    ex = set(exclude)
    return df.select(*[c for c in df.columns if c not in ex])


def columns_matching(df: DataFrame, prefix: str = "", suffix: str = "",
                     regex: str | None = None) -> list[str]:
    """Names by prefix / suffix / regex."""
    pat = re.compile(regex) if regex else None
    return [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)
            and (pat is None or pat.search(c))]


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """``kind`` is ``'string'`` (object) or ``'numeric'``."""
    want = T.StringType if kind == "string" else T.NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, want)]


def train_rows(df: DataFrame, target: str = "target") -> DataFrame:
    """P5: train side = target present."""
    return df.where(F.col(target).isNotNull())


def test_rows(df: DataFrame, target: str = "target") -> DataFrame:
    return df.where(F.col(target).isNull())


def overwrite_where(col: str, cond: Column, value) -> Column:
    """Conditional overwrite."""
    return F.when(cond, F.lit(value) if not isinstance(value, Column) else value).otherwise(F.col(col))


def semi_filter(df: DataFrame, other: DataFrame, on: str, keep: bool = True) -> DataFrame:
    """Membership (semi join) or non-membership (anti join)."""
    return df.join(other.select(on).distinct(), on, "left_semi" if keep else "left_anti")


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P10."""
    return df.withColumnsRenamed(mapping)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """P11."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def replace_value(df: DataFrame, old, new, cols: list[str] | None = None) -> DataFrame:
    """Global value replacement (e.g. a missing code)."""
    return df.replace(old, new, subset=cols)


def common_columns(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep only columns present on both sides (order of ``a``)."""
    both = [c for c in a.columns if c in set(b.columns)]
    return a.select(*both), b.select(*both)


def column_difference(a: DataFrame, b: DataFrame) -> list[str]:
    """U4: columns of ``a`` not in ``b``."""
    return [c for c in a.columns if c not in set(b.columns)]


def slice_columns(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Positional column slice (``iloc[:, 1:-1]``)."""
    return df.select(*df.columns[start:stop])


def with_row_number(df: DataFrame, order_col: str = "id", name: str = "row",
                    tie_col: str = "id") -> DataFrame:
    """Explicit 0-based row number in ``order_col`` order, ties broken
    by ``tie_col`` (distributed, no single-task window)."""
    order = [order_col] if order_col == tie_col or tie_col not in df.columns else [order_col, tie_col]
    return row_index(df, order, name=name)


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side (target) are null."""
    return train.unionByName(test, allowMissingColumns=True)


def pseudo_label_union(train: DataFrame, test_pred: DataFrame, pred: str, threshold: float = 0.5,
                       target: str = "target", dtype: str = "tinyint") -> DataFrame:
    """Test rows labelled by an earlier prediction appended to train.
    The label is the prediction cast to the narrow integer type (a cast
    truncates: only 1.0 becomes 1), or thresholded when ``dtype`` is None."""
    lab = (F.col(pred).cast(dtype) if dtype else (F.col(pred) > threshold).cast("int"))
    pl = test_pred.withColumn(target, lab.cast(train.schema[target].dataType)).drop(pred)
    return train.unionByName(pl, allowMissingColumns=True)
