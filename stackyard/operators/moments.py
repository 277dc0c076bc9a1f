"""Pairwise sums of many columns from one scan.

A column x becomes three entries of a row vector: its value around a centre (0
where missing), a mask (1 where present) and the square of the value. The Gramian
of these vectors, which Spark adds up as one triangular array for each task, holds
everything pairwise-complete statistics of every two columns need: common
rows, sums and sums of squares over them, and the sum of products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of one Gramian; more columns are scanned by pairs of blocks.
BLOCK = 400
SAMPLE_ROWS = 1000
#: A variance below this share of the mean square is that of a constant.
CONSTANT = 1e-13


def gramian(df: DataFrame, entries: list[Column]) -> np.ndarray:
    """X'X of the rows of ``entries``: one pass, one array for each task."""
    vectors = df.select(array_to_vector(F.array(*[e.cast("double") for e in entries])).alias("v"))
    if not vectors.take(1):
        return np.zeros((len(entries), len(entries)))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), 0, len(entries)).computeGramianMatrix().toArray()


def centres(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """A value of each column near its middle, from a few rows: it only keeps
    the sums small, so any value would do."""
    got = df.limit(SAMPLE_ROWS).agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5).alias(c) for c in cols]).first()
    return {c: float(got[c]) if got[c] is not None and np.isfinite(got[c]) else 0.0 for c in cols}


def present(col: str) -> Column:
    x = F.col(col).cast("double")
    return x.isNotNull() & ~F.isnan(x)


@dataclass
class Moments:
    """Pairwise sums: entry [a, b] is over the rows where both are present."""
    cols: list[str]
    rows: int
    n: np.ndarray        # common rows
    total: np.ndarray    # sum of a
    square: np.ndarray   # sum of a * a
    product: np.ndarray  # sum of a * b

    def at(self, a: str, b: str) -> tuple[int, int]:
        return self.cols.index(a), self.cols.index(b)

    def correlations(self) -> np.ndarray:
        """Pearson's r of every two columns; nan where a side is constant or no two rows are common."""
        n, s = self.n, self.total
        with np.errstate(invalid="ignore", divide="ignore"):
            var = n * self.square - s * s
            var[var <= CONSTANT * n * self.square] = 0
            r = (n * self.product - s * s.T) / np.sqrt(var * var.T)
        r[(n < 2) | (var <= 0) | (var.T <= 0)] = np.nan
        return np.clip(r, -1, 1)

    def missing(self) -> np.ndarray:
        """Rows where a column is missing."""
        return self.rows - np.diag(self.n)


def _block(df: DataFrame, cols: list[str], centre: dict[str, float]) -> tuple[np.ndarray, ...]:
    values, masks, squares = [], [], []
    for c in cols:
        x = F.when(present(c), F.col(c).cast("double") - F.lit(centre[c])).otherwise(F.lit(0.0))
        values.append(x)
        masks.append(present(c).cast("double"))
        squares.append(x * x)
    k = len(cols)
    g = gramian(df, [*values, *masks, *squares, F.lit(1.0)])
    return g[-1, -1], g[k:2 * k, k:2 * k], g[:k, k:2 * k], g[2 * k:3 * k, k:2 * k], g[:k, :k]


def pair_moments(df: DataFrame, cols: list[str]) -> Moments:
    """All pairwise sums of ``cols``; values are taken around the centres
    (which correlations and counts do not see). NaN counts as missing."""
    centre = centres(df, cols)
    src = df.select(*cols)
    blocks = [cols[i:i + BLOCK // 2] for i in range(0, len(cols), BLOCK // 2)] if len(cols) > BLOCK else [cols]
    m = len(cols)
    out = [np.zeros((m, m)) for _ in range(4)]
    place = {c: i for i, c in enumerate(cols)}
    rows = 0.0
    pairs = [(a, b) for i, a in enumerate(blocks) for b in blocks[i + 1:]] or [(cols, [])]
    for a, b in pairs:
        both = [*a, *b]
        at = np.ix_([place[c] for c in both], [place[c] for c in both])
        rows, *got = _block(src, both, centre)
        for matrix, g in zip(out, got):
            matrix[at] = g
    return Moments(list(cols), int(rows), *out)


def sums_of_products(df: DataFrame, cols: list[str]) -> dict[tuple[str, str], float]:
    """Sum of a * b for every two columns (both orders), from one pass; missing values count as 0."""
    g = gramian(df, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    return {(a, b): float(g[i, j]) for i, a in enumerate(cols) for j, b in enumerate(cols)}
