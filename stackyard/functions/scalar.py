"""Scalar column functions (F1-F18): all built-in expressions, so they run
inside whole-stage code generation (no Python UDF)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_null(c: Column) -> Column:
    """NaN → NULL (results of pow/log on bad input)."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def az_to_int(s) -> Column:
    """letters as a base-26 number, case-folded (``a``=1 … ``z``=26);
    null passes through, the empty string is 0. Fits a long up to 13
    characters."""
    s = _c(s)
    digits = F.transform(F.split(F.lower(s), ""), lambda ch: F.ascii(ch).cast("long") - 96)
    val = F.aggregate(digits, F.lit(0).cast("long"), lambda acc, x: acc * 26 + x)
    return F.when(s.isNull(), F.lit(None)).when(s == "", F.lit(0).cast("long")).otherwise(val)


def padded_codes(s, width: int = 4, pad: str = "@", fill: str = "@@@@") -> list[Column]:
    """left-pad to ``width`` with ``pad`` (longer strings keep their
    first ``width`` characters), code point of each position; null → fill."""
    p = F.lpad(F.coalesce(_c(s), F.lit(fill)), width, pad)
    return [F.ascii(F.substring(p, i, 1)) for i in range(1, width + 1)]


def char_at(s, pos: int) -> Column:
    """character at 1-based ``pos``; missing → null."""
    ch = F.substring(_c(s), pos, 1)
    return F.when(ch == "", F.lit(None)).otherwise(ch)


def concat_pair(a, b, sep: str = "__", null_label: str = "NaN") -> Column:
    """``a + sep + b`` with nulls shown as ``null_label``."""
    return F.concat_ws(sep, F.coalesce(_c(a).cast("string"), F.lit(null_label)),
                       F.coalesce(_c(b).cast("string"), F.lit(null_label)))


def count_label(n, fmt: str = "C%d") -> Column:
    """F5."""
    return F.format_string(fmt, _c(n))


def capitals(s) -> Column:
    """keep the capital letters (e.g. a class name's initials)."""
    return F.regexp_replace(_c(s), "[^A-Z]", "")


def power(x, p: float = 0.125) -> Column:
    """``x ** p``; a negative base gives NaN, which becomes null."""
    return nan_null(F.pow(_c(x), F.lit(p)))


def snap_zero(x, digits: int = 5) -> Column:
    """F8: 0 where the value rounds (half-even) to 0 at ``digits``."""
    x = _c(x)
    return F.when(F.bround(x, digits) == 0, F.lit(0.0)).otherwise(x)


def rescale(x, unit) -> Column:
    """divide out a recovered unit (``x * 1/unit``)."""
    return _c(x) * (F.lit(1.0) / _c(unit))


def slot_scale(x, lo, hi) -> list[Column]:
    """``m = int(lo) - 2`` fills nulls; ``(x-m)/(hi-m)`` and a flag."""
    m = F.lit(int(lo) - 2).cast("double")
    v = F.coalesce(_c(x).cast("double"), m)
    return [F.try_divide(v - m, F.lit(float(hi)) - m), (v == m).cast("int")]


def stretch(x, lo, hi) -> Column:
    """min-max stretch to [0, 1]."""
    return F.try_divide(_c(x) - _c(lo), _c(hi) - _c(lo))


def clip(x, lo: float, hi: float) -> Column:
    """clip, null stays null."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def standardise(x, mean, std, digits: int | None = None) -> Column:
    """``(x - mean) / std`` (std from the fit side), optional rounding."""
    z = F.try_divide(_c(x) - _c(mean), _c(std))
    return F.bround(z, digits) if digits is not None else z


def interactions(cols: list[str], a: str, b: str, c: str | None = None) -> list[Column]:
    """``f*(a+b)`` per column and, with ``c``, also ``f*(a+c)``,
    ``f*(c+b)`` and ``f*a + f*b + f*c``."""
    pairs = [(a, b)] if c is None else [(a, b), (a, c), (c, b)]
    out = []
    for f in cols:
        out += [(F.col(f) * (F.col(x) + F.col(y))).alias(f"{f}_x_{x}_{y}") for x, y in pairs]
        if c is not None:
            out.append((F.col(f) * F.col(a) + F.col(f) * F.col(b) + F.col(f) * F.col(c))
                       .alias(f"{f}_x_{a}_{b}_{c}"))
    return out


def product(*cols) -> Column:
    """F15."""
    return reduce(lambda x, y: x * y, [_c(c) for c in cols])


def round_even(x, digits: int) -> Column:
    """F16: round half to even."""
    return F.bround(_c(x), digits)


def log1p(x) -> Column:
    return F.log1p(_c(x))


def geometric_blend(cols: list[str], weights: list[float]) -> Column:
    """``Π p_i ** w_i``."""
    return reduce(lambda x, y: x * y, [F.pow(F.col(c), F.lit(w)) for c, w in zip(cols, weights)])


# Fixed value: number of 15-digit hexadecimal numbers.
HASH_RANGE = 16 ** 15


def seeded_shuffle_key(key, seed: int) -> Column:
    """Reproducible shuffle order, the first 15 hexadecimal digits of
    ``md5(seed:key)``. Seed and key are mixed before the digest, so each seed
    gives an order of its own, for keys of any size or type."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
