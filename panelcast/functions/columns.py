"""Column expressions that keep the null rules of the panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_lower(c: Column | str, lo: float = 0.0) -> Column:
    """max(c, lo); null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(float(lo))))


def clip_upper(c: Column | str, hi: Column | str) -> Column:
    """min(c, hi); null stays null, and a null bound does not clip."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(c, _col(hi)))


def log_target(c: Column | str) -> Column:
    return F.log1p(_col(c))


def unlog(c: Column | str) -> Column:
    """Back from log1p, never below zero."""
    return clip_lower(F.expm1(_col(c)), 0.0)


def rescale(c: Column | str, scale: Column | str) -> Column:
    return _col(c) * _col(scale)


def safe_name(c: Column | str) -> Column:
    """Text fit for a file name: slash and blank become underscores."""
    return F.translate(_col(c), "/ ", "__")


def uplift_pct(absolute: Column, mean_sale: Column, eps: float = 1e-9) -> Column:
    return F.try_divide(F.lit(100.0) * absolute, mean_sale + F.lit(eps))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys where null equals null; the keys and other columns of both sides once."""
    named = right.select(*[F.col(f"`{c}`").alias(f"__right_{c}" if c in keys else c) for c in right.columns])
    if not keys:
        return left.join(named, how=how)
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__right_{k}`")) for k in keys]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return left.join(named, condition, how).drop(*[f"__right_{k}" for k in keys])
