"""Feature scalars: bins, codes, ratios, flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from featuremart.functions.text import _col


def bucketise(c: Column | str, bins: Sequence[tuple[str, float | None, float | None]]) -> Column:
    """Name of the left-closed bin ``[low, high)`` that holds the value."""
    value = _col(c)
    named = []
    for name, low, high in bins:
        inside = value.isNotNull()
        if low is not None:
            inside = inside & (value >= low)
        if high is not None:
            inside = inside & (value < high)
        named.append(F.when(inside, F.lit(name)))
    return F.coalesce(*named)


def ordinal_encode(c: Column | str, codes: Mapping[str, int]) -> Column:
    """Integer code of a category; NULL for categories without one."""
    value = _col(c)
    return F.coalesce(*[F.when(value == name, F.lit(code)) for name, code in codes.items()])


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Ratio where the denominator is positive, NULL elsewhere."""
    bottom = _col(denominator)
    return F.when(bottom > 0, F.try_divide(_col(numerator).cast("double"), bottom))


def threshold_flag(c: Column | str, comparison: str, limit: float) -> Column:
    """1 when the comparison holds, 0 otherwise and for NULL."""
    value = _col(c)
    holds = value > limit if comparison == ">" else value < limit
    return F.when(holds, 1).otherwise(0)


def decide(score: Column | str, threshold: float) -> Column:
    return (_col(score) >= threshold).cast("int")


def clean_score(score: Column | str) -> Column:
    """Score as double with NaN treated as missing."""
    value = _col(score).try_cast("double")
    return F.when(~F.isnan(value), value)
