"""Cleaning functions for messy text: Column in, Column out, built-ins only.

Spark 4 runs with ANSI casts, so every parse goes through ``try_cast``; a value that
does not parse becomes NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed

WHITESPACE = " \t\n\r\x0b\x0c"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_dirty_number(c: Column | str, to: str = "double") -> Column:
    """Drop every character that cannot belong to a number, then parse.

    Integer targets truncate: ``'3.7'`` gives 3.
    """
    digits = F.regexp_replace(_col(c).cast("string"), fixed.NUMBER_CHARACTERS, "")
    number = F.nullif(digits, F.lit("")).try_cast("double")  # a failed cast costs an exception
    return number if to == "double" else number.try_cast(to)


def null_out_of_range(c: Column | str, low=None, high=None) -> Column:
    """Keep values inside the closed range, NULL otherwise; an open end is ``None``."""
    value = _col(c)
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value >= low)
    if high is not None:
        inside = inside & (value <= high)
    return F.when(inside, value)


def clean_age(c: Column | str, low: int = fixed.AGE_RANGE[0], high: int = fixed.AGE_RANGE[1]) -> Column:
    """Age from text; the decimal point is dropped too, so ``'45.5'`` is out of range."""
    return null_out_of_range(parse_digits(c), low, high)


def parse_digits(c: Column | str) -> Column:
    """Integer from the digits and dashes of a text alone."""
    return F.regexp_replace(_col(c).cast("string"), fixed.DIGIT_DASH_CHARACTERS, "").try_cast("int")


def normalise_name(c: Column | str) -> Column:
    return F.initcap(F.trim(_col(c)))


def mask_keep_first(c: Column | str, keep: int = 1, mask: str = "*") -> Column:
    text = _col(c)
    hidden = F.greatest(F.length(text) - keep, F.lit(0))
    return F.concat(F.substring(text, 1, keep), F.repeat(F.lit(mask), hidden))


def validate_pattern(
    c: Column | str,
    pattern: str = fixed.SSN_PATTERN,
    strip: str = fixed.DIGIT_DASH_CHARACTERS,
) -> Column:
    """Remove foreign characters; NULL unless what is left matches ``pattern``."""
    text = F.regexp_replace(_col(c), strip, "")
    return F.when(text.rlike(pattern), text)


def mask_keep_last(c: Column | str, prefix: str = fixed.SSN_MASK_PREFIX, keep: int = 4) -> Column:
    return F.concat(F.lit(prefix), F.substring(_col(c), -keep, keep))


def clean_category(c: Column | str, sentinel: str = fixed.OCCUPATION_SENTINEL) -> Column:
    """Sentinel to NULL, remaining underscores to spaces."""
    return F.translate(F.nullif(_col(c), F.lit(sentinel)), "_", " ")


def whitelist(c: Column | str, allowed: Sequence[str]) -> Column:
    value = _col(c)
    return F.when(value.isin(list(allowed)), value)


def collapse_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Translate listed values, NULL for all others."""
    value = _col(c)
    by_target: dict[str, list[str]] = {}
    for source, target in mapping.items():
        by_target.setdefault(target, []).append(source)
    return F.coalesce(
        *[F.when(value.isin(sources), F.lit(target)) for target, sources in by_target.items()]
    )


def regex_category(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first rule whose pattern is found, ignoring case."""
    value = _col(c)
    return F.coalesce(
        *[F.when(value.rlike(f"(?i){pattern}"), F.lit(label)) for pattern, label in rules]
    )


def parse_duration_months(c: Column | str) -> Column:
    """``'15 Years and 10 Months'`` to 190; a missing part counts as 0, so does NULL."""

    def part(unit: str) -> Column:
        number = F.regexp_extract(_col(c), rf"(\d+)\s+{unit}", 1)
        return F.coalesce(F.nullif(number, F.lit("")).try_cast("int"), F.lit(0))

    return part("Years") * 12 + part("Months")


def clean_multi_value(
    c: Column | str, junk: Sequence[str] = tuple(fixed.MULTI_VALUE_JUNK), separator: str = "|"
) -> Column:
    """Text list to a separated list of distinct trimmed items, in first-seen order."""
    items = F.split(F.regexp_replace(_col(c), r"\s+and\s+", ","), ",")
    trimmed = F.transform(items, lambda item: F.trim(item))
    unwanted = F.array(*[F.lit(item) for item in junk]).cast("array<string>")
    return F.array_join(F.array_except(trimmed, unwanted), separator)  # keeps one of equal items


def normalise_nulls(c: Column | str, tokens: Sequence[str] = tuple(fixed.NULL_TOKENS)) -> Column:
    """Strip surrounding whitespace; spelled-out missing values become NULL."""
    text = F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))
    return F.when(~text.isin(list(tokens)), text)


def hash_id(*columns: Column | str, separator: str = "||") -> Column:
    return F.sha2(F.concat_ws(separator, *[_col(c) for c in columns]), 256)


def parse_version_date(c: Column | str) -> Column:
    """Date from a trailing ``YYYY_MM_DD``; NULL when absent or not a calendar date."""
    stamp = F.regexp_extract(_col(c), r"(\d{4}_\d{2}_\d{2})$", 1)
    return F.replace(stamp, F.lit("_"), F.lit("-")).try_cast("date")
