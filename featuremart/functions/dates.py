"""Date and delinquency expressions."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from featuremart.functions.text import _col


def month_floor(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def to_date_safe(c: Column | str) -> Column:
    """Date from text, NULL when it does not parse."""
    return _col(c).try_cast("date")


def feature_cutoff(label_date: Column | str, months_on_book: int) -> Column:
    """First date whose features are no longer allowed for a label of this date."""
    return F.add_months(_col(label_date), 1 - months_on_book)


def whole_months_between(start: Column | str, end: Column | str) -> Column:
    """Full calendar months from ``start`` to ``end``, truncated towards zero."""
    a, b = _col(start), _col(end)
    months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    reached = F.add_months(a, months)
    return (
        months
        - F.when((b >= a) & (reached > b), 1).otherwise(0)
        + F.when((b < a) & (reached < b), 1).otherwise(0)
    )


def installments_missed(overdue: Column | str, due: Column | str) -> Column:
    """Missed instalments, rounded up; no usable due amount counts as none missed."""
    return F.coalesce(F.ceil(F.try_divide(_col(overdue), _col(due))).try_cast("int"), F.lit(0))


def first_missed_date(snapshot: Column | str, missed: Column | str) -> Column:
    return F.when(_col(missed) > 0, F.add_months(_col(snapshot), -_col(missed)))


def days_past_due(overdue: Column | str, snapshot: Column | str, first_missed: Column | str) -> Column:
    days = F.datediff(_col(snapshot), _col(first_missed))
    return F.when(_col(overdue) > 0, days).otherwise(F.lit(0))


def shift_months(day: date, months: int) -> date:
    """Calendar shift with the day clamped to the target month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


@dataclass(frozen=True)
class TrainingWindows:
    """Closed date ranges used for fitting and for out-of-time checks."""

    train_test_start: date
    train_test_end: date
    oot_start: date
    oot_end: date


def derive_windows(anchor: date, train_test_months: int, oot_months: int) -> TrainingWindows:
    oot_start = shift_months(anchor, -oot_months)
    one_day = timedelta(days=1)
    return TrainingWindows(
        train_test_start=shift_months(oot_start, -train_test_months),
        train_test_end=oot_start - one_day,
        oot_start=oot_start,
        oot_end=anchor - one_day,
    )


def derive_window_columns(anchor: Column | str, train_test_months: int, oot_months: int) -> list[Column]:
    """The same windows as columns, for a table of anchor dates."""
    day = _col(anchor)
    oot_start = F.add_months(day, -oot_months)
    return [
        F.add_months(oot_start, -train_test_months).alias("train_test_start"),
        F.date_sub(oot_start, 1).alias("train_test_end"),
        oot_start.alias("oot_start"),
        F.date_sub(day, 1).alias("oot_end"),
    ]


def assign_split(day: Column | str, windows: TrainingWindows) -> Column:
    """``train_test`` or ``oot`` by date, NULL outside both windows."""
    value = _col(day)
    return F.when(value.between(windows.oot_start, windows.oot_end), F.lit("oot")).when(
        value.between(windows.train_test_start, windows.train_test_end), F.lit("train_test")
    )
