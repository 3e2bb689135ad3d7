from datetime import date

import pytest
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.functions import dates, numeric, text


def test_parse_dirty_number(one):
    given = ["12_000.5_", "--", "_", "", None, "-7", "3.7", "1e5"]
    assert one(text.parse_dirty_number("x"), *given) == [12000.5, None, None, None, None, -7.0, 3.7, 15.0]
    assert one(text.parse_dirty_number("x", "int"), *given) == [12000, None, None, None, None, -7, 3, 15]


def test_range_is_closed_and_keeps_null(one):
    given = [-1, 0, 50, 51, None]
    assert one(text.null_out_of_range("x", 0, 50), *given, type="int") == [None, 0, 50, None, None]
    assert one(text.null_out_of_range("x", 0), *given, type="int") == [None, 0, 50, 51, None]


def test_clean_age(one):
    given = ["28_", "-500", "45.5", "", "18", "120", "17", "121", None]
    assert one(text.clean_age("x"), *given) == [28, None, None, None, 18, 120, None, None, None]


def test_names(one):
    assert one(text.normalise_name("x"), "  aNN lee ", None) == ["Ann Lee", None]
    assert one(text.mask_keep_first("x"), "", "A", "Ann Lee", None) == ["", "A", "A******", None]


def test_identifier(one):
    given = ["123-45-6789", "#F%$D@*&8", "1234-5-6789", " 123-45-6789_", None]
    valid = ["123-45-6789", None, None, "123-45-6789", None]
    assert one(text.validate_pattern("x"), *given) == valid
    assert one(text.mask_keep_last(text.validate_pattern("x")), *given) == [
        "XXX-XX-6789", None, None, "XXX-XX-6789", None]


def test_categories(one):
    assert one(text.clean_category("x"), "_______", "Media_Manager", None) == [None, "Media Manager", None]
    assert one(text.whitelist("x", fixed.CREDIT_MIX_VALUES), "Good", "_", None) == ["Good", None, None]
    assert one(text.collapse_values("x", fixed.MIN_AMOUNT_VALUES), "NM", "No", "Yes", "q", None) == [
        "No", "No", "Yes", None, None]
    given = ["LOW_spent_Small_value_payments", "High_spent_large_value_payments", "!@9#%8", None]
    assert one(text.regex_category("x", fixed.SPENT_PATTERNS), *given) == ["Low", "High", None, None]
    assert one(text.regex_category("x", fixed.PAYMENT_PATTERNS), *given) == ["Small", "Large", None, None]


def test_duration(one):
    given = ["15 Years and 10 Months", "1 Year", "NA", None, "7 Months"]
    assert one(text.parse_duration_months("x"), *given) == [190, 0, 0, 0, 7]


def test_multi_value(one):
    given = ["A, B, and A", "Not Specified", None, "A and B,  C ", "A, Not Specified, B"]
    assert one(text.clean_multi_value("x"), *given) == ["A|B", "", None, "A|B|C", "A|B"]


def test_null_tokens(one):
    given = ["  ", "N/A", " nan\t", "value ", None, "n/a"]
    assert one(text.normalise_nulls("x"), *given) == [None, None, None, "value", None, "n/a"]


def test_version_date(one):
    given = ["m_2024_02_29", "m_2024_02_30", "m_2024_1_1", "2024_01_01_x", None]
    assert one(text.parse_version_date("x"), *given) == [date(2024, 2, 29), None, None, None, None]


@pytest.mark.parametrize("start,end,months", [
    ("2023-03-31", "2023-06-30", 3), ("2022-12-30", "2023-02-28", 2), ("2023-01-15", "2023-04-14", 2),
    ("2023-01-01", "2023-01-01", 0), ("2023-04-14", "2023-01-15", -2), ("2023-05-01", "2024-05-01", 12)])
def test_whole_months(spark, start, end, months):
    a, b = F.lit(start).cast("date"), F.lit(end).cast("date")
    assert spark.range(1).select(dates.whole_months_between(a, b)).first()[0] == months


def test_windows():
    w = dates.derive_windows(date(2024, 3, 31), 12, 1)
    assert (w.oot_start, w.oot_end) == (date(2024, 2, 29), date(2024, 3, 30))
    assert (w.train_test_start, w.train_test_end) == (date(2023, 2, 28), date(2024, 2, 28))


def test_windows_as_columns_agree(spark):
    anchor = date(2024, 5, 31)
    row = spark.createDataFrame([(anchor,)], "d date").select(*dates.derive_window_columns("d", 12, 2)).first()
    w = dates.derive_windows(anchor, 12, 2)
    assert tuple(row) == (w.train_test_start, w.train_test_end, w.oot_start, w.oot_end)


def test_split_by_date(one):
    w = dates.derive_windows(date(2024, 1, 1), 12, 2)
    given = [date(2022, 10, 31), date(2022, 11, 1), date(2023, 10, 31), date(2023, 11, 1), date(2023, 12, 31),
             date(2024, 1, 1), None]
    assert one(dates.assign_split("x", w), *given, type="date") == [
        None, "train_test", "train_test", "oot", "oot", None, None]


def test_age_bins(one):
    assert one(numeric.bucketise("x", fixed.AGE_BINS), 17, 18, 24, 25, 49, 50, 64, 65, None, type="int") == [
        "under_18", "18_24", "18_24", "25_34", "35_49", "50_64", "50_64", "65_plus", None]


def test_ratio_and_flag(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (4.0, -1.0), (4.0, None), (None, 2.0)], "n double, d double")
    rows = df.select(numeric.guarded_ratio("n", "d"), numeric.threshold_flag("n", ">", 3)).collect()
    assert [tuple(r) for r in rows] == [(2.0, 1), (None, 1), (None, 1), (None, 1), (None, 0)]
