"""Bronze to silver: one projection per table over all snapshots at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.functions import dates, text
from featuremart.operators.schema import enforce_schema, expect_columns, fill_numeric_nulls, lenient_cast


def add_delinquency(loans: DataFrame, fill_nulls: bool = True) -> DataFrame:
    """Months on book, missed instalments, first missed date and days past due.

    With ``fill_nulls`` every numeric NULL of the loan row becomes 0 before the date
    arithmetic.
    """
    counted = loans.select(
        "*",
        F.col("installment_num").cast("int").alias("mob"),
        dates.installments_missed("overdue_amt", "due_amt").alias("installments_missed"),
    )
    if fill_nulls:
        counted = fill_numeric_nulls(counted)
    dated = counted.select(
        "*", dates.first_missed_date("snapshot_date", "installments_missed").alias("first_missed_date")
    )
    return dated.select(
        "*",
        dates.days_past_due("overdue_amt", "snapshot_date", "first_missed_date").cast("int").alias("dpd"),
    )


def silver_loans(bronze: DataFrame) -> DataFrame:
    return add_delinquency(enforce_schema(bronze, fixed.LOAN_TYPES))


def silver_clickstream(bronze: DataFrame) -> DataFrame:
    return enforce_schema(bronze, fixed.CLICKSTREAM_TYPES)


def silver_attributes(bronze: DataFrame) -> DataFrame:
    """Names, ages, identifiers and occupations cleaned; two masked columns added."""
    name = text.normalise_name("Name")
    ssn = text.validate_pattern("SSN")
    cleaned: dict[str, Column] = {
        "Name": name,
        "Age": text.null_out_of_range("Age", *fixed.AGE_RANGE),
        "SSN": ssn,
        "Occupation": text.clean_category("Occupation"),
    }
    typed = enforce_schema(expect_columns(bronze, cleaned), {
        c: t for c, t in fixed.ATTRIBUTE_TYPES.items() if c in bronze.columns
    })
    typed = _parsed_first(typed, {"Age": text.parse_digits("Age")})
    return typed.select(
        *[cleaned[c].alias(c) if c in cleaned else F.col(c) for c in typed.columns],
        text.mask_keep_first(name).alias("Name_Masked"),
        text.mask_keep_last(ssn).alias("SSN_Masked"),
    )


def _parsed_first(df: DataFrame, parsed: dict[str, Column]) -> DataFrame:
    """Columns replaced in a projection of their own: later expressions name a value several times, it is parsed once."""
    return df.select(*[parsed[c].alias(c) if c in parsed else F.col(f"`{c}`") for c in df.columns])


def financial_expressions(bronze: DataFrame, real: str = "float") -> dict[str, Column]:
    """Cleaning expression per financial column, dirty integers parsed before; ``real`` is the floating type used."""
    cleaned: dict[str, Column] = {
        c: lenient_cast(bronze, c, real if t == "float" else t)
        for c, t in fixed.FINANCIAL_TYPES.items()
        if c in bronze.columns
    }
    for c in fixed.DIRTY_FLOATS:
        cleaned[c] = text.parse_dirty_number(c).cast(real)
    for c, (low, high, kind) in fixed.FINANCIAL_RANGES.items():
        value = cleaned.get(c, lenient_cast(bronze, c, "double"))
        bounded = text.null_out_of_range(value, low, high)
        cleaned[c] = bounded.try_cast(real if kind == "float" else kind)
    cleaned["Type_of_Loan"] = text.clean_multi_value("Type_of_Loan")
    cleaned["Credit_Mix"] = text.whitelist("Credit_Mix", fixed.CREDIT_MIX_VALUES)
    cleaned["Payment_of_Min_Amount"] = text.collapse_values(
        "Payment_of_Min_Amount", fixed.MIN_AMOUNT_VALUES
    )
    cleaned["Credit_History_Age"] = text.parse_duration_months("Credit_History_Age")
    return cleaned


def silver_financials(bronze: DataFrame, real: str = "float") -> DataFrame:
    """All financial columns cleaned; the behaviour text is split in two categories."""
    parsed = _parsed_first(bronze, {c: text.parse_dirty_number(c, "int") for c in fixed.DIRTY_INTS})
    cleaned = financial_expressions(parsed, real)
    expect_columns(bronze, [*(c for c in cleaned if c not in fixed.FINANCIAL_TYPES), "Payment_Behaviour"])
    return parsed.select(
        *[
            cleaned[c].alias(c) if c in cleaned else F.col(c)
            for c in parsed.columns
            if c != "Payment_Behaviour"
        ],
        text.regex_category("Payment_Behaviour", fixed.SPENT_PATTERNS).alias("Payment_Behaviour_Spent"),
        text.regex_category("Payment_Behaviour", fixed.PAYMENT_PATTERNS).alias("Payment_Behaviour_Payment"),
    )
