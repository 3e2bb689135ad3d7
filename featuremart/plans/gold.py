"""Silver to gold: label store and the three feature tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.functions import numeric
from featuremart.operators.schema import select_prefix


def label_store(silver: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """One label per loan at a fixed age: 1 when at least ``dpd`` days past due."""
    return (
        silver.filter(F.col("mob") == mob)
        .select(
            "*",
            F.when(F.col("dpd") >= dpd, 1).otherwise(0).alias("label"),
            F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        )
        .select(*fixed.LABEL_COLUMNS)
    )


def gold_clickstream(silver: DataFrame) -> DataFrame:
    """Click features with the snapshot they describe."""
    features = select_prefix(silver, "fe_", keys=["Customer_ID", "snapshot_date"])
    return features.select("*", F.col("snapshot_date").alias("feature_snapshot_date"))


def gold_attributes(silver: DataFrame) -> DataFrame:
    return silver.select(
        "Customer_ID", "Age", "Occupation", "snapshot_date",
        numeric.bucketise("Age", fixed.AGE_BINS).alias("Age_bin"),
    )


def add_ordinal_codes(df: DataFrame, codes: Mapping[str, Mapping[str, int]] = fixed.ORDINAL_CODES) -> DataFrame:
    """``<column>_Enc`` for each listed category column, unless it is there already."""
    return df.select(
        "*",
        *[
            numeric.ordinal_encode(c, mapping).alias(f"{c}_Enc")
            for c, mapping in codes.items()
            if c in df.columns and f"{c}_Enc" not in df.columns
        ],
    )


def add_ratios(df: DataFrame) -> DataFrame:
    monthly_income = F.col("Annual_Income") / 12
    return df.select(
        "*",
        numeric.guarded_ratio("Total_EMI_per_month", monthly_income).alias("emi_to_income_ratio"),
        numeric.guarded_ratio("Outstanding_Debt", "Annual_Income").alias("debt_to_income_ratio"),
        numeric.guarded_ratio("Delay_from_due_date", "Num_of_Loan").alias("avg_delay"),
        numeric.guarded_ratio("Monthly_Balance", monthly_income).alias("balance_to_income_ratio"),
    )


def add_risk_flags(df: DataFrame, limits: Mapping[str, float] | None = None) -> DataFrame:
    """0/1 flags; ``limits`` replaces single default thresholds by flag name."""
    limits = limits or {}
    return df.select(
        "*",
        *[
            numeric.threshold_flag(column, comparison, limits.get(flag, default)).alias(flag)
            for flag, (column, comparison, default) in fixed.RISK_FLAGS.items()
        ],
    )


def gold_financials(silver: DataFrame, limits: Mapping[str, float] | None = None) -> DataFrame:
    """Base columns, codes, income ratios and risk flags."""
    base = silver.select("Customer_ID", "snapshot_date", *fixed.FINANCIAL_BASE_COLUMNS)
    return add_risk_flags(add_ratios(add_ordinal_codes(base)), limits).select(
        "Customer_ID", "snapshot_date", *fixed.FINANCIAL_BASE_COLUMNS,
        *fixed.ENCODED_COLUMNS, *fixed.RATIO_COLUMNS, *fixed.FLAG_COLUMNS,
    )
