"""Gold feature tables and labels to the pretrain feature store and the training table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from featuremart import fixed_values as fixed
from featuremart.operators import pit
from featuremart.operators.schema import drop_null_features, project_present
from featuremart.plans.gold import add_ordinal_codes

ATTRIBUTE_FEATURES = ["Age_bin", "Occupation"]


def financial_feature_names(financials: DataFrame) -> list[str]:
    """Base columns plus whatever codes, ratios and flags the table already carries."""
    engineered = [*fixed.ENCODED_COLUMNS, *fixed.RATIO_COLUMNS, *fixed.FLAG_COLUMNS]
    base = [c for c in fixed.FINANCIAL_BASE_COLUMNS if c != "Changed_Credit_Limit"]
    return base + [c for c in engineered if c in financials.columns]


def pretrain_features(
    labels: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    clickstream: DataFrame,
    months_on_book: int = 6,
    strategy: str = "latest",
    drop_nulls: bool = False,
    make_attributes: Callable[[DataFrame], DataFrame] | None = None,
    make_financials: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Leakage-free features for a batch of labels, for any number of label dates at once.

    ``latest`` gives one row per customer and label date, ``none`` keeps every
    combination of attribute and financial snapshots before the cutoff.  Where the two
    tables are not stored as features yet, ``make_...`` are the projections that make
    them; ``latest`` runs them on the rows that labels take, not on all.
    """
    if strategy not in ("latest", "none"):
        raise ValueError("strategy must be 'latest' or 'none'")
    batch = pit.label_batch(labels)
    made_attributes = make_attributes(attributes) if make_attributes else attributes
    made_financials = make_financials(financials) if make_financials else financials
    money = financial_feature_names(made_financials)
    clicks = pit.Mean(clickstream, fixed.CLICK_FEATURES)
    if strategy == "latest":
        merged = pit.point_in_time_features(batch, months_on_book, [
            clicks,
            pit.Latest(attributes, ATTRIBUTE_FEATURES, "attributes_snapshot_date", make_attributes),
            pit.Latest(financials, money, "financials_snapshot_date", make_financials),
        ])
    else:
        merged = pit.merge_features([
            pit.point_in_time_features(batch, months_on_book, [clicks]),
            pit.point_in_time_join(batch, made_attributes, months_on_book, ATTRIBUTE_FEATURES, "attributes_snapshot_date"),
            pit.point_in_time_join(batch, made_financials, months_on_book, money, "financials_snapshot_date"),
        ])
    coded = add_ordinal_codes(merged)
    if drop_nulls:
        coded = drop_null_features(coded, fixed.PRETRAIN_METADATA)
    return project_present(coded, fixed.PRETRAIN_COLUMNS)


def training_rows(features: DataFrame, labels: DataFrame, drop_nulls: bool = False) -> DataFrame:
    joined = pit.training_table(features, labels)
    return drop_null_features(joined, fixed.TRAINING_METADATA) if drop_nulls else joined

