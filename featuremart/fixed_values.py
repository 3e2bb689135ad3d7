"""Types, ranges, category names and column orders.

These must equal the values of the datamart this package rebuilds, otherwise the
results differ.  They are data, not logic; every operator takes them as parameters.
"""

from __future__ import annotations

# --- fixed values: column types -------------------------------------------------
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}
CLICK_FEATURES = [f"fe_{i}" for i in range(1, 21)]
CLICKSTREAM_TYPES = {
    "Customer_ID": "string",
    **{name: "int" for name in CLICK_FEATURES},
    "snapshot_date": "date",
}
ATTRIBUTE_TYPES = {"Customer_ID": "string", "snapshot_date": "date"}
FINANCIAL_TYPES = {
    "Customer_ID": "string",
    "Monthly_Inhand_Salary": "float",
    "Delay_from_due_date": "int",
    "Credit_Utilization_Ratio": "float",
    "Total_EMI_per_month": "float",
    "snapshot_date": "date",
}

# --- fixed values: cleaning -----------------------------------------------------
NUMBER_CHARACTERS = r"[^0-9.\-]"
DIGIT_DASH_CHARACTERS = r"[^0-9\-]"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
SSN_MASK_PREFIX = "XXX-XX-"
AGE_RANGE = (18, 120)
OCCUPATION_SENTINEL = "_______"
DIRTY_FLOATS = [
    "Annual_Income",
    "Changed_Credit_Limit",
    "Outstanding_Debt",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
DIRTY_INTS = ["Num_of_Loan", "Num_of_Delayed_Payment"]
FINANCIAL_RANGES = {
    "Num_Bank_Accounts": (0, 50, "int"),
    "Num_Credit_Card": (0, 20, "int"),
    "Interest_Rate": (0, 100, "float"),
    "Num_of_Loan": (0, 20, "int"),
    "Num_Credit_Inquiries": (0, 50, "int"),
    "Num_of_Delayed_Payment": (0, 100, "int"),
    "Total_EMI_per_month": (0, None, "float"),
}
CREDIT_MIX_VALUES = ["Good", "Standard", "Bad"]
MIN_AMOUNT_VALUES = {"No": "No", "NM": "No", "Yes": "Yes"}
SPENT_PATTERNS = [("^Low_spent", "Low"), ("^High_spent", "High")]
PAYMENT_PATTERNS = [
    ("Large_value_payments", "Large"),
    ("Medium_value_payments", "Medium"),
    ("Small_value_payments", "Small"),
]
MULTI_VALUE_JUNK = ["Not Specified", ""]
NULL_TOKENS = ["", " ", "NONE", "None", "none", "NULL", "null", "NaN", "nan", "N/A", "NA"]

# --- fixed values: gold features ------------------------------------------------
AGE_BINS = [
    ("under_18", None, 18),
    ("18_24", 18, 25),
    ("25_34", 25, 35),
    ("35_49", 35, 50),
    ("50_64", 50, 65),
    ("65_plus", 65, None),
]
ORDINAL_CODES = {
    "Credit_Mix": {"Bad": 0, "Standard": 1, "Good": 2},
    "Payment_of_Min_Amount": {"No": 0, "Yes": 1},
    "Payment_Behaviour_Spent": {"Low": 0, "High": 1},
    "Payment_Behaviour_Payment": {"Small": 0, "Medium": 1, "Large": 2},
}
# flag name -> (column, comparison, default threshold)
RISK_FLAGS = {
    "high_credit_inquiry_flag": ("Num_Credit_Inquiries", ">", 10),
    "high_utilization_flag": ("Credit_Utilization_Ratio", ">", 0.8),
    "high_emi_burden_flag": ("emi_to_income_ratio", ">", 0.5),
    "negative_balance_flag": ("Monthly_Balance", "<", 0),
}
LABEL_COLUMNS = ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]
FINANCIAL_BASE_COLUMNS = [
    "Annual_Income", "Monthly_Inhand_Salary",
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Type_of_Loan",
    "Interest_Rate", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Changed_Credit_Limit", "Num_Credit_Inquiries",
    "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age",
    "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
    "Credit_Mix", "Payment_of_Min_Amount",
    "Payment_Behaviour_Spent", "Payment_Behaviour_Payment",
]
ENCODED_COLUMNS = [
    "Credit_Mix_Enc", "Payment_of_Min_Amount_Enc",
    "Payment_Behaviour_Spent_Enc", "Payment_Behaviour_Payment_Enc",
]
RATIO_COLUMNS = [
    "emi_to_income_ratio", "debt_to_income_ratio", "avg_delay", "balance_to_income_ratio",
]
FLAG_COLUMNS = list(RISK_FLAGS)
PRETRAIN_COLUMNS = [
    "Customer_ID", "label_snapshot_date",
    "Age_bin", "Occupation", "attributes_snapshot_date",
    "Annual_Income", "Monthly_Inhand_Salary",
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Type_of_Loan",
    "Interest_Rate", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Credit_History_Age",
    "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
    "financials_snapshot_date",
    *ENCODED_COLUMNS, *RATIO_COLUMNS, *FLAG_COLUMNS,
    *[f"{name}_mean" for name in CLICK_FEATURES],
]
PRETRAIN_METADATA = [
    "Customer_ID", "label_snapshot_date", "attributes_snapshot_date",
    "financials_snapshot_date", "Age_bin", "Occupation",
]
TRAINING_METADATA = ["loan_id", "label", "label_def", "label_snapshot_date", "Customer_ID"]

# --- fixed values: scoring, monitoring, registry --------------------------------
DECISION_THRESHOLD = 0.5
PSI_BUCKETS = 10
PSI_EPSILON = 1e-8
PSI_BANDS = [("stable", None, 0.1), ("moderate", 0.1, 0.25), ("significant", 0.25, None)]
AUC_BANDS = [("poor", None, 0.70), ("caution", 0.70, 0.75), ("good", 0.75, None)]
PROMOTION_EPSILON = 1e-6
MIN_TEST_AUC = 0.70
MIN_HISTORY_MONTHS = 14
RETRAIN_AFTER_MONTHS = 3
SPLIT_RATIO = 0.8
SEED = 88
MONITORING_ALIASES = {
    "predicted_default_risk_mean": "score_mean",
    "macro_f1": "f1_macro",
    "weight_f1": "f1_weighted",
    "auc": "auc_roc",
}
MONITORING_METRICS = [
    "sample_size", "score_mean", "accuracy", "f1_macro", "auc_roc",
    "psi_vs_trailing", "ks_vs_trailing",
]
REGISTRY_SCHEMA = (
    "model_version string not null, train_start date, train_end date, "
    "oot_start date, oot_end date, auc_train double, auc_test double, auc_oot double, "
    "promoted_flag boolean, promoted_at timestamp, "
    "run_id string, status string, train_date date, flavor string, model_name string, "
    "version bigint, stage string, model_uri string, description string, "
    "gini_train double, gini_test double, gini_oot double, accuracy_test double, "
    "precision_weighted_test double, recall_weighted_test double, f1_weighted_test double"
)
SNAPSHOT_METRICS = [
    "auc_train", "auc_test", "auc_oot", "gini_train", "gini_test", "gini_oot",
    "accuracy_test", "precision_weighted_test", "recall_weighted_test", "f1_weighted_test",
]
