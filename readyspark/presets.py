"""The credit-application preset: domains, category orders and thresholds.

Everything else in the package takes these as parameters; this module only
collects the values of the credit case in one place.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES. They must equal the workflow being rebuilt for equal results:
# allowed categories, category orders, bounds, bins, mappings and thresholds.
# ---------------------------------------------------------------------------

TARGET = "class"
SENSITIVE = "sex"

NUMERIC_COLUMNS = [
    "duration",
    "credit_amount",
    "installment_commitment",
    "residence_since",
    "age",
    "existing_credits",
    "num_dependents",
]

# lower bounds, inclusive
NUMERIC_MIN = {
    "duration": 1,
    "credit_amount": 100,
    "installment_commitment": 1,
    "residence_since": 1,
    "age": 18,
    "existing_credits": 1,
    "num_dependents": 0,
}

ALLOWED_CATEGORIES = {
    "checking_status": ["<0", "0<=X<200", ">=200", "no checking"],
    "credit_history": [
        "no credits/all paid",
        "all paid",
        "existing paid",
        "delayed previously",
        "critical/other existing credit",
    ],
    "purpose": [
        "new car",
        "used car",
        "furniture/equipment",
        "radio/tv",
        "domestic appliance",
        "repairs",
        "education",
        "retraining",
        "business",
        "other",
    ],
    "savings_status": ["<100", "100<=X<500", "500<=X<1000", ">=1000", "no known savings"],
    "employment": ["unemployed", "<1", "1<=X<4", "4<=X<7", ">=7"],
    "other_parties": ["none", "co applicant", "guarantor"],
    "property_magnitude": ["real estate", "life insurance", "car", "no known property"],
    "other_payment_plans": ["bank", "stores", "none"],
    "housing": ["rent", "own", "for free"],
    "job": [
        "unemp/unskilled non res",
        "unskilled resident",
        "skilled",
        "high qualif/self emp/mgmt",
    ],
    "personal_status": [
        "male div/sep",
        "female div/dep/mar",
        "male single",
        "male mar/wid",
        "female single",
    ],
    "foreign_worker": ["yes", "no"],
}

TARGET_VALUES = ["good", "bad"]
TARGET_MAPPING = {"good": 0, "bad": 1}

# age groups: right-closed bins (17, 24], (24, 40], (40, 60], (60, inf)
AGE_EDGES = [17, 24, 40, 60, float("inf")]
AGE_LABELS = ["<25", "25-40", "40-60", "60+"]

SECURITY_NONE = "none"
HIGH_RISK_CHECKING = "<0"
HIGH_RISK_SAVINGS = ["<100", "no known savings"]

# columns removed from the training table
DELETED_ATTRIBUTES = ["personal_status", "foreign_worker", "own_telephone", "age"]
EXPECTED_FEATURES = [
    "monthly_payment",
    "age_group",
    "has_additional_security",
    "high_risk_financial_status",
]

# declared category orders (profiling and ordinal encoding)
EMPLOYMENT_ORDER = ["unemployed", "<1", "1<=X<4", "4<=X<7", ">=7"]
JOB_ORDER = [
    "unemp/unskilled non res",
    "unskilled resident",
    "skilled",
    "high qualif/self emp/mgmt",
]
CHECKING_ORDER = ["no checking", "<0", "0<=X<200", ">=200"]
SAVINGS_ORDER = ["no known savings", "<100", "100<=X<500", "500<=X<1000", ">=1000"]
INSTALLMENT_ORDER = [1, 2, 3, 4]

# encoder column roles
ORDINAL_FEATURES = {"employment": EMPLOYMENT_ORDER, "job": JOB_ORDER}
BINARY_FEATURES = ["has_additional_security", "high_risk_financial_status"]
NOMINAL_FEATURES = [
    "purpose",
    "credit_history",
    "other_parties",
    "property_magnitude",
    "other_payment_plans",
    "housing",
    "age_group",
    "checking_status",
    "savings_status",
]

# personal-status codes of the original survey form
MALE_CODES = ["a91", "a93", "a94"]
FEMALE_CODES = ["a92", "a95"]

# metamorphic moves: one step better checking status, one step lower savings
CHECKING_IMPROVEMENT = {
    "<0": "0<=X<200",
    "0<=X<200": ">=200",
    ">=200": ">=200",
    "no checking": "no checking",
}
CHECKING_MOVABLE = ["<0", "0<=X<200"]
SAVINGS_DETERIORATION = {
    ">=1000": "500<=X<1000",
    "500<=X<1000": "100<=X<500",
    "100<=X<500": "<100",
    "<100": "<100",
    "no known savings": "no known savings",
}
SAVINGS_MOVABLE = ["100<=X<500", "500<=X<1000", ">=1000"]
DURATION_INCREASE_MONTHS = 12

# robustness variants
PERTURB_COLUMNS = ["duration", "credit_amount"]
PERTURB_LOW = 0.95
PERTURB_HIGH = 1.05
INFLATION_FACTOR = 1.03
SEED = 42

# data gates
RAW_MIN_ROWS = 1000
RAW_NOT_NULL_MOSTLY = 0.95
PREPARED_MIN_ROWS = 800
MIN_CLASS_SHARE = 0.1

# model gates
PERFORMANCE_THRESHOLDS = {
    "precision": 0.50,
    "recall": 0.70,
    "f1": 0.60,
    "roc_auc": 0.80,
    "mcc": 0.40,
}
FAIRNESS_THRESHOLD = 0.05
FAIRNESS_GROUPS = ("male", "female")
ROBUSTNESS_THRESHOLD = 0.95
MAX_VIOLATION_RATE = 0.1
TEST_SIZE = 0.2
N_FOLDS = 5

# search space of the forest
PARAM_SPACE = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [None, 3, 5, 10, 20, 30],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2"],
    "bootstrap": [True, False],
}
SEARCH_ITERATIONS = 20

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------
