"""Settings of the mart and the fixed column lists the operators share."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Business parameters. Months are ISO dates on the first of the month."""

    snapshot_start: str = "2023-01-01"
    snapshot_end: str = "2024-12-01"
    dpd_threshold: int = 30
    mob_label: int = 6
    anchor: str = "2024-06-01"
    initial_model: str = "logistic_regression"
    refresh_months: int = 6
    oot_months: int = 3
    test_months: int = 3
    auc_floor: float = 0.70
    psi_watch: float = 0.10
    psi_retrain: float = 0.25
    promotion_gate_auc: float = 0.60
    enforce_gate: bool = False
    target_recall: float = 0.75
    min_labelled: int = 30
    seed: int = 42
    # Files of the as-of state; fixed once it exists.
    asof_buckets: int = 200
    # Files of a month in the silver customer stores; 0 leaves them unbucketed.
    store_buckets: int = 0

    @property
    def label_def(self) -> str:
        return f"{self.dpd_threshold}dpd_{self.mob_label}mob"


DEFAULTS = Settings()

# Columns that arrive as dirty text and end up as numbers.
DIRTY_NUMERIC = (
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Total_EMI_per_month",
    "Credit_Utilization_Ratio",
    "Age",
    "Interest_Rate",
    "Delay_from_due_date",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
)

# Plausible range per column; values outside are sentinels.
CLIP_BOUNDS = {
    "Num_Bank_Accounts": (0, 20),
    "Num_Credit_Card": (0, 15),
    "Num_of_Loan": (0, 20),
    "Interest_Rate": (0, 50),
    "Num_of_Delayed_Payment": (0, 60),
    "Age": (18, 100),
    "Num_Credit_Inquiries": (0, 50),
}

# Categorical model inputs.
CATEGORICAL = ("Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour")

# Texts that mean "no category given".
UNKNOWN_CATEGORIES = ("_", "", "nan", "!@9#%8", "NM")

# Columns that are never model inputs.
NON_FEATURES = (
    "Customer_ID",
    "loan_id",
    "snapshot_date",
    "feat_snapshot",
    "label",
    "label_def",
    "orig_month",
    "Type_of_Loan",
    "model_name",
    "model_version",
    "score",
    "prediction",
    "scored_at",
)

PII = ("Name", "SSN")

CLICK_FEATURES = tuple(f"fe_{i}" for i in range(1, 21))
