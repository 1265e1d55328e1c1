"""Names that tie the operators to one table.

Operators take column names; a ``TableSpec`` only bundles them, so the same jobs run on
any labelled table. ``LOANS`` is the preset for a consumer loan table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """Column roles of a table with one row per business key and a 0/1 label."""

    key: str
    entity: str
    label: str
    numeric: Sequence[str]
    categorical: Sequence[str]
    leakage: Sequence[str] = ()
    core: Sequence[str] = ()
    summary: Sequence[str] = ()
    recommended: Sequence[str] = ()
    recommended_categorical: Sequence[str] = ()
    ordered_rate_columns: Sequence[str] = ()
    rate_columns: Sequence[str] = ()
    histogram_columns: Sequence[str] = ()
    matrix_columns: Sequence[str] = ()
    lenient_casts: Mapping[str, str] = field(default_factory=dict)
    unit_columns: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    percent_columns: Sequence[str] = ()
    free_text: Sequence[str] = ()
    ordinals: Mapping[str, tuple[str, Mapping[str, float], float]] = field(default_factory=dict)
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    interactions: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    ratio_caps: Mapping[str, float] = field(default_factory=dict)
    label_names: Mapping[int, str] = field(default_factory=dict)
    notes: Mapping[str, str] = field(default_factory=dict)

    @property
    def engineered(self) -> list[str]:
        """Names of the derived numeric features."""
        return [*self.ordinals, *self.ratios, *self.interactions]

    @property
    def model_numeric(self) -> list[str]:
        """Every numeric model input, given and derived."""
        return [*self.numeric, *self.engineered]

    @property
    def features(self) -> list[str]:
        """Every model input."""
        return [*self.model_numeric, *self.categorical]

    @property
    def raw_columns(self) -> list[str]:
        """Input columns that feature preparation needs."""
        return [*self.numeric, *self.categorical, self.label]

    @property
    def non_predictors(self) -> list[str]:
        """Columns that may never be used to predict the label."""
        return [self.label, self.key, self.entity, *self.leakage]


# The column roles, grade order, caps and class names of the loan table.
LOANS = TableSpec(
    key="id",
    entity="member_id",
    label="default_ind",
    numeric=(
        "int_rate", "term", "dti", "annual_inc", "delinq_2yrs", "inq_last_6mths",
        "revol_util", "loan_amnt", "open_acc", "pub_rec", "revol_bal", "installment",
        "total_acc", "collections_12_mths_ex_med", "acc_now_delinq", "tot_coll_amt",
        "tot_cur_bal", "total_rev_hi_lim",
    ),
    categorical=(
        "grade", "sub_grade", "home_ownership", "purpose", "verification_status",
        "emp_length", "application_type", "addr_state",
    ),
    leakage=(
        "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
        "total_rec_late_fee", "recoveries", "collection_recovery_fee", "last_pymnt_amnt",
        "out_prncp", "out_prncp_inv", "last_pymnt_d", "next_pymnt_d", "last_credit_pull_d",
    ),
    core=(
        "loan_amnt", "int_rate", "term", "dti", "annual_inc", "delinq_2yrs",
        "inq_last_6mths", "revol_util", "grade", "sub_grade",
    ),
    summary=(
        "loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc", "dti",
        "delinq_2yrs", "inq_last_6mths", "revol_bal", "revol_util", "open_acc", "total_acc",
        "default_ind",
    ),
    recommended=(
        "int_rate", "term", "dti", "annual_inc", "delinq_2yrs", "inq_last_6mths", "revol_util",
    ),
    recommended_categorical=("grade",),
    ordered_rate_columns=("grade", "term"),
    rate_columns=(
        "home_ownership", "purpose", "verification_status", "emp_length", "sub_grade",
    ),
    histogram_columns=("loan_amnt", "int_rate", "dti", "annual_inc", "revol_util"),
    matrix_columns=(
        "loan_amnt", "int_rate", "dti", "annual_inc", "revol_util", "delinq_2yrs",
        "inq_last_6mths", "default_ind",
    ),
    lenient_casts={
        "int_rate": "double", "installment": "double", "annual_inc": "double",
        "dti": "double", "loan_amnt": "double", "funded_amnt": "double",
        "delinq_2yrs": "double", "inq_last_6mths": "double", "open_acc": "double",
        "pub_rec": "double", "revol_bal": "double", "total_acc": "double",
        "default_ind": "int",
    },
    unit_columns={"term": ("months", "int")},
    percent_columns=("revol_util",),
    free_text=("desc",),
    ordinals={
        "grade_ord": (
            "grade",
            {"A": 1.0, "B": 2.0, "C": 3.0, "D": 4.0, "E": 5.0, "F": 6.0, "G": 7.0},
            4.0,
        ),
    },
    ratios={
        "loan_to_income": ("loan_amnt", "annual_inc"),
        "payment_to_income": ("installment", "annual_inc"),
        "revol_bal_ratio": ("revol_bal", "total_rev_hi_lim"),
        "loan_to_rev_limit": ("loan_amnt", "total_rev_hi_lim"),
    },
    interactions={
        "int_rate_x_term": ("int_rate", "term"),
        "dti_x_revol_util": ("dti", "revol_util"),
        "int_rate_x_grade_ord": ("int_rate", "grade_ord"),
        "dti_x_loan_amnt": ("dti", "loan_amnt"),
    },
    ratio_caps={"loan_to_income": 5.0, "payment_to_income": 0.5, "revol_bal_ratio": 1.5},
    label_names={0: "No default", 1: "Default"},
)

# Fixed value: the seed of every sample, split and fit.
SEED = 192
