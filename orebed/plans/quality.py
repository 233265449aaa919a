"""The quality report over the bank tables: every planted kind of defect."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.functions.scalars import DPD_EDGES
from orebed.operators import rules as R
from orebed.operators.rules import Known, TableChecks, Unique

# Code domains and limits of the bank tables.
SEGMENTS = ["Retail", "PYME", "Corporativo", "Premium"]
BRANCH_TYPES = ["Sucursal", "Agencia", "Corresponsal", "Digital"]
REGIONS = ["GY", "PI", "AZ", "MN", "OR", "ES", "LO", "SD"]
SCORE_RANGE = (300, 850)
MAX_BALANCE_RATIO = 1.2
GROWTH_SENTINEL = 999.99
APPROVED = "Aprobada"

CUSTOMERS, BRANCHES, TRANSACTIONS, LOANS, KPIS = "customers", "branches", "transactions", "loans", "kpis"


def _customers(df: DataFrame, as_of) -> TableChecks:
    return TableChecks(
        CUSTOMERS,
        df,
        {
            "missing_region": R.missing_when(df, "country_code"),
            "future_acquisition": R.future_when("acquisition_date", as_of),
            "segment_case": R.wrong_case_when("segment", SEGMENTS),
            "score_range": R.outside_when("credit_score", *SCORE_RANGE),
        },
        key_rules={"duplicate_id": Unique(["customer_id"])},
    )


def _branches(df: DataFrame) -> TableChecks:
    return TableChecks(
        BRANCHES,
        df,
        {
            "missing_region": R.missing_when(df, "country_code"),
            "type_case": R.wrong_case_when("branch_type", BRANCH_TYPES),
        },
        key_rules={"duplicate_id": Unique(["branch_id"])},
    )


def _transactions(df: DataFrame) -> TableChecks:
    return TableChecks(
        TRANSACTIONS,
        df,
        {
            "zero_approved": R.zero_while_when("amount", F.col("status") == APPROVED),
            "missing_date": R.missing_when(df, "transaction_date"),
            "negative_amount": R.negative_when("amount"),
        },
        key_rules={
            "orphan_customer": Known(["customer_id"], CUSTOMERS),
            "orphan_branch": Known(["branch_id"], BRANCHES),
        },
    )


def _loans(df: DataFrame) -> TableChecks:
    return TableChecks(
        LOANS,
        df,
        {
            "negative_days": R.negative_when("days_past_due"),
            "ends_before_start": R.ends_before_when("disbursement_date", "maturity_date"),
            "balance_above_original": R.above_ratio_when("outstanding_balance", "original_amount", MAX_BALANCE_RATIO),
            "missing_rate": R.missing_when(df, "interest_rate"),
            "bucket_mismatch": R.bucket_differs_when("days_past_due", "dpd_bucket", DPD_EDGES),
        },
    )


def _kpis(df: DataFrame) -> TableChecks:
    return TableChecks(
        KPIS,
        df,
        {
            "ratio_above_one": F.col("npl_ratio") > 1,
            "zero_with_disbursements": R.zero_while_when("total_portfolio", F.col("new_disbursements") > 0),
            "growth_sentinel": R.sentinel_when("yoy_portfolio_growth", [GROWTH_SENTINEL]),
            "unknown_region": R.outside_domain_when("country_code", REGIONS),
        },
    )


def bank_report(tables: Mapping[str, DataFrame], as_of, total: str | None = "all") -> DataFrame:
    """Violations per table and rule, with a grand total."""
    return R.dq_report(
        [
            _customers(tables[CUSTOMERS], as_of),
            _branches(tables[BRANCHES]),
            _transactions(tables[TRANSACTIONS]),
            _loans(tables[LOANS]),
            _kpis(tables[KPIS]),
        ],
        total,
    )
