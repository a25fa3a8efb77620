"""Credit-bureau history, one row per loan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import aggregate, flag, ratio

# Months overdue that count as bad and as severe.
BAD_STATUS = "'1', '2', '3', '4', '5'"
SEVERE_STATUS = "'4', '5'"
WORST_STATUS = "'5'"


def distinct_credit_types(stg_bureau: DataFrame) -> DataFrame:
    """Exact number of credit types per loan.

    Kept out of the sum aggregate: two plain aggregates dedupe map-side first,
    so a loan with very many rows never lands whole in one task.
    """
    pairs = stg_bureau.where(F.col("credit_type").isNotNull()).select("loan_id", "credit_type").distinct()
    return pairs.groupBy("loan_id").agg(F.count("*").alias("loan_types_bureau"))


def bureau_features(stg_bureau: DataFrame) -> DataFrame:
    """One scan: first by loan and credit type, where a hot loan is combined map-side, then by loan."""
    by_type = aggregate(stg_bureau, ["loan_id", "credit_type"], {
        "n": "count(*)",
        "active": "count_if(credit_active = 'Active')",
        "closed": "count_if(credit_active = 'Closed')",
        "debt": "sum(credit_sum_debt)",
        "credit": "sum(credit_sum)",
        "n_credit": "count(credit_sum)",
        "overdue": "sum(credit_sum_overdue)",
        "max_overdue": "max(credit_max_overdue)",
        "max_day_overdue": "max(credit_day_overdue)",
        "oldest": "min(days_credit)",
        "newest": "max(days_credit)",
    })
    return aggregate(by_type, ["loan_id"], {
        "bureau_credit_count": "sum(n)",
        "bureau_active_count": "sum(active)",
        "bureau_closed_count": "sum(closed)",
        "bureau_debt_total": "sum(debt)",
        "bureau_credit_avg": ratio("sum(credit)", "sum(n_credit)"),
        "bureau_credit_sum_total": "coalesce(sum(credit), 0e0)",
        "bureau_overdue_max": "max(max_overdue)",
        "bureau_day_overdue_max": "max(max_day_overdue)",
        "bureau_oldest_credit": "min(oldest)",
        "bureau_most_recent_credit": "max(newest)",
        "debt_credit_ratio": f"coalesce({ratio('sum(debt)', 'sum(credit)')}, 0e0)",
        "overdue_debt_ratio": f"coalesce({ratio('sum(overdue)', 'sum(debt)')}, 0e0)",
        "loan_types_bureau": "count(credit_type)",
    })


def balance_by_credit(stg_balance: DataFrame) -> DataFrame:
    """First level: months of one bureau credit."""
    return aggregate(stg_balance, ["bureau_id"], {
        "total_months": "count(*)",
        "bad_months": f"count_if(status IN ({BAD_STATUS}))",
        "severe_months": f"count_if(status IN ({SEVERE_STATUS}))",
        "had_severe_overdue": f"max({flag(f'status = {WORST_STATUS}')})",
    })


def bureau_balance_features(stg_balance: DataFrame, stg_bureau: DataFrame) -> DataFrame:
    """Second level: credits of one loan; aggregated before the join, so it joins unique keys."""
    credits = stg_bureau.select("loan_id", "bureau_id").join(balance_by_credit(stg_balance), "bureau_id")
    return aggregate(credits, ["loan_id"], {
        "bb_total_months": "sum(total_months)",
        "bb_bad_months": "sum(bad_months)",
        "bb_severe_months": "sum(severe_months)",
        "bb_had_severe_overdue": "max(had_severe_overdue)",
        "bb_bad_months_ratio": ratio("sum(bad_months)", "sum(total_months)", 4),
    })


def any_severe(stg_balance: DataFrame, stg_bureau: DataFrame) -> DataFrame:
    """Whether a loan ever had the worst status."""
    return bureau_balance_features(stg_balance, stg_bureau).select("loan_id", "bb_had_severe_overdue")
