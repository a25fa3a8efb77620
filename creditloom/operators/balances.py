"""Monthly point-of-sale and credit-card balances, one row per loan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.numeric import aggregate, duck_round, ratio, share

LATE = "days_past_due > 0"


def pos_features(stg_pos: DataFrame) -> DataFrame:
    return aggregate(stg_pos, ["loan_id"], {
        "pos_total_months": "count(*)",
        "pos_late_months": f"count_if({LATE})",
        "pos_late_ratio": share(LATE, 4),
        "pos_dpd_max": "max(days_past_due)",
        "pos_dpd_avg": "avg(days_past_due)",
        "pos_active_count": "count_if(contract_status = 'Active')",
    })


def _mean_ratio(num: str, den: str) -> str:
    """Mean of per-row ratios; rows with a zero or missing denominator are skipped."""
    return duck_round(f"avg({ratio(num, den)})", 4)


def card_features(stg_card: DataFrame) -> DataFrame:
    return aggregate(stg_card, ["loan_id"], {
        "cc_total_months": "count(*)",
        "cc_late_months": f"count_if({LATE})",
        "cc_late_ratio": share(LATE, 4),
        "cc_dpd_max": "max(days_past_due)",
        "cc_utilization_avg": _mean_ratio("balance", "credit_limit"),
        "cc_atm_ratio": _mean_ratio("drawings_atm", "drawings_total"),
        "cc_payment_ratio": _mean_ratio("payment_current", "balance"),
    })
