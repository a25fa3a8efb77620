"""Previous applications, one row per loan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import aggregate, duck_round, flag, named, ratio, share

# Columns of the latest previous application and their output names.
LATEST = {
    "credit_amount": "prev_last_credit",
    "application_amount": "prev_last_application",
    "annuity_amount": "prev_last_annuity",
    "days_decision": "prev_last_days_decision",
    "payment_count": "prev_last_payment_count",
}


GRANTED_SHARE = ratio("credit_amount", "application_amount")
LAST_REFUSED = "prev_last_was_refused"


def previous_features(stg_prev: DataFrame) -> DataFrame:
    return aggregate(stg_prev, ["loan_id"], {
        "prev_application_count": "count(*)",
        "prev_approved_count": "count_if(contract_status = 'Approved')",
        "prev_refused_count": "count_if(contract_status = 'Refused')",
        "prev_canceled_count": "count_if(contract_status = 'Canceled')",
        "prev_refused_ratio": share("contract_status = 'Refused'", 4),
        "prev_credit_avg": "avg(credit_amount)",
        "prev_application_avg": "avg(application_amount)",
        "prev_app_credit_sum": "coalesce(sum(credit_amount), 0e0)",
        "prev_credit_ratio": duck_round(f"avg({GRANTED_SHARE})", 4),
        "prev_oldest_decision": "min(days_decision)",
        "prev_most_recent_decision": "max(days_decision)",
    })


def _approved_aggregates(rows: str) -> dict[str, str]:
    return {
        "prev_approved_credit_avg": f"avg(credit_amount) {rows}",
        "prev_approved_credit_max": f"max(credit_amount) {rows}",
        "prev_approved_annuity_avg": f"avg(annuity_amount) {rows}",
        "prev_approved_credit_ratio": f"avg({GRANTED_SHARE}) {rows}",
    }


def _refused_aggregates(rows: str) -> dict[str, str]:
    return {
        "prev_refused_credit_avg": f"avg(credit_amount) {rows}",
        "prev_refused_credit_max": f"max(credit_amount) {rows}",
        "prev_refused_most_recent": f"max(days_decision) {rows}",
    }


def previous_windowed(stg_prev: DataFrame, tie_break: str = "prev_application_id") -> DataFrame:
    """Approved-only, refused-only and latest-row features in one aggregate.

    ``max_by`` on (day, id) picks the latest row with partial aggregation, so
    neither a join nor a per-loan sort in one task is needed.
    """
    by_status = (_approved_aggregates("FILTER (WHERE contract_status = 'Approved')")
                 | _refused_aggregates("FILTER (WHERE contract_status = 'Refused')"))
    latest = f"max_by(struct({', '.join(LATEST)}, contract_status), struct(days_decision, {tie_break}))"
    grouped = aggregate(stg_prev, ["loan_id"], by_status | {"latest": latest})
    return grouped.select("loan_id", *by_status, *named(
        {name: f"latest.{column}" for column, name in LATEST.items()}
        | {LAST_REFUSED: flag("latest.contract_status = 'Refused'")}))


def latest_previous(stg_prev: DataFrame, tie_break: str = "prev_application_id") -> DataFrame:
    """The latest previous application of each loan, as a ranked window.

    Spark limits each map task to its own first row per loan before the shuffle.
    """
    order = W.partitionBy("loan_id").orderBy(F.desc_nulls_last("days_decision"), F.desc(tie_break))
    ranked = stg_prev.withColumn("rank_in_loan", F.row_number().over(order))
    return ranked.where("rank_in_loan = 1").drop("rank_in_loan")


def full_outer_combine(stg_prev: DataFrame, tie_break: str = "prev_application_id") -> DataFrame:
    """The same features as :func:`previous_windowed`, combined by full outer joins on a coalesced key."""
    approved = aggregate(stg_prev.where("contract_status = 'Approved'"), ["loan_id"], _approved_aggregates(""))
    refused = aggregate(stg_prev.where("contract_status = 'Refused'"), ["loan_id"], _refused_aggregates(""))
    latest = latest_previous(stg_prev, tie_break).select("loan_id", *named(
        {name: column for column, name in LATEST.items()} | {LAST_REFUSED: flag("contract_status = 'Refused'")}))
    combined = approved.join(refused, "loan_id", "full").join(latest, "loan_id", "full")
    return combined.withColumn(LAST_REFUSED, F.coalesce(LAST_REFUSED, F.lit(0)))
