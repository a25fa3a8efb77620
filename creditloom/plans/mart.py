"""The credit feature mart: one row per application."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import staging
from ..operators.application import application_features
from ..operators.balances import card_features, pos_features
from ..operators.bureau import bureau_balance_features, bureau_features
from ..operators.installments import installments_features
from ..operators.previous import previous_features
from ..session import scratch_path
from ..sources.writers import write_bucketed

# Mart columns in output order.
MART_COLUMNS = (
    "loan_id target income_amount credit_amount annuity_amount ratio_income_credit ratio_annuity_income "
    "days_employed years_employed is_employed age_years gender_clean age_group owns_car owns_realty "
    "ext_source_1 ext_source_2 ext_source_3 ext_source_mean ext_source_1_available income_type occupation_type "
    "education_type family_status region_rating days_id_publish days_registration reg_city_not_work_city "
    "flag_document_3 is_pensioner is_working is_unemployed bureau_credit_count bureau_active_count "
    "bureau_debt_total bureau_overdue_max bb_bad_months bb_bad_months_ratio bb_had_severe_overdue "
    "inst_late_avg inst_late_ratio inst_payment_ratio inst_late_max prev_application_count prev_refused_count "
    "prev_refused_ratio prev_credit_ratio cc_utilization_avg cc_atm_ratio cc_late_ratio pos_dpd_max "
    "pos_late_ratio cnt_children cnt_fam_members own_car_age organization_type days_last_phone_change "
    "obs_30_social_circle def_30_social_circle obs_60_social_circle def_60_social_circle req_bureau_hour "
    "req_bureau_day req_bureau_week req_bureau_mon req_bureau_qrt req_bureau_year credit_to_annuity_ratio "
    "credit_to_goods_ratio income_per_family_member income_per_child employed_to_birth_ratio "
    "phone_to_birth_ratio ext_source_1_x_2 ext_source_2_x_3 ext_source_1_x_2_x_3 def_30_social_ratio "
    "def_60_social_ratio req_bureau_recent debt_credit_ratio overdue_debt_ratio loan_types_bureau"
).split()

# History columns that default to zero when an application has no bureau record.
ZERO_WITHOUT_BUREAU = ("debt_credit_ratio", "overdue_debt_ratio", "loan_types_bureau")

Reader = Callable[[str], DataFrame]


# Staged table -> raw table and staging operator.
STAGED = {
    "application": ("application_train", staging.stg_application),
    "bureau": ("bureau", staging.stg_bureau),
    "bureau_balance": ("bureau_balance", staging.stg_bureau_balance),
    "previous": ("previous_application", staging.stg_previous),
    "installments": ("installments_payments", staging.stg_installments),
    "pos": ("POS_CASH_balance", staging.stg_pos),
    "credit_card": ("credit_card_balance", staging.stg_credit_card),
}


def staged(read: Reader, name: str) -> DataFrame:
    """One staged table, from a function that reads a raw table by name."""
    raw, clean = STAGED[name]
    return clean(read(raw))


def mart_from_features(app: DataFrame, histories: list[DataFrame]) -> DataFrame:
    """Left-join the history features; each side has unique keys already hashed by ``loan_id``."""
    joined = reduce(lambda left, right: left.join(right, "loan_id", "left"), histories, app)
    defaulted = {c: F.coalesce(c, F.lit(0)) for c in ZERO_WITHOUT_BUREAU}
    return joined.withColumns(defaulted).select(*MART_COLUMNS)


def credit_mart(read: Reader) -> DataFrame:
    """The 82-column mart, unordered; see :func:`ordered_mart` for a sorted file."""
    return mart_of_staged(lambda name: staged(read, name))


def mart_of_staged(stg: Reader) -> DataFrame:
    """The mart from a function that gives staged tables by name."""
    bureau = stg("bureau")
    return mart_from_features(application_features(stg("application")), [
        bureau_features(bureau),
        bureau_balance_features(stg("bureau_balance"), bureau),
        previous_features(stg("previous")),
        installments_features(stg("installments")),
        pos_features(stg("pos")),
        card_features(stg("credit_card")),
    ])


def bucketed_staging(spark: SparkSession, read: Reader, buckets: int | None = None) -> dict[str, DataFrame]:
    """All staged tables, written bucketed and sorted by ``loan_id`` (the balance history by ``bureau_id``).

    What groups or joins them by loan afterwards reads them without an exchange, as
    often as they are used. ``buckets`` defaults to the shuffle partitions; with fewer,
    Spark prefers to shuffle all sides anew.
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = uuid.uuid4().hex
    return {name: write_bucketed(staged(read, name), f"stg_{name}_{run}", scratch_path(spark, name),
                                 "bureau_id" if name == "bureau_balance" else "loan_id", n) for name in STAGED}


def ordered_mart(mart: DataFrame) -> DataFrame:
    """Global order by ``loan_id``; only the file layout needs it, splits hash the key instead."""
    return mart.orderBy("loan_id")
