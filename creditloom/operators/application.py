"""Row-level features of the application table.

The derived expressions are shared by the mart and by request scoring, so that
training and serving use one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.numeric import duck_round, flag, named, ratio, zero_if_null
from .staging import DAYS_PER_YEAR

# Staged columns carried through unchanged.
CARRIED = (
    "loan_id target income_amount credit_amount annuity_amount goods_price age_years days_birth days_employed "
    "gender_clean contract_type owns_car owns_realty has_mobile has_email income_type occupation_type "
    "education_type family_status region_rating days_id_publish days_registration reg_city_not_work_city "
    "flag_document_3 ext_source_1 ext_source_2 ext_source_3 cnt_children cnt_fam_members own_car_age "
    "organization_type days_last_phone_change obs_30_social_circle def_30_social_circle obs_60_social_circle "
    "def_60_social_circle req_bureau_hour req_bureau_day req_bureau_week req_bureau_mon req_bureau_qrt "
    "req_bureau_year"
).split()

# Age limits of the three age groups.
YOUNG_BELOW = 30
ADULT_UP_TO = 50


def age_group(age: str = "age_years") -> str:
    """young / adult / senior; an unknown age counts as senior."""
    return (f"CASE WHEN {age} < {YOUNG_BELOW} THEN 'young' "
            f"WHEN {age} <= {ADULT_UP_TO} THEN 'adult' ELSE 'senior' END")


def financial_ratios() -> dict[str, str]:
    return {
        "ratio_income_credit": ratio("income_amount", "credit_amount", 4),
        "ratio_annuity_income": ratio("annuity_amount", "income_amount", 4),
        "credit_to_annuity_ratio": ratio("credit_amount", "annuity_amount", 4),
        "credit_to_goods_ratio": ratio("credit_amount", "goods_price", 4),
        "income_per_family_member": ratio("income_amount", "cnt_fam_members", 4),
        "income_per_child": ratio("income_amount", "(1 + cnt_children)", 4),
    }


def score_features() -> dict[str, str]:
    """Mean and products of the external scores.

    A missing first or third score is left out of the mean and counts as zero in
    the products; without the second one all of them are NULL.
    """
    first, second, third = zero_if_null("ext_source_1"), "ext_source_2", zero_if_null("ext_source_3")
    available = "1 + int(ext_source_1 IS NOT NULL) + int(ext_source_3 IS NOT NULL)"
    return {
        "ext_source_mean": duck_round(f"({first} + {second} + {third}) / ({available})", 4),
        "ext_source_1_available": flag("ext_source_1 IS NOT NULL"),
        "ext_source_1_x_2": duck_round(f"{first} * {second}", 4),
        "ext_source_2_x_3": duck_round(f"{second} * {third}", 4),
        "ext_source_1_x_2_x_3": duck_round(f"{first} * {second} * {third}", 4),
    }


def personal_features() -> dict[str, str]:
    """Employment, age, income-type, social-circle and enquiry features."""
    return {
        "is_employed": flag("days_employed IS NOT NULL"),
        "years_employed": duck_round(f"days_employed / -{DAYS_PER_YEAR}D", 1),
        "age_group": age_group(),
        "is_pensioner": flag("income_type = 'Pensioner'"),
        "is_working": flag("income_type = 'Working'"),
        "is_unemployed": flag("income_type = 'Unemployed'"),
        "employed_to_birth_ratio": ratio("days_employed", "days_birth", 4),
        "phone_to_birth_ratio": ratio("days_last_phone_change", "days_birth", 4),
        "def_30_social_ratio": ratio("def_30_social_circle", "obs_30_social_circle", 4),
        "def_60_social_ratio": ratio("def_60_social_circle", "obs_60_social_circle", 4),
        "req_bureau_recent": " + ".join(zero_if_null(f"req_bureau_{span}") for span in ("day", "week", "mon")),
    }


def application_features(stg_app: DataFrame) -> DataFrame:
    derived = financial_ratios() | score_features() | personal_features()
    return stg_app.select(*CARRIED, *named(derived))
