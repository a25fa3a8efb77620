"""Scoring requests: defaults, missing derived features, decision.

All steps are row-wise, so they run on batch and streaming input alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import duck_round
from .application import age_group, financial_ratios, personal_features, score_features
from .encoders import AGE_GROUPS

REQUIRED = ("income_amount", "credit_amount", "annuity_amount", "age_years")

# Request fields in order, with the default used when a field is omitted (None: stays NULL).
_NUMBERS: dict[str, float | int | None] = {
    "days_employed": None, "years_employed": None, "is_employed": 0, "is_working": 0, "is_pensioner": 0,
    "is_unemployed": 0, "owns_car": 0, "owns_realty": 0, "own_car_age": None, "cnt_children": 0.0,
    "cnt_fam_members": 1.0, "region_rating": 2.0, "reg_city_not_work_city": 0, "flag_document_3": 0,
    "days_id_publish": 0.0, "days_registration": 0.0, "days_last_phone_change": None,
    "phone_to_birth_ratio": None, "ext_source_1": None, "ext_source_2": None, "ext_source_3": None,
    "ext_source_mean": None, "ext_source_1_available": 0, "ratio_income_credit": None,
    "ratio_annuity_income": None, "credit_to_annuity_ratio": None, "credit_to_goods_ratio": None,
    "income_per_family_member": None, "income_per_child": None, "employed_to_birth_ratio": None,
    "obs_30_social_circle": 0.0, "def_30_social_circle": 0.0, "obs_60_social_circle": 0.0,
    "def_60_social_circle": 0.0, "def_30_social_ratio": 0.0, "def_60_social_ratio": 0.0,
    "req_bureau_hour": 0.0, "req_bureau_day": 0.0, "req_bureau_week": 0.0, "req_bureau_mon": 0.0,
    "req_bureau_qrt": 0.0, "req_bureau_year": 0.0, "req_bureau_recent": 0.0,
    "bureau_credit_count": 0.0, "bureau_active_count": 0.0, "bureau_debt_total": 0.0, "bureau_overdue_max": 0.0,
    "debt_credit_ratio": 0.0, "overdue_debt_ratio": 0.0, "loan_types_bureau": 0.0,
    "bb_bad_months": 0.0, "bb_bad_months_ratio": 0.0, "bb_had_severe_overdue": 0.0,
    "inst_late_avg": 0.0, "inst_late_ratio": 0.0, "inst_payment_ratio": 1.0, "inst_late_max": 0.0,
    "prev_application_count": 0.0, "prev_refused_count": 0.0, "prev_refused_ratio": 0.0, "prev_credit_ratio": 1.0,
    "cc_utilization_avg": 0.0, "cc_atm_ratio": 0.0, "cc_late_ratio": 0.0,
    "pos_dpd_max": 0.0, "pos_late_ratio": 0.0,
    "ext_source_1_x_2": None, "ext_source_2_x_3": None, "ext_source_1_x_2_x_3": None,
}
_TEXTS: dict[str, str | None] = {
    "gender_clean": None, "income_type": "Working", "occupation_type": None,
    "education_type": "Secondary / secondary special", "family_status": "Married",
    "organization_type": "Business Entity Type 3", "age_group": None,
}
DEFAULTS: dict[str, float | int | str | None] = dict.fromkeys(REQUIRED) | _NUMBERS | _TEXTS

# Features that score_backfill computes when a request leaves them out.
BACKFILLED = (
    "ratio_income_credit ratio_annuity_income credit_to_annuity_ratio income_per_family_member income_per_child "
    "ext_source_mean ext_source_1_x_2 ext_source_2_x_3 ext_source_1_x_2_x_3"
).split()


# Features that follow from fields of a request, once those are given, and the fields they need: all, or for sums any.
FOLLOWING = {
    "is_working": ("income_type",), "is_pensioner": ("income_type",), "is_unemployed": ("income_type",),
    "is_employed": ("days_employed",), "years_employed": ("days_employed",), "ext_source_1_available": ("ext_source_1",),
    "def_30_social_ratio": ("def_30_social_circle", "obs_30_social_circle"),
    "def_60_social_ratio": ("def_60_social_circle", "obs_60_social_circle"),
    "req_bureau_recent": ("req_bureau_day", "req_bureau_week", "req_bureau_mon"),
}


def _field_type(name: str) -> T.DataType:
    default = DEFAULTS[name]
    if name in _TEXTS:
        return T.StringType()
    return T.IntegerType() if isinstance(default, int) else T.DoubleType()


REQUEST_SCHEMA = T.StructType([T.StructField("request_id", T.LongType())]
                              + [T.StructField(n, _field_type(n)) for n in DEFAULTS])


def as_requests(df: DataFrame, request_id: str) -> DataFrame:
    """Bring any table to the request schema; fields it lacks count as omitted."""
    present = set(df.columns)
    cols = [(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in REQUEST_SCHEMA.fields[1:]]
    return df.select(F.col(request_id).cast("bigint").alias("request_id"), *cols)


def score_defaults(requests: DataFrame) -> DataFrame:
    """Fill omitted fields; ``error`` names the missing required ones, NULL on valid requests.

    Omitted features follow from the given fields they depend on, with the
    definitions of the mart; so does the age group from the age.
    """
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    filled: dict[str, Column] = {
        c: F.coalesce(c, F.lit(d)) for c, d in DEFAULTS.items() if d is not None}
    definitions = personal_features() | score_features()
    for name, inputs in FOLLOWING.items():
        given = (" OR " if name == "req_bureau_recent" else " AND ").join(f"{i} IS NOT NULL" for i in inputs)
        follows = F.expr(f"CASE WHEN {given} THEN {definitions[name]} END").cast(_field_type(name))
        filled[name] = F.coalesce(name, follows, F.lit(DEFAULTS[name]).cast(_field_type(name)))
    filled["age_group"] = F.coalesce("age_group", F.when(F.col("age_years").isNotNull(), F.expr(age_group())))
    filled["error"] = F.when(missing != "", F.concat(F.lit("missing: "), missing))
    return requests.withColumns(filled)


def score_backfill(requests: DataFrame) -> DataFrame:
    """Compute derived features that were omitted, with the definitions of the mart."""
    definitions = financial_ratios() | score_features()
    return requests.withColumns({c: F.coalesce(F.col(c), F.expr(definitions[c])) for c in BACKFILLED})


def quick_ratios(df: DataFrame) -> DataFrame:
    """Income/credit, credit/annuity and credit/goods for display: 0 without a denominator, not rounded."""
    pairs = {"ratio_income_credit": ("income_amount", "credit_amount"),
             "credit_to_annuity_ratio": ("credit_amount", "annuity_amount"),
             "credit_to_goods_ratio": ("credit_amount", "goods_price")}
    return df.withColumns({n: F.coalesce(F.try_divide(a, b), F.lit(0.0)) for n, (a, b) in pairs.items()})


def score_decision(scored: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Rounded probability, decision and risk level."""
    p = F.col(score)
    risk = F.when(p >= 0.5, "high").when(p >= threshold, "medium").when(p.isNotNull(), "low")
    return scored.withColumns({
        "default_probability": F.expr(duck_round(score, 4)),
        "threshold": F.lit(float(threshold)),
        "decision": (p >= threshold).cast("int"),
        "risk_level": risk,
    })


def score_requests(requests: DataFrame, model: Callable[[DataFrame], DataFrame], threshold: float) -> DataFrame:
    """Answer requests: ``model`` adds ``score`` to rows with defaults and derived features filled.

    Requests with a missing required field or an unknown age group get an
    ``error`` and no score; valid ones in the same batch are answered.
    """
    prepared = score_backfill(score_defaults(requests))
    group = F.col("age_group")
    odd = F.when(group.isNull(), "missing: age_group").when(~group.isin(*AGE_GROUPS), F.concat(F.lit("unknown age_group: "), group))
    prepared = prepared.withColumn("error", F.coalesce("error", odd))
    # The model sees a neutral group on rows that are answered with an error.
    prepared = prepared.withColumn("age_group", F.when(F.col("error").isNull(), group).otherwise(F.lit(AGE_GROUPS[1])))
    scored = model(prepared).withColumn("score", F.when(F.col("error").isNull(), F.col("score")))
    return score_decision(scored, threshold).select(
        "request_id", "default_probability", "threshold", "decision", "risk_level", "error")
