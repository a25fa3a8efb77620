"""Staging: rename raw columns, remove sentinels, cast."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.numeric import flag

# Sentinels of the raw data.
UNKNOWN_GENDER = "XNA"
UNKNOWN_DAYS = 365243
DAYS_PER_YEAR = 365.25

# Raw name -> staged name, plain renames only.
APPLICATION_NAMES = {
    "SK_ID_CURR": "loan_id",
    "TARGET": "target",
    "NAME_CONTRACT_TYPE": "contract_type",
    "AMT_CREDIT": "credit_amount",
    "AMT_ANNUITY": "annuity_amount",
    "AMT_INCOME_TOTAL": "income_amount",
    "AMT_GOODS_PRICE": "goods_price",
    "CODE_GENDER": "gender",
    "DAYS_BIRTH": "days_birth",
    "NAME_INCOME_TYPE": "income_type",
    "OCCUPATION_TYPE": "occupation_type",
    "NAME_EDUCATION_TYPE": "education_type",
    "NAME_FAMILY_STATUS": "family_status",
    "EXT_SOURCE_1": "ext_source_1",
    "EXT_SOURCE_2": "ext_source_2",
    "EXT_SOURCE_3": "ext_source_3",
    "REGION_RATING_CLIENT_W_CITY": "region_rating",
    "DAYS_ID_PUBLISH": "days_id_publish",
    "DAYS_REGISTRATION": "days_registration",
    "REG_CITY_NOT_WORK_CITY": "reg_city_not_work_city",
    "FLAG_DOCUMENT_3": "flag_document_3",
    "FLAG_MOBIL": "has_mobile",
    "FLAG_EMAIL": "has_email",
    "CNT_CHILDREN": "cnt_children",
    "CNT_FAM_MEMBERS": "cnt_fam_members",
    "OWN_CAR_AGE": "own_car_age",
    "ORGANIZATION_TYPE": "organization_type",
    "DAYS_LAST_PHONE_CHANGE": "days_last_phone_change",
    "OBS_30_CNT_SOCIAL_CIRCLE": "obs_30_social_circle",
    "DEF_30_CNT_SOCIAL_CIRCLE": "def_30_social_circle",
    "OBS_60_CNT_SOCIAL_CIRCLE": "obs_60_social_circle",
    "DEF_60_CNT_SOCIAL_CIRCLE": "def_60_social_circle",
    "AMT_REQ_CREDIT_BUREAU_HOUR": "req_bureau_hour",
    "AMT_REQ_CREDIT_BUREAU_DAY": "req_bureau_day",
    "AMT_REQ_CREDIT_BUREAU_WEEK": "req_bureau_week",
    "AMT_REQ_CREDIT_BUREAU_MON": "req_bureau_mon",
    "AMT_REQ_CREDIT_BUREAU_QRT": "req_bureau_qrt",
    "AMT_REQ_CREDIT_BUREAU_YEAR": "req_bureau_year",
}

BUREAU_NAMES = {
    "SK_ID_CURR": "loan_id",
    "SK_ID_BUREAU": "bureau_id",
    "CREDIT_ACTIVE": "credit_active",
    "CREDIT_TYPE": "credit_type",
    "CREDIT_CURRENCY": "credit_currency",
    "DAYS_CREDIT": "days_credit",
    "DAYS_CREDIT_ENDDATE": "days_credit_enddate",
    "DAYS_ENDDATE_FACT": "days_enddate_fact",
    "DAYS_CREDIT_UPDATE": "days_credit_update",
    "CREDIT_DAY_OVERDUE": "credit_day_overdue",
    "AMT_CREDIT_SUM": "credit_sum",
    "AMT_CREDIT_SUM_DEBT": "credit_sum_debt",
    "AMT_CREDIT_SUM_LIMIT": "credit_sum_limit",
    "AMT_CREDIT_SUM_OVERDUE": "credit_sum_overdue",
    "AMT_CREDIT_MAX_OVERDUE": "credit_max_overdue",
    "AMT_ANNUITY": "annuity_amount",
    "CNT_CREDIT_PROLONG": "credit_prolong_count",
}

BUREAU_BALANCE_NAMES = {
    "SK_ID_BUREAU": "bureau_id",
    "MONTHS_BALANCE": "months_balance",
    "STATUS": "status",
}

PREVIOUS_NAMES = {
    "SK_ID_PREV": "prev_application_id",
    "SK_ID_CURR": "loan_id",
    "NAME_CONTRACT_TYPE": "contract_type",
    "AMT_ANNUITY": "annuity_amount",
    "AMT_APPLICATION": "application_amount",
    "AMT_CREDIT": "credit_amount",
    "AMT_DOWN_PAYMENT": "down_payment",
    "AMT_GOODS_PRICE": "goods_price",
    "DAYS_DECISION": "days_decision",
    "NAME_CASH_LOAN_PURPOSE": "loan_purpose",
    "NAME_CONTRACT_STATUS": "contract_status",
    "NAME_PAYMENT_TYPE": "payment_type",
    "NAME_CLIENT_TYPE": "client_type",
    "NAME_GOODS_CATEGORY": "goods_category",
    "NAME_PORTFOLIO": "portfolio",
    "NAME_PRODUCT_TYPE": "product_type",
    "CHANNEL_TYPE": "channel_type",
    "NAME_SELLER_INDUSTRY": "seller_industry",
    "NAME_YIELD_GROUP": "yield_group",
    "PRODUCT_COMBINATION": "product_combination",
    "FLAG_LAST_APPL_PER_CONTRACT": "is_last_application",
    "NFLAG_LAST_APPL_IN_DAY": "is_last_appl_in_day",
    "CNT_PAYMENT": "payment_count",
}

# Day offsets of previous applications that carry the sentinel.
PREVIOUS_DAY_NAMES = {
    "DAYS_FIRST_DRAWING": "days_first_drawing",
    "DAYS_FIRST_DUE": "days_first_due",
    "DAYS_LAST_DUE_1ST_VERSION": "days_last_due_first",
    "DAYS_LAST_DUE": "days_last_due",
    "DAYS_TERMINATION": "days_termination",
}

INSTALLMENT_NAMES = {
    "SK_ID_PREV": "prev_application_id",
    "SK_ID_CURR": "loan_id",
    "NUM_INSTALMENT_VERSION": "installment_version",
    "NUM_INSTALMENT_NUMBER": "installment_number",
    "DAYS_INSTALMENT": "days_instalment",
    "DAYS_ENTRY_PAYMENT": "days_entry_payment",
    "AMT_INSTALMENT": "instalment_amount",
    "AMT_PAYMENT": "payment_amount",
}

POS_NAMES = {
    "SK_ID_PREV": "prev_application_id",
    "SK_ID_CURR": "loan_id",
    "MONTHS_BALANCE": "months_balance",
    "CNT_INSTALMENT": "installment_count",
    "CNT_INSTALMENT_FUTURE": "installment_future_count",
    "NAME_CONTRACT_STATUS": "contract_status",
    "SK_DPD": "days_past_due",
    "SK_DPD_DEF": "days_past_due_def",
}

CARD_NAMES = {
    "SK_ID_PREV": "prev_application_id",
    "SK_ID_CURR": "loan_id",
    "MONTHS_BALANCE": "months_balance",
    "AMT_BALANCE": "balance",
    "AMT_CREDIT_LIMIT_ACTUAL": "credit_limit",
    "AMT_DRAWINGS_ATM_CURRENT": "drawings_atm",
    "AMT_DRAWINGS_CURRENT": "drawings_total",
    "AMT_DRAWINGS_OTHER_CURRENT": "drawings_other",
    "AMT_DRAWINGS_POS_CURRENT": "drawings_pos",
    "AMT_INST_MIN_REGULARITY": "min_installment",
    "AMT_PAYMENT_CURRENT": "payment_current",
    "AMT_PAYMENT_TOTAL_CURRENT": "payment_total",
    "AMT_RECEIVABLE_PRINCIPAL": "receivable_principal",
    "AMT_RECIVABLE": "receivable_total",
    "AMT_TOTAL_RECEIVABLE": "total_receivable",
    "CNT_DRAWINGS_ATM_CURRENT": "cnt_drawings_atm",
    "CNT_DRAWINGS_CURRENT": "cnt_drawings_total",
    "CNT_DRAWINGS_OTHER_CURRENT": "cnt_drawings_other",
    "CNT_DRAWINGS_POS_CURRENT": "cnt_drawings_pos",
    "CNT_INSTALMENT_MATURE_CUM": "installment_mature_count",
    "NAME_CONTRACT_STATUS": "contract_status",
    "SK_DPD": "days_past_due",
    "SK_DPD_DEF": "days_past_due_def",
}


def _renamed(names: dict[str, str]) -> list[str]:
    return [f"{raw} AS {staged}" for raw, staged in names.items()]


def stg_application(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        *_renamed(APPLICATION_NAMES),
        f"nullif(CODE_GENDER, '{UNKNOWN_GENDER}') AS gender_clean",
        f"CAST(round(DAYS_BIRTH / -{DAYS_PER_YEAR}D) AS INT) AS age_years",
        f"nullif(DAYS_EMPLOYED, {UNKNOWN_DAYS}) AS days_employed",
        f"{flag("FLAG_OWN_CAR = 'Y'")} AS owns_car",
        f"{flag("FLAG_OWN_REALTY = 'Y'")} AS owns_realty",
    )


def stg_bureau(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_renamed(BUREAU_NAMES))


def stg_bureau_balance(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_renamed(BUREAU_BALANCE_NAMES))


def stg_previous(raw: DataFrame) -> DataFrame:
    days = [f"nullif({raw_name}, {UNKNOWN_DAYS}) AS {name}" for raw_name, name in PREVIOUS_DAY_NAMES.items()]
    return raw.selectExpr(*_renamed(PREVIOUS_NAMES), *days)


def stg_installments(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_renamed(INSTALLMENT_NAMES))


def stg_pos(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_renamed(POS_NAMES))


def stg_credit_card(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_renamed(CARD_NAMES))
