"""Edge cases of the feature definitions, on literal rows."""

import pytest
from pyspark.sql import functions as F

from creditloom.functions.numeric import duck_round
from creditloom.operators import balances, bureau, installments, previous, staging
from creditloom.operators.application import application_features
from creditloom.plans.mart import MART_COLUMNS, credit_mart
from creditloom.sources.schemas import APPLICATION


def application(spark, *changes):
    """Raw application rows: all columns NULL but for the key and the given ones."""
    filled = [{f.name: None for f in APPLICATION.fields} | {"SK_ID_CURR": i} | change for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(r.values()) for r in filled], APPLICATION)


def staged(spark, *changes):
    return staging.stg_application(application(spark, *changes)).orderBy("loan_id").collect()


def features(spark, *changes):
    return application_features(staging.stg_application(application(spark, *changes))).orderBy("loan_id").collect()


@pytest.mark.parametrize("value, digits, expected", [
    (0.285, 2, 0.28), (1.005, 2, 1.0), (1.00005, 4, 1.0001), (-1.00005, 4, -1.0001)])
def test_duck_round(spark, value, digits, expected):
    assert spark.range(1).select(F.expr(duck_round(f"{value!r}D", digits))).first()[0] == expected


def test_sentinels_become_null(spark):
    row = staged(spark, {"CODE_GENDER": "XNA", "DAYS_EMPLOYED": 365243})[0]
    assert row["gender"] == "XNA" and row["gender_clean"] is None and row["days_employed"] is None
    assert features(spark, {"DAYS_EMPLOYED": 365243})[0]["is_employed"] == 0


def test_age_is_rounded_and_flags_default_to_zero(spark):
    row = staged(spark, {"DAYS_BIRTH": -9700})[0]
    assert row["age_years"] == 27 and row["owns_car"] == 0 and row["owns_realty"] == 0
    assert len(row.asDict()) == 43


@pytest.mark.parametrize("scores, mean", [((None, .6, None), .6), ((.3, .6, .9), .6), ((.3, None, .9), None)])
def test_score_mean(spark, scores, mean):
    change = {f"EXT_SOURCE_{i + 1}": s for i, s in enumerate(scores)}
    assert features(spark, change)[0]["ext_source_mean"] == mean


def test_ratio_without_denominator_is_null(spark):
    row = features(spark, {"AMT_CREDIT": 0.0, "AMT_INCOME_TOTAL": 100.0})[0]
    assert row["ratio_income_credit"] is None and row["income_per_child"] is None


def test_age_groups(spark):
    days = [None if a is None else round(-a * 365.25) for a in (29, 30, 50, 51, None)]
    assert [r["age_group"] for r in features(spark, *[{"DAYS_BIRTH": d} for d in days])] == [
        "young", "adult", "adult", "senior", "senior"]


def test_recent_enquiries_count_missing_as_zero(spark):
    assert features(spark, {"AMT_REQ_CREDIT_BUREAU_WEEK": 2.0})[0]["req_bureau_recent"] == 2.0


BUREAU = ("loan_id bigint, bureau_id bigint, credit_active string, credit_type string, days_credit bigint, "
          "credit_day_overdue bigint, credit_sum double, credit_sum_debt double, credit_sum_overdue double, "
          "credit_max_overdue double")


def test_bureau_ratios_default_to_zero(spark, rows):
    df = rows([(1, 1, "Active", None, -5, 0, 10.0, None, 1.0, None), (2, 2, "Sold", "a", -5, 0, 0.0, 3.0, 1.0, None)], BUREAU)
    first, second = bureau.bureau_features(df).orderBy("loan_id").collect()
    assert (first["debt_credit_ratio"], first["overdue_debt_ratio"], first["loan_types_bureau"]) == (0.0, 0.0, 0)
    assert second["debt_credit_ratio"] == 0.0 and second["loan_types_bureau"] == 1


def test_bureau_balance_levels(spark, rows):
    balance = rows([(1, -i, s) for i, s in enumerate("015CX")], "bureau_id bigint, months_balance int, status string")
    credits = rows([(7, 1), (8, 2)], "loan_id bigint, bureau_id bigint")
    (row,) = bureau.bureau_balance_features(balance, credits).collect()
    assert row.asDict() == {"loan_id": 7, "bb_total_months": 5, "bb_bad_months": 2, "bb_severe_months": 1,
                            "bb_had_severe_overdue": 1, "bb_bad_months_ratio": 0.4}


PAYMENT = ("loan_id bigint, days_instalment double, days_entry_payment double, instalment_amount double, "
           "payment_amount double")


def test_unpaid_installment_counts_but_is_not_late(spark, rows):
    row = installments.installments_features(rows([(1, -10.0, None, 5.0, None)], PAYMENT)).first()
    assert (row["inst_total_count"], row["inst_late_count"], row["inst_late_avg"], row["instpay_payment_sum"]) == (1, 0, None, 0.0)


def test_windows_without_rows_are_null(spark, rows):
    row = installments.installments_windowed(rows([(1, -200.0, -200.0, 5.0, 5.0)], PAYMENT)).first().asDict()
    empty = [c for c in row if c.endswith("_3m") or c.endswith("_6m")]
    assert len(empty) == 8 and all(row[c] is None for c in empty)
    assert row["inst_late_ratio_12m"] == 0.0 and row["inst_payment_ratio_12m"] == 1.0
    assert row["inst_late_trend_3m_vs_all"] is None


def test_one_pass_windows_equal_the_joined_form(tables):
    stg = tables.stg("installments")
    one, joined = installments.installments_windowed(stg), installments.installments_windowed_joined(stg)
    assert one.columns == joined.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, joined.collect()))


def test_one_pass_previous_equals_the_full_outer_form(tables):
    stg = tables.stg("previous")
    one = previous.previous_windowed(stg)
    joined = previous.full_outer_combine(stg).select(*one.columns)
    assert sorted(map(str, one.collect())) == sorted(map(str, joined.collect()))


PREVIOUS = ("loan_id bigint, prev_application_id bigint, days_decision bigint, contract_status string, "
            "credit_amount double, application_amount double, annuity_amount double, payment_count double")


def test_latest_previous_application(spark, rows):
    df = rows([(1, 5, -3, "Approved", 1.0, 1.0, 1.0, 1.0), (1, 9, -3, "Refused", 2.0, 0.0, 2.0, 2.0),
               (1, 11, None, "Approved", 4.0, 1.0, 1.0, 1.0), (2, 6, -1, "Canceled", 3.0, 3.0, 3.0, 3.0)], PREVIOUS)
    for form in (previous.previous_windowed, previous.full_outer_combine):
        first, second = form(df).orderBy("loan_id").collect()
        assert first["prev_last_credit"] == 2.0 and first["prev_last_was_refused"] == 1
        assert first["prev_approved_credit_max"] == 4.0 and first["prev_refused_most_recent"] == -3
        assert second["prev_approved_credit_avg"] is None and second["prev_last_credit"] == 3.0
        assert second["prev_last_was_refused"] == 0


def test_card_utilization_skips_rows_without_limit(spark, rows):
    df = rows([(1, 0, 10.0, 0, 1.0, 1.0, 1.0), (1, 0, 10.0, 20, 1.0, 0.0, 1.0)],
              "loan_id bigint, days_past_due bigint, balance double, credit_limit bigint, drawings_atm double, "
              "drawings_total double, payment_current double")
    row = balances.card_features(df).first()
    assert row["cc_utilization_avg"] == 0.5 and row["cc_atm_ratio"] == 1.0


def test_mart_is_one_row_per_application(tables):
    mart = tables.mart()
    assert mart.columns == MART_COLUMNS and len(MART_COLUMNS) == 82
    n, keys = mart.agg(F.count("*"), F.count_distinct("loan_id")).first()
    assert n == keys == tables.raw("application_train").count()


def test_application_without_history_keeps_null_but_for_three_columns(tables):
    mart = credit_mart(lambda name: tables.raw(name).where("SK_ID_CURR <> 9") if name == "bureau" else tables.raw(name))
    row = mart.where("loan_id = 9").first()
    assert (row["debt_credit_ratio"], row["overdue_debt_ratio"], row["loan_types_bureau"]) == (0.0, 0.0, 0)
    assert row["bureau_debt_total"] is None and row["bb_bad_months"] is None


def test_hot_loan_key(spark):
    """A third of all rows on one loan gives the sums of a plain count."""
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("loan_id"), (F.col("id") % 40).alias("days_past_due"),
        F.lit("Active").alias("contract_status"))
    row = balances.pos_features(hot).where("loan_id = 1").first()
    expected = [i % 40 for i in range(30_000) if i % 3 == 0 or i == 1]
    assert (row["pos_total_months"], row["pos_dpd_max"]) == (len(expected), max(expected))
    assert row["pos_dpd_avg"] == sum(expected) / len(expected)
