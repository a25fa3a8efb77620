import json

from pyspark.sql import functions as F

from creditloom.operators import encoders, scoring
from creditloom.operators.application import application_features
from creditloom.streaming.scoring_stream import start_scoring


def fixed_model(df):
    return df.withColumn("score", F.coalesce("ext_source_2", F.lit(0.5)))


def requests(spark, *fields):
    return spark.createDataFrame([tuple(dict(f).get(n) for n in scoring.REQUEST_SCHEMA.fieldNames()) for f in fields],
                                 scoring.REQUEST_SCHEMA)


COMPLETE = {"income_amount": 100.0, "credit_amount": 400.0, "annuity_amount": 20.0, "age_years": 29.0}


def test_eighty_fields():
    assert len(scoring.DEFAULTS) == 80 and set(scoring.REQUIRED) <= set(scoring.DEFAULTS)


def test_defaults_and_errors(spark):
    good, bad = scoring.score_defaults(requests(spark, COMPLETE, {"income_amount": 1.0, "age_years": 60.0})).collect()
    assert good["error"] is None and good["age_group"] == "young" and good["inst_payment_ratio"] == 1.0
    assert bad["error"] == "missing: credit_amount, annuity_amount" and bad["age_group"] == "senior"


def test_backfill_keeps_given_values(spark):
    given = COMPLETE | {"ratio_income_credit": 9.0, "cnt_children": 3.0, "ext_source_1": .3, "ext_source_2": .6}
    row = scoring.score_backfill(scoring.score_defaults(requests(spark, given))).first()
    assert row["ratio_income_credit"] == 9.0 and row["income_per_child"] == 25.0 and row["ext_source_1_x_2"] == 0.18
    assert row["ext_source_mean"] == 0.45 and row["credit_to_annuity_ratio"] == 20.0


def test_serving_uses_the_training_definitions(tables):
    trained = application_features(tables.stg("application")).where(
        "annuity_amount IS NOT NULL AND cnt_fam_members IS NOT NULL")
    served = scoring.score_backfill(scoring.score_defaults(tables.requests()))
    names = scoring.BACKFILLED
    one = trained.select(F.col("loan_id").alias("id"), *names)
    other = served.select(F.col("request_id").alias("id"), *names).join(one.select("id"), "id", "left_semi")
    assert sorted(map(str, one.collect())) == sorted(map(str, other.select("id", *names).collect()))


def test_decisions(rows):
    scored = rows([(.09,), (.5,), (.0899,), (None,)], "score double")
    got = [(r["decision"], r["risk_level"]) for r in scoring.score_decision(scored, .09).collect()]
    assert got == [(1, "medium"), (1, "high"), (0, "low"), (None, None)]


def test_stream_scores_each_request_once(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    (tmp_path / "in").mkdir()

    def drop(name, *requests):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(r) for r in requests))
        start_scoring(spark, inbox, out, checkpoint, fixed_model, 0.3, once=True).awaitTermination(120)

    drop("a.json", COMPLETE | {"request_id": 1, "ext_source_2": 0.7}, {"request_id": 2, "age_years": 40.0})
    drop("b.json", COMPLETE | {"request_id": 3, "ext_source_2": 0.1})
    got = {r["request_id"]: (r["decision"], r["risk_level"], r["error"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: (1, "high", None), 3: (0, "low", None),
                   2: (None, None, "missing: income_amount, credit_amount, annuity_amount")}


def test_bad_requests_do_not_stop_good_ones(spark):
    """The model's encoder fails the job on an age group it does not know; such requests never reach it."""
    def model(df):
        return fixed_model(encoders.ordinal_encode(df))

    asked = requests(spark, COMPLETE, COMPLETE | {"age_group": "old"}, {k: v for k, v in COMPLETE.items() if k != "age_years"})
    good, odd, missing = scoring.score_requests(asked, model, 0.3).collect()
    assert good["error"] is None and good["decision"] == 1
    assert odd["error"] == "unknown age_group: old" and missing["error"] == "missing: age_years"
    assert odd["default_probability"] is None and missing["decision"] is None


def test_features_follow_from_given_fields(spark):
    given = COMPLETE | {"income_type": "Pensioner", "days_employed": -3652.5, "ext_source_1": 0.2, "obs_30_social_circle": 4.0,
                        "def_30_social_circle": 1.0, "req_bureau_week": 2.0}
    row, bare, told = scoring.score_defaults(requests(spark, given, COMPLETE, given | {"is_employed": 0})).collect()
    assert (row["is_working"], row["is_pensioner"], row["is_employed"], row["years_employed"]) == (0, 1, 1, 10.0)
    assert (row["ext_source_1_available"], row["def_30_social_ratio"], row["req_bureau_recent"]) == (1, 0.25, 2.0)
    assert (bare["is_working"], bare["is_employed"], bare["def_30_social_ratio"], bare["req_bureau_recent"]) == (0, 0, 0.0, 0.0)
    assert told["is_employed"] == 0
