"""Metrics on known values: literal rows, published confusion matrices, spark.ml."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from creditloom.operators import evaluation as ev

SCORED = "target int, score double"


@pytest.mark.parametrize("scores, labels, expected", [
    ((.1, .4, .35, .8), (0, 0, 1, 1), 0.75), ((.5,) * 4, (0, 0, 1, 1), 0.5), ((.1, .2), (1, 1), None)])
def test_auc(rows, scores, labels, expected):
    assert ev.auc(rows(list(zip(labels, scores)), SCORED)).first()["auc"] == expected


def test_auc_equals_spark_ml(tables):
    scored = tables.scored()
    reference = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="target", numBins=0)
    expected = reference.evaluate(scored)
    assert ev.auc(scored).first()["auc"] == pytest.approx(expected, abs=1e-12)


def test_auc_with_a_third_of_rows_on_one_score(spark):
    hot = spark.range(3_000).select((F.col("id") % 5 == 0).cast("int").alias("target"),
                                    F.when(F.col("id") % 3 == 0, 0.08).otherwise((F.col("id") % 997) / 997).alias("score"))
    reference = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="target", numBins=0)
    assert ev.auc(hot).first()["auc"] == pytest.approx(reference.evaluate(hot), abs=1e-12)


# Published counts (tn, fp, fn, tp) and rates (accuracy, recall, fpr, fnr).
PUBLISHED = [
    ((50985, 5553, 2864, 2101), (0.8631, 0.4232, 0.0982, 0.5768)),
    ((50681, 5857, 2811, 2154), (0.8591, 0.4338, 0.1036, 0.5662)),
    ((51762, 4776, 3034, 1931), (0.8730, 0.3889, 0.0845, 0.6111)),
]


@pytest.mark.parametrize("counts, expected", PUBLISHED)
def test_rates_of_published_matrices(rows, counts, expected):
    row = ev.rates(rows([counts], "tn bigint, fp bigint, fn bigint, tp bigint")).first()
    assert (row["accuracy"], row["recall"], row["fpr"], row["fnr"]) == expected


def test_sweep_counts_scores_on_a_threshold(rows):
    scored = rows([(1, i / 100) for i in range(1, 99)] + [(0, 0.0)], SCORED)
    for r in ev.threshold_sweep(scored).collect():
        assert r["recall"] == pytest.approx((99 - round(r["threshold"] * 100)) / 98)


def test_sweep_without_predicted_positives(rows):
    row = ev.threshold_sweep(rows([(1, 0.2), (0, 0.1)], SCORED)).where("threshold = 0.9D").first()
    assert (row["precision"], row["f1"], row["recall"]) == (0.0, 0.0, 0.0)


def test_lowest_threshold_wins_ties(rows):
    sweep = rows([(0.2, 0.5), (0.1, 0.5), (0.3, 0.4)], "threshold double, f1 double")
    assert ev.best_threshold(sweep).first()["threshold"] == 0.1


def test_confusion_counts_sum_to_the_rows(tables):
    row = ev.confusion_metrics(tables.scored(), 0.3).first()
    assert row["tn"] + row["fp"] + row["fn"] + row["tp"] == tables.scored().count()


def test_small_groups_are_left_out(rows):
    data = [("F", i % 2, i / 9) for i in range(9)] + [("M", i % 2, i / 10) for i in range(10)] + [("X", 1, .5)] * 20
    got = ev.auc_by_group(rows(data, "gender_clean string, target int, score double")).collect()
    assert {r["gender_clean"]: r["n_rows"] for r in got} == {"M": 10, "all": 19}


def test_roc_curve_without_straight_points(rows):
    scored = rows([(1, .9), (1, .8), (0, .7), (0, .6), (1, .5), (0, .4)], SCORED)
    full = ev.roc_curve(scored, drop_intermediate=False).orderBy("fpr", "tpr").collect()
    short = ev.roc_curve(scored).orderBy("fpr", "tpr").collect()
    assert len(full) == 7 and [r["threshold"] for r in short] == [float("inf"), .9, .8, .6, .5, .4]
    assert short[-1]["fpr"] == short[-1]["tpr"] == 1.0


def test_pr_curve_ends(rows):
    curve = ev.pr_curve(rows([(1, .9), (0, .8), (1, .1)], SCORED)).orderBy(F.asc_nulls_last("threshold")).collect()
    assert [(r["precision"], r["recall"]) for r in curve] == [(2 / 3, 1.0), (.5, .5), (1.0, .5), (1.0, 0.0)]


def test_gap_names_the_higher_group(rows):
    groups = rows([("F", .1, .2, .3), ("M", .4, .2, .1)],
                  "gender_clean string, selection_rate double, false_positive_rate double, false_negative_rate double")
    got = {r["metric"]: r["higher_group"] for r in ev.fairness_gap(groups).collect()}
    assert got == {"selection_rate": "M", "false_positive_rate": None, "false_negative_rate": "F"}


def test_rows_without_a_score_count_nowhere(rows):
    scored = rows([(1, .9), (1, .6), (0, .4), (0, .2), (0, None), (None, .5)], SCORED)
    complete = scored.na.drop()
    for metric in (ev.auc, ev.roc_curve, ev.pr_curve, ev.threshold_sweep, ev.prevalence,
                   lambda df: ev.confusion_metrics(df, 0.5), lambda df: ev.class_report(df, 0.5)):
        assert sorted(map(str, metric(scored).collect())) == sorted(map(str, metric(complete).collect()))
