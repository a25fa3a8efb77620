"""The evaluation chain: threshold, metrics, classes, fairness, importance, all from one table of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lookup import fitted
from ..operators import evaluation as ev
from ..session import written

EVERYONE = "*"


def _facts(df: DataFrame, section: str, cols: list[str], subject: str | None = None) -> DataFrame:
    """Columns of ``df`` as rows ``section, subject, measure, value``."""
    values = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in cols)
    who = subject or "CAST(NULL AS STRING)"
    return df.selectExpr(f"'{section}' AS section", f"{who} AS subject", f"stack({len(cols)}, {values}) AS (measure, value)")


def evaluation_report(scored: DataFrame, importance: DataFrame | None = None, tune: str = "val", report: str = "test",
                      group: str = "gender_clean") -> DataFrame:
    """Tune the threshold by F1 on one split of a scored table and report on another.

    The scores are scanned once: positives and negatives per split, group and score
    are written, and the sweep, the confusion of all rows and of every group, the
    class report and all AUCs follow from them. What they give is a few rows per
    group, from which rates and gaps are made without another job. ``importance`` is
    an optional ranking with ``feature`` first and its measure second.
    """
    cube = written(ev.score_counts(scored.where(F.col("split").isin(tune, report)), ["split", group]), "cube")
    best = ev.best_threshold(ev.sweep_of_counts(cube.where(F.col("split") == tune))).first()
    counts = cube.where(F.col("split") == report)
    confusion, _ = fitted(ev.confusion_of_counts(counts, best["threshold"], group))
    aucs, _ = fitted(ev.aucs_of_counts(counts, group, everyone=EVERYONE))
    overall = confusion.where("everyone")
    audited = ev.group_rates(confusion.where(~F.col("everyone") & F.col(group).isin(*ev.GROUPS)), group)
    group_aucs = aucs.where((F.col(group) != EVERYONE) & (F.col("n_rows") >= ev.MIN_GROUP_ROWS))
    chosen = scored.sparkSession.createDataFrame([(best["threshold"], best["f1"])], "threshold double, f1 double")
    parts = [
        _facts(chosen, "threshold", ["threshold", "f1"]),
        _facts(aucs.where(F.col(group) == EVERYONE), "metrics", ["auc"]),
        _facts(ev.rates(overall.select("tn", "fp", "fn", "tp")), "metrics",
               ["tn", "fp", "fn", "tp", "accuracy", "error_rate", "recall", "fpr", "fnr"]),
        _facts(ev.class_rows(overall), "classes", ["precision", "recall", "f1", "support"], "label"),
        _facts(audited, "fairness", list(ev.RATES), group),
        _facts(group_aucs, "fairness", ["auc"], group),
        _facts(ev.fairness_gap(audited, group_aucs, group), "fairness_gap", ["gap"], "metric"),
    ]
    if importance is not None:
        feature, measure = importance.columns[:2]
        parts.append(_facts(importance, "importance", [measure], feature))
    return reduce(DataFrame.unionByName, parts)
