"""Model evaluation on scored rows: ``loan_id``, ``target`` (0/1), ``gender_clean``, ``score``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import duck_round, named
from ..functions.order import default_cells, quantile_edges, running_totals, with_cells

# Thresholds of the sweep, in hundredths, and the groups of the fairness audit.
FIRST_THRESHOLD, LAST_THRESHOLD = 1, 98
GROUPS = ("F", "M")
MIN_GROUP_ROWS = 10


def _or_zero(num: str, den: str) -> str:
    """``num / den``, 0 where it is undefined."""
    return f"coalesce({num} / nullif({den}, 0), 0e0)"


def judged(scored: DataFrame) -> DataFrame:
    """The rows that every metric is about: those with a score and a target. The others are left out everywhere."""
    return scored.where("score IS NOT NULL AND target IS NOT NULL")


# ---------------------------------------------------------------- ranking curves

def score_counts(scored: DataFrame, by: list[str]) -> DataFrame:
    """Positives and negatives per distinct score; combined map-side before the shuffle.

    Every metric follows from these counts; written once, they stand for the scores.
    """
    return judged(scored).groupBy(*by, "score").agg(
        F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg"))


def _cumulative(scored: DataFrame, by: list[str] = (), neighbours: bool = False) -> DataFrame:
    edges = quantile_edges(judged(scored), "score", default_cells(scored))
    return running_totals(score_counts(scored, list(by)), "score", ["pos", "neg"], by=list(by), edges=edges,
                          last=["pos", "neg"] if neighbours else [])


def auc(scored: DataFrame, by: list[str] = (), min_rows: int = 0) -> DataFrame:
    """Tie-aware ROC-AUC, per group if ``by`` is given; NULL when a class is missing.

    Pairs are won inside score cells first, then between cells, over one row per
    cell. They are counted in decimals: exact up to the last division.
    """
    return auc_of_counts(score_counts(scored, list(by)), list(by), min_rows)


def auc_of_counts(counts: DataFrame, by: list[str], min_rows: int) -> DataFrame:
    counts = with_cells(counts, "score", quantile_edges(counts, "score", default_cells(counts)))
    inside = W.partitionBy(*by, "cell").orderBy("score").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*by).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    won = "sum(CAST({pos} AS DECIMAL(18, 0)) * CAST({beaten} AS DECIMAL(19, 0)))"
    cells = counts.withColumn("neg_through", F.sum("neg").over(inside)).groupBy(*by, "cell").agg(*named({
        "won_inside": won.format(pos="pos", beaten="2 * neg_through - neg"),
        "pos_cell": "sum(pos)", "neg_cell": "sum(neg)"}))
    totals = cells.withColumn("neg_before", F.coalesce(F.sum("neg_cell").over(before), F.lit(0))).groupBy(*by).agg(*named({
        "won": f"CAST(sum(won_inside) + {won.format(pos='pos_cell', beaten='2 * neg_before')} AS DOUBLE) / 2",
        "pairs": "CAST(sum(pos_cell) AS DOUBLE) * sum(neg_cell)",
        "n_rows": "coalesce(sum(pos_cell + neg_cell), 0)",
    }))
    return totals.where(F.col("n_rows") >= min_rows).select(
        *by, "n_rows", F.expr("won / nullif(pairs, 0e0)").alias("auc"))


def auc_by_group(scored: DataFrame, group: str = "gender_clean", groups: tuple[str, ...] = GROUPS,
                 min_rows: int = MIN_GROUP_ROWS) -> DataFrame:
    """AUC of every audited group with enough rows, and of the audited rows together (``all``)."""
    counts = score_counts(scored.where(F.col(group).isin(*groups)), [group])
    return auc_of_counts(_also(counts, group, F.array(F.col(group), F.lit("all"))), [group], min_rows)


def _also(counts: DataFrame, group: str, groups: Column) -> DataFrame:
    """Counts per score of all ``groups`` that a row is in."""
    return counts.select("score", "pos", "neg", F.explode(groups).alias(group)).groupBy(group, "score").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def aucs_of_counts(counts: DataFrame, group: str = "gender_clean", groups: tuple[str, ...] = GROUPS,
                   everyone: str = "*") -> DataFrame:
    """AUC of all rows (``everyone``), of the audited groups, and of the audited rows together (``all``)."""
    audited = F.col(group).isin(*groups)
    both = F.when(audited, F.array(F.col(group), F.lit("all"), F.lit(everyone))).otherwise(F.array(F.lit(everyone)))
    return auc_of_counts(_also(counts, group, both), [group], 0)


def roc_curve(scored: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """False and true positive rate at every distinct score, from the origin on.

    With ``drop_intermediate`` points on a straight line between their
    neighbours are left out, the first and last are kept.
    """
    counted = _cumulative(scored, neighbours=True)
    if drop_intermediate:
        highest = "pos_through + neg_through = pos_total + neg_total"
        bend = "NOT (pos <=> prev_pos AND neg <=> prev_neg)"
        counted = counted.where(f"{highest} OR {bend}")
    points = counted.select(*named({
        "threshold": "score",
        "fpr": "(neg_total - neg_through + neg) / nullif(neg_total, 0)",
        "tpr": "(pos_total - pos_through + pos) / nullif(pos_total, 0)",
    }))
    origin = scored.sparkSession.range(1).select(*named(
        {"threshold": "double('Infinity')", "fpr": "0e0", "tpr": "0e0"}))
    return points.unionByName(origin)


def pr_curve(scored: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score, the end point (1, 0), and the positive rate."""
    points = _cumulative(scored).select(*named({
        "threshold": "score",
        "precision": "(pos_total - pos_through + pos) "
                     "/ (pos_total - pos_through + pos + neg_total - neg_through + neg)",
        "recall": "(pos_total - pos_through + pos) / nullif(pos_total, 0)",
    }))
    end = scored.sparkSession.range(1).select(*named(
        {"threshold": "CAST(NULL AS DOUBLE)", "precision": "1e0", "recall": "0e0"}))
    return points.unionByName(end)


def prevalence(scored: DataFrame) -> DataFrame:
    return judged(scored).agg(F.avg("target").alias("prevalence"))


# ---------------------------------------------------------------- thresholds

def _thresholds_met(score: Column) -> Column:
    """Number of thresholds i/100 that are <= score, exact also on the thresholds themselves."""
    guess = F.floor(score * 100)
    exact = guess + (score >= (guess + 1) / 100).cast("int") - (score < guess / 100).cast("int")
    return F.greatest(F.lit(0), F.least(F.lit(LAST_THRESHOLD), exact)).cast("int")


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """F1, precision, recall and Youden's J at every hundredth from 0.01 to 0.98.

    One pass counts rows per interval between thresholds; the sums over the
    intervals above a threshold then run over at most 99 rows.
    """
    return _swept(judged(scored).groupBy(_thresholds_met(F.col("score")).alias("step")).agg(
        F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg")))


def sweep_of_counts(counts: DataFrame) -> DataFrame:
    """:func:`threshold_sweep` from counts per score."""
    return _swept(counts.groupBy(_thresholds_met(F.col("score")).alias("step")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def _swept(met: DataFrame) -> DataFrame:
    steps = met.sparkSession.range(LAST_THRESHOLD + 1).select(F.col("id").cast("int").alias("step"))
    filled = steps.join(met, "step", "left").na.fill(0, ["pos", "neg"])
    above = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy()
    counts = filled.select(
        "step", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(everything).alias("p"), F.sum("neg").over(everything).alias("n"))
    return counts.where(F.col("step") >= FIRST_THRESHOLD).select(*named({
        "threshold": "step / 100",
        "f1": _or_zero("2 * tp", "(tp + fp + p)"),
        "precision": _or_zero("tp", "(tp + fp)"),
        "recall": _or_zero("tp", "p"),
        "youden_j": f"{_or_zero('tp', 'p')} + {_or_zero('(n - fp)', 'n')} - 1",
    }))


def best_threshold(sweep: DataFrame, by: str = "f1") -> DataFrame:
    """The row with the highest value of ``by``; the lowest threshold wins ties."""
    return sweep.orderBy(F.desc(by), "threshold").limit(1)


def best_thresholds(sweep: DataFrame) -> DataFrame:
    """Best by F1, best by Youden's J, and the default of one half."""
    parts = [best_threshold(sweep, "f1").withColumn("choice", F.lit("best_f1")),
             best_threshold(sweep, "youden_j").withColumn("choice", F.lit("best_youden")),
             sweep.where("threshold = 0.5D").withColumn("choice", F.lit("default"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _confusion(threshold: float) -> dict[str, str]:
    return {
        "tn": f"count_if(target = 0 AND score < {threshold!r}D)",
        "fp": f"count_if(target = 0 AND score >= {threshold!r}D)",
        "fn": f"count_if(target = 1 AND score < {threshold!r}D)",
        "tp": f"count_if(target = 1 AND score >= {threshold!r}D)",
    }


def confusion_of_counts(counts: DataFrame, threshold: float, group: str = "gender_clean") -> DataFrame:
    """``tn, fp, fn, tp`` of every group, and of all rows (``everyone``), from counts per group and score."""
    t = f"{threshold!r}D"
    return counts.groupingSets([[group], []], group).agg(F.grouping(group).cast("boolean").alias("everyone"), *named({
        "tn": f"coalesce(sum(if(score < {t}, neg, 0)), 0)", "fp": f"coalesce(sum(if(score >= {t}, neg, 0)), 0)",
        "fn": f"coalesce(sum(if(score < {t}, pos, 0)), 0)", "tp": f"coalesce(sum(if(score >= {t}, pos, 0)), 0)"}))


def rates(counts: DataFrame) -> DataFrame:
    """Rates of confusion counts ``tn, fp, fn, tp``, rounded to four digits."""
    return counts.select(*counts.columns, *named({name: duck_round(text, 4) for name, text in {
        "accuracy": "(tp + tn) / nullif(tn + fp + fn + tp, 0)",
        "error_rate": "1 - (tp + tn) / nullif(tn + fp + fn + tp, 0)",
        "recall": "tp / nullif(tp + fn, 0)",
        "fpr": "fp / nullif(fp + tn, 0)",
        "fnr": "fn / nullif(fn + tp, 0)",
    }.items()}))


def confusion_metrics(scored: DataFrame, threshold: float) -> DataFrame:
    return rates(judged(scored).agg(*named(_confusion(threshold))))


def class_report(scored: DataFrame, threshold: float) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted average."""
    return class_rows(judged(scored).agg(*named(_confusion(threshold))))


def class_rows(c: DataFrame) -> DataFrame:
    """:func:`class_report` from one row of ``tn, fp, fn, tp``."""
    per_class = c.select(*named({
        "zero": "struct(tn AS hit, tn + fn AS predicted, tn + fp AS support)",
        "one": "struct(tp AS hit, tp + fp AS predicted, tp + fn AS support)",
    })).select(*named({"classes": "array(struct('0' AS label, zero AS c), struct('1' AS label, one AS c))"}))
    rows = per_class.selectExpr("inline(classes)").select("label", *named({
        "precision": _or_zero("c.hit", "c.predicted"),
        "recall": _or_zero("c.hit", "c.support"),
        "f1": _or_zero("2 * c.hit", "(c.predicted + c.support)"),
        "support": "c.support",
        "hit": "c.hit",
    }))
    measures = ("precision", "recall", "f1")
    macro = rows.agg(F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in measures],
                     F.sum("support").alias("support"))
    weighted = rows.agg(F.lit("weighted avg").alias("label"), *named(
        {m: _or_zero(f"sum({m} * support)", "sum(support)") for m in measures} | {"support": "sum(support)"}))
    overall = rows.agg(F.lit("accuracy").alias("label"), *named(
        {m: _or_zero("sum(hit)", "sum(support)") for m in measures} | {"support": "sum(support)"}))
    parts = [rows.drop("hit"), overall, macro, weighted]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ---------------------------------------------------------------- fairness

def fairness_by_group(scored: DataFrame, threshold: float, group: str = "gender_clean",
                      groups: tuple[str, ...] = GROUPS) -> DataFrame:
    """Selection rate, false positive and false negative rate of the audited groups; undefined rates are 0."""
    return group_rates(judged(scored).where(F.col(group).isin(*groups)).groupBy(group).agg(*named(_confusion(threshold))), group)


def group_rates(counts: DataFrame, group: str = "gender_clean") -> DataFrame:
    """:func:`fairness_by_group` from ``tn, fp, fn, tp`` per group."""
    return counts.select(group, *named({
        "n_rows": "tn + fp + fn + tp",
        "selection_rate": _or_zero("(fp + tp)", "(tn + fp + fn + tp)"),
        "false_positive_rate": _or_zero("fp", "(fp + tn)"),
        "false_negative_rate": _or_zero("fn", "(fn + tp)"),
    }))


RATES = ("selection_rate", "false_positive_rate", "false_negative_rate")


def fairness_gap(by_group: DataFrame, aucs: DataFrame | None = None, group: str = "gender_clean",
                 groups: tuple[str, str] = GROUPS) -> DataFrame:
    """Largest difference between groups per metric, and the group with the higher value.

    The higher group is NULL on equality. With ``aucs`` the AUC gap is included.
    """
    rows = by_group.selectExpr(group, f"stack({len(RATES)}, {', '.join(f"'{r}', {r}" for r in RATES)}) AS (metric, value)")
    if aucs is not None:
        rows = rows.unionByName(aucs.where(F.col(group).isin(*groups)).select(
            group, F.lit("auc").alias("metric"), F.col("auc").alias("value")))
    spread = rows.groupBy("metric").agg(*named({
        "gap": "max(value) - min(value)", "highest": f"max_by({group}, value)"}))
    return spread.select("metric", "gap", F.expr("CASE WHEN gap > 0 THEN highest END").alias("higher_group"))
