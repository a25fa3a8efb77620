"""Stacking: two learners, out-of-fold predictions, a logistic model on top."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting, learners
from .boosting import Model, Settings
from .evaluation import auc
from .learners import KEY, LABEL, TreeScorer, load_scorer
from .splits import fold_roles, stratified_folds

BASE = ("p1", "p2")
Pair = tuple[TreeScorer, TreeScorer]


@dataclass(frozen=True)
class BaseModels:
    """The two learners, fitted without each fold, and on all rows."""

    folds: list[Pair]
    full: Pair


def fit_bases(train: DataFrame, k: int = 5, boosted: Settings = learners.STACKED_BOOSTED,
              categorical: Settings = learners.STACKED_CATEGORICAL) -> BaseModels:
    """All ``2 * (k + 1)`` models at once, on one coded table: they differ by the role of a row and their settings.

    Each stops on a tenth of its own rows; encoded categories follow each model's own rows as well.
    """
    roles = fold_roles(stratified_folds(train, k), k)
    quantizer = learners.tree_quantizer(train, max(boosted.bins, categorical.bins))
    blocks = boosting.coded_blocks(roles, quantizer, LABEL, KEY, [f"role{i}" for i in range(k + 1)])
    features, encode = learners.encoded_features(quantizer)
    models = [Model(i, boosted, features, encode) for i in range(k + 1)]
    models += [Model(i, categorical, learners.category_features(quantizer)) for i in range(k + 1)]
    boosting.grow(blocks, quantizer, models)
    scorers = [TreeScorer(quantizer, m.best()) for m in models]
    pairs = list(zip(scorers[:k + 1], scorers[k + 1:]))
    return BaseModels(pairs[:k], pairs[k])


def _both(df: DataFrame, pair: Pair) -> DataFrame:
    """``df`` with the probabilities of both learners."""
    one = pair[0].score(df).withColumnRenamed("score", BASE[0])
    return pair[1].score(one).withColumnRenamed("score", BASE[1])


def out_of_fold(train: DataFrame, bases: BaseModels) -> DataFrame:
    """Every row scored by models that did not see it: ``loan_id, target, fold, p1, p2``."""
    folded = stratified_folds(train, len(bases.folds))
    parts = [_both(folded.where(F.col("fold") == fold), pair).select(KEY, LABEL, "fold", *BASE) for fold, pair in enumerate(bases.folds)]
    return reduce(DataFrame.unionByName, parts)


def fold_aucs(oof: DataFrame) -> DataFrame:
    """AUC of both learners per fold and over all rows (fold NULL)."""
    learner = F.explode(F.array(*[F.struct(F.lit(p).alias("learner"), F.col(p).alias("score")) for p in BASE]))
    long = oof.select(LABEL, "fold", learner.alias("l")).select(LABEL, "fold", "l.*")
    overall = auc(long, ["learner"]).withColumn("fold", F.lit(None).cast("int"))
    return auc(long, ["learner", "fold"]).unionByName(overall)


def fit_meta(oof: DataFrame) -> PipelineModel:
    """Logistic regression on the two out-of-fold probabilities, with an L2 penalty of C = 1."""
    regression = LogisticRegression(labelCol=LABEL, featuresCol="meta", maxIter=100, regParam=1.0 / oof.count(),
                                    elasticNetParam=0.0, standardization=False)
    return Pipeline(stages=[VectorAssembler(inputCols=list(BASE), outputCol="meta"), regression]).fit(
        oof.select(LABEL, *BASE))


@dataclass(frozen=True)
class StackedScorer:
    first: TreeScorer
    second: TreeScorer
    meta: PipelineModel

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the stacked probability as ``score``."""
        based = _both(df, (self.first, self.second))
        scored = self.meta.transform(based)
        kept = [c for c in df.columns if c != "score"]
        return scored.select(*kept, vector_to_array("probability")[1].alias("score"))

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return self.score(df).withColumn("prediction", (F.col("score") >= threshold).cast("int"))

    def save(self, path: str) -> None:
        self.first.save(f"{path}/first")
        self.second.save(f"{path}/second")
        self.meta.write().overwrite().save(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> StackedScorer:
        return StackedScorer(load_scorer(spark, f"{path}/first"), load_scorer(spark, f"{path}/second"),
                             PipelineModel.load(f"{path}/meta"))


def fit_stack(bases: BaseModels, oof: DataFrame) -> StackedScorer:
    """The base models of all training rows and the meta model."""
    return StackedScorer(*bases.full, fit_meta(oof))
