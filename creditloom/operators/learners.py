"""Classifiers on the mart: logistic baseline, boosted trees, trees with native categories.

Every fit returns a scorer, which adds a ``score`` column and can be saved. The
sensitive column is never a feature.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting, encoders
from .boosting import HELD, LEARNED, Model, Quantizer, Settings, Tree
from .encoders import ColumnValues, TargetEncoder
from .profiling import numeric_columns, string_columns

KEY, LABEL, SENSITIVE = "loan_id", "target", "gender_clean"
NOT_FEATURES = {KEY, LABEL, SENSITIVE, "split", "fold", "is_holdout", "weight"}

# Settings of the single models and of the models inside the stack. A positive row counts as three.
BOOSTED = Settings(rounds=2500, depth=3, leaves=32, rate=0.05, l1=20, l2=20, min_gain=0.5, min_rows=20, row_share=0.7,
                   feature_share=0.8, bins=512, patience=100)
CATEGORICAL = Settings(rounds=1000, depth=6, rate=0.05, l2=3, patience=50, positive_weight=3)
STACKED_BOOSTED = Settings(rounds=500, depth=5, leaves=31, rate=0.05, min_rows=20, patience=50, positive_weight=3)
STACKED_CATEGORICAL = Settings(rounds=500, depth=6, rate=0.05, l2=3, patience=50, positive_weight=3)


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]


@dataclass(frozen=True)
class Scorer:
    """A fitted model with the fitted preparation of its input."""

    model: PipelineModel | None
    numbers: list[str]
    ordinal: bool = False
    target_encoder: TargetEncoder | None = None
    medians: ColumnValues | None = None
    scaler: ColumnValues | None = None
    categories: list[str] = field(default_factory=list)

    def encode(self, df: DataFrame) -> DataFrame:
        if self.ordinal:
            df = encoders.ordinal_encode(df)
        return self.target_encoder.transform(df) if self.target_encoder else df

    def prepare(self, df: DataFrame) -> DataFrame:
        df = self.encode(df)
        if self.categories:
            df = encoders.fill_unknown(df, self.categories)
        if self.medians:
            df = encoders.impute_median(df, self.medians)
        else:
            df = df.withColumns({c: F.col(c).cast("double") for c in self.numbers})
        return encoders.standardize(df, self.scaler) if self.scaler else df

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the probability of the positive class as ``score``; other columns unchanged."""
        kept = [c for c in df.columns if c != "score"]
        original = F.struct(*kept).alias("__row")
        scored = self.model.transform(self.prepare(df.select(*kept, original)))
        return scored.select("__row.*", vector_to_array("probability")[1].alias("score"))

    def save(self, path: str) -> None:
        """Write the spark.ml model, the category statistics and the fitted numbers below ``path``."""
        spark = SparkSession.active()
        self.model.write().overwrite().save(f"{path}/model")
        facts = {"numbers": self.numbers, "ordinal": self.ordinal, "categories": self.categories,
                 "medians": self.medians and self.medians.values, "scaler": self.scaler and self.scaler.values}
        if self.target_encoder:
            self.target_encoder.stats.write.mode("overwrite").parquet(f"{path}/categories")
            facts |= {"prior": self.target_encoder.prior, "encoded": self.target_encoder.cols}
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scorer:
        facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
        encoder = None
        if "encoded" in facts:
            encoder = TargetEncoder(spark.read.parquet(f"{path}/categories"), facts["prior"], facts["encoded"])
        return Scorer(PipelineModel.load(f"{path}/model"), facts["numbers"], facts["ordinal"], encoder,
                      facts["medians"] and ColumnValues(facts["medians"]),
                      facts["scaler"] and ColumnValues(facts["scaler"]), facts["categories"])


def _encoding(train: DataFrame) -> dict:
    """Fitted encoders for the categories present, as :class:`Scorer` fields."""
    present = [c for c in encoders.TARGET_ENCODED if c in train.columns]
    return {"ordinal": "age_group" in train.columns,
            "target_encoder": encoders.fit_target_encoder(train, LABEL, present) if present else None}


def _encoded_features(df: DataFrame) -> list[str]:
    """All features; after encoding every one of them is a number."""
    return [c for c in feature_columns(df) if c in set(numeric_columns(df)) | set(encoders.TARGET_ENCODED) | {"age_group"}]


def fit_logistic(train: DataFrame, max_iter: int = 1000) -> Scorer:
    """Logistic regression on encoded, median-imputed, standardised features, with an L2 penalty of C = 1."""
    features = _encoded_features(train)
    encoding = _encoding(train)
    encoded = Scorer(None, features, **encoding).encode(train).select(LABEL, *features)
    encoded.persist(StorageLevel.MEMORY_AND_DISK)
    medians = encoders.fit_medians(encoded, features)
    imputed = encoders.impute_median(encoded, medians)
    scaler = encoders.fit_scaler(imputed, features)
    regression = LogisticRegression(labelCol=LABEL, featuresCol="features", maxIter=max_iter,
                                    regParam=1.0 / encoded.count(), elasticNetParam=0.0, standardization=False)
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), regression])
    model = pipeline.fit(encoders.standardize(imputed, scaler))
    encoded.unpersist()
    return Scorer(model, features, medians=medians, scaler=scaler, **encoding)


@dataclass(frozen=True)
class TreeScorer:
    """Boosted trees with the coding of their columns."""

    quantizer: Quantizer
    model: Model

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the probability of the positive class as ``score``; other columns unchanged."""
        return boosting.scored(df, self.quantizer, self.model)

    def trees(self) -> int:
        return len(self.model.trees)

    def save(self, path: str) -> None:
        """Write the coding and the trees below ``path``."""
        facts = {"quantizer": asdict(self.quantizer), "settings": asdict(self.model.settings), "base": self.model.base,
                 "trees": [t.facts() for t in self.model.trees]}
        table = SparkSession.active().createDataFrame([(json.dumps(facts),)], "value string")
        table.coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def load_scorer(spark: SparkSession, path: str) -> Scorer | TreeScorer:
    """A scorer of either kind as its ``save`` wrote it."""
    facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
    if "trees" not in facts:
        return Scorer.load(spark, path)
    model = Model(0, Settings(**facts["settings"]), base=facts["base"], trees=[Tree.of(t) for t in facts["trees"]])
    return TreeScorer(Quantizer(**facts["quantizer"]), model)


def tree_quantizer(train: DataFrame, bins: int) -> Quantizer:
    """The coding all tree learners share: numbers, the age group by rank, and every string as a category."""
    features = feature_columns(train)
    numbers = [c for c in numeric_columns(train) if c in features]
    categories = [c for c in string_columns(train) if c in features]
    ordered = {"age_group": encoders.AGE_GROUPS} if "age_group" in features else {}
    return boosting.fit_quantizer(train, numbers, categories, ordered, bins, encoders.UNKNOWN)


def encoded_features(quantizer: Quantizer) -> tuple[np.ndarray, dict[str, tuple[float, float]]]:
    """Columns of the boosted learner: numbers, the ranked age group, and categories ordered by their smoothed target mean."""
    plain = len(quantizer.cuts) + len(quantizer.ordered)
    encoded = [c for c in quantizer.values if c in encoders.TARGET_ENCODED]
    at = [i for i, c in enumerate(quantizer.features) if i < plain or c in encoded]
    return np.array(at, np.int64), {c: (encoders.SMOOTHING, encoders.MIN_SAMPLES) for c in encoded}


def category_features(quantizer: Quantizer) -> np.ndarray:
    """Columns of the learner with native categories: numbers and all categories, ordered by gradient at every node."""
    skipped = range(len(quantizer.cuts), len(quantizer.cuts) + len(quantizer.ordered))
    return np.array([i for i in range(len(quantizer.features)) if i not in skipped], np.int64)


def _fit_trees(train: DataFrame, holdout: DataFrame | None, settings: Settings, encoded: bool) -> TreeScorer:
    quantizer = tree_quantizer(train, settings.bins)
    rows = train.withColumn("role0", F.lit(LEARNED))
    if holdout is not None:
        shared = [c for c in rows.columns if c in holdout.columns]
        rows = rows.select(*shared, "role0").unionByName(holdout.select(*shared, F.lit(HELD).alias("role0")))
    features, encode = encoded_features(quantizer) if encoded else (category_features(quantizer), {})
    blocks = boosting.coded_blocks(rows, quantizer, LABEL, KEY, ["role0"])
    if holdout is None:
        settings = replace(settings, patience=0)
    [model] = boosting.grow(blocks, quantizer, [Model(0, settings, features, encode)])
    return TreeScorer(quantizer, model.best())


def fit_boosted(train: DataFrame, holdout: DataFrame | None, settings: Settings = BOOSTED) -> TreeScorer:
    """Boosted trees on encoded features; stops when the holdout has not improved for ``settings.patience`` rounds."""
    return _fit_trees(train, holdout, settings, encoded=True)


def fit_categorical(train: DataFrame, holdout: DataFrame | None, settings: Settings = CATEGORICAL) -> TreeScorer:
    """Boosted trees that split on the categories themselves; positives weigh more."""
    return _fit_trees(train, holdout, settings, encoded=False)
