"""Quality classifier as a sparse ensemble of conjunctive rules.

Statistics of a text are built-in column expressions. Boosted trees over them
are fitted on a bounded sample of labelled rows; every path from a root to a
node below it is a rule, a conjunction of threshold tests. A lasso logistic
regression over all rules keeps few with a weight, and the model is compiled
into one column expression: scoring is a scan without Python and without shuffle.

Only the sample is bounded (``Settings.sample_rows``, by default 20,000 labelled
rows, those with the smallest hash of their id); every row is scored.

Defined results: a null text counts as an empty one and is scored; labels that
are null are not learned; repeated rows are scored row by row; with fewer than
two classes among the labels the score is the share of label 1 for every row
(0.5 without labels); an empty table gives an empty result; extra columns are
ignored unless named in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import SPACE, SYMBOLS
from .tables import kept

STATISTICS = ("words", "mean_word", "distinct_share", "upper_share", "digit_share", "symbol_rate", "exclaim_rate",
              "stop_rate", "comma_rate", "line_words", "repeated_line_share", "same_next_share")


@dataclass(frozen=True)
class Settings:
    """Sizes of the ensemble, the lasso's strength, and the bound of the training sample."""

    trees: int = 12
    depth: int = 3
    lasso: float = 0.001
    sample_rows: int = 20_000
    seed: int = 42


@dataclass(frozen=True)
class Test:
    """``statistic <= threshold``, or its opposite."""

    statistic: str
    below: bool
    threshold: float

    @property
    def text(self) -> str:
        return f"{self.statistic} {'<=' if self.below else '>'} {self.threshold!r}D"


@dataclass(frozen=True)
class Model:
    """An intercept and weighted rules; ``constant`` replaces them where there was nothing to learn."""

    intercept: float
    rules: tuple[tuple[tuple[Test, ...], float], ...]
    constant: float | None = None

    def score(self) -> Column:
        """Probability of label 1 over the columns of ``statistics``."""
        if self.constant is not None:
            return F.lit(self.constant)
        logit = F.lit(self.intercept)
        for tests, weight in self.rules:
            logit = logit + F.when(F.expr(" AND ".join(t.text for t in tests)), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and one double per statistic of the whole text."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumns({"w": F.array_remove(F.split("t", SPACE), ""),
                             "l": F.array_remove(F.split("t", r"\n"), "")})
    n, chars = F.greatest(F.size("w"), F.lit(1)), F.greatest(F.char_length("t"), F.lit(1))
    lines = F.greatest(F.size("l"), F.lit(1))

    def count(pattern: str) -> Column:
        return F.regexp_count("t", F.lit(pattern))

    symbols = "[" + SYMBOLS.replace("$", r"\$").replace("&", r"\&") + "]"
    values = {
        "words": F.size("w"), "mean_word": F.char_length(F.array_join("w", "")) / n,
        "distinct_share": F.size(F.array_distinct("w")) / n, "upper_share": count(r"\p{Lu}") / chars,
        "digit_share": count(r"[0-9]") / chars, "symbol_rate": count(symbols) / n,
        "exclaim_rate": count("!") / n, "stop_rate": count(r"\.") / n, "comma_rate": count(",") / n,
        "line_words": F.size("w") / lines, "repeated_line_share": (F.size("l") - F.size(F.array_distinct("l"))) / lines,
        "same_next_share": count(r"(?<=\s)(\S++)(?=\s\1\s)") / n}
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
                       *[values[s].cast("double").alias(s) for s in STATISTICS])


def _paths(tree) -> list[tuple[Test, ...]]:
    """Every path of a fitted tree from its root to a node below it."""
    found: list[tuple[Test, ...]] = []

    def walk(node, path: tuple[Test, ...]) -> None:
        if path:
            found.append(path)
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, threshold = STATISTICS[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), (*path, Test(name, True, threshold)))
        walk(node.rightChild(), (*path, Test(name, False, threshold)))

    walk(tree._call_java("rootNode"), ())
    return found


def fit(labelled: DataFrame, label: str = "label", settings: Settings = Settings()) -> Model:
    """Learn from rows of statistics with a label of 0 or 1."""
    counts = {r[0]: r[1] for r in labelled.groupBy(label).count().collect() if r[0] is not None}
    if len(counts) < 2:
        return Model(0.0, (), float(next(iter(counts), 0.5)))
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(
        labelled.where(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double")))
    # Both classes weigh the same in the trees, so that rules describe the rarer one too.
    least, most = min(counts.values()), max(counts.values())
    rare = min(counts, key=counts.get)
    rows = rows.withColumn("weight", F.when(F.col("label") == rare, most / least).otherwise(1.0))
    trees = GBTClassifier(maxIter=settings.trees, maxDepth=settings.depth, minInstancesPerNode=5, weightCol="weight",
                          seed=settings.seed, stepSize=0.3).fit(rows).trees
    rules = sorted({p for t in trees for p in _paths(t)}, key=lambda p: (len(p), [t.text for t in p]))
    fired = rows.select("label", array_to_vector(F.array(*[
        F.expr(" AND ".join(t.text for t in p)).cast("double") for p in rules])).alias("features"))
    lasso = LogisticRegression(regParam=settings.lasso, elasticNetParam=1.0, maxIter=200, standardization=False).fit(fired)
    weighted = tuple((p, float(w)) for p, w in zip(rules, lasso.coefficients) if abs(w) > 1e-9)
    return Model(float(lasso.intercept), weighted)


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "label",
           settings: Settings = Settings()) -> tuple[DataFrame, Model]:
    """``doc_id`` and ``score`` of every row of ``docs``, and the model learned from ``labels`` (doc_id, label)."""
    known = labels.where(F.col(label).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    chosen = texts.join(F.broadcast(sample), "doc_id")  # at most sample_rows rows
    train = kept(statistics(chosen, keep=("label",)).repartition(4), "statistics")  # small, and read many times
    model = fit(train, settings=settings)
    return statistics(texts).select("doc_id", model.score().alias("score")), model
