"""Credit-risk features and score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def risk_features(loans: DataFrame, customer: str, amount: str, past_due: Column) -> DataFrame:
    """Per customer: loans, largest amount, loans past due."""
    return loans.groupBy(customer).agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.round(F.max(amount), 2).alias("max_amount"),
        F.count_if(past_due).alias("n_past_due"),
    )


@dataclass(frozen=True)
class ScoreCard:
    """A fitted logistic score: one weight per feature and an intercept."""

    weights: dict[str, float]
    intercept: float

    def probability(self) -> Column:
        """The score as an expression; a missing feature gives a null score."""
        terms = [F.col(name).cast("double") * F.lit(weight) for name, weight in self.weights.items()]
        margin = reduce(lambda a, b: a + b, terms, F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def train_score(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 20) -> ScoreCard:
    """Fit on all rows without missing values; only the weights reach the driver."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip")
    rows = assembler.transform(train.na.drop(subset=[label, *features])).select("_features", label)
    model = LogisticRegression(featuresCol="_features", labelCol=label, maxIter=max_iter).fit(rows)
    weights = {name: float(weight) for name, weight in zip(features, model.coefficients)}
    return ScoreCard(weights, float(model.intercept))


def credit_score(card: ScoreCard, apply: DataFrame, out: str = "score") -> DataFrame:
    """Probability of the bad outcome for every row."""
    return apply.withColumn(out, card.probability())
