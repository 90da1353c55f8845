"""Logistic regression by iteratively reweighted least squares.

Each step is one aggregate: the weighted moments of the features under the current
coefficients, added up by Spark.  The driver solves a system as large as the features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.models.moments import unpack
from seriesforge.session import materialize


@dataclass(frozen=True)
class LogisticFit:
    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    steps: int

    def chance(self) -> Column:
        """The chance of an event, as column arithmetic."""
        value = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            value = value + F.lit(weight) * F.col(name)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [("intercept", self.intercept), *zip(self.features, self.coefficients)]
        return spark.createDataFrame([(f, float(c)) for f, c in rows], "feature string, coefficient double")


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, steps: int = 25, tolerance: float = 1e-10) -> LogisticFit:
    """Fit a 0/1 ``label``; rows that lack a feature or the label do not count.

    Features are scaled by their mean and deviation while fitting, so that the systems are well
    conditioned.  Labels of one class only have no finite fit and raise.
    """
    columns = [F.col(c).cast("double") for c in features]
    rows = df.select(*[c.alias(f"x{i}") for i, c in enumerate(columns)], F.col(label).cast("double").alias("y")).dropna()
    rows = materialize(rows)
    shape = [F.avg("y"), *[f(f"x{i}") for i in range(len(columns)) for f in (F.avg, F.stddev_pop)]]
    share, *moments = rows.agg(*shape).first()
    if share is None or share in (0.0, 1.0):
        raise ValueError("a logistic fit needs rows of both classes")
    means, spreads = np.array(moments[::2], float), np.array([s or 1.0 for s in moments[1::2]], float)
    scaled = [(F.col(f"x{i}") - float(means[i])) / float(spreads[i]) for i in range(len(columns))]
    terms = [F.lit(1.0), *scaled]
    beta = np.zeros(len(terms))
    beta[0] = np.log(share / (1 - share))
    taken = 0
    for taken in range(1, steps + 1):
        value = sum((F.lit(float(b)) * t for b, t in zip(beta[1:], terms[1:])), F.lit(float(beta[0])))
        weighed = rows.select("y", *[t.alias(f"t{i}") for i, t in enumerate(terms)], (F.lit(1.0) / (F.lit(1.0) + F.exp(-value))).alias("p"))
        names = [f"t{i}" for i in range(len(terms))]
        weight = F.col("p") * (1 - F.col("p"))
        gram = [F.sum(weight * F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
        row = weighed.agg(F.array(*gram).alias("gram"), F.array(*[F.sum((F.col("y") - F.col("p")) * F.col(a)) for a in names]).alias("pull")).first()
        step = np.linalg.pinv(unpack(row["gram"]), hermitian=True) @ np.array(row["pull"])
        beta = beta + step
        if np.abs(step).max() < tolerance:
            break
    weights = beta[1:] / spreads
    return LogisticFit(tuple(features), float(beta[0] - weights @ means), tuple(float(w) for w in weights), taken)
