"""Quality features, the score, routing by threshold and its evaluation."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from inkweir.operators.ordered import prefix_sums
from inkweir.session import cut

FEATURES = ["f_document", "f_sentence", "f_relevance", "f_views"]


def safe_log(x: Column) -> Column:
    """Natural logarithm, minus infinity for 0."""
    return F.when(x > 0, F.log(x)).when(x == 0, F.lit(float("-inf")))


def features(rows: DataFrame) -> DataFrame:
    """rows(document_tokens, sentence_tokens, score, views) with the four features: logs of the lengths,
    of the relevance plus one, and of the views (1 where unknown)."""
    return rows.withColumns({"f_document": safe_log(F.col("document_tokens")), "f_sentence": safe_log(F.col("sentence_tokens")), "f_relevance": F.log(F.col("score") + 1), "f_views": safe_log(F.coalesce("views", F.lit(1)))})


def _assembled(rows: DataFrame) -> DataFrame:
    finite = rows.where(" and ".join(f"{f} is not null and {f} > double('-infinity')" for f in FEATURES))
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(finite)


def train(rows: DataFrame, strength: float = 1.0) -> LogisticRegressionModel:
    """Logistic regression on rows with FEATURES and label (1 or 0); others are left out. ``strength`` is
    the inverse of the penalty for the whole sample."""
    labelled = _assembled(rows.where("label in (0, 1)"))
    n = max(1, labelled.count())
    return LogisticRegression(featuresCol="features", labelCol="label", regParam=1 / (strength * n), standardization=False).fit(labelled)


def decision(rows: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """rows with ``decision``, the log-odds of the positive class. Rows with infinite features go."""
    out = model.transform(_assembled(rows))
    return out.withColumn("decision", vector_to_array("rawPrediction")[1]).drop("features", "rawPrediction", "probability", "prediction")


def save_model(model: LogisticRegressionModel, path: str) -> None:
    """Write a trained model, for other jobs."""
    model.write().overwrite().save(path)


def load_model(path: str) -> LogisticRegressionModel:
    """A model that ``save_model`` wrote."""
    return LogisticRegressionModel.load(path)


def hold_out(rows: DataFrame, n: int, *keys: str, seed: str = "hold out") -> tuple[DataFrame, DataFrame]:
    """(train, held): the first ``n`` rows in the order of a hash of their keys are held out, all others
    are for training. Keys must be unique; fewer rows than ``n`` leave nothing to train on."""
    order = F.md5(F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in keys)))
    chosen = cut(rows.select(*keys, order.alias("_h")).orderBy("_h", *keys).limit(n).drop("_h"))
    return rows.join(chosen, list(keys), "left_anti"), rows.join(chosen, list(keys), "left_semi")


def _tail(r: float, n: float) -> float | None:
    """Two-sided probability of a correlation as far from 0 as ``r`` among ``n`` unrelated pairs: the
    regularised incomplete beta function at 1 - r^2, by its continued fraction."""
    if r is None or n is None or n < 3 or r != r:
        return None
    a, b, x = (n - 2) / 2, 0.5, max(0.0, 1 - r * r)
    if x in (0.0, 1.0):
        return x
    swap = x > (a + 1) / (a + b + 2)
    if swap:
        a, b, x = b, a, 1 - x
    c, d = 1.0, 1 / max(1e-300, 1 - (a + b) * x / (a + 1))
    value = d
    for m in range(1, 500):
        for factor in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + factor * d) or 1e-300)
            c = (1 + factor / c) or 1e-300
            value *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    return 1 - front * value if swap else front * value


@F.pandas_udf(T.DoubleType())
def _tails(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([_tail(x, y) for x, y in zip(r, n)], dtype="float64")


def correlation(rows: DataFrame, x: str, y: str) -> DataFrame:
    """One row (r, n, p): Pearson's correlation of two columns, the pairs without a null, and the
    two-sided probability of one as strong among unrelated values."""
    both = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"), F.count("*").alias("n")).withColumn("p", _tails("r", "n"))


def linear_score(weights: dict[str, float], bias: float) -> Column:
    """The log-odds as an expression, for a model whose weights are known."""
    out = F.lit(float(bias))
    for name, w in weights.items():
        out = out + F.lit(float(w)) * F.col(name)
    return out


def route(scored: DataFrame, threshold: float, *keys: str) -> DataFrame:
    """scored(*keys, doc_index, score) to (*keys, good, bad): the indexes of each record's documents at
    or above the threshold, and below it, in order. A record can have both."""
    good = F.sort_array(F.collect_list(F.when(F.col("score") >= threshold, F.col("doc_index"))))
    bad = F.sort_array(F.collect_list(F.when(F.col("score") < threshold, F.col("doc_index"))))
    return scored.groupBy(*keys).agg(good.alias("good"), bad.alias("bad"))


def pr_curve(scored: DataFrame) -> DataFrame:
    """scored(score, label) to (threshold, precision, recall, f1) at each different score, equal scores
    together. f1 is null where precision and recall are 0, all is empty without a row."""
    per = scored.where("score is not null").groupBy("score").agg(F.sum("label").cast("bigint").alias("pos"), F.count("*").alias("n"))
    # materialised: the total is read from the running sums, not from the scores once more
    run = cut(prefix_sums(per, ["score"], descending=True, tp=F.col("pos"), seen=F.col("n")))
    total = run.agg(F.sum("pos").alias("all_pos"))
    curve = run.crossJoin(F.broadcast(total))
    precision, recall = F.col("tp") / F.col("seen"), F.try_divide(F.col("tp"), F.col("all_pos"))
    return curve.select(F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall"), F.try_divide(2 * precision * recall, precision + recall).alias("f1"), "tp", "seen", "pos", "all_pos")


def average_precision(curve: DataFrame) -> DataFrame:
    """One row (average_precision): the sum of precision times the gain in recall."""
    return curve.agg(F.sum(F.try_divide(F.col("pos"), F.col("all_pos")) * F.col("precision")).alias("average_precision"))


def worst_errors(scored: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` positives with the lowest score and the ``n`` negatives with the highest."""
    wrong = F.when(F.col("label") == 1, F.col("score")).otherwise(-F.col("score"))
    w = Window.partitionBy("label").orderBy("_wrong", *keys)
    return scored.where("label in (0, 1)").withColumn("_wrong", wrong).withColumn("place", F.row_number().over(w)).where(F.col("place") <= n).drop("_wrong")
