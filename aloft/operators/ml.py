"""Binary classification steps on pyspark.ml.

Fitting is distributed by pyspark.ml itself: StringIndexer counts labels
with a grouped aggregate (the distinct labels reach the driver: for columns of closed
cardinality only, like country; else :func:`index_categories_distributed`), StandardScaler and
LogisticRegression use tree aggregation of fixed-size summaries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.constants import LOGISTIC_MAX_ITER, SPLIT_SEED, SPLIT_WEIGHTS
from aloft.operators.percentile import select_ranks
from aloft.session import saved


def index_categories(df: DataFrame, input_col: str, output_col: str,
                     handle_invalid: str = "error") -> DataFrame:
    """M01 (Q23): category -> index by descending frequency, ties alphabetical."""
    return (StringIndexer(inputCol=input_col, outputCol=output_col,
                          handleInvalid=handle_invalid, stringOrderType="frequencyDesc")
            .fit(df).transform(df))


def index_categories_distributed(df: DataFrame, input_col: str, output_col: str) -> DataFrame:
    """M01 without collecting the labels to the driver, for open-ended
    columns: the same indices as ``StringIndexer`` (descending frequency,
    ties alphabetical, 0-based; NULL stays NULL).  Label counts come from a
    grouped aggregate and ranks from a distributed running total.  Spark broadcasts the
    label table if it is small; else rows with a NULL label stay out of the shuffled join."""
    from aloft.operators.ranking import running_total

    counts = (df.where(F.col(input_col).isNotNull())
              .groupBy(F.col(input_col).alias("__label")).agg(F.count(F.lit(1)).alias("__n")))
    ranked = running_total(counts, [F.desc("__n"), F.asc("__label")], F.lit(1), "__rank")
    labels = ranked.select("__label", (F.col("__rank") - 1).cast("double").alias(output_col))
    some = df.where(F.col(input_col).isNotNull())
    none = df.where(F.col(input_col).isNull()).withColumn(output_col, F.lit(None).cast("double"))
    return (some.join(labels, F.col(input_col) == F.col("__label")).drop("__label")
            .unionByName(none))


def assemble(df: DataFrame, input_cols: list[str], output_col: str = "features") -> DataFrame:
    """M02 (Q24): numeric columns -> one vector column."""
    return VectorAssembler(inputCols=input_cols, outputCol=output_col).transform(df)


def scale(df: DataFrame, output_col: str, input_col: str = "features") -> DataFrame:
    """M03 (Q25): divide each feature by its sample standard deviation, no
    centring; a zero-deviation feature becomes 0.0."""
    return (StandardScaler(inputCol=input_col, outputCol=output_col, withStd=True,
                           withMean=False).fit(df).transform(df))


def in_train(id_col: str, train_fraction: float = SPLIT_WEIGHTS[0], seed: int = SPLIT_SEED):
    """Boolean column: the row's key hashes into the training share.

    The hash is md5 of ``"<key>:<seed>"``; its first 8 hex digits are a
    uniform 32-bit number, compared as text with the threshold
    ``train_fraction * 2^32`` written the same way.  Any engine with md5 can
    reproduce the split exactly (the SQL oracle does)."""
    threshold = int(round(train_fraction * 2 ** 32))
    if threshold >= 2 ** 32:
        return F.lit(True)
    if threshold <= 0:
        return F.lit(False)
    cut = f"{threshold:08x}"
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return F.substring(digest, 1, 8) < F.lit(cut)


def hash_split(df: DataFrame, id_col: str, train_fraction: float = SPLIT_WEIGHTS[0],
               seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """M06 (Q28): reproducible split by hashing a row key; unlike
    ``randomSplit`` it does not depend on partitioning or row order."""
    flag = in_train(id_col, train_fraction, seed)
    return df.where(flag), df.where(~flag)


def exact_split(df: DataFrame, id_col: str, strata: list[str], train_fraction: float = SPLIT_WEIGHTS[0],
                seed: int = SPLIT_SEED, out_col: str = "in_train") -> DataFrame:
    """M06 with exact sizes: ``df`` with a flag that holds for round(fraction * n) rows (halves up) of each
    stratum, those of least md5 hash of the key and, where hashes are equal, of least key.

    No stratum is sorted: the hash at the cut is found by repeated histograms for all strata at once
    (:func:`select_ranks`), and only rows with that very hash are ordered."""
    # 52 bits, which a double holds
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    names = [f"k{i}" for i in range(len(strata))]
    rows = saved(df.select(F.struct("*").alias("__row"), number.alias("v"), F.struct(
        *[F.col(k).alias(n) for k, n in zip(strata, names, strict=True)]).alias("__key")), "split-rows")
    wanted = F.floor(F.col("n") * F.lit(train_fraction) + 0.5)
    cut = select_ranks(rows.select("__key", "v"), F.greatest(F.lit(0), wanted - 1).cast("double"))
    cut = cut.select("__key", "lo", (wanted - F.col("below")).alias("room"))
    joined = rows.join(cut, "__key")
    clear = (joined.where(F.col("v") != F.col("lo"))
             .withColumn("__in", (F.col("v") < F.col("lo")) & (F.col("room") > 0)))
    tied = joined.where(F.col("v") == F.col("lo")).withColumn("__in", F.row_number().over(
        Window.partitionBy("__key").orderBy(F.asc_nulls_first(F.col("__row")[id_col]))) <= F.col("room"))
    return clear.unionByName(tied).select("__row.*", F.col("__in").alias(out_col))


def random_split(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SPLIT_SEED) -> list[DataFrame]:
    """M06 as written originally (depends on the input partitioning)."""
    return df.randomSplit(list(weights), seed)


def fit_logistic(training: DataFrame, features_col: str, label_col: str,
                 prediction_col: str = "prediction",
                 max_iter: int = LOGISTIC_MAX_ITER, tol: float = 1e-6) -> LogisticRegressionModel:
    """M04 (Q26): binomial logistic regression."""
    return LogisticRegression(maxIter=max_iter, tol=tol, featuresCol=features_col,
                              labelCol=label_col, predictionCol=prediction_col,
                              family="binomial").fit(training)


@dataclass(frozen=True)
class NewtonFit:
    """A fitted binomial model: ``converged`` if the last step moved no coefficient by the tolerance."""
    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    iterations: int
    converged: bool


#: a pivot below this share of its diagonal entry marks a feature that others determine; it is left as it is
ALIASED = 1e-10


def _solve(gram: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination of a positive semidefinite system; determined unknowns get 0."""
    m, diagonal = np.column_stack([gram, gradient]), np.diag(gram).copy()
    for k in range(len(m)):
        if m[k, k] <= ALIASED * diagonal[k]:
            m[k] = 0.0
            continue
        m[k] /= m[k, k]
        others = np.arange(len(m)) != k
        m[others] -= np.outer(m[others, k], m[k])
    return m[:, -1]


def _probability(intercept: float, coefficients, features):
    eta = F.lit(float(intercept))
    for b, c in zip(coefficients, features, strict=True):
        eta = eta + F.lit(float(b)) * F.col(c)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


def fit_newton(training: DataFrame, features: list[str], label_col: str,
               max_iter: int = LOGISTIC_MAX_ITER, tol: float = 1e-9) -> NewtonFit:
    """M04 (Q26): binomial logistic regression by Newton's method (iteratively reweighted least squares),
    without a penalty, starting from 0.

    An iteration is one aggregate over the rows: the weighted Gram matrix and the gradient, (d + 1)(d + 4) / 2
    sums for d features, combined map-side.  The driver solves a system of d + 1 unknowns.  ``training``
    should be a written table; it is read once an iteration.  Rows with a null feature or label add
    nothing.  Steps do not depend on the scale of the features."""
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    k = len(x)
    rows = training.na.drop(subset=[*features, label_col])
    beta, iterations, converged = np.zeros(k), 0, False
    while iterations < max_iter and not converged:
        p = _probability(beta[0], beta[1:], features)
        sums = [F.sum(F.col("__w") * x[a] * x[b]) for a in range(k) for b in range(a, k)]
        sums += [F.sum(F.col("__r") * x[a]) for a in range(k)]
        got = (rows.withColumn("__p", p)
               .withColumns({"__w": F.col("__p") * (F.lit(1.0) - F.col("__p")), "__r": F.col(label_col) - F.col("__p")})
               .agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first())
        if got[0] is None:
            raise ValueError("no rows to fit")
        gram = np.zeros((k, k))
        gram[np.triu_indices(k)] = got[:len(got) - k]
        step = _solve(gram + np.triu(gram, 1).T, np.array(got[len(got) - k:]))
        beta = beta + step
        iterations += 1
        converged = bool(np.abs(step).max() < tol)
    return NewtonFit(tuple(features), float(beta[0]), tuple(map(float, beta[1:])), iterations, converged)


def predict_newton(fit: NewtonFit, data: DataFrame, prediction_col: str = "prediction",
                   probability_col: str = "p_positive") -> DataFrame:
    """M05 (Q27): ``data`` with the probability of 1 and the prediction (1.0 if that is over a half)."""
    return (data.withColumn(probability_col, _probability(fit.intercept, fit.coefficients, fit.features))
            .withColumn(prediction_col, (F.col(probability_col) > 0.5).cast("double")))


def fit_and_score_newton(df: DataFrame, id_col: str, category_col: str, numeric_cols: list[str],
                         label_col: str, train_fraction: float = SPLIT_WEIGHTS[0], seed: int = SPLIT_SEED,
                         max_iter: int = LOGISTIC_MAX_ITER) -> tuple[NewtonFit, DataFrame]:
    """Q30 by Newton's method: split by key hash, index the category and scale all features by what the
    training part says, fit on that, score the rest."""
    df = saved(df, "model-input")
    train, test = hash_split(df, id_col, train_fraction, seed)
    index = f"{category_col}_index"
    indexer = StringIndexer(inputCol=category_col, outputCol=index, handleInvalid="keep",
                            stringOrderType="frequencyDesc").fit(train)
    names = [index, *numeric_cols]
    std = indexer.transform(train).agg(*[F.stddev_samp(c) for c in names]).first()

    def scaled(part: DataFrame) -> DataFrame:
        return indexer.transform(part).withColumns(
            {f"scaled_{c}": F.col(c) / F.lit(s) if s else F.lit(0.0) for c, s in zip(names, std, strict=True)})
    fit = fit_newton(saved(scaled(train), "training"), [f"scaled_{c}" for c in names], label_col, max_iter)
    return fit, predict_newton(fit, scaled(test))


def predict(model, data: DataFrame) -> DataFrame:
    """M05 (Q27): score rows (prediction 1.0 = yes, 0.0 = no)."""
    return model.transform(data)


def evaluate(predictions: DataFrame, label_col: str, prediction_col: str = "prediction",
             raw_col: str = "rawPrediction") -> dict:
    """M07 (Q29): area under ROC on the raw scores (``auc``), on the hard 0/1
    predictions as originally coded (``auc_hard``), and plain ``accuracy``."""
    # numBins=0: every distinct score is a point of the curve
    ev = BinaryClassificationEvaluator(labelCol=label_col, metricName="areaUnderROC", numBins=0)
    predictions = saved(predictions.select(*dict.fromkeys((label_col, prediction_col, raw_col))), "scored")
    auc = ev.setRawPredictionCol(raw_col).evaluate(predictions)
    auc_hard = ev.setRawPredictionCol(prediction_col).evaluate(
        predictions.withColumn(prediction_col, F.col(prediction_col).cast("double")))
    acc, n = predictions.agg(
        F.avg((F.col(label_col) == F.col(prediction_col)).cast("double")),
        F.count(F.lit(1))).first()
    return {"auc": float(auc), "auc_hard": float(auc_hard),
            "accuracy": float(acc) if acc is not None else None, "n": int(n)}


def classifier_stages(category_col: str, numeric_cols: list[str], label_col: str,
                      max_iter: int = LOGISTIC_MAX_ITER, index_col: str | None = None) -> Pipeline:
    """Q30: index -> assemble -> scale -> logistic regression, as one estimator."""
    index_col = index_col or f"{category_col}_index"
    return Pipeline(stages=[
        StringIndexer(inputCol=category_col, outputCol=index_col, handleInvalid="keep"),
        VectorAssembler(inputCols=[index_col, *numeric_cols], outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaledFeatures", withStd=True,
                       withMean=False),
        LogisticRegression(maxIter=max_iter, featuresCol="scaledFeatures", labelCol=label_col,
                           predictionCol="prediction", family="binomial"),
    ])


def fit_and_score(df: DataFrame, id_col: str, category_col: str, numeric_cols: list[str],
                  label_col: str, train_fraction: float = SPLIT_WEIGHTS[0],
                  seed: int = SPLIT_SEED,
                  max_iter: int = LOGISTIC_MAX_ITER) -> tuple[PipelineModel, DataFrame]:
    """Q30: split by key hash, fit the stages on the training part, score the rest.

    The input is written to the shared folder once: the indexer, scaler and every solver
    iteration then re-read the materialised rows instead of re-running the
    upstream joins and parsing, and a lost executor recomputes nothing before it.
    """
    df = saved(df, "model-input")
    train, test = hash_split(df, id_col, train_fraction, seed)
    model = classifier_stages(category_col, numeric_cols, label_col, max_iter).fit(train)
    return model, model.transform(test)


def score_columns(scored: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Scored rows as plain columns (id, label, prediction, probability of 1)."""
    return scored.select(F.col(id_col), F.col(label_col),
                         F.col("prediction"),
                         F.round(vector_to_array("probability")[1], 6).alias("p_positive"))


def vector_columns(df: DataFrame, vector_col: str, names: list[str], keep: list[str],
                   digits: int = 6) -> DataFrame:
    """Emit a vector column as named double columns, rounded."""
    arr = vector_to_array(vector_col)
    return df.select(*keep, *[F.round(arr[i], digits).alias(n) for i, n in enumerate(names)])
