"""Model families on Spark ML, with scoring in one shape."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scalar import label_at
from tabwright.session import spread

# Training defaults of the model families.
LOGISTIC_DEFAULTS = {"C": 1.0, "max_iter": 200}
FOREST_DEFAULTS = {"numTrees": 100, "maxDepth": 5, "seed": 42}
GBT_DEPTH_DEFAULTS = {"maxDepth": 6, "stepSize": 0.1, "maxIter": 100, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}
GBT_LEAF_DEFAULTS = {"maxDepth": 5, "stepSize": 0.1, "maxIter": 100, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}
#: Training rows of a task, from which a pass over them outweighs the task's start.
LOGISTIC_SHARE, TREE_SHARE, MLP_SHARE = 50_000, 20_000, 5_000
PATIENCE = 10
MLP_HIDDEN = [128, 64, 32]
MLP_EPOCHS = 50


@dataclass(frozen=True)
class Family:
    """``fit(train, val)`` on ``features`` and ``label``; ``val`` may be unused."""

    name: str
    fit: Callable[[DataFrame, DataFrame | None], Model]


def logistic(C: float = LOGISTIC_DEFAULTS["C"], max_iter: int = LOGISTIC_DEFAULTS["max_iter"], tol: float = 1e-8) -> Family:
    """L2 logistic regression with penalty strength C summed over rows.

    The objective here averages the loss over rows, hence the division by n.
    """

    def fit(train, val=None):
        n = train.count()
        return LogisticRegression(
            maxIter=max_iter, regParam=1.0 / (C * n), elasticNetParam=0.0, standardization=False, tol=tol
        ).fit(spread(train, n, LOGISTIC_SHARE))

    return Family("logistic", fit)


def random_forest(**params) -> Family:
    def fit(train, val=None):
        return RandomForestClassifier(**{**FOREST_DEFAULTS, **params}).fit(spread(train, train.count(), TREE_SHARE))

    return Family("forest", fit)


def best_round(losses: list[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: the best one seen before ``patience`` rounds passed without a better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_with_patience(est: GBTClassifier, train: DataFrame, val: DataFrame | None, patience: int = PATIENCE):
    """Boost until ``patience`` rounds pass without a smaller loss on ``val``; keep the rounds up to the best.

    A ``maxIter`` with the same seed grows the same first trees, so rounds are doubled until
    patience is spent, and only the kept ones are fitted again.
    """
    most = est.getMaxIter()
    train = spread(train, train.count(), TREE_SHARE)
    if val is None:
        return est.fit(train)
    rounds = min(most, 2 * patience)
    while True:
        model = est.copy({est.maxIter: rounds}).fit(train)
        keep = best_round(list(model.evaluateEachIteration(val)), patience)
        if keep + patience <= rounds or rounds == most:
            break
        rounds = min(most, 2 * rounds)
    return model if keep == rounds else est.copy({est.maxIter: keep}).fit(train)


def _gbt(name: str, defaults: dict, patience: int, params: dict) -> Family:
    return Family(name, lambda train, val=None: fit_with_patience(GBTClassifier(**{**defaults, **params}), train, val, patience))


def gbt_depth(patience: int = PATIENCE, **params) -> Family:
    """Depth-bounded boosting. Spark's trees take no L1/L2 leaf penalty."""
    return _gbt("gbt_depth", GBT_DEPTH_DEFAULTS, patience, params)


def gbt_leaf(patience: int = PATIENCE, **params) -> Family:
    """Leaf-bounded boosting, approximated by depth 5 (at most 32 leaves)."""
    return _gbt("gbt_leaf", GBT_LEAF_DEFAULTS, patience, params)


#: Epochs between two looks at the validation loss of a network.
MLP_STEP = 5


def _log_loss(model: Model, df: DataFrame) -> float:
    p = F.greatest(F.lit(1e-12), F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1))
    return model.transform(df).agg(F.avg(-F.ln(p)).alias("loss")).first()["loss"]


def mlp(hidden: list[int] | None = None, max_iter: int = MLP_EPOCHS, seed: int = 42, patience: int = PATIENCE, **params) -> Family:
    """Feed-forward network; Spark's layers are sigmoid, without dropout or batch norm.

    With ``val`` training goes on from the last weights a few epochs at a time until ``patience``
    epochs pass without a smaller validation loss; the best weights are kept.
    """
    hidden = list(MLP_HIDDEN if hidden is None else hidden)

    def fit(train, val=None):
        d = train.select("features").first()[0].size
        train = spread(train, train.count(), MLP_SHARE)
        est = MultilayerPerceptronClassifier(layers=[d, *hidden, 2], maxIter=max_iter, seed=seed, **params)
        if val is None:
            return est.fit(train)
        best, least, waited, done = None, float("inf"), 0, 0
        while done < max_iter and waited < patience:
            step = min(MLP_STEP, max_iter - done)
            model = est.copy({est.maxIter: step}).fit(train)
            loss = _log_loss(model, val)
            if best is None or loss < least:
                best, least, waited = model, loss, 0
            else:
                waited += step
            done += step
            est = est.copy({est.initialWeights: model.weights})
        return best

    return Family("mlp", fit)


LOGIT_CLIP = 1e-6


def score(model: Model, df: DataFrame, prob: str = "prob", logit: str = "logit") -> DataFrame:
    """Add the positive-class probability and its log-odds.

    Log-odds come from the raw margins where a family has them and from the
    clipped probability elsewhere.
    """
    out = model.transform(df)
    p = vector_to_array("probability")[1]
    raw = vector_to_array("rawPrediction")
    if isinstance(model, LogisticRegressionModel):
        z = raw[1]
    elif isinstance(model, MultilayerPerceptronClassificationModel):
        z = raw[1] - raw[0]
    elif isinstance(model, GBTClassificationModel):
        z = 2.0 * raw[1]
    else:
        c = F.least(F.greatest(p, F.lit(LOGIT_CLIP)), F.lit(1.0 - LOGIT_CLIP))
        z = F.ln(c / (1.0 - c))
    return out.select(*df.columns, p.alias(prob), z.alias(logit))


def respond(scored: DataFrame, choice=None, t: float = 0.5, key: str = "key") -> DataFrame:
    """The scoring response: probability, calibrated probability, logit, prediction (>= t).

    ``choice`` is a chosen calibrator, which knows whether it reads the
    probability or the logit; without one the plain probability is repeated.
    """
    out = "probability_calibrated"
    cal = choice.transform(scored, out) if choice is not None else scored.withColumn(out, F.col("prob"))
    return cal.select(key, F.col("prob").alias("probability"), out, "logit", label_at(out, t, ">=").alias("prediction"))
