"""Probability calibration: Platt scaling, isotonic regression, and the choice between them.

Both fits read a table collapsed by score, so ties cost one row and a hot score
cannot fill a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.scalar import sigmoid
from tabwright.operators import metrics as M
from tabwright.operators import pooling
from tabwright.operators.split import assign_folds
from tabwright.session import settle


class PlattCalibrator:
    """Logistic regression of the label on the logit (L2, C = 1)."""

    def __init__(self, max_iter: int = 1000):
        self.max_iter = max_iter
        self.model: LogisticRegressionModel | None = None

    def fit(self, df: DataFrame, y: str, logit: str) -> PlattCalibrator:
        src = df.filter(F.col(y).isNotNull() & F.col(logit).isNotNull())
        c = src.groupBy(F.col(logit).alias("logit"), F.col(y).cast("double").alias("label")).agg(
            F.count(F.lit(1)).cast("double").alias("n")
        )
        c = VectorAssembler(inputCols=["logit"], outputCol="features").transform(c)
        total = src.count()
        self.model = LogisticRegression(
            weightCol="n", regParam=1.0 / total, elasticNetParam=0.0, standardization=False, maxIter=self.max_iter, tol=1e-12
        ).fit(c)
        return self

    def transform(self, df: DataFrame, logit: str, out: str = "prob_cal") -> DataFrame:
        if self.model is None:
            raise ValueError("PlattCalibrator must be fitted before transform")
        a, b = float(self.model.coefficients[0]), float(self.model.intercept)
        return df.withColumn(out, sigmoid(F.col(logit) * a + b))

    def write(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> PlattCalibrator:
        c = cls()
        c.model = LogisticRegressionModel.load(path)
        return c


OUT_OF_BOUNDS = ("clip", "nan", "raise")


#: Lines of an isotonic fit that are kept as a model of two arrays; longer fits stay a table that is joined.
MODEL_LINES = 1 << 18


class IsotonicCalibrator:
    """Increasing step fit with linear interpolation between its points."""

    def __init__(self, out_of_bounds: str = "clip"):
        if out_of_bounds not in OUT_OF_BOUNDS:
            raise ValueError(f"out_of_bounds must be one of {OUT_OF_BOUNDS}")
        self.out_of_bounds = out_of_bounds
        self.lines: DataFrame | None = None
        self.model: IsotonicRegressionModel | None = None

    def fit(self, df: DataFrame, y: str, p: str) -> IsotonicCalibrator:
        """Scores are collapsed and pooled chunk by chunk; NaN counts as missing."""
        v = F.col(p).cast("double")
        c = df.filter(F.col(y).isNotNull() & v.isNotNull() & ~F.isnan(v))
        c = c.groupBy(v.alias("x")).agg(F.count(F.lit(1)).cast("double").alias("w"), F.sum(F.col(y).cast("double")).alias("s"))
        blocks = settle(pooling.isotonic_blocks(c), "isotonic")
        self.lines = settle(pooling.lines(blocks), "lines")
        if self.lines.count() <= MODEL_LINES:
            ends = [F.struct(F.col(x).alias("p"), F.col(y).alias("label")) for x, y in (("lo", "value"), ("hi", "value"))]
            points = blocks.select(F.inline(F.array_distinct(F.array(*ends))))
            self.model = IsotonicRegression(featuresCol="p", isotonic=True).fit(points)
        return self

    def transform(self, df: DataFrame, p: str, out: str = "prob_cal") -> DataFrame:
        if self.lines is None:
            raise ValueError("IsotonicCalibrator must be fitted before transform")
        value = F.col(p).cast("double")
        if self.model is not None:
            m = self.model.copy().setFeaturesCol("_iso_in").setPredictionCol("_iso")
            # the model's own answer to NaN is a value: it is missing here
            res = m.transform(df.withColumn("_iso_in", F.coalesce(value, F.lit(float("nan")))))
            res = res.withColumn("_iso", F.when(~F.isnan("_iso_in"), F.col("_iso")))
        else:
            res = pooling.interpolate(df.withColumn("_iso_in", value), self.lines, "_iso_in", "_iso")
        found = F.col("_iso")
        if self.out_of_bounds != "clip":
            low, high = self.lines.agg(F.min("x0"), F.max("x1")).first() if self.model is None else (self.model.boundaries[0], self.model.boundaries[-1])
            outside = (F.col("_iso_in") < float(low)) | (F.col("_iso_in") > float(high))
            other = (
                F.lit(float("nan"))
                if self.out_of_bounds == "nan"
                else F.raise_error(F.lit("score outside the fitted range")).cast("double")
            )
            found = F.when(outside, other).otherwise(found)
        return res.withColumn(out, found).select(*[c for c in df.columns if c != out], out)

    def write(self, path: str) -> None:
        if self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")
        self.lines.write.mode("overwrite").parquet(f"{path}/lines")
        options = SparkSession.active().createDataFrame([(self.out_of_bounds, self.model is not None)], "out_of_bounds string, model boolean")
        options.write.mode("overwrite").json(f"{path}/options")

    @classmethod
    def load(cls, path: str) -> IsotonicCalibrator:
        options = SparkSession.active().read.json(f"{path}/options").first()
        c = cls(options["out_of_bounds"])
        c.lines = SparkSession.active().read.parquet(f"{path}/lines")
        if options["model"]:
            c.model = IsotonicRegressionModel.load(f"{path}/model")
        return c


def fit_calibrator(df: DataFrame, y: str, p: str | None = None, logit: str | None = None, method: str = "platt", out_of_bounds: str = "clip"):
    if method == "platt":
        if logit is None:
            raise ValueError("Platt scaling needs a logit column")
        return PlattCalibrator().fit(df, y, logit)
    if method == "isotonic":
        if p is None:
            raise ValueError("isotonic calibration needs a probability column")
        return IsotonicCalibrator(out_of_bounds).fit(df, y, p)
    raise ValueError(f"Unknown calibration method: {method}")


@dataclass
class Choice:
    """The chosen calibrator with the score of every candidate."""

    method: str
    calibrator: PlattCalibrator | IsotonicCalibrator | None
    scores: dict[str, float]
    p: str
    logit: str | None

    def transform(self, df: DataFrame, out: str = "prob_cal") -> DataFrame:
        if self.calibrator is None:
            return df.withColumn(out, F.col(self.p))
        return self.calibrator.transform(df, self.logit if self.method == "platt" else self.p, out)


def decide(scores: dict[str, float]) -> str:
    """Platt only if it beats both others, else isotonic if it beats the plain score."""
    inf = float("inf")
    base, iso, platt = scores["uncalibrated"], scores.get("isotonic", inf), scores.get("platt", inf)
    if platt < iso and platt < base:
        return "platt"
    return "isotonic" if iso < base else "uncalibrated"


def candidate_scores(df: DataFrame, y: str, candidates: dict[str, str], metric: str = "brier", n_bins: int = 10) -> DataFrame:
    """``(method, score)`` of several probability columns in one job."""
    if metric not in ("brier", "ece"):
        raise ValueError("metric must be 'brier' or 'ece'")
    items = F.array(*[F.struct(F.lit(m).alias("method"), F.col(c).alias("_p")) for m, c in candidates.items()])
    long = df.select(F.col(y).alias("_y"), F.inline(items))
    out = M.brier(long, "_y", "_p", ["method"]) if metric == "brier" else M.ece(long, "_y", "_p", ["method"], n_bins)
    return out.withColumnRenamed(metric, "score")


def select_best_calibrator(
    df: DataFrame,
    y: str,
    p: str,
    logit: str | None = None,
    metric: str = "brier",
    n_bins: int = 10,
    cross_fit: bool = False,
    key: str | None = None,
    k: int = 5,
    seed: int = 42,
) -> Choice:
    """Fit the candidates and keep the best by ``metric``.

    By default they are judged on the rows they were fitted on, which favours
    isotonic; ``cross_fit`` judges each row by a calibrator that did not see it.
    """

    def fitted(src, target):
        cal = {"isotonic": IsotonicCalibrator().fit(src, y, p)}
        out = cal["isotonic"].transform(target, p, "_iso_prob")
        if logit is not None:
            cal["platt"] = PlattCalibrator().fit(src, y, logit)
            out = cal["platt"].transform(out, logit, "_platt_prob")
        return cal, out

    cals, judged = fitted(df, df)
    if cross_fit:
        if key is None:
            raise ValueError("cross_fit needs a key")
        need = [c for c in (key, y, p, logit) if c is not None]
        f = settle(assign_folds(df.select(*need), key, k, seed, "_cal_fold"), "calibration-folds")
        parts = [fitted(f.filter(F.col("_cal_fold") != i), f.filter(F.col("_cal_fold") == i))[1] for i in range(k)]
        judged = parts[0]
        for part in parts[1:]:
            judged = judged.unionByName(part)
    cand = {"uncalibrated": p, "isotonic": "_iso_prob"} | ({"platt": "_platt_prob"} if logit is not None else {})
    scores = {r["method"]: r["score"] for r in candidate_scores(judged, y, cand, metric, n_bins).collect()}  # three rows
    best = decide(scores)
    return Choice(best, cals.get(best), scores, p, logit)
