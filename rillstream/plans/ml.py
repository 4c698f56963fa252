"""Training, evaluating and applying a tree-ensemble classifier with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..functions import ratio


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    categorical: Sequence[str] = (),
    kind: str = "gbt",
    depth: int = 6,
    rounds: int = 20,
    seed: int = 45,
) -> PipelineModel:
    """Fit on executors only; no rows reach the driver.

    Booleans become 0/1, missing numbers the column's mean, categories integer
    codes in alphabetical order.
    """
    indexed = [f"{c}__ix" for c in categorical]
    numeric = [c for c in features if c not in categorical]
    filled = [f"{c}__in" for c in numeric]
    stages = [
        StringIndexer(inputCol=c, outputCol=i, stringOrderType="alphabetAsc", handleInvalid="keep")
        for c, i in zip(categorical, indexed)
    ]
    stages.append(Imputer(inputCols=numeric, outputCols=filled))
    stages.append(VectorAssembler(inputCols=[*filled, *indexed], outputCol="features"))
    if kind == "gbt":
        stages.append(GBTClassifier(
            labelCol=label, maxDepth=depth, maxIter=rounds, maxBins=64, seed=seed, maxMemoryInMB=512))
    else:
        stages.append(RandomForestClassifier(
            labelCol=label, maxDepth=depth, numTrees=rounds, maxBins=64, seed=seed, maxMemoryInMB=512))
    return Pipeline(stages=stages).fit(numeric_inputs(df, [*numeric, label]))


def numeric_inputs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with a ``prediction`` column; the input columns keep their types."""
    imputer = next(s for s in model.stages if hasattr(s, "surrogateDF"))
    names = imputer.getInputCols()
    raw = df.withColumns({f"__raw_{c}": F.col(c) for c in names})
    scored = model.transform(numeric_inputs(raw, names))
    kept = [F.col(f"__raw_{c}").alias(c) if c in names else F.col(c) for c in df.columns]
    return scored.select(*kept, F.col("prediction").cast("int").alias("prediction"))


def evaluate(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Confusion matrix, precision, recall, F1 and macro F1 in one pass.

    Without true positives precision, recall and F1 are NULL (nothing to evaluate).
    """
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    cm = pred.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    guard = lambda c: F.when(tp > 0, c)
    f1 = ratio(2 * tp, 2 * tp + fp + fn, 0.0)
    f1_negative = ratio(2 * tn, 2 * tn + fp + fn, 0.0)
    return cm.select(
        "tn", "fp", "fn", "tp",
        guard(ratio(tp, tp + fp)).alias("precision"), guard(ratio(tp, tp + fn)).alias("recall"),
        guard(f1).alias("f1"), ((f1 + f1_negative) / 2).alias("macro_f1"))
