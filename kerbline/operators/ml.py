"""Preparation, training, scoring and evaluation with Spark MLlib.

Fit everything that learns (category indexes, scaling, group facts) on the training part only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.operators.category_index import CategoryIndex
from kerbline.operators.features import index_categories, lump_rare
from kerbline.operators.metrics import binary_metrics
from kerbline.plans.durable import durable

SEED = 42


def prob1(vector: Column | str) -> Column:
    """Probability of class 1 out of a probability vector."""
    return F.element_at(vector_to_array(vector), 2)


def assemble(
    df: DataFrame, columns: Sequence[str], invalid: str = "error", name: str = "features_raw"
) -> DataFrame:
    return VectorAssembler(
        inputCols=list(columns), outputCol=name, handleInvalid=invalid
    ).transform(df)


def scale(
    df: DataFrame, with_mean: bool = False, source: str = "features_raw", name: str = "features"
) -> DataFrame:
    """Unit standard deviation per feature, centred on request; fitted on the rows given."""
    return StandardScaler(inputCol=source, outputCol=name, withMean=with_mean).fit(df).transform(df)


def preprocess(
    train: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str],
    with_mean: bool = False,
    invalid: str = "error",
) -> PipelineModel:
    """Fitted stages: index categories (unseen ones kept), assemble, scale to `features`.

    The index is a table, so the number of categories is not bounded. Trees treat the indexes as ordered
    numbers and need no bin per category.
    """
    indexed = [f"{c}_idx" for c in categories]
    stages = [CategoryIndex(inputCols=list(categories), outputCols=indexed)] if categories else []
    stages += [
        VectorAssembler(
            inputCols=[*numeric, *indexed], outputCol="features_raw", handleInvalid=invalid
        ),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=with_mean),
    ]
    return Pipeline(stages=stages).fit(train)


def feature_names(numeric: Sequence[str], categories: Sequence[str]) -> list[str]:
    return [*numeric, *[f"{c}_idx" for c in categories]]


def design_matrix(
    df: DataFrame,
    numeric: Sequence[str],
    street: str = "street_marker",
    device: str = "device_id",
    min_street: int = 50,
    min_device: int = 20,
) -> DataFrame:
    """`design`: the numeric block and a 0/1 place for every lumped street and device.

    The category places are sparse vectors, so the width costs nothing per row.
    """
    for column, least in ((street, min_street), (device, min_device)):
        df = lump_rare(df, column, least)
    lumped = [f"{street}_lumped", f"{device}_lumped"]
    # the encoder and the assembler each read the rows
    indexed = durable(index_categories(df, lumped))
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in lumped],
        outputCols=[f"{c}_hot" for c in lumped],
        dropLast=False,
    ).fit(indexed)
    return assemble(
        encoder.transform(indexed), [*numeric, *[f"{c}_hot" for c in lumped]], name="design"
    )


def logistic(weight: str | None = None, reg: float = 0.01, iterations: int = 50, **cols: str):
    more = {"weightCol": weight} if weight else {}
    return LogisticRegression(
        labelCol="label", regParam=reg, maxIter=iterations, elasticNetParam=0.0,
        **{"featuresCol": "features", **cols, **more},
    )


def fit_lr(train: DataFrame) -> Model:
    return logistic().fit(train)


def fit_weighted_lr(train: DataFrame, weight: str = "class_weight") -> Model:
    return logistic(weight, reg=0.1, iterations=100).fit(train)


def random_forest(trees: int = 100, depth: int = 10, least: int = 5):
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=least, seed=SEED, cacheNodeIds=True,
    )


def fit_rf(train: DataFrame, **params: int) -> Model:
    return random_forest(**params).fit(train)


def boosted_trees(depth: int = 5, iterations: int = 80, step: float = 0.1):
    return GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=iterations, maxDepth=depth,
        stepSize=step, seed=SEED,
    )


def fit_gbt(train: DataFrame, **params) -> Model:
    return boosted_trees(**params).fit(train)


def linear_svc(iterations: int = 50, reg: float = 0.1):
    return LinearSVC(featuresCol="features", labelCol="label", maxIter=iterations, regParam=reg)


def fit_svc(train: DataFrame, **params) -> Model:
    return linear_svc(**params).fit(train)


def decision_tree(depth: int = 8):
    return DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=depth, seed=SEED)


def fit_dt(train: DataFrame, **params: int) -> Model:
    return decision_tree(**params).fit(train)


def auc_evaluator() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    )


def fit_tuned_rf(
    train: DataFrame,
    trees: Sequence[int] = (100, 200),
    depths: Sequence[int] = (8, 12),
    parallelism: int = 4,
) -> TrainValidationSplitModel:
    """Best forest of a grid by AUC on a fifth of the rows held back, refitted on all of them."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", featureSubsetStrategy="sqrt", seed=SEED,
        probabilityCol="rf_prob", cacheNodeIds=True,
    )
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(trees))
        .addGrid(forest.maxDepth, list(depths))
        .build()
    )
    search = TrainValidationSplit(
        estimator=forest, estimatorParamMaps=grid, evaluator=auc_evaluator(),
        trainRatio=0.8, parallelism=parallelism, seed=SEED,
    )
    return search.fit(train)


def best_params(tuned: TrainValidationSplitModel) -> dict[str, float]:
    best = tuned.bestModel
    return {
        "numTrees": best.getNumTrees,
        "maxDepth": best.getOrDefault("maxDepth"),
        "validation_auc": max(tuned.validationMetrics),
    }


class _Nested(MLReadable, MLWritable):
    """Estimators or models kept together: `parts` names them, each is saved in a folder of its name."""

    parts = ("forest", "linear", "meta")

    def __init__(self, forest=None, linear=None, meta=None):
        super().__init__()
        self.forest, self.linear, self.meta = forest, linear, meta

    def write(self) -> MLWriter:
        return _NestedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _NestedReader(cls)


class _NestedWriter(MLWriter):
    def __init__(self, instance: _Nested):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for part in self.instance.parts:
            getattr(self.instance, part).write().save(f"{path}/{part}")


class _NestedReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        parts = [DefaultParamsReader.loadParamsInstance(f"{path}/{part}", self.sparkSession) for part in self.cls.parts]
        made = self.cls(*parts)
        made._resetUid(metadata["uid"])
        return made


class Stack(_Nested, Estimator):
    """A forest, a logistic regression, and one on top of their class-1 probabilities.

    The forest writes its probability to `rf_prob` and may be a trained model, which is then taken as it is.
    """

    def _fit(self, train: DataFrame) -> StackModel:
        forest = self.forest if isinstance(self.forest, Model) else self.forest.fit(train)
        model = StackModel(forest, self.linear.fit(train))
        model.meta = self.meta.fit(model.level_one(train))
        return model


class StackModel(_Nested, Model):
    """The trained stack; it saves and loads as one."""

    def level_one(self, df: DataFrame) -> DataFrame:
        both = self.linear.transform(self.forest.transform(df))
        probs = both.withColumns({"rf_prob1": prob1("rf_prob"), "lr_prob1": prob1("lr_prob")})
        return assemble(probs, ["rf_prob1", "lr_prob1"], name="stack_features")

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.meta.transform(self.level_one(df))


def stack(forest: Estimator | Model) -> Stack:
    """The stack on a forest, with a regularised regression beside it and a plain one on top."""
    linear = logistic(probabilityCol="lr_prob", rawPredictionCol="lr_raw", predictionCol="lr_pred")
    meta = logistic(
        reg=0.0, featuresCol="stack_features", probabilityCol="stack_prob",
        rawPredictionCol="stack_raw", predictionCol="stack_pred",
    )
    return Stack(forest, linear, meta)


def fit_stack(train: DataFrame, forest: Model | None = None) -> StackModel:
    """Stack on a tuned forest (or the one given, with its probability in `rf_prob`) and an LR."""
    return stack(forest or fit_tuned_rf(train).bestModel).fit(train)


def evaluate(
    preds: DataFrame, prediction: str = "prediction", raw: str = "rawPrediction"
) -> DataFrame:
    """One row: auc, accuracy, f1_weighted and the confusion counts tp, fp, fn, tn.

    The predictions are kept while the evaluations run.
    """
    preds.persist()
    try:
        multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol=prediction)
        counts = binary_metrics(preds.select("label", F.col(prediction).alias("prediction"))).first()
        row = (
            float(auc_evaluator().setRawPredictionCol(raw).evaluate(preds)),
            float(multi.setMetricName("accuracy").evaluate(preds)),
            float(multi.setMetricName("f1").evaluate(preds)),
            *(counts[c] for c in ("tp", "fp", "fn", "tn")),
        )
    finally:
        preds.unpersist()
    return preds.sparkSession.createDataFrame(
        [row], "auc double, accuracy double, f1_weighted double, tp long, fp long, fn long, tn long"
    )


def train_and_eval(
    estimator: Estimator | Callable[[DataFrame], Model], train: DataFrame, test: DataFrame
) -> tuple[Model, DataFrame, DataFrame]:
    """Model, test predictions and their metrics with confusion counts."""
    model = estimator.fit(train) if isinstance(estimator, Estimator) else estimator(train)
    preds = model.transform(test)
    return model, preds, evaluate(preds)


def score(
    model: Model,
    df: DataFrame,
    keep: Sequence[str] = (),
    probability: str = "probability",
    prediction: str = "prediction",
) -> DataFrame:
    """Label, prediction, probability of class 1 and the columns to keep; rows stay distributed."""
    scored = model.transform(df)
    return scored.select(
        "label",
        F.col(prediction).alias("prediction"),
        prob1(probability).alias("prob_occupied"),
        *[c for c in keep if c in scored.columns],
    )


def importances(model: Model, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Feature and importance, one row per feature of the model."""
    values = model.featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(
        list(zip(names, values, strict=True)), "feature string, importance double"
    )


def top_importances(table: DataFrame, k: int = 15) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(k)
