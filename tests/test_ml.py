"""Models on a learnable fixture: invariants rather than exact figures."""

import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from kerbline.functions.hashing import fraction
from kerbline.operators import ml
from kerbline.operators import model_tables as mt
from kerbline.operators.category_index import CategoryIndex
from kerbline.operators.sampling import parts, random_split
from kerbline.plans.durable import durable, spread
from kerbline.plans.jobs import score_export, train_and_export
from kerbline.sources.writers import save_model

NUMERIC, CATEGORIES = ["hour", "minutes"], ["street"]


@pytest.fixture(scope="module")
def prepared(spark):
    """Label follows the hour, with about one row in ten flipped."""
    df = spark.range(900).select(
        (F.col("id") * 7 % 24).cast("int").alias("hour"),
        (F.col("id") * 13 % 50 / 2.0).alias("minutes"),
        F.concat(F.lit("s"), F.col("id") % 5).alias("street"),
        F.col("id"),
    )
    clear = F.col("hour") >= 12
    df = df.withColumn("label", F.when(fraction(F.col("id"), 1) < 0.1, ~clear).otherwise(clear).cast("double"))
    train, test = parts(random_split(df, [2, 1], "id"))
    stages = ml.preprocess(train, NUMERIC, CATEGORIES)
    return stages.transform(train).repartition(4).cache(), stages.transform(test).repartition(2).cache()


def check(metrics):
    row = metrics.first()
    assert 0.8 < row.auc <= 1 and 0.8 < row.accuracy <= 1 and 0.8 < row.f1_weighted <= 1


@pytest.mark.parametrize(
    "fit",
    [
        ml.fit_lr,
        lambda t: ml.fit_dt(t, depth=3),
        lambda t: ml.fit_rf(t, trees=10, depth=4),
        lambda t: ml.fit_gbt(t, depth=3, iterations=5),
        lambda t: ml.fit_svc(t, iterations=20),
        lambda t: ml.fit_weighted_lr(t.withColumn("class_weight", F.lit(1.0))),
    ],
    ids=["lr", "dt", "rf", "gbt", "svc", "weighted_lr"],
)
def test_models_learn(prepared, fit):
    _, preds, metrics = ml.train_and_eval(fit, *prepared)
    check(metrics)
    assert preds.count() == prepared[1].count()


def test_train_and_eval_takes_an_estimator(prepared):
    check(ml.train_and_eval(ml.decision_tree(3), *prepared)[2])


def test_tuned_forest_stack_and_outputs(prepared, tmp_path):
    train, test = prepared
    tuned = ml.fit_tuned_rf(train, trees=(5, 8), depths=(2, 4))
    best = ml.best_params(tuned)
    assert best["numTrees"] in (5, 8) and best["maxDepth"] in (2, 4)
    check(ml.evaluate(tuned.bestModel.transform(test)))
    stack = ml.fit_stack(train, tuned.bestModel)
    check(ml.evaluate(stack.transform(test), "stack_pred", "stack_raw"))
    scored = ml.score(tuned.bestModel, test, ["hour", "absent"], probability="rf_prob")
    assert scored.columns == ["label", "prediction", "prob_occupied", "hour"]
    assert scored.filter("prob_occupied < 0 or prob_occupied > 1").isEmpty()
    assert scored.filter("(prob_occupied > 0.5) <> (prediction = 1)").count() <= 1
    table = ml.importances(tuned.bestModel, train, ml.feature_names(NUMERIC, CATEGORIES))
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert rows(ml.top_importances(table, 1), "feature") == [("hour",)]
    save_model(tuned.bestModel, str(tmp_path / "model"))
    save_model(tuned.bestModel, str(tmp_path / "model"))


def test_preprocess_keeps_unseen_and_refuses_null(spark, prepared):
    train = prepared[0].select("hour", "minutes", "street")
    stages = ml.preprocess(train, NUMERIC, CATEGORIES)
    unseen = train.limit(1).withColumn("street", F.lit("new"))
    assert stages.transform(unseen).count() == 1
    with pytest.raises(Exception, match="(?i)null|nan"):
        stages.transform(train.limit(1).withColumn("minutes", F.lit(None).cast("double"))).collect()
    lenient = ml.preprocess(train, NUMERIC, CATEGORIES, invalid="keep")
    empty = train.withColumn("minutes", F.lit(None).cast("double"))
    assert lenient.transform(empty).filter("features is not null").count() == train.count()


def test_many_categories_train_save_load_and_score_alike(spark, both_plans, tmp_path):
    """200,000 categories: the index is a table, in training, in the saved model and in scoring."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 1000 != 0, F.concat(F.lit("c"), F.col("id") % 200_000)).alias("c"),
        (F.col("id") % 3).cast("int").alias("e"), F.col("id").cast("double").alias("x"), "id",
    )
    stages = ml.preprocess(df, ["x"], ["c", "e"])
    made = stages.transform(df).select("id", ml.vector_to_array("features_raw").alias("f")).cache()
    assert made.count() == 300_000
    index = dict(rows(made.filter("id in (0, 1, 3, 100001, 150000)"), "id", "f"))
    # c1 to c99999 occur twice; ties in alphabetical order; nulls share the place after the last.
    assert index[1][1] == 0.0 and index[0][1] == index[150000][1] == 199_800.0
    assert index[1][2] == 1.0 and index[3][2] == 0.0
    save_model(stages, str(tmp_path / "stages"))
    save_model(stages, str(tmp_path / "stages"))
    loaded = PipelineModel.load(str(tmp_path / "stages"))
    again = loaded.transform(df).select("id", ml.vector_to_array("features_raw").alias("g"))
    assert made.join(again, "id").filter("f <> g").isEmpty()
    unseen = loaded.transform(df.limit(1).withColumn("c", F.lit("new")))
    assert unseen.select("c_idx").first()[0] == 199_800.0


def test_index_equals_string_indexer(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("b", 2), ("c", 10), ("a", None), (None, 2), ("é", 2)], "s string, n int")
    own = CategoryIndex(inputCols=["s", "n"], outputCols=["s_idx", "n_idx"]).fit(df).transform(df)
    theirs = StringIndexer(inputCols=["s", "n"], outputCols=["s_idx", "n_idx"], handleInvalid="keep").fit(df).transform(df)
    assert sorted(rows(own), key=str) == sorted(rows(theirs), key=str)
    empty = CategoryIndex(inputCols=["s"], outputCols=["i"]).fit(df.filter("false"))
    assert set(rows(empty.transform(df), "i")) == {(0.0,)}


@pytest.mark.parametrize("kind", ["dt", "rf", "gbt"])
def test_node_tables_score_like_the_model(spark, prepared, both_plans, kind, tmp_path):
    train, test = prepared
    model = {"dt": lambda: ml.fit_dt(train, depth=4), "rf": lambda: ml.fit_rf(train, trees=7, depth=5),
             "gbt": lambda: ml.fit_gbt(train, depth=3, iterations=4)}[kind]()
    trees = mt.tree_nodes(model, spark)
    scores = mt.tree_scores(trees, test, ["id"])
    both = model.transform(test).join(scores, "id")
    assert both.count() == test.count()
    assert both.filter(F.abs(ml.prob1("probability") - F.col("prob_walked")) > 1e-9).isEmpty()
    own = dict(rows(mt.node_importances(trees, ml.feature_names(NUMERIC, CATEGORIES))))
    for name, value in rows(ml.importances(model, train, ml.feature_names(NUMERIC, CATEGORIES))):
        assert own[name] == pytest.approx(value, abs=1e-9)
    if kind == "dt":
        reached = mt.leaves(trees, train, ["id", "label"]).groupBy("prediction", "stats").agg({"label": "sum", "id": "count"})
        assert all(r["count(id)"] % sum(r.stats) == 0 and r["sum(label)"] * sum(r.stats) == r["count(id)"] * r.stats[1] for r in reached.collect())


def test_categorical_splits_walk_like_the_model(spark):
    df = spark.range(600).select(
        "id", F.concat(F.lit("k"), F.col("id") % 7).alias("k"), (F.col("id") % 7).isin(1, 3, 6).cast("double").alias("label")
    )
    indexed = StringIndexer(inputCol="k", outputCol="i").fit(df).transform(df)
    ready = ml.assemble(indexed, ["i"], name="features")
    model = ml.fit_rf(ready, trees=3, depth=3)
    trees = mt.tree_nodes(model, spark)
    assert not trees.nodes.filter("categories is not null").isEmpty()
    both = model.transform(ready).join(mt.tree_scores(trees, ready, ["id"]), "id")
    assert both.filter(F.abs(ml.prob1("probability") - F.col("prob_walked")) > 1e-9).isEmpty()


def test_gradient_is_flat_only_at_the_optimum(spark, prepared):
    train, test = prepared
    names = ml.feature_names(NUMERIC, CATEGORIES)
    weighted = train.withColumn("w", F.when(F.col("label") == 1, 2.0).otherwise(0.5))
    for rows_, weight, reg in ((train, None, 0.01), (weighted, "w", 0.1)):
        model = ml.logistic(weight, reg=reg, iterations=100).fit(rows_)
        table = mt.coefficients(model, names, spark)
        slopes = dict(rows(mt.loss_gradient(table, rows_, reg, weight, key="id")))
        assert len(slopes) == len(names) + 1 and max(map(abs, slopes.values())) < 1e-4
        moved = table.withColumn("coefficient", F.col("coefficient") + F.when(F.col("place") == 0, 0.1).otherwise(0.0))
        assert abs(dict(rows(mt.loss_gradient(moved, rows_, reg, weight, key="id")))["hour"]) > 1e-3
    model = ml.fit_lr(train)
    found = mt.margins(mt.coefficients(model, names, spark), test, ["id"])
    both = model.transform(test).join(found, "id")
    assert both.filter(F.abs(ml.prob1("rawPrediction") - F.col("margin")) > 1e-9).isEmpty()


def test_stack_saves_and_loads(spark, prepared, tmp_path):
    train, test = prepared
    forest = ml.random_forest(trees=5, depth=3).setProbabilityCol("rf_prob")
    estimator = ml.stack(forest)
    save_model(estimator, str(tmp_path / "plan"))
    model = ml.Stack.load(str(tmp_path / "plan")).fit(train)
    stages = PipelineModel([model])
    save_model(stages, str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    a, b = (m.transform(test).select("id", "stack_prob", "stack_pred") for m in (model, loaded))
    assert sorted(rows(a), key=lambda r: r[0]) == sorted(rows(b), key=lambda r: r[0])
    check(ml.evaluate(a.join(test, "id").withColumnRenamed("stack_prob", "raw"), "stack_pred", "raw"))


def test_evaluate_counts_the_confusion(prepared):
    _, preds, metrics = ml.train_and_eval(ml.decision_tree(3), *prepared)
    row = metrics.first()
    assert row.tp + row.fn == preds.filter("label = 1").count()
    assert row.tp == preds.filter("label = 1 and prediction = 1").count()
    assert row.accuracy == pytest.approx((row.tp + row.tn) / preds.count())


def test_design_matrix_places(spark):
    df = spark.range(100).select(
        F.when(F.col("id") < 60, "a").when(F.col("id") < 99, "b").otherwise("c").alias("street_marker"),
        (F.col("id") % 2).cast("string").alias("device_id"), F.col("id").cast("double").alias("x"),
    )
    out = ml.design_matrix(df, ["x"], min_street=30, min_device=20)
    widths = out.select(F.size(ml.vector_to_array("design")).alias("w")).distinct()
    assert rows(widths) == [(1 + 3 + 2,)]
    ones = out.select(
        F.aggregate(ml.vector_to_array("design"), F.lit(0.0), lambda a, b: a + b).alias("s"), "x"
    )
    assert ones.filter("s <> x + 2").isEmpty()


def test_export_job(spark, tmp_path):
    from kerbline import schemas

    numeric, categories = ["Hour", "DwellMinutes"], ["AreaName"]
    clean = spark.range(400).select(
        (F.col("id") % 24).cast("int").alias("Hour"),
        (F.col("id") % 7).cast("double").alias("DwellMinutes"),
        F.concat(F.lit("A"), F.col("id") % 3).alias("AreaName"),
        F.lit("Present").alias("Status"),
        (F.col("id") % 24 >= 12).cast("int").alias("target_occupied"),
        F.col("id").alias("row"),
    )
    metrics = train_and_export(
        clean, str(tmp_path), key="row", numeric=numeric, categories=categories,
        trees=(5,), depths=(3,),
    )
    check(metrics)
    preds = spark.read.option("header", True).csv(str(tmp_path / "predictions"))
    assert preds.columns == ["label", "prediction", "prob_occupied", *numeric, *categories]
    found = spark.read.schema(schemas.IMPORTANCES).option("header", True).csv(
        str(tmp_path / "feature_importances")
    )
    assert found.count() == 3
    # The saved model scores cleaned rows by itself, as the test rows were scored.
    assert score_export(clean, str(tmp_path / "model"), str(tmp_path / "scored"), ["row"]) == clean.count()
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert scored.columns == ["row", "prediction", "prob_occupied"]
    both = scored.select(F.round("prob_occupied", 6).alias("p")).distinct()
    trained = preds.select(F.round(F.col("prob_occupied").cast("double"), 6).alias("p")).distinct()
    assert {x.p for x in trained.collect()} <= {x.p for x in both.collect()}


def test_walk_shuffles_no_row_per_level(spark, prepared, big_plans):
    train, test = prepared
    trees = mt.tree_nodes(ml.fit_rf(train, trees=5, depth=5), spark)
    reached = mt.leaves(trees, test, ["id"])
    plan = reached._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert reached.count() == 5 * test.count()


def test_training_partitions_follow_the_rows(spark):
    kept = durable(spark.range(20_000))
    cores = spark.sparkContext.defaultParallelism
    assert spread(kept).rdd.getNumPartitions() >= cores
    spark.conf.set("spark.kerbline.partitionRows", "100")
    try:
        parted = spread(kept)
        sizes = [n for (n,) in rows(parted.groupBy(F.spark_partition_id()).count(), "count")]
        assert len(sizes) == 200 and max(sizes) <= 150 and sum(sizes) == 20_000
    finally:
        spark.conf.unset("spark.kerbline.partitionRows")


def test_one_row_group_is_spread_though_it_covers_many_splits(spark):
    """Splits without rows do not count: all rows of a row group are in one of its file's splits."""
    kept = durable(spark.range(4_000).withColumn("text", F.sha2(F.col("id").cast("string"), 512)).coalesce(1))
    settings = {"spark.sql.files.maxPartitionBytes": "10000", "spark.sql.files.openCostInBytes": "1", "spark.kerbline.partitionRows": "500"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        cores = spark.sparkContext.defaultParallelism
        assert kept.rdd.getNumPartitions() >= max(cores, 8)
        sizes = spread(kept).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 4_000
        assert len(sizes) >= cores and max(r["count"] for r in sizes) <= 600
        assert spread(kept.filter("false")).count() == 0
    finally:
        for key in settings:
            spark.conf.unset(key)
