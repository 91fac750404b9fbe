"""Model preparation, training, scoring and evaluation over the stand-in tables.

Vectors that SQL can work out are compared value by value. SQL cannot train, but it can say what a trained
model must satisfy: every test row has a score, which equals the score worked out from the model's own
tables (trees walked by joins, sums over coefficients); the gradient of the loss is 0 at the optimum; leaves
hold the rows that walk there; importances follow from the nodes. So these queries return, for each row,
node or feature, how far the two are apart, and counts that SQL gets from its own split.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.checks.common import DATED, plain, sql
from kerbline.checks.history_checks import LABELLED
from kerbline.operators import features as f
from kerbline.operators import ml
from kerbline.operators import model_tables as mt
from kerbline.operators import sampling as s
from kerbline.plans.durable import durable, spread
from kerbline.sources.standin import dated

NUMERIC = [
    "hour", "dow", "is_weekend", "duration_min", "log_duration_min", "is_peak",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "in_violation",
]
CATEGORIES = ["street_marker", "area_name"]
WEIGHTED, WEIGHTED_CATEGORIES = schemas.WEIGHTED_FEATURES, schemas.WEIGHTED_CATEGORIES
PLAIN_NUMBERS = ["hour", "dow", "is_weekend", "duration_min"]


def _rows(spark, sf):
    """Events with a label and the row-wise features."""
    labelled = f.target_occupied(dated(spark, sf)).withColumn(
        "label", F.col("target_occupied").cast("double")
    )
    return f.cyclic_time(f.is_peak(f.log_duration(labelled)))


def _split(spark, sf):
    """Train and test rows; the table is computed once."""
    rows = _rows(spark, sf).select("event_id", "label", *NUMERIC, *CATEGORIES)
    return s.parts(spread(durable(s.random_split(rows, [0.7, 0.3], "event_id"))))


def _prepared(spark, sf):
    """Train and test rows with `features`, fitted on the training part."""
    train, test = _split(spark, sf)
    stages = ml.preprocess(train, NUMERIC, CATEGORIES)
    return stages.transform(train), stages.transform(test)


def _values(df, vector, names):
    """Vector entries as columns."""
    cells = ml.vector_to_array(vector)
    return plain(df.select("event_id", *[cells[i].alias(n) for i, n in enumerate(names)]))


def _scaled(with_mean, spark, sf):
    rows = ml.scale(ml.assemble(dated(spark, sf), PLAIN_NUMBERS), with_mean)
    return _values(rows, "features", [f"{c}_scaled" for c in PLAIN_NUMBERS])


def _design(spark, sf):
    """Design matrix: the numbers, then which place of the street block and device block is set.

    The vectors are read as they are stored, most of them sparse, without writing out their zeros.
    """
    rows = ml.design_matrix(dated(spark, sf), PLAIN_NUMBERS)
    stored = F.unwrap_udt("design")
    dense = F.filter(
        F.transform(stored["values"], lambda x, i: F.when(x != 0.0, i)), lambda i: i.isNotNull()
    )
    places = F.filter(
        F.coalesce(stored["indices"], dense), lambda i: i >= len(PLAIN_NUMBERS)
    )
    return plain(
        rows.select(
            "event_id", *[F.col(n).cast("double").alias(n) for n in PLAIN_NUMBERS],
            F.coalesce(stored["size"], F.size(stored["values"])).alias("width"),
            F.element_at(places, 1).alias("street_place"),
            F.element_at(places, 2).alias("device_place"),
        )
    )


def _preprocessed(spark, sf):
    train, test = _split(spark, sf)
    stages = ml.preprocess(train, PLAIN_NUMBERS, CATEGORIES)
    names = [f"{n}_scaled" for n in ml.feature_names(PLAIN_NUMBERS, CATEGORIES)]
    return _values(stages.transform(test), "features", names)


def _apart(a, b):
    return F.abs(a - b)


def _class(prob):
    """Class of a probability; sums in another order must not move one half."""
    return F.when(F.round(prob, 9) > 0.5, 1.0).otherwise(0.0)


def _counted(rows, metrics, *columns):
    """Rows with the evaluation's numbers of positive and negative test rows."""
    found = metrics.select((F.col("tp") + F.col("fn")).alias("p"), (F.col("fp") + F.col("tn")).alias("n"))
    return plain(
        rows.select(
            "event_id", "label", *columns, found.select("p").scalar().alias("positives"),
            found.select("n").scalar().alias("negatives"),
        )
    )


def _walked(preds, trees, test, probability="probability"):
    """Predictions beside the scores of the node table."""
    joined = preds.join(mt.tree_scores(trees, test, ["event_id"]), "event_id")
    return joined.withColumns(
        {
            "prob_apart": _apart(ml.prob1(probability), F.col("prob_walked")),
            "prediction_apart": _apart(F.col("prediction"), _class(F.col("prob_walked"))),
        }
    )


def _trees(fit, spark, sf):
    train, test = _prepared(spark, sf)
    model, preds, metrics = ml.train_and_eval(fit, train, test)
    rows = _walked(preds, mt.tree_nodes(model, spark), test)
    return _counted(rows, metrics, "prob_apart", "prediction_apart")


def _tree(spark, sf):
    """One tree: its scores, and whether the training rows that walk to a leaf are those it counted."""
    train, test = _prepared(spark, sf)
    model, preds, metrics = ml.train_and_eval(ml.fit_dt, train, test)
    trees = mt.tree_nodes(model, spark)
    reached = mt.leaves(trees, train, ["event_id", "label"])
    counts = reached.groupBy("stats").agg(
        F.count_if(F.col("label") == 0).alias("zeros"), F.count_if(F.col("label") == 1).alias("ones"),
        F.count_distinct("prediction").alias("leaves"),
    )
    # Leaves with the same class counts meet here; both then hold a multiple of them.
    wrong = counts.filter("zeros * stats[1] <> ones * stats[0]").agg(F.count(F.lit(1))).scalar()
    rows = _walked(preds, trees, test).withColumns(
        {"wrong_leaves": wrong, "trained_on": trees.nodes.filter("node = 0").select("cover").scalar()}
    )
    return _counted(rows, metrics, "prob_apart", "prediction_apart", "wrong_leaves", "trained_on")


def _tuned(spark, sf):
    train, test = _prepared(spark, sf)
    tuned = ml.fit_tuned_rf(train)
    best, forest = ml.best_params(tuned), tuned.bestModel
    preds = forest.transform(test)
    trees = mt.tree_nodes(forest, spark)
    in_grid = best["numTrees"] in (100, 200) and best["maxDepth"] in (8, 12) and trees.trees == best["numTrees"]
    rows = _walked(preds, trees, test, "rf_prob").withColumn("in_grid", F.lit(in_grid))
    return _counted(rows, ml.evaluate(preds), "prob_apart", "prediction_apart", "in_grid")


def _gradient(names, train, model, reg, weight=None):
    table = mt.coefficients(model, names, train.sparkSession)
    slopes = mt.loss_gradient(table, train, reg, weight)
    # The optimiser stops near the optimum: derivatives to three digits.
    return slopes.select(
        "feature", (F.round("gradient", 3) + 0.0).alias("gradient"),
        train.agg(F.count(F.lit(1))).scalar().alias("trained_on"),
    )


def _lr(spark, sf):
    train, _ = _prepared(spark, sf)
    return _gradient(ml.feature_names(NUMERIC, CATEGORIES), durable(train), ml.fit_lr(train), 0.01)


def _weighted_lr(spark, sf):
    rows = f.hour_bucket_name(f.interactions(_rows(spark, sf)))
    split = s.stratified_split(s.class_weights(rows), "event_id")
    train, test = s.parts(spread(durable(split)))
    stages = ml.preprocess(train, WEIGHTED, WEIGHTED_CATEGORIES, with_mean=True, invalid="keep")
    ready = durable(stages.transform(train))
    names = ml.feature_names(WEIGHTED, WEIGHTED_CATEGORIES)
    return _gradient(names, ready, ml.fit_weighted_lr(ready), 0.1, "class_weight")


def _linear(spark, sf, fit, raw):
    """Predictions of a linear model beside the margins of its coefficients."""
    train, test = _prepared(spark, sf)
    model, preds, metrics = ml.train_and_eval(fit, train, test)
    table = mt.coefficients(model, ml.feature_names(NUMERIC, CATEGORIES), spark)
    joined = preds.join(mt.margins(table, test, ["event_id"]), "event_id")
    return joined.withColumn("raw_apart", _apart(ml.prob1(raw), F.col("margin"))), metrics


def _svc(spark, sf):
    rows, metrics = _linear(spark, sf, ml.fit_svc, "rawPrediction")
    sign = F.when(F.col("margin") > 0, 1.0).otherwise(0.0)
    return _counted(
        rows.withColumn("prediction_apart", _apart(F.col("prediction"), sign)), metrics, "raw_apart", "prediction_apart"
    )


def _prob1(spark, sf):
    rows, _ = _linear(spark, sf, ml.fit_lr, "rawPrediction")
    own = mt.sigmoid(F.col("margin"))
    return plain(rows.select("event_id", "label", _apart(ml.prob1("probability"), own).alias("prob_apart")))


def _stack(spark, sf):
    """The stack's probability, worked out from the forest's nodes and both tables of coefficients."""
    train, test = _prepared(spark, sf)
    names = ml.feature_names(NUMERIC, CATEGORIES)
    forest = ml.random_forest().setProbabilityCol("rf_prob").fit(train)
    model = ml.fit_stack(train, forest)
    preds = model.transform(test)
    linear = mt.margins(mt.coefficients(model.linear, names, spark), test, ["event_id"])
    walked = mt.tree_scores(mt.tree_nodes(forest, spark), test, ["event_id"]).join(linear, "event_id")
    low, rf, lr = (model.meta.intercept, *model.meta.coefficients.toArray().tolist())
    meta = low + rf * F.col("prob_walked") + lr * mt.sigmoid(F.col("margin"))
    rows = preds.join(walked, "event_id").withColumns(
        {
            "prob_apart": _apart(ml.prob1("stack_prob"), mt.sigmoid(meta)),
            "prediction_apart": _apart(F.col("stack_pred"), _class(mt.sigmoid(meta))),
        }
    )
    return _counted(rows, ml.evaluate(preds, "stack_pred", "stack_raw"), "prob_apart", "prediction_apart")


def _score(spark, sf):
    train, test = _prepared(spark, sf)
    model = ml.fit_rf(train)
    scored = ml.score(model, test, ["event_id", *NUMERIC, *CATEGORIES])
    walked = mt.tree_scores(mt.tree_nodes(model, spark), test, ["event_id"])
    return plain(
        scored.join(walked, "event_id").select(
            "event_id", "label", *PLAIN_NUMBERS, *CATEGORIES,
            _apart(F.col("prob_occupied"), F.col("prob_walked")).alias("prob_apart"),
            _apart(F.col("prediction"), _class(F.col("prob_walked"))).alias("prediction_apart"),
        )
    )


def _importances(spark, sf):
    train, _ = _prepared(spark, sf)
    names = ml.feature_names(NUMERIC, CATEGORIES)
    model = ml.fit_rf(train)
    own = mt.node_importances(mt.tree_nodes(model, spark), names).withColumnRenamed("importance", "own")
    table = ml.top_importances(ml.importances(model, train, names))
    return plain(table.join(own, "feature").select("feature", _apart(F.col("importance"), F.col("own")).alias("importance_apart")))


QUERIES = {
    "assemble": lambda p, d: _values(
        ml.assemble(dated(p, d), PLAIN_NUMBERS), "features_raw", PLAIN_NUMBERS
    ),
    "scale": partial(_scaled, False),
    "scale_centred": partial(_scaled, True),
    "design_matrix": _design,
    "preprocess": _preprocessed,
    "prob1": _prob1,
    "fit_lr": _lr,
    "fit_weighted_lr": _weighted_lr,
    "fit_rf": partial(_trees, ml.fit_rf),
    "fit_gbt": partial(_trees, ml.fit_gbt),
    "fit_svc": _svc,
    "fit_dt": _tree,
    "fit_tuned_rf": _tuned,
    "fit_stack": _stack,
    "score": _score,
    "importances": _importances,
}

BUCKET = "CAST('0x' || substr(md5(event_id || '#42'), 1, 8) AS BIGINT)"
CUT = "CAST(floor(4294967296 * 0.7) AS BIGINT)"
SCALED = tuple(f"{c}_scaled" for c in PLAIN_NUMBERS)


def _index(column: str, rows: str) -> str:
    return f"""(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i
      FROM {rows} GROUP BY {column})"""


SPLIT = f"""{LABELLED},
train AS (SELECT * FROM labelled WHERE {BUCKET} < {CUT}),
test AS (SELECT *, CAST(0.0 AS DOUBLE) AS nil FROM labelled WHERE {BUCKET} >= {CUT})"""
COUNTS = """(SELECT count(*) FILTER (label = 1) FROM test) AS positives,
  (SELECT count(*) FILTER (label = 0) FROM test) AS negatives"""


def _agrees(*nils: str, more: str = "") -> str:
    """Each test row, with nothing apart, and the size of the classes."""
    same = "".join(f", nil AS {n}" for n in nils)
    return f"WITH {SPLIT}\nSELECT event_id, label{same}{more}, {COUNTS} FROM test"


def _flat(names: list[str]) -> str:
    listed = ", ".join(f"('{n}')" for n in [mt.INTERCEPT, *names])
    return f"""WITH {SPLIT}
    SELECT feature, CAST(0.0 AS DOUBLE) AS gradient, (SELECT count(*) FROM train) AS trained_on
    FROM (VALUES {listed}) AS t(feature)"""


SQL = {
    "assemble": sql(
        DATED,
        "SELECT event_id, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in PLAIN_NUMBERS)
        + " FROM dated",
        tuple(PLAIN_NUMBERS),
    ),
    "scale": sql(
        DATED,
        "SELECT event_id, "
        + ", ".join(f"{c} / stddev_samp({c}) OVER () AS {c}_scaled" for c in PLAIN_NUMBERS)
        + " FROM dated",
        SCALED,
    ),
    "scale_centred": sql(
        DATED,
        "SELECT event_id, "
        + ", ".join(
            f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}_scaled"
            for c in PLAIN_NUMBERS
        )
        + " FROM dated",
        SCALED,
    ),
    "design_matrix": sql(
        f"""{DATED},
        lumped AS (SELECT *,
          CASE WHEN count(*) OVER (PARTITION BY street_marker) >= 50 THEN street_marker
               ELSE '_OTHER' END AS street,
          CASE WHEN count(*) OVER (PARTITION BY device_id) >= 20 THEN device_id
               ELSE '_OTHER' END AS device FROM dated)""",
        f"""SELECT event_id, CAST(hour AS DOUBLE) AS hour, CAST(dow AS DOUBLE) AS dow,
          CAST(is_weekend AS DOUBLE) AS is_weekend, duration_min,
          CAST(4 + (SELECT count(DISTINCT street) + count(DISTINCT device) FROM lumped)
            AS INTEGER) AS width,
          CAST(4 + st.i AS INTEGER) AS street_place,
          CAST(4 + (SELECT count(DISTINCT street) FROM lumped) + de.i AS INTEGER) AS device_place
        FROM lumped JOIN {_index("street", "lumped")} st USING (street)
        JOIN {_index("device", "lumped")} de USING (device)""",
        ("hour", "dow", "is_weekend", "duration_min"),
    ),
    "preprocess": sql(
        f"""{DATED},
        train AS (SELECT * FROM dated WHERE {BUCKET} < {CUT}),
        test AS (SELECT * FROM dated WHERE {BUCKET} >= {CUT}),
        st AS {_index("street_marker", "train")},
        ar AS {_index("area_name", "train")},
        sd AS (SELECT stddev_samp(hour) AS h, stddev_samp(dow) AS d, stddev_samp(is_weekend) AS w,
          stddev_samp(duration_min) AS m, stddev_samp(st.i) AS s, stddev_samp(ar.i) AS a
          FROM train JOIN st USING (street_marker) JOIN ar USING (area_name))""",
        """SELECT event_id, hour / h AS hour_scaled, dow / d AS dow_scaled,
          is_weekend / w AS is_weekend_scaled, duration_min / m AS duration_min_scaled,
          coalesce(st.i, (SELECT count(*) FROM st)) / s AS street_marker_idx_scaled,
          coalesce(ar.i, (SELECT count(*) FROM ar)) / a AS area_name_idx_scaled
        FROM test LEFT JOIN st USING (street_marker) LEFT JOIN ar USING (area_name), sd""",
        SCALED + ("street_marker_idx_scaled", "area_name_idx_scaled"),
    ),
    "prob1": f"WITH {SPLIT}\nSELECT event_id, label, nil AS prob_apart FROM test",
    "fit_lr": _flat(ml.feature_names(NUMERIC, CATEGORIES)),
    "fit_weighted_lr": _flat(ml.feature_names(WEIGHTED, WEIGHTED_CATEGORIES)),
    "fit_rf": _agrees("prob_apart", "prediction_apart"),
    "fit_gbt": _agrees("prob_apart", "prediction_apart"),
    "fit_svc": _agrees("raw_apart", "prediction_apart"),
    "fit_dt": _agrees(
        "prob_apart", "prediction_apart",
        more=""", CAST(0 AS BIGINT) AS wrong_leaves,
        (SELECT CAST(count(*) AS DOUBLE) FROM train) AS trained_on""",
    ),
    "fit_tuned_rf": _agrees("prob_apart", "prediction_apart", more=", true AS in_grid"),
    "fit_stack": _agrees("prob_apart", "prediction_apart"),
    "score": sql(
        SPLIT,
        f"""SELECT event_id, label, hour, dow, is_weekend, duration_min, {", ".join(CATEGORIES)},
          nil AS prob_apart, nil AS prediction_apart FROM test""",
        ("duration_min",),
    ),
    "importances": "SELECT feature, CAST(0.0 AS DOUBLE) AS importance_apart FROM (VALUES "
    + ", ".join(f"('{n}')" for n in ml.feature_names(NUMERIC, CATEGORIES))
    + ") AS t(feature)",
}
