"""Whole jobs: export to tables, tables to model outputs.

Run as `python -m kerbline.plans.jobs <job> --help`, or call the functions.
"""

from __future__ import annotations

import argparse
import warnings
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline import schemas
from kerbline.operators import cleaning, features, metrics, ml, reports, sampling, stats
from kerbline.operators.metrics import binary_metrics
from kerbline.plans import tables
from kerbline.plans.durable import durable, spread
from kerbline.session import build_session
from kerbline.sources import readers, writers
from kerbline.streaming import intake, sinks, windows


def clean_export(
    spark: SparkSession, export: str, out: str, zone: str, high: datetime, k: int = 7_500
) -> None:
    """Sensor export to normalised rows, cleaned table and narrow model table, all rows, as Parquet.

    A balanced sample of `k` rows per status is written beside them; nothing else is made from it.
    """
    raw = readers.read_raw_csv(spark, export)
    writers.write_parquet(tables.all_rows(raw, ["DeviceId", "StreetMarker"]), f"{out}/rows")
    rows = spark.read.parquet(f"{out}/rows")
    writers.write_parquet(tables.sample_rows(rows, k), f"{out}/sample")
    writers.write_parquet(tables.clean_table(rows, zone, high), f"{out}/clean")
    writers.write_parquet(tables.ml_ready(spark.read.parquet(f"{out}/clean")), f"{out}/ml_ready")


def prepare_data(spark: SparkSession, clean_csv: str, out: str) -> int:
    """Cleaned CSV to typed Parquet; returns the row count."""
    return writers.write_parquet(readers.read_clean_csv(spark, clean_csv), out)


def build_silver(
    spark: SparkSession, export: str, out: str, minutes: int = 15, multi_line: bool | None = None
) -> None:
    """Loose export to bronze by date, then train-ready rows.

    An export without line breaks in fields is read by many tasks; `multi_line` saves the look for them.
    """
    loose = readers.read_loose_csv(spark, export, multi_line)
    writers.write_bronze(cleaning.bronze_events(loose), f"{out}/bronze")
    made = tables.silver_tables(readers.read_bronze(spark, f"{out}/bronze"), minutes)
    writers.write_parquet(made["train_ready"], f"{out}/train_ready")


def checked(df: DataFrame, out: str, required: Sequence[str], features: Sequence[str], **names: str) -> list[str]:
    """Write the quality report of a job's input under `out` and return the features that it has.

    A missing required column or a target other than 0 and 1 stops the job; missing features are left out
    with a warning.
    """
    report = durable(stats.quality_report(df, required, features, **names))
    writers.write_csv(report, f"{out}/quality")
    found = {row.check: row.violations for row in report.collect()}  # a row per check
    fatal = {c: found[c] for c in ("missing_required_columns", "target_not_binary") if found.get(c)}
    if fatal:
        raise ValueError(f"the input fails its checks: {fatal}")
    absent = [c for c in features if c not in df.columns]
    if absent:
        warnings.warn(f"features the table lacks are left out: {absent}", stacklevel=3)
    return [c for c in features if c in df.columns]


def _split(
    clean: DataFrame, out: str, key: str, numeric: Sequence[str], categories: Sequence[str]
) -> tuple[PipelineModel, DataFrame, DataFrame, list[str], list[str]]:
    """Checked rows, 70 % to train on, as fitted stages, train and test rows, and the features there are."""
    have = checked(clean, out, [key, "target_occupied"], [*numeric, *categories])
    numeric, categories = [c for c in numeric if c in have], [c for c in categories if c in have]
    rows = tables.model_rows(clean, numeric, categories)
    split = sampling.random_split(rows, [0.7, 0.3], key)
    narrow = split.select("label", *numeric, *categories, "part")
    train, test = sampling.parts(spread(durable(narrow)))
    return ml.preprocess(train, numeric, categories), train, test, numeric, categories


def train_and_export(
    clean: DataFrame,
    out: str,
    key: str,
    numeric: Sequence[str] = schemas.NUMERIC_FEATURES,
    categories: Sequence[str] = schemas.CATEGORY_FEATURES,
    trees: Sequence[int] = (100, 200),
    depths: Sequence[int] = (8, 12),
) -> DataFrame:
    """Tuned forest on 70 % of the rows; predictions, importances, metrics, best parameters and model under `out`.

    `key` names a unique column that assigns rows to train or test. Returns the test metrics with the
    confusion counts.
    """
    stages, train, test, numeric, categories = _split(clean, out, key, numeric, categories)
    tuned = ml.fit_tuned_rf(stages.transform(train), trees, depths)
    best, ready = tuned.bestModel, stages.transform(test)
    names = ml.feature_names(numeric, categories)
    writers.write_csv(
        ml.score(best, ready, [*numeric, *categories], probability="rf_prob"), f"{out}/predictions"
    )
    writers.write_csv(ml.importances(best, clean, names), f"{out}/feature_importances")
    found = ml.best_params(tuned)
    listed = clean.sparkSession.createDataFrame([(n, float(v)) for n, v in found.items()], "parameter string, value double")
    writers.write_csv(listed, f"{out}/best_params")
    # One model from cleaned rows to predictions: indexes, scaling and forest together.
    writers.save_model(PipelineModel([*stages.stages, best]), f"{out}/model")
    metrics = ml.evaluate(best.transform(ready))
    writers.write_csv(metrics, f"{out}/metrics")
    return metrics


def train_weighted(ready: DataFrame, out: str, key: str | None = None) -> DataFrame:
    """Class-weighted logistic regression on the narrow model table; model, predictions and metrics under `out`.

    Rows are split by class at the digest of `key`, or of all their columns. Returns the test metrics.
    """
    needed = ["target_occupied", "hour", "dow", "is_weekend", "duration_min", "street_marker"]
    checked(ready, out, needed, [])
    labelled = cleaning.cast_label(ready.withColumnRenamed("target_occupied", "label"))
    rows = cleaning.require_not_null(labelled, ["label", *needed[1:]])
    rows = features.is_peak(features.hour_bucket_name(features.log_duration(features.interactions(rows))))
    if key is None:
        key, columns = "_key", [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]
        rows = rows.withColumn(key, F.concat_ws("|", *columns))
    split = sampling.stratified_split(sampling.class_weights(rows), key)
    train, test = sampling.parts(spread(durable(split)))
    stages = ml.preprocess(train, schemas.WEIGHTED_FEATURES, schemas.WEIGHTED_CATEGORIES, with_mean=True, invalid="keep")
    model, preds, metrics = ml.train_and_eval(ml.fit_weighted_lr, stages.transform(train), stages.transform(test))
    kept = [c for c in ("device_id", "street_marker", "hour", "dow", "is_weekend", "duration_min") if c in ready.columns]
    writers.write_csv(
        preds.select(*kept, "label", "prediction", ml.prob1("probability").alias("prob_occupied")), f"{out}/predictions"
    )
    counts = F.broadcast(binary_metrics(preds).select("precision", "recall"))
    metrics = durable(metrics.join(counts))
    writers.write_csv(metrics, f"{out}/metrics")
    writers.save_model(PipelineModel([*stages.stages, model]), f"{out}/model")
    return metrics


#: Models that the comparison trains, by name: estimator, prediction and raw score.
COMPARED = {
    "logistic": lambda: (ml.logistic(), "prediction", "rawPrediction"),
    "tree": lambda: (ml.decision_tree(), "prediction", "rawPrediction"),
    "forest": lambda: (ml.random_forest(), "prediction", "rawPrediction"),
    "boosted": lambda: (ml.boosted_trees(), "prediction", "rawPrediction"),
    "svc": lambda: (ml.linear_svc(), "prediction", "rawPrediction"),
    "stack": lambda: (ml.stack(ml.random_forest().setProbabilityCol("rf_prob")), "stack_pred", "stack_raw"),
}


def compare_models(
    clean: DataFrame,
    out: str,
    key: str,
    numeric: Sequence[str] = schemas.NUMERIC_FEATURES,
    categories: Sequence[str] = schemas.CATEGORY_FEATURES,
    models: dict | None = None,
) -> DataFrame:
    """Train several models on one split; each saved with its stages, a row of test metrics each, best first."""
    stages, train, test, *_ = _split(clean, out, key, numeric, categories)
    ready, held = durable(stages.transform(train)), durable(stages.transform(test))
    rows = []
    for name, make in (models or COMPARED).items():
        estimator, prediction, raw = make()
        model = estimator.fit(ready)
        rows.append(ml.evaluate(model.transform(held), prediction, raw).withColumn("model", F.lit(name)))
        writers.save_model(PipelineModel([*stages.stages, model]), f"{out}/models/{name}")
    table = durable(sampling.union_by_name(rows).select("model", *[c for c in rows[0].columns if c != "model"]))
    ordered = table.orderBy(F.desc("auc"), "model")
    writers.write_csv(ordered.coalesce(1), f"{out}/comparison")
    return ordered


def report_rows(clean: DataFrame) -> DataFrame:
    """Cleaned rows under the names that the reports use; weekdays from 1 = Sunday."""
    found = cleaning.find_columns(clean)
    return clean.select(
        F.col(found["street_marker"]).alias("street_marker"),
        F.col("AreaName").alias("area_name"),
        F.col("_event_time").alias("event_time"),
        F.col("_hour").alias("hour"),
        ((F.col("_dow") + 1) % 7 + 1).cast("int").alias("dow"),
        F.col("_occupied").alias("occupied"),
        F.col("InViolation").alias("in_violation"),
        F.col("_duration_min").alias("duration_min"),
    )


def write_reports(
    clean: DataFrame,
    preds: DataFrame,
    importances: DataFrame,
    out: str,
    areas: Sequence[str] | None = None,
    streets: Sequence[str] | None = None,
    days: Sequence[str] | None = None,
    hours: tuple[int, int] = (0, 23),
    min_n: int = 50,
) -> dict[str, int]:
    """All tables a dashboard shows, for a choice of areas, streets, weekdays and hours, as Parquet under `out`.

    Rows are filtered once and kept; the choices that are open are written too. Returns rows per table.
    """
    every = report_rows(clean)
    rows = durable(cleaning.apply_filters(every, areas, streets, days, hours))
    by_day = rows.withColumn("dow0", (F.col("dow") + 5) % 7)
    held = durable(preds)
    made = {
        "areas": cleaning.filter_options(every, "area_name"),
        "streets": cleaning.filter_options(every, "street_marker"),
        "kpis": reports.kpi_rates(rows),
        "class_balance": reports.class_balance(rows, "occupied"),
        "by_hour": reports.occ_by_hour(rows),
        "by_weekday": reports.occ_by_dow(by_day),
        "by_street": reports.occ_by_street(rows),
        "street_hour": reports.street_hour_pivot(rows),
        "day_hour": reports.day_hour_heatmap(rows),
        "top_streets": reports.top_streets(rows, min_n),
        "violation_by_area": reports.violation_by_area(rows, min_n),
        "daily": reports.daily_trend(rows),
        "street_cv": reports.street_cv(rows),
        "dwell_histogram": reports.dwell_histogram(rows),
        "dwell_by_violation": reports.dwell_by_violation(rows),
        "model_kpis": metrics.kpi_model(held),
        "confusion": metrics.confusion_matrix(held),
        "roc": metrics.roc_curve(held),
        "auc": metrics.auc(held),
        "importances": ml.top_importances(importances),
    }
    return {name: writers.write_parquet(table, f"{out}/{name}") for name, table in made.items()}


def score_export(
    clean: DataFrame, model: str, out: str, keep: Sequence[str] = (),
    prediction: str = "prediction", probability: str = "rf_prob",
) -> int:
    """Predictions of a saved model for cleaned rows, with the columns to keep; returns their number.

    Rows with a null in a feature cannot be scored and are left out, as in training.
    """
    whole = PipelineModel.load(model)
    wanted = whole.stages[0].getInputCols() if whole.stages[0].hasParam("inputCols") else []
    numeric = [c for s in whole.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    features = [c for c in dict.fromkeys([*wanted, *numeric]) if c in clean.columns]
    rows = clean.dropna(subset=features)
    flags = {c: F.col(c).cast("double") for c, kind in rows.dtypes if kind == "boolean" and c in features}
    scored = whole.transform(rows.withColumns(flags))
    return writers.write_parquet(
        scored.select(
            *keep, F.col(prediction).alias("prediction"), ml.prob1(probability).alias("prob_occupied")
        ),
        out,
    )


def stream_windows(spark: SparkSession, source: str, out: str, state: str, once: bool = False):
    """Event files to window occupancy; runs until stopped unless `once`."""
    stream = windows.window_occupancy(windows.stream_events(spark, source))
    return sinks.start_window_sink(stream, out, state, once=once)


def stream_changes(spark: SparkSession, source: str, out: str, state: str, once: bool = False):
    """Event files to intake, then closed windows with their change; rejects stay under `out`/intake.

    Runs until stopped unless `once`. Returns the two queries.
    """
    taken = intake.start_intake(spark, source, f"{out}/intake", f"{state}/intake", once=once)
    if once:
        taken.awaitTermination()
    stream = windows.occupancy_change_stream(intake.event_stream(spark, f"{out}/intake"))
    return taken, sinks.start_append_sink(stream, f"{out}/changes", f"{state}/changes", once=once)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kerbline")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, fields in {
        "clean": ("export", "out", "zone"),
        "prepare": ("clean_csv", "out"),
        "silver": ("export", "out"),
        "train": ("clean", "out", "key"),
        "weighted": ("ml_ready", "out"),
        "compare": ("clean", "out", "key"),
        "score": ("clean", "model", "out"),
        "report": ("clean", "model_out", "out"),
        "stream": ("source", "out", "state"),
        "changes": ("source", "out", "state"),
    }.items():
        job = jobs.add_parser(name)
        for field in fields:
            job.add_argument(field)
        if name == "clean":
            job.add_argument("--sample", type=int, default=7_500, help="rows per status in the sample")
        if name == "report":
            for choice in ("area", "street", "day"):
                job.add_argument(f"--{choice}", action="append", help=f"only this {choice}; may be repeated")
        if name == "silver":
            job.add_argument("--single-line", action="store_true", help="no line breaks in fields")
    args = parser.parse_args(argv)
    spark = build_session()
    if args.job == "clean":
        tomorrow = datetime.now(UTC) + timedelta(days=1)
        clean_export(spark, args.export, args.out, args.zone, tomorrow, args.sample)
    elif args.job == "prepare":
        prepare_data(spark, args.clean_csv, args.out)
    elif args.job == "silver":
        build_silver(spark, args.export, args.out, multi_line=False if args.single_line else None)
    elif args.job == "train":
        train_and_export(spark.read.parquet(args.clean), args.out, args.key).show()
    elif args.job == "weighted":
        train_weighted(spark.read.parquet(args.ml_ready), args.out).show()
    elif args.job == "compare":
        compare_models(spark.read.parquet(args.clean), args.out, args.key).show()
    elif args.job == "report":
        preds = readers.read_predictions(spark, f"{args.model_out}/predictions")
        found = readers.read_importances(spark, f"{args.model_out}/feature_importances")
        write_reports(spark.read.parquet(args.clean), preds, found, args.out, args.area, args.street, args.day)
    elif args.job == "changes":
        for query in stream_changes(spark, args.source, args.out, args.state):
            query.awaitTermination()
    elif args.job == "score":
        score_export(spark.read.parquet(args.clean), args.model, args.out)
    else:
        stream_windows(spark, args.source, args.out, args.state).awaitTermination()


if __name__ == "__main__":
    main()
