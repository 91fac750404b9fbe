"""Statistics, reports, metrics and batch windows over the stand-in tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.checks.cleaning_checks import bronze
from kerbline.checks.common import BRONZE, DATED, LOOSE, PREDS, SENSORS, plain, sql
from kerbline.operators import metrics as m
from kerbline.operators import reports as r
from kerbline.operators import stats
from kerbline.sources.standin import dated, loose, predictions, sensors, table
from kerbline.streaming import windows as w

OCCUPANCY_NAMES = {0: "Free", 1: "Occupied"}
VIOLATION_NAMES = {False: "Compliant", True: "Violation"}


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


def _quality_rows(spark, sf):
    return dated(spark, sf).select(
        "event_id", "device_id", F.col("occupied").alias("target_occupied"),
        (F.col("duration_min") - 1).alias("duration_min"),
        F.when(F.col("event_id") % 10 > 0, F.col("hour")).alias("hour"), "dow",
    )


def _windows(spark, sf):
    return w.window_occupancy(
        dated(spark, sf).withColumn("event_time_ts", F.col("event_time"))
    )


def _coarse_windows(spark, sf):
    """An hour of window over areas, so that most windows have one an interval earlier."""
    rows = dated(spark, sf).select(
        F.col("event_time").alias("event_time_ts"), F.col("area_name").alias("street_marker"),
        "occupied",
    )
    return w.window_occupancy(rows, size="1 hour", slide="30 minutes")


QUERIES = {
    "kpi_rates": lambda s, d: plain(r.kpi_rates(dated(s, d))),
    "class_balance": lambda s, d: plain(r.class_balance(dated(s, d), "occupied", OCCUPANCY_NAMES)),
    "violation_balance": lambda s, d: plain(
        r.class_balance(dated(s, d), "in_violation", VIOLATION_NAMES)
    ),
    "occ_by_hour": lambda s, d: plain(r.occ_by_hour(dated(s, d))),
    "occ_by_dow": lambda s, d: plain(r.occ_by_dow(dated(s, d))),
    "occ_by_street": lambda s, d: plain(r.occ_by_street(dated(s, d))),
    "street_hour_pivot": lambda s, d: plain(r.street_hour_pivot(dated(s, d))),
    "day_hour_heatmap": lambda s, d: plain(r.day_hour_heatmap(dated(s, d))),
    "top_streets": lambda s, d: plain(r.top_streets(dated(s, d))),
    "violation_by_area": lambda s, d: plain(r.violation_by_area(dated(s, d))),
    "describe_duration": lambda s, d: plain(stats.describe_duration(sensors(s, d))),
    "missing_profile": lambda s, d: plain(
        stats.missing_profile(loose(s, d))
    ),
    "overview": lambda s, d: stats.overview(loose(s, d), bronze(s, d)),
    "daily_trend": lambda s, d: plain(r.daily_trend(dated(s, d))),
    "order_days": lambda s, d: plain(
        r.daily_trend(
            table(s, d, "orders").select(
                F.col("o_orderdate").cast("timestamp").alias("event_time"),
                (F.col("o_orderstatus") == "F").cast("int").alias("occupied"),
            )
        )
    ),
    "street_cv": lambda s, d: plain(r.street_cv(dated(s, d))),
    "winsorize": lambda s, d: plain(stats.winsorize(_orders(s, d), "o_totalprice", name="price_w")),
    "robust_z": lambda s, d: plain(stats.robust_z(_orders(s, d), "o_totalprice", "price_z")),
    "sigma_outlier": lambda s, d: stats.sigma_outlier(sensors(s, d)).select(
        "event_id", "duration_outlier"
    ),
    "street_anomalies": lambda s, d: plain(
        stats.street_anomalies(sensors(s, d)).select(
            "street_marker", "duration_min", "event_time", "event_id", "z"
        )
    ),
    "dwell_histogram": lambda s, d: plain(r.dwell_histogram(sensors(s, d))),
    "duration_histogram": lambda s, d: plain(r.duration_histogram(sensors(s, d))),
    "dwell_by_violation": lambda s, d: plain(r.dwell_by_violation(sensors(s, d))),
    "quantity_by_flag": lambda s, d: plain(
        r.dwell_by_violation(
            table(s, d, "lineitem").select(
                F.col("l_extendedprice").alias("duration_min"),
                (F.col("l_returnflag") == "R").alias("in_violation"),
            ),
            high=1e9,
        )
    ),
    "extent": lambda s, d: plain(stats.extent(sensors(s, d))),
    "quality_report": lambda s, d: stats.quality_report(
        _quality_rows(s, d), ["target_occupied", "label_source"],
        ["hour", "dow", "duration_min", "rolling_occ_N10", "arrivals_N10"],
    ),
    "top_k": lambda s, d: plain(
        r.top_k(
            table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"),
            [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 25,
        )
    ),
    "confusion_counts": lambda s, d: plain(m.confusion_counts(predictions(s, d))),
    "confusion_matrix": lambda s, d: plain(m.confusion_matrix(predictions(s, d))),
    "binary_metrics": lambda s, d: plain(m.binary_metrics(predictions(s, d))),
    "kpi_model": lambda s, d: plain(m.kpi_model(predictions(s, d))),
    "f1_weighted": lambda s, d: plain(m.f1_weighted(predictions(s, d))),
    "roc_curve": lambda s, d: plain(m.roc_curve(predictions(s, d))),
    "roc_curve_all": lambda s, d: plain(
        m.roc_curve(predictions(s, d), drop_intermediate=False)
    ),
    "auc": lambda s, d: plain(m.auc(predictions(s, d))),
    "window_occupancy": lambda s, d: plain(_windows(s, d)),
    "sorted_windows": lambda s, d: plain(w.sorted_windows(_coarse_windows(s, d))),
    "occupancy_change": lambda s, d: plain(w.occupancy_change(_coarse_windows(s, d), 60)),
}

HOUR_COLUMNS = ", ".join(
    f"avg(occupied) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24)
)
HOUR_NAMES = tuple(f"h{h:02d}" for h in range(24))

SCORES = f"""{PREDS},
steps AS (
  SELECT prob_occupied AS threshold, count(*) FILTER (WHERE label = 1) AS pos,
         count(*) FILTER (WHERE label = 0) AS neg FROM preds GROUP BY 1),
curve AS (
  SELECT threshold, pos, neg,
    sum(pos) OVER o AS tp, sum(neg) OVER o AS fp,
    lead(pos) OVER o AS pos2, lead(neg) OVER o AS neg2, row_number() OVER o AS rn
  FROM steps WINDOW o AS (ORDER BY threshold DESC)),
total AS (SELECT sum(pos) AS p, sum(neg) AS n FROM steps)"""

POINTS = """SELECT 'infinity'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
  UNION ALL SELECT threshold, fp / n, tp / p FROM curve, total"""


def _pieces(size: int, slide: int, key: str) -> str:
    """Each event once per window that holds it."""
    count = size // slide
    return f"""{DATED},
pieces AS (
  SELECT make_timestamp((epoch_us(event_time) // ({slide} * 60000000) - i) * {slide} * 60000000)
           AS window_start, {key} AS street_marker, occupied
  FROM dated, (SELECT unnest(range({count})) AS i)),
win AS (
  SELECT window_start, window_start + INTERVAL {size} MINUTE AS window_end, street_marker,
         round(avg(occupied), 3) AS occupancy_rate, count(*) AS event_count
  FROM pieces GROUP BY window_start, street_marker)"""


def _box(source: str) -> str:
    return f"""WITH b AS ({source}),
    q AS (SELECT violation, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
            quantile_cont(x, 0.75) AS q3, count(*) AS "count", min(x) AS "min", max(x) AS "max"
          FROM b GROUP BY violation)
    SELECT violation, "count", round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median,
      round(q3, 6) + 0.0 AS q3, round("min", 6) + 0.0 AS "min", round("max", 6) + 0.0 AS "max",
      (SELECT round(min(x), 6) + 0.0 FROM b WHERE b.violation = q.violation
        AND x >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
      (SELECT round(max(x), 6) + 0.0 FROM b WHERE b.violation = q.violation
        AND x <= q3 + 1.5 * (q3 - q1)) AS whisker_high
    FROM q"""


SQL = {
    "kpi_rates": sql(
        DATED,
        """SELECT avg(occupied) AS avg_occupancy, avg(CAST(in_violation AS INTEGER))
        AS avg_violation_rate FROM dated""",
        ("avg_occupancy", "avg_violation_rate"),
    ),
    "class_balance": sql(
        DATED,
        """SELECT CASE occupied WHEN 1 THEN 'Occupied' ELSE 'Free' END AS status,
        count(*) AS "count", count(*) / sum(count(*)) OVER () AS share
        FROM dated WHERE occupied IS NOT NULL GROUP BY occupied""",
        ("share",),
    ),
    "violation_balance": sql(
        DATED,
        """SELECT CASE WHEN in_violation THEN 'Violation' ELSE 'Compliant' END AS status,
        count(*) AS "count", count(*) / sum(count(*)) OVER () AS share
        FROM dated GROUP BY in_violation""",
        ("share",),
    ),
    "occ_by_hour": sql(
        DATED,
        """SELECT hour, count(occupied) AS events, avg(occupied) AS occ_rate
        FROM dated GROUP BY hour""",
        ("occ_rate",),
    ),
    "occ_by_dow": sql(
        DATED,
        """SELECT dow0, count(occupied) AS events, avg(occupied) AS occ_rate
        FROM dated GROUP BY dow0""",
        ("occ_rate",),
    ),
    "occ_by_street": sql(
        DATED,
        """SELECT street_marker, count(*) AS events, avg(occupied) AS occ_rate FROM dated
        GROUP BY street_marker ORDER BY occ_rate DESC NULLS LAST, events DESC, street_marker
        LIMIT 25""",
        ("occ_rate",),
    ),
    "street_hour_pivot": sql(
        DATED,
        f"""SELECT street_marker, {HOUR_COLUMNS} FROM dated WHERE street_marker IN (
          SELECT street_marker FROM dated GROUP BY street_marker
          ORDER BY count(*) DESC, street_marker LIMIT 10) GROUP BY street_marker""",
        HOUR_NAMES,
    ),
    "day_hour_heatmap": sql(
        DATED,
        f"""SELECT dow, strftime(any_value(event_time), '%a') AS day_name, {HOUR_COLUMNS}
        FROM dated GROUP BY dow""",
        HOUR_NAMES,
    ),
    "top_streets": sql(
        DATED,
        """SELECT street_marker, avg(occupied) AS occ_rate, count(occupied) AS "count" FROM dated
        GROUP BY street_marker HAVING count(occupied) >= 50
        ORDER BY occ_rate DESC, street_marker LIMIT 10""",
        ("occ_rate",),
    ),
    "violation_by_area": sql(
        DATED,
        """SELECT area_name, avg(CAST(in_violation AS INTEGER)) AS violation_rate,
        count(in_violation) AS "count" FROM dated GROUP BY area_name
        HAVING count(in_violation) >= 50 ORDER BY violation_rate DESC, area_name LIMIT 10""",
        ("violation_rate",),
    ),
    "describe_duration": sql(
        SENSORS,
        """SELECT count(duration_min) AS "count", avg(duration_min) AS mean,
        stddev_samp(duration_min) AS std, min(duration_min) AS "min",
        quantile_cont(duration_min, 0.5) AS p50, quantile_cont(duration_min, 0.9) AS p90,
        quantile_cont(duration_min, 0.95) AS p95, quantile_cont(duration_min, 0.99) AS p99,
        max(duration_min) AS "max" FROM sensors""",
        ("mean", "std", "min", "p50", "p90", "p95", "p99", "max"),
    ),
    "missing_profile": sql(
        f"""{LOOSE},
        counts AS (
          SELECT count(*) AS n, count(event_id) AS event_id, count("BayId") AS "BayId",
            count("DeviceId") AS "DeviceId", count("StreetMarker") AS "StreetMarker",
            count(sign_value) AS "SignPlateID",
            count("Status") AS "Status", count("ArrivalTime") AS "ArrivalTime",
            count("DepartureTime") AS "DepartureTime", count("DurationMinutes") AS "DurationMinutes",
            count("VehiclePresent") AS "VehiclePresent", count("AreaName") AS "AreaName",
            count("InViolation") AS "InViolation" FROM loose)""",
        """SELECT "column", nonnull, n - nonnull AS missing,
          round(100.0 * (n - nonnull) / n, 2) AS missing_pct
        FROM (UNPIVOT counts ON COLUMNS(* EXCLUDE n) INTO NAME "column" VALUE nonnull)""",
        ("missing_pct",),
    ),
    "overview": sql(
        BRONZE,
        """SELECT 'rows_raw' AS metric, (SELECT count(*) FROM loose) AS value
        UNION ALL SELECT 'rows_clean', (SELECT count(*) FROM bronze)
        UNION ALL SELECT 'columns_raw', 12""",
    ),
    "daily_trend": sql(
        f"""{DATED},
        kept AS (SELECT CAST(event_time AS DATE) AS day, occupied FROM dated)""",
        """SELECT CAST(g.day AS DATE) AS day, count(kept.day) AS events, avg(occupied) AS occ_rate
        FROM (SELECT unnest(range(min(day), max(day) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day
              FROM kept) g
        LEFT JOIN kept ON kept.day = CAST(g.day AS DATE) GROUP BY g.day""",
        ("occ_rate",),
    ),
    "order_days": """
        SELECT CAST(g.day AS DATE) AS day, count(o_orderkey) AS events,
          round(avg(CAST(o_orderstatus = 'F' AS INTEGER)), 6) + 0.0 AS occ_rate
        FROM (SELECT unnest(range(min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY,
                                  INTERVAL 1 DAY)) AS day FROM orders) g
        LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(g.day AS DATE) GROUP BY g.day""",
    "street_cv": sql(
        DATED,
        """SELECT street_marker, round(occ_rate, 3) AS occ_rate, events, round(std, 3) AS std,
          round(cv, 3) AS cv FROM (
          SELECT *, std / nullif(occ_rate, 0) AS cv FROM (
            SELECT street_marker, avg(occupied) AS occ_rate, count(*) AS events,
              stddev_samp(occupied) AS std FROM dated GROUP BY street_marker))
        ORDER BY cv DESC NULLS LAST, street_marker LIMIT 15""",
        ("occ_rate", "std", "cv"),
    ),
    "winsorize": """
        SELECT o_orderkey, round(o_totalprice, 6) + 0.0 AS o_totalprice,
          round(greatest(q[1], least(q[2], o_totalprice)), 6) + 0.0 AS price_w
        FROM orders, (SELECT quantile_cont(o_totalprice, [0.001, 0.999]) AS q FROM orders)""",
    "robust_z": """
        WITH med AS (SELECT median(o_totalprice) AS m FROM orders),
        mad AS (SELECT median(abs(o_totalprice - m)) AS a FROM orders, med)
        SELECT o_orderkey, round(o_totalprice, 6) + 0.0 AS o_totalprice,
          round(0.6745 * (o_totalprice - m) / CASE WHEN a = 0 THEN 1 ELSE a END, 6) + 0.0 AS price_z
        FROM orders, med, mad""",
    "sigma_outlier": sql(
        SENSORS,
        """SELECT event_id, CASE WHEN abs(duration_min - (SELECT avg(duration_min) FROM sensors))
          > 3 * (SELECT stddev_pop(duration_min) FROM sensors) THEN 1 ELSE 0 END
          AS duration_outlier FROM sensors""",
    ),
    "street_anomalies": sql(
        SENSORS,
        """SELECT street_marker, duration_min, event_time, event_id, (duration_min - mu) / sd AS z
        FROM sensors JOIN (
          SELECT street_marker, avg(duration_min) AS mu, stddev_pop(duration_min) AS sd
          FROM sensors GROUP BY street_marker HAVING count(*) >= 20) USING (street_marker)
        WHERE sd > 0 AND abs((duration_min - mu) / sd) > 3
        ORDER BY z DESC, street_marker, event_time, event_id LIMIT 25""",
        ("duration_min", "z"),
    ),
    "dwell_histogram": sql(
        SENSORS,
        """SELECT CAST(bin AS INTEGER) AS bin, bin * 6.0::DOUBLE AS bin_start,
          (bin + 1) * 6.0::DOUBLE AS bin_end, (SELECT count(*) FROM sensors
            WHERE duration_min >= bin * 6 AND (duration_min < (bin + 1) * 6
              OR (bin = 39 AND duration_min = 240))) AS "count"
        FROM (SELECT unnest(range(40)) AS bin)""",
    ),
    "duration_histogram": sql(
        f"""{SENSORS},
        cut AS (SELECT least(duration_min, 1440) AS x FROM sensors),
        ends AS (SELECT min(x) AS a, max(x) AS b FROM cut),
        placed AS (SELECT least(floor((x - a) * 50 / (b - a)), 49) AS bin, count(*) AS n
                   FROM cut, ends GROUP BY 1)""",
        """SELECT CAST(g.bin AS INTEGER) AS bin, a + g.bin * (b - a) / 50 AS bin_start,
          a + (g.bin + 1) * (b - a) / 50 AS bin_end, coalesce(n, 0) AS "count"
        FROM (SELECT unnest(range(50)) AS bin) g CROSS JOIN ends
        LEFT JOIN placed ON placed.bin = g.bin""",
        ("bin_start", "bin_end"),
    ),
    "dwell_by_violation": _box(
        """SELECT CAST(value > 150 AS INTEGER) AS violation, value AS x FROM events
        WHERE value BETWEEN 0 AND 240"""
    ),
    "quantity_by_flag": _box(
        """SELECT CAST(l_returnflag = 'R' AS INTEGER) AS violation, l_extendedprice AS x
        FROM lineitem"""
    ),
    "extent": sql(
        SENSORS,
        """SELECT count(*) AS "rows", min(event_time) AS min_t, max(event_time) AS max_t
        FROM sensors""",
    ),
    "quality_report": sql(
        DATED,
        """SELECT 'missing_required_columns' AS "check", 'error' AS level, 1::BIGINT AS violations
        UNION ALL SELECT 'missing_feature_columns', 'warning', 2
        UNION ALL SELECT 'null_features', 'error', count(*) FROM dated WHERE event_id % 10 = 0
        UNION ALL SELECT 'target_not_binary', 'error', count(*) FROM dated WHERE occupied IS NULL
        UNION ALL SELECT 'negative_duration', 'error', count(*) FROM dated
          WHERE duration_min < 1""",
    ),
    "top_k": """
        SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) + 0.0 AS l_extendedprice
        FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25""",
    "confusion_counts": sql(
        PREDS,
        """SELECT prediction, label, count(*) AS "count" FROM preds GROUP BY prediction, label""",
        ("prediction", "label"),
    ),
    "confusion_matrix": sql(
        PREDS,
        """SELECT t.label, h.prediction, count(preds.label) AS "count",
          count(preds.label) / nullif(sum(count(preds.label)) OVER (PARTITION BY t.label), 0)
            AS share
        FROM (VALUES (0), (1)) t(label) CROSS JOIN (VALUES (0), (1)) h(prediction)
        LEFT JOIN preds ON preds.label = t.label AND preds.prediction = h.prediction
        GROUP BY t.label, h.prediction""",
        ("share",),
    ),
    "binary_metrics": sql(
        f"""{PREDS},
        c AS (SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
          count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp,
          count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn,
          count(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn FROM preds)""",
        """SELECT *, coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0) AS accuracy,
          coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
          coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM c""",
        ("accuracy", "precision", "recall"),
    ),
    "kpi_model": sql(
        f"""{PREDS},
        c AS (SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
          count(*) FILTER (WHERE prediction = 1) AS hits,
          count(*) FILTER (WHERE label = 1) AS ones,
          count(*) FILTER (WHERE label = prediction) / count(*) AS accuracy FROM preds)""",
        """SELECT accuracy, 2 * (tp / (hits + 1e-9)) * (tp / (ones + 1e-9))
          / (tp / (hits + 1e-9) + tp / (ones + 1e-9) + 1e-9) AS f1_positive FROM c""",
        ("accuracy", "f1_positive"),
    ),
    "f1_weighted": sql(
        f"""{PREDS},
        per AS (
          SELECT cls, count(*) FILTER (WHERE label = cls AND prediction = cls) AS hit,
            count(*) FILTER (WHERE prediction = cls) AS hits,
            count(*) FILTER (WHERE label = cls) AS n
          FROM preds, (VALUES (0), (1)) c(cls) GROUP BY cls)""",
        "SELECT sum(n * 2 * hit / (hits + n)) / sum(n) AS f1_weighted FROM per",
        ("f1_weighted",),
    ),
    "roc_curve": sql(
        SCORES,
        f"{POINTS} WHERE rn = 1 OR pos2 IS NULL OR pos2 <> pos OR neg2 <> neg",
        ("threshold", "fpr", "tpr"),
    ),
    "roc_curve_all": sql(SCORES, POINTS, ("threshold", "fpr", "tpr")),
    # rank-sum form: the chance that a positive outranks a negative, ties counted half
    "auc": sql(
        f"""{PREDS},
        ranked AS (SELECT label, rank() OVER (ORDER BY prob_occupied)
            + (count(*) OVER (PARTITION BY prob_occupied) - 1) / 2.0 AS r FROM preds),
        c AS (SELECT count(*) FILTER (WHERE label = 1) AS p,
            count(*) FILTER (WHERE label = 0) AS n,
            sum(r) FILTER (WHERE label = 1) AS rs FROM ranked)""",
        "SELECT (rs - p * (p + 1) / 2.0) / (p * n)::DOUBLE AS auc FROM c",
        ("auc",),
    ),
    "window_occupancy": sql(_pieces(5, 1, "street_marker"), "SELECT * FROM win", ("occupancy_rate",)),
    "sorted_windows": sql(_pieces(60, 30, "area_name"), "SELECT * FROM win", ("occupancy_rate",)),
    "occupancy_change": sql(
        _pieces(60, 30, "area_name"),
        """SELECT win.*, round(win.occupancy_rate - b.occupancy_rate, 3) AS occupancy_change
        FROM win LEFT JOIN win b ON b.street_marker = win.street_marker
         AND b.window_start = win.window_start - INTERVAL 60 MINUTE""",
        ("occupancy_rate", "occupancy_change"),
    ),
}
