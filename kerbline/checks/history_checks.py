"""De-duplication, sampling, splits, joins and device history over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.checks.cleaning_checks import silver
from kerbline.checks.common import BASE, DATED, SENSORS, plain, sql
from kerbline.operators import features as f
from kerbline.operators import history as h
from kerbline.operators import sampling as s
from kerbline.plans.durable import durable
from kerbline.plans.quantiles import quantiles
from kerbline.sources.standin import dated, sensors, table

DAY = 24 * 60


def _copies(spark, sf):
    """Every line item twice or more under one order and part, with a number that tells them apart."""
    items = table(spark, sf, "lineitem")
    return items.select(
        (F.col("l_partkey") % 50).alias("bay_id"),
        F.col("l_returnflag").alias("status"),
        F.when(F.col("l_suppkey") % 5 > 0, F.col("l_linestatus")).alias("sign"),
        F.col("l_orderkey").alias("first_key"),
        F.col("l_linenumber").alias("second_key"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("price"),
    )


def _labelled(spark, sf):
    return f.target_occupied(dated(spark, sf)).withColumn(
        "label", F.col("target_occupied").cast("double")
    )


def _holes(spark, sf):
    """Durations missing in a third of the rows, and in all rows of some streets."""
    missing = (F.col("event_id") % 3 == 0) | (F.col("k") % 17 == 0)
    return sensors(spark, sf).withColumn(
        "duration_min", F.when(~missing, F.col("duration_min"))
    )


def _train_ready(spark, sf, minutes):
    base = durable(silver(spark, sf))
    priors = h.silver_priors(h.silver_history(base), base)
    return plain(h.train_ready(priors, h.label_next_window(base, minutes)))


def _lumped_parts(spark, sf):
    parts = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part")
    )
    return f.lump_rare(parts, "part", 32)


def _union(spark, sf):
    split = s.parts(s.stratified_split(_labelled(spark, sf), "event_id"))
    tagged = [p.withColumn("share", F.lit(n)) for p, n in zip(split, ("train", "test"), strict=True)]
    return plain(s.union_by_name(tagged).select("share", "event_id", "label"))


QUERIES = {
    "dedup_events": lambda p, d: plain(
        s.dedup_events(
            _copies(p, d), ["bay_id", "status", "sign"],
            ["first_key", "second_key", "part", "quantity", "price"],
        )
    ),
    "dedup_bay_times": lambda p, d: plain(
        s.dedup_events(
            sensors(p, d).select(
                F.col("bay_id"), F.date_trunc("day", "arrive_ts").alias("arrive_ts"),
                F.date_trunc("day", "depart_ts").alias("depart_ts"), "event_id", "street_marker",
            ),
            ["bay_id", "arrive_ts", "depart_ts"], ["event_id"],
        )
    ),
    "balanced_sample": lambda p, d: s.balanced_sample(
        sensors(p, d).select("event_id", "status"), "status", 7_500, "event_id"
    ),
    "shuffle_rows": lambda p, d: s.shuffle_rows(
        sensors(p, d).select("event_id", "status"), "event_id"
    ),
    "time_split": lambda p, d: s.time_split(sensors(p, d)).select("event_id", "split"),
    "random_split": lambda p, d: s.random_split(
        sensors(p, d), [0.7, 0.3], "event_id"
    ).select("event_id", "part"),
    "stratified_split": lambda p, d: plain(
        s.stratified_split(_labelled(p, d), "event_id").select("event_id", "label", "part")
    ),
    "union_by_name": _union,
    "time_percent_rank": lambda p, d: plain(
        h.time_percent_rank(sensors(p, d).withColumn("event_time", F.date_trunc("hour", "event_time")))
        .select("event_id", "event_time", "pr")
    ),
    "time_percent_rank_nulls": lambda p, d: plain(
        h.time_percent_rank(
            sensors(p, d).withColumn("event_time", F.expr("nullif(date_trunc('day', event_time), TIMESTAMP'2024-01-03')"))
        ).select("event_id", "event_time", "pr")
    ),
    "quantiles_by_group": lambda p, d: plain(
        quantiles(
            sensors(p, d).withColumn("street", F.expr("nullif(street_marker, 'S3')")),
            "duration_min", [0.25, 0.5, 0.9], ["street"],
        ).select("street", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q90"))
    ),
    "class_weights": lambda p, d: plain(
        s.class_weights(_labelled(p, d)).select("event_id", "label", "class_weight")
    ),
    "street_priors": lambda p, d: plain(h.street_priors(silver(p, d))),
    "silver_priors": lambda p, d: plain(
        h.silver_priors(silver(p, d)).select(
            "event_id", "street_marker", "hour", "dow", "street_hour_dow_occ_prior"
        )
    ),
    "street_target_stats": lambda p, d: plain(
        f.street_target_stats(_labelled(p, d)).select(
            "event_id", "street_marker", "avg_duration_per_marker", "occ_rate_per_marker"
        )
    ),
    "label_next_window": lambda p, d: plain(h.label_next_window(silver(p, d))),
    "label_next_day": lambda p, d: plain(h.label_next_window(silver(p, d), DAY)),
    "label_next_event": lambda p, d: h.label_next_event(silver(p, d)).select("event_id", "occ_next"),
    "train_ready": lambda p, d: _train_ready(p, d, 15),
    "train_ready_day": lambda p, d: _train_ready(p, d, DAY),
    "impute_duration": lambda p, d: plain(
        f.impute_duration(_holes(p, d)).select("event_id", "duration_min", "duration_min_imp")
    ),
    "silver_history": lambda p, d: plain(
        h.silver_history(silver(p, d)).select(
            "event_id", "device_id", "event_time", "occ_lag1", "occ_lag2", "occ_roll10_past",
            "dur_roll10_past",
        )
    ),
    "rolling_occ": lambda p, d: plain(
        h.rolling_occ(_labelled(p, d)).select("event_id", "rolling_occ_N10")
    ),
    "rolling_occ_past": lambda p, d: plain(
        h.rolling_occ(_labelled(p, d), past_only=True).select("event_id", "rolling_occ_past10")
    ),
    "arrivals_n": lambda p, d: h.arrivals_n(sensors(p, d)).select("event_id", "arrivals_N10"),
    "lump_rare": _lumped_parts,
    "index_categories": lambda p, d: plain(
        f.index_categories(dated(p, d), ["street_marker", "status"]).select(
            "event_id", "street_marker_idx", "status_idx"
        )
    ),
}

BUCKET = "CAST('0x' || substr(md5(event_id || '#42'), 1, 8) AS BIGINT)"

HISTORY = f"""{BASE},
hist AS (
  SELECT *,
    lag(occupied, 1) OVER w AS occ_lag1, lag(occupied, 2) OVER w AS occ_lag2,
    avg(occupied) OVER (w ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS occ_roll10_past,
    avg(duration_min) OVER (w ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS dur_roll10_past
  FROM base WINDOW w AS (PARTITION BY device_id ORDER BY event_time, event_id)
)"""


def _labels(minutes: int) -> str:
    """For each distinct time of a device, the largest state at its later times within the horizon."""
    return f"""instants AS (
  SELECT device_id, event_time, max(occupied) AS state FROM base
  WHERE device_id IS NOT NULL AND event_time IS NOT NULL GROUP BY device_id, event_time
),
lbl AS (
  SELECT device_id, event_time, max(state) OVER (
    PARTITION BY device_id ORDER BY event_time
    RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND INTERVAL {minutes} MINUTE FOLLOWING
  ) AS occ_in_next
  FROM instants
)"""


def _train_sql(minutes: int) -> str:
    return sql(
        f"""{HISTORY}, {_labels(minutes)},
        told AS (SELECT device_id, event_time, occ_in_next FROM lbl WHERE occ_in_next >= 0),
        rates AS (SELECT DISTINCT street_marker, hour, dow,
                    avg(occupied) OVER (PARTITION BY street_marker, hour, dow) AS rate FROM base),
        ready AS (
          SELECT event_id, device_id, street_marker, event_time, hour, dow, is_weekend, duration_min,
            occ_lag1, occ_lag2, occ_roll10_past, dur_roll10_past,
            CASE WHEN rate IS NULL THEN 0.5 ELSE rate END AS street_hour_dow_occ_prior,
            occ_in_next AS label
          FROM hist INNER JOIN told USING (device_id, event_time)
          LEFT JOIN rates USING (street_marker, hour, dow))""",
        """SELECT *, (rank() OVER (ORDER BY event_time) - 1)
            / CAST(greatest(count(*) OVER () - 1, 1) AS DOUBLE) AS pr FROM ready""",
        ("duration_min", "occ_roll10_past", "dur_roll10_past", "street_hour_dow_occ_prior", "pr"),
    )


LABELLED = f"""{DATED},
labelled AS (SELECT *, CAST(coalesce(occupied, 0) AS DOUBLE) AS label FROM dated)"""

SQL = {
    "dedup_events": """
        SELECT bay_id, status, sign, first_key, second_key,
               round(quantity, 6) + 0.0 AS quantity, part, round(price, 6) + 0.0 AS price
        FROM (
          SELECT *, row_number() OVER (PARTITION BY bay_id, status, sign
            ORDER BY first_key, second_key, part, quantity, price) AS rn
          FROM (SELECT l_partkey % 50 AS bay_id, l_returnflag AS status,
                  CASE WHEN l_suppkey % 5 > 0 THEN l_linestatus END AS sign,
                  l_orderkey AS first_key, l_linenumber AS second_key, l_quantity AS quantity,
                  l_partkey AS part, l_extendedprice AS price FROM lineitem))
        WHERE rn = 1""",
    "dedup_bay_times": sql(
        SENSORS,
        """SELECT bay_id, arrive_ts, depart_ts, event_id, street_marker FROM (
          SELECT *, row_number() OVER (PARTITION BY bay_id, arrive_ts, depart_ts
                                       ORDER BY event_id) AS rn
          FROM (SELECT bay_id, date_trunc('day', arrive_ts) AS arrive_ts,
                  date_trunc('day', depart_ts) AS depart_ts, event_id, street_marker
                FROM sensors)) WHERE rn = 1""",
    ),
    "balanced_sample": sql(
        SENSORS,
        """SELECT event_id, status FROM (
          SELECT event_id, status, row_number() OVER (
            PARTITION BY status ORDER BY md5(event_id || '#42'), event_id) AS rn FROM sensors)
        WHERE rn <= (SELECT least(min(n), 7500) FROM
          (SELECT count(*) AS n FROM sensors GROUP BY status))""",
    ),
    "shuffle_rows": sql(
        SENSORS, "SELECT event_id, status FROM sensors ORDER BY md5(event_id || '#42'), event_id"
    ),
    "time_split": sql(
        SENSORS,
        """SELECT event_id, CASE WHEN epoch_us(event_time) <= q[1] THEN 'train'
          WHEN epoch_us(event_time) <= q[2] THEN 'val' ELSE 'test' END AS split
        FROM sensors, (SELECT quantile_cont(CAST(epoch_us(event_time) AS DOUBLE), [0.7, 0.85]) AS q
                       FROM sensors)""",
    ),
    "random_split": sql(
        SENSORS,
        f"""SELECT event_id, CASE WHEN {BUCKET} < CAST(floor(4294967296 * 0.7) AS BIGINT)
        THEN 0 ELSE 1 END AS part FROM sensors""",
    ),
    "stratified_split": sql(
        LABELLED,
        f"""SELECT event_id, label, CASE WHEN {BUCKET} < CAST(floor(4294967296 * 0.7) AS BIGINT)
        THEN 0 ELSE 1 END AS part FROM labelled""",
        ("label",),
    ),
    "union_by_name": sql(
        LABELLED,
        f"""SELECT CASE WHEN {BUCKET} < CAST(floor(4294967296 * 0.7) AS BIGINT)
        THEN 'train' ELSE 'test' END AS share, event_id, label FROM labelled""",
        ("label",),
    ),
    "time_percent_rank": sql(
        SENSORS,
        """SELECT event_id, date_trunc('hour', event_time) AS event_time,
        percent_rank() OVER (ORDER BY date_trunc('hour', event_time)) AS pr FROM sensors""",
        ("pr",),
    ),
    "time_percent_rank_nulls": sql(
        f"""{SENSORS},
        days AS (SELECT event_id, nullif(date_trunc('day', event_time), TIMESTAMP '2024-01-03') AS event_time
                 FROM sensors)""",
        """SELECT event_id, event_time, percent_rank() OVER (ORDER BY event_time NULLS FIRST) AS pr FROM days""",
        ("pr",),
    ),
    "quantiles_by_group": sql(
        SENSORS,
        """SELECT nullif(street_marker, 'S3') AS street, quantile_cont(duration_min, 0.25) AS q25,
        quantile_cont(duration_min, 0.5) AS q50, quantile_cont(duration_min, 0.9) AS q90
        FROM sensors GROUP BY 1""",
        ("q25", "q50", "q90"),
    ),
    "class_weights": sql(
        LABELLED,
        """SELECT event_id, label, (SELECT count(*) FROM labelled)
          / (2.0 * count(*) OVER (PARTITION BY label)) AS class_weight FROM labelled""",
        ("label", "class_weight"),
    ),
    "street_priors": sql(
        BASE,
        """SELECT street_marker, hour, dow, avg(occupied) AS street_hour_dow_occ_prior,
        count(*) AS n FROM base GROUP BY street_marker, hour, dow""",
        ("street_hour_dow_occ_prior",),
    ),
    "silver_priors": sql(
        BASE,
        """SELECT event_id, street_marker, hour, dow, avg(occupied) OVER (
        PARTITION BY street_marker, hour, dow) AS street_hour_dow_occ_prior FROM base""",
        ("street_hour_dow_occ_prior",),
    ),
    "street_target_stats": sql(
        LABELLED,
        """SELECT event_id, street_marker,
        avg(duration_min) OVER (PARTITION BY street_marker) AS avg_duration_per_marker,
        avg(label) OVER (PARTITION BY street_marker) AS occ_rate_per_marker FROM labelled""",
        ("avg_duration_per_marker", "occ_rate_per_marker"),
    ),
    "label_next_window": sql(f"{BASE}, {_labels(15)}", "SELECT * FROM lbl"),
    "label_next_day": sql(f"{BASE}, {_labels(DAY)}", "SELECT * FROM lbl"),
    "label_next_event": sql(
        BASE,
        """SELECT event_id, lead(occupied) OVER (
        PARTITION BY device_id ORDER BY event_time, event_id) AS occ_next FROM base""",
    ),
    "train_ready": _train_sql(15),
    "train_ready_day": _train_sql(DAY),
    "impute_duration": sql(
        f"""{SENSORS},
        holes AS (SELECT event_id, street_marker,
          CASE WHEN event_id % 3 <> 0 AND k % 17 <> 0 THEN duration_min END AS duration_min
          FROM sensors)""",
        """SELECT event_id, duration_min, coalesce(duration_min,
          median(duration_min) OVER (PARTITION BY street_marker),
          (SELECT median(duration_min) FROM holes)) AS duration_min_imp FROM holes""",
        ("duration_min", "duration_min_imp"),
    ),
    "silver_history": sql(
        HISTORY,
        """SELECT event_id, device_id, event_time, occ_lag1, occ_lag2, occ_roll10_past,
        dur_roll10_past FROM hist""",
        ("occ_roll10_past", "dur_roll10_past"),
    ),
    "rolling_occ": sql(
        LABELLED,
        """SELECT event_id, avg(label) OVER (PARTITION BY device_id ORDER BY event_time, event_id
        ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS "rolling_occ_N10" FROM labelled""",
        ("rolling_occ_N10",),
    ),
    "rolling_occ_past": sql(
        LABELLED,
        """SELECT event_id, avg(label) OVER (PARTITION BY device_id ORDER BY event_time, event_id
        ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_occ_past10 FROM labelled""",
        ("rolling_occ_past10",),
    ),
    "arrivals_n": sql(
        SENSORS,
        """SELECT event_id, CAST(least(row_number() OVER (
        PARTITION BY device_id ORDER BY event_time, event_id), 10) AS INTEGER)
        AS "arrivals_N10" FROM sensors""",
    ),
    "lump_rare": """
        SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part,
          CASE WHEN count(*) OVER (PARTITION BY l_partkey) >= 32
               THEN CAST(l_partkey AS VARCHAR) ELSE '_OTHER' END AS part_lumped
        FROM lineitem""",
    "index_categories": sql(
        f"""{SENSORS},
        st AS (SELECT street_marker, row_number() OVER (ORDER BY count(*) DESC, street_marker) - 1
               AS i FROM sensors GROUP BY street_marker),
        ss AS (SELECT status, row_number() OVER (ORDER BY count(*) DESC, status) - 1
               AS j FROM sensors GROUP BY status)""",
        """SELECT event_id, CAST(i AS DOUBLE) AS street_marker_idx, CAST(j AS DOUBLE) AS status_idx
        FROM sensors JOIN st USING (street_marker) JOIN ss USING (status)""",
    ),
}
