"""Resampling and table summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.catalog.registry import now, query, rounded
from slowtide.catalog.source_sink import sql_rows
from slowtide.functions import clock
from slowtide.operators import profile
from slowtide.operators.quantiles import exact_quantiles
from slowtide.operators.series import resample
from slowtide.plans import features
from slowtide.session import durable
from slowtide.sources.testdata import requests, scored, table, w3c_log

_MEANS = 'round(response_time, 6) AS response_time, round("CPU", 6) AS "CPU", round("RAM", 6) AS "RAM"'


@query("ag1_resample_5min", f'SELECT bucket_id, bucket, "Delay_Detected", {_MEANS}, is_error FROM series')
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.health_series(requests(spark, sf)))


@query(
    "ag1_resample_5min_by_site",
    """WITH b AS (SELECT site, epoch_us("timestamp") // 300000000 AS bucket_id, max(CASE WHEN response_time > 2000 THEN 1 ELSE 0 END) AS "Delay_Detected",
                         avg(response_time) AS response_time, avg("CPU") AS "CPU", avg("RAM") AS "RAM", max(is_error) AS is_error
                  FROM requests GROUP BY ALL),
            s AS (SELECT site, unnest(generate_series(min(bucket_id), max(bucket_id))) AS bucket_id FROM b GROUP BY site)
       SELECT site, bucket_id, make_timestamp(bucket_id * 300000000) AS bucket, "Delay_Detected", round(response_time, 6) AS response_time,
              round("CPU", 6) AS "CPU", round("RAM", 6) AS "RAM", is_error FROM s LEFT JOIN b USING (site, bucket_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.health_series(requests(spark, sf), keys=["site"]))


@query(
    "ag2_resample_5min_status",
    f"""SELECT bucket, {_MEANS}, CASE WHEN status_code IS NULL THEN NULL WHEN "Delay_Detected" > 0 THEN 1 ELSE 0 END AS "Delay_Detected",
               round(status_code, 6) AS status_code, CASE WHEN status_code IS NULL THEN NULL WHEN is_error > 0 THEN 1 ELSE 0 END AS is_error
        FROM counts5""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    flagged = features.flag_delays(requests(spark, sf))
    return rounded(resample(flagged, features.HEALTH_STATUS_AGGS, 300).drop("bucket_id"))


@query("ag3_resample_10min_counts", f'SELECT bucket, "Delay_Detected", {_MEANS}, round(status_code, 6) AS status_code, is_error FROM counts10')
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.count_series(requests(spark, sf), 600).drop("bucket_id"))


@query(
    "ag4_resample_5min_counts",
    """SELECT bucket, "Delay_Detected", round(response_time, 6) AS time_taken, round("CPU", 6) AS "CPU", round("RAM", 6) AS "RAM",
              round(status_code, 6) AS sc_status, is_error FROM counts5""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    flagged = features.flag_delays(sql_rows(spark, sf), column="time_taken")
    return rounded(resample(flagged, features.SQL_COUNT_AGGS, 300, ts="datetime").drop("bucket_id"))


@query(
    "ag5_resample_complete_rows",
    """WITH d AS (SELECT * FROM requests WHERE response_time IS NOT NULL AND "CPU" IS NOT NULL AND "RAM" IS NOT NULL),
            b AS (SELECT epoch_us("timestamp") // 600000000 AS bucket_id, sum(CASE WHEN response_time > 2000 THEN 1 ELSE 0 END) AS dd,
                         avg(response_time) AS response_time, avg("CPU") AS "CPU", avg("RAM") AS "RAM" FROM d GROUP BY 1),
            s AS (SELECT unnest(generate_series(min(bucket_id), max(bucket_id))) AS bucket_id FROM b)
       SELECT make_timestamp(bucket_id * 600000000) AS bucket, CAST(coalesce(dd, 0) AS BIGINT) AS "Delay_Detected",
              round(response_time, 6) AS response_time, round("CPU", 6) AS "CPU", round("RAM", 6) AS "RAM" FROM s LEFT JOIN b USING (bucket_id)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    whole = requests(spark, sf).dropna(subset=["response_time", "CPU", "RAM"])
    aggs = {c: features.COUNT_AGGS[c] for c in ("Delay_Detected", "response_time", "CPU", "RAM")}
    return rounded(resample(features.flag_delays(whole), aggs, 600).drop("bucket_id"))


_RATE = """CAST(sum("Delay_Detected") AS BIGINT) AS delays, count(*) AS total, round(avg("Delay_Detected") * 100, 6) AS delay_pct"""


@query(
    "ag6_delay_rate",
    f"""SELECT 'requests' AS source, {_RATE} FROM enriched UNION ALL SELECT 'orders', {_RATE} FROM w3c_enriched
        UNION ALL SELECT 'buckets', {_RATE} FROM filled""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf)
    w3c = w3c_log(spark, sf)
    parts = {
        "requests": features.flag_delays(log),
        "orders": features.flag_delays(w3c, column="time_taken"),
        "buckets": features.health_series(log).fillna(0, ["Delay_Detected"]),
    }
    rows = [rounded(profile.rate_summary(df)).withColumn("source", F.lit(name)) for name, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "ag7_delay_rate_by_peak_hour",
    """SELECT is_peak_hour, round(avg("Delay_Detected"), 6) AS "mean_Delay_Detected" FROM enriched GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.group_mean(features.enrich(requests(spark, sf)), "is_peak_hour", "Delay_Detected"))


@query(
    "ag8_null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ("{c}" IS NULL) AS nulls,
                   round(count(*) FILTER ("{c}" IS NULL) * 100.0 / count(*), 6) AS null_pct FROM series"""
        for c in ("bucket_id", "bucket", "Delay_Detected", "response_time", "CPU", "RAM", "is_error")
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.null_profile(features.health_series(requests(spark, sf))))


@query(
    "ag8_total_nulls",
    """SELECT count(*) FILTER ("CPU" IS NULL) + count(*) FILTER ("RAM" IS NULL) + count(*) FILTER (response_time IS NULL) AS total_nulls FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profile.total_nulls(requests(spark, sf).select("CPU", "RAM", "response_time"))


@query("ag9_target_balance", "SELECT target, count(*) AS n FROM features GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(features.feature_series(requests(spark, sf)), "target")


@query("ag10_distinct_times", """SELECT DISTINCT strftime("timestamp", '%H:%M:%S') AS time_only FROM requests""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return requests(spark, sf).select(clock.time_of_day(F.col("timestamp")).alias("time_only")).distinct()


@query("ag10_distinct_count", """SELECT count(DISTINCT strftime("timestamp", '%H:%M:%S')) AS n_times FROM requests""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return requests(spark, sf).agg(F.countDistinct(clock.time_of_day(F.col("timestamp"))).alias("n_times"))


@query(
    "ag11_quantiles",
    """SELECT 'response_time' AS column_name, 0.5::DOUBLE AS p, round(quantile_cont(response_time, 0.5), 6) AS value FROM requests
       UNION ALL SELECT 'response_time', 0.9::DOUBLE, round(quantile_cont(response_time, 0.9), 6) FROM requests
       UNION ALL SELECT 'CPU', 0.8::DOUBLE, round(quantile_cont("CPU", 0.8), 6) FROM requests
       UNION ALL SELECT 'RAM', 0.5::DOUBLE, round(quantile_cont("RAM", 0.5), 6) FROM requests
       UNION ALL SELECT 'RAM', 0.8::DOUBLE, round(quantile_cont("RAM", 0.8), 6) FROM requests
       UNION ALL SELECT 'price', 0.5::DOUBLE, round(quantile_cont(l_extendedprice, 0.5), 6) FROM lineitem
       UNION ALL SELECT 'price', 0.9::DOUBLE, round(quantile_cont(l_extendedprice, 0.9), 6) FROM lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = {c: (F.col(c), ps) for c, ps in (("response_time", [0.5, 0.9]), ("CPU", [0.8]), ("RAM", [0.5, 0.8]))}
    items = {"price": (F.col("l_extendedprice"), [0.5, 0.9])}
    found = {
        **exact_quantiles(requests(spark, sf), log),
        **exact_quantiles(table(spark, sf, "lineitem"), items),
    }
    rows = [(c, p, v) for c, (_, ps) in {**log, **items}.items() for p, v in zip(ps, found[c])]
    return rounded(spark.createDataFrame(rows, "column_name string, p double, value double"))


@query(
    "ag12_time_span",
    """SELECT min("timestamp") AS oldest, max("timestamp") AS newest,
              (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) // 86400000000 AS span_days,
              round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max("timestamp"))) / 3600000000.0::DOUBLE, 6) AS hours_old FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.time_span(requests(spark, sf), now()))


@query(
    "ag13_repeated_timestamps",
    """SELECT 'requests' AS source, count(*) - count(DISTINCT "timestamp") AS repeated FROM requests
       UNION ALL SELECT 'orders', count(*) - count(DISTINCT o_orderdate) FROM orders
       UNION ALL SELECT 'lineitem', count(*) - count(DISTINCT l_shipdate) FROM lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"requests": (requests(spark, sf), "timestamp"), "orders": (table(spark, sf, "orders"), "o_orderdate"),
               "lineitem": (table(spark, sf, "lineitem"), "l_shipdate")}
    rows = [
        df.agg(profile.repeated(c).alias("repeated")).select(F.lit(name).alias("source"), "repeated")
        for name, (df, c) in columns.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "ag14_table_shape",
    """SELECT n_rows, 5 AS n_columns, position, column_name, data_type
       FROM (SELECT count(*) AS n_rows FROM requests),
            (VALUES (0, 'event_id', 'bigint'), (1, 'timestamp', 'timestamp_ntz'), (2, 'response_time', 'double'),
                    (3, 'CPU', 'double'), (4, 'status_code', 'int')) AS c(position, column_name, data_type)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profile.shape(requests(spark, sf).select("event_id", "timestamp", "response_time", "CPU", "status_code"))


@query(
    "ag15_recent_input_std",
    """SELECT round(stddev_pop("CPU"), 6) AS "CPU_std", round(stddev_pop("RAM"), 6) AS "RAM_std"
       FROM (SELECT * FROM filled ORDER BY bucket_id DESC LIMIT 100)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    series = features.feature_series(requests(spark, sf))
    return rounded(profile.recent_std(series, ["CPU", "RAM"], 100, "bucket_id"))


@query(
    "ag15_prediction_std",
    """SELECT round(stddev_pop(probability), 6) AS pred_prob_std,
              (SELECT round(stddev_pop(probability), 6) FROM (SELECT probability FROM scored ORDER BY "timestamp" DESC, event_id DESC LIMIT 50)) AS rolling_pred_std
       FROM scored""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.prediction_std(scored(spark, sf), "probability", "timestamp", ["event_id"]))


def _box_sql(value: str) -> str:
    return f"""
        SELECT "Delay_Detected", count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
               round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), 6) AS whisker_low,
               round(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_high,
               count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
        FROM (SELECT "Delay_Detected", {value} AS x FROM enriched WHERE {value} IS NOT NULL)
        JOIN (SELECT "Delay_Detected", quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS q2, quantile_cont({value}, 0.75) AS q3
              FROM enriched GROUP BY 1) USING ("Delay_Detected") GROUP BY 1"""


for _name, _column in (("cpu", "CPU"), ("ram", "RAM"), ("response", "response_time")):

    @query(f"ag16_box_{_name}_by_delay", _box_sql(f'"{_column}"'))
    def _(spark: SparkSession, sf: str, column: str = _column) -> DataFrame:
        return rounded(profile.box_stats(features.flag_delays(requests(spark, sf)), column, "Delay_Detected"))


def histogram_sql(source: str, value: str, bins: int) -> str:
    return f"""
        WITH e AS (SELECT min({value}) AS lo, max({value}) AS hi, (max({value}) - min({value})) / {bins} AS step FROM {source}),
             g AS (SELECT {value} AS x, lo, hi, step, CAST(least(floor(({value} - lo) * ({bins} / (hi - lo))), {bins} - 1) AS INTEGER) AS i
                   FROM {source}, e WHERE {value} IS NOT NULL),
             p AS (SELECT CASE WHEN x < CASE WHEN i >= {bins} THEN hi ELSE i * step + lo END THEN i - 1
                               WHEN i < {bins} - 1 AND x >= CASE WHEN i + 1 >= {bins} THEN hi ELSE (i + 1) * step + lo END THEN i + 1
                               ELSE i END AS bin FROM g),
             c AS (SELECT bin, count(*) AS n FROM p GROUP BY 1),
             s AS (SELECT CAST(unnest(range({bins})) AS INTEGER) AS bin)
        SELECT bin, round(bin * step + lo, 6) AS bin_low, round(CASE WHEN bin + 1 >= {bins} THEN hi ELSE (bin + 1) * step + lo END, 6) AS bin_high,
               coalesce(n, 0) AS n FROM s LEFT JOIN c USING (bin), e"""


@query("ag17_histogram_response_time", histogram_sql("requests", "response_time", 50))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.histogram(requests(spark, sf), "response_time", 50))


@query("ag17_histogram_probability", histogram_sql("scored", "probability", 50))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.histogram(scored(spark, sf), "probability", 50))


@query(
    "ag17_histogram_by_class",
    f"""SELECT 0 AS true_label, * FROM ({histogram_sql("(SELECT * FROM scored WHERE true_label = 0)", "probability", 30)})
        UNION ALL SELECT 1, * FROM ({histogram_sql("(SELECT * FROM scored WHERE true_label = 1)", "probability", 30)})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf)
    parts = [
        rounded(profile.histogram(rows.where(F.col("true_label") == c), "probability", 30)).withColumn("true_label", F.lit(c))
        for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


@query("ag17_histogram_confidence", histogram_sql("(SELECT greatest(probability, 1 - probability) AS confidence FROM scored)", "confidence", 20))
def _(spark: SparkSession, sf: str) -> DataFrame:
    from slowtide.operators.evaluation import details

    return rounded(profile.histogram(details(scored(spark, sf)), "confidence", 20))


def _density_sql(label: str, source: str, column: str) -> str:
    return f"""
        SELECT '{label}' AS source, '{column}' AS column_name, CAST(g AS INTEGER) AS point,
               round(lo + g * ((hi - lo) / 199), 6) AS at,
               round(sum(n * exp(-0.5 * pow((lo + g * ((hi - lo) / 199) - x) / h, 2))) / (any_value(total) * any_value(h) * sqrt(2 * pi())), 9) AS density
        FROM (SELECT "{column}" AS x, count(*) AS n FROM {source} WHERE "{column}" IS NOT NULL GROUP BY 1),
             (SELECT total, h, mn - 3 * h AS lo, mx + 3 * h AS hi
              FROM (SELECT count("{column}") AS total, stddev_samp("{column}") * pow(count("{column}"), -0.2) AS h,
                           min("{column}") AS mn, max("{column}") AS mx FROM {source})),
             (SELECT unnest(range(200)) AS g) GROUP BY g, lo, hi"""


@query(
    "ag18_density_two_sources",
    " UNION ALL ".join(
        _density_sql(label, source, c)
        for label, source in (("raw", "requests"), ("buckets", "filled"))
        for c in ("CPU", "RAM", "response_time")
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf)
    names = ["CPU", "RAM", "response_time"]
    parts = [
        profile.density(df.select(*names), names).select(
            F.lit(source).alias("source"),
            "column_name",
            "point",
            F.round("at", 6).alias("at"),
            F.round("density", 9).alias("density"),
        )
        for source, df in (("raw", log), ("buckets", durable(features.feature_series(log))))
    ]
    return parts[0].unionByName(parts[1])
