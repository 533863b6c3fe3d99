"""Column functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide import schemas
from slowtide.catalog.registry import plain, query, rounded
from slowtide.functions import clock, flags
from slowtide.operators.quality import clean
from slowtide.operators.quantiles import exact_quantiles
from slowtide.plans import features
from slowtide.sources.testdata import requests, scored, server_log, urls


@query(
    "fn1_delay_flags",
    """SELECT event_id, CASE WHEN response_time > 2000 THEN 1 ELSE 0 END AS over_2000, CASE WHEN response_time > 4800 THEN 1 ELSE 0 END AS over_4800,
              CASE WHEN "CPU" * 40 > 2000 THEN 1 ELSE 0 END AS with_nulls FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return requests(spark, sf).select(
        "event_id",
        flags.is_delayed(F.col("response_time"), schemas.RESPONSE_LIMIT_MS).alias("over_2000"),
        flags.is_delayed(F.col("response_time"), schemas.RESPONSE_LIMIT_MS_EXPORT).alias("over_4800"),
        flags.is_delayed(F.col("CPU") * 40).alias("with_nulls"),
    )


@query("fn2_status_flags", "SELECT event_id, is_error, is_success FROM enriched")
def _(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("status_code")
    return requests(spark, sf).select(
        "event_id", flags.is_error(status).alias("is_error"), flags.is_success(status).alias("is_success")
    )


@query(
    "fn3_peak_hour",
    """SELECT event_id, is_peak_hour, CASE WHEN hour IN (9, 10, 11, 14, 15, 16) THEN 1 ELSE 0 END AS is_listed_peak_hour FROM enriched""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    hour = F.hour("timestamp")
    return requests(spark, sf).select(
        "event_id", clock.is_peak_hour(hour).alias("is_peak_hour"), clock.is_listed_peak_hour(hour).alias("is_listed_peak_hour")
    )


@query("fn4_weekend", "SELECT event_id, day_of_week, CASE WHEN day_of_week IN (5, 6) THEN 1 ELSE 0 END AS is_weekend FROM enriched")
def _(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("timestamp")
    return requests(spark, sf).select("event_id", clock.day_of_week(ts).alias("day_of_week"), clock.is_weekend(ts).alias("is_weekend"))


_PARTS = ", ".join(
    f'CAST(coalesce({sql}, 0) AS INTEGER) AS {name}'
    for name, sql in (
        ("hour", "hour(t)"), ("minute", "minute(t)"), ("second", "second(t)"), ("day", "day(t)"),
        ("month", "month(t)"), ("year", "year(t)"), ("day_of_week", "isodow(t) - 1"),
    )
)


@query(
    "fn5_calendar_parts",
    f"""SELECT event_id, strftime(t, '%Y-%m-%d') AS date, {_PARTS}
        FROM (SELECT event_id, CASE WHEN "CPU" IS NOT NULL THEN "timestamp" END AS t FROM requests)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.when(F.col("CPU").isNotNull(), F.col("timestamp"))
    parts = clock.calendar_parts(ts, missing=0)
    return plain(
        requests(spark, sf).select("event_id", F.to_date(ts).alias("date"), *[c.alias(n) for n, c in parts.items()])
    )


@query("fn6_time_text", """SELECT event_id, strftime("timestamp", '%H:%M:%S') AS time_only FROM requests""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return requests(spark, sf).select("event_id", clock.time_of_day(F.col("timestamp")).alias("time_only"))


@query("fn7_timestamp_from_texts", """SELECT event_id, date_trunc('second', "timestamp") AS "timestamp" FROM requests""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return server_log(spark, sf).select(
        "event_id", clock.from_date_and_time(F.col("log_date"), F.col("log_time")).alias("timestamp")
    )


@query("fn8_utc_to_kolkata", """SELECT event_id, "timestamp" + INTERVAL 330 MINUTE AS "timestamp" FROM requests""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return requests(spark, sf).select("event_id", clock.shift_zone(F.col("timestamp")).alias("timestamp"))


@query(
    "fn9_fn10_url_shape",
    """SELECT page_id, CAST(length(coalesce(url, '')) - length(replace(coalesce(url, ''), '/', '')) AS INTEGER) AS request_path_depth,
              split_part(coalesce(url, ''), '/', -1) AS endpoint_base FROM urls""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    return urls(spark, sf).select(
        "page_id", flags.path_depth(url).alias("request_path_depth"), flags.last_segment(url).alias("endpoint_base")
    )


DIRTY_SQL = """(SELECT event_id, "timestamp", response_time - 200 AS response_time, "CPU" * 1.25 - 10 AS "CPU", "RAM" * 1.25 - 10 AS "RAM", is_error FROM requests)"""


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Requests with values out of range."""
    return requests(spark, sf).select(
        "event_id", "timestamp", (F.col("response_time") - 200).alias("response_time"),
        (F.col("CPU") * 1.25 - 10).alias("CPU"), (F.col("RAM") * 1.25 - 10).alias("RAM"), "is_error",
    )


@query(
    "fn11_clip_and_fill",
    f"""SELECT event_id, round(CASE WHEN "CPU" IS NULL THEN 0 ELSE least(greatest("CPU", 0), 100) END, 6) AS "CPU",
               round(least(greatest(coalesce("RAM", (SELECT quantile_cont("RAM", 0.5) FROM {DIRTY_SQL})), 0), 100), 6) AS "RAM",
               round(CASE WHEN response_time IS NULL THEN 0 ELSE greatest(response_time, 0) END, 6) AS response_time FROM {DIRTY_SQL}""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clean(dirty(spark, sf)).select("event_id", "CPU", "RAM", "response_time"))


@query(
    "fn12_quantile_flags",
    """SELECT event_id, CASE WHEN "CPU" > (SELECT quantile_cont("CPU", 0.8) FROM requests) THEN 1 ELSE 0 END AS high_cpu,
              CASE WHEN "RAM" > (SELECT quantile_cont("RAM", 0.8) FROM requests) THEN 1 ELSE 0 END AS high_ram,
              CASE WHEN round(response_time, 9) > (SELECT round(quantile_cont(response_time, 0.9), 9) FROM requests) THEN 1 ELSE 0 END AS slowest_tenth
       FROM requests""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = requests(spark, sf)
    limits = exact_quantiles(
        log, {"CPU": (F.col("CPU"), [0.8]), "RAM": (F.col("RAM"), [0.8]), "response_time": (F.col("response_time"), [0.9])}
    )
    return log.select(
        "event_id",
        *[
            features.above(F.col(c), limits[c][0]).alias(name)
            for name, c in (("high_cpu", "CPU"), ("high_ram", "RAM"), ("slowest_tenth", "response_time"))
        ],
    )


@query(
    "fn13_to_fn17_decisions",
    """SELECT event_id, CASE WHEN abs(probability - 0.5) > 0.3 THEN 'High' WHEN abs(probability - 0.5) > 0.1 THEN 'Medium' ELSE 'Low' END AS confidence,
              CASE WHEN abs(probability - 0.7) > 0.3 THEN 'High' WHEN abs(probability - 0.5) > 0.1 THEN 'Medium' ELSE 'Low' END AS confidence_shifted,
              CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS above_050, CASE WHEN probability > 0.3 THEN 1 ELSE 0 END AS above_030,
              round(greatest(probability, 1 - probability), 6) AS confidence_score, CASE WHEN true_label = predicted_label THEN 1 ELSE 0 END AS correct,
              CASE WHEN predicted_label = 1 THEN 'Yes' ELSE 'No' END AS answer, predicted_label AS alert FROM scored""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    p, y = F.col("probability"), F.col("predicted_label")
    return rounded(
        scored(spark, sf).select(
            "event_id",
            flags.confidence_label(p).alias("confidence"),
            flags.confidence_label_shifted(p).alias("confidence_shifted"),
            flags.decision(p, 0.5).alias("above_050"),
            flags.decision(p, 0.3).alias("above_030"),
            flags.confidence_score(p).alias("confidence_score"),
            flags.flag(F.col("true_label") == y).alias("correct"),
            flags.answer_text(y).alias("answer"),
            flags.flag(y == 1).alias("alert"),
        )
    )


@query(
    "ud1_request_enrichment",
    """SELECT event_id, "Delay_Detected", date, time, hour, day_of_week, request_path_depth, endpoint_base, service, is_error, is_success, is_peak_hour FROM enriched""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return plain(
        features.enrich(requests(spark, sf)).select(
            "event_id", "Delay_Detected", "date", "time", "hour", "day_of_week", "request_path_depth", "endpoint_base",
            "service", "is_error", "is_success", "is_peak_hour",
        )
    )
