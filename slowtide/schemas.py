"""Column contracts, rename maps and thresholds of the request-latency domain."""

from __future__ import annotations

from pyspark.sql import types as T

RESPONSE_LIMIT_MS = 2000
RESPONSE_LIMIT_MS_EXPORT = 4800
BUCKET_SECONDS = 300
WINDOW_BUCKETS = 24
ROLLING_BUCKETS = 6
HOLDOUT_BUCKETS = 5
VALIDATION_SHARE = 0.2

# The model's input columns, in model order.
FEATURES = [
    "CPU",
    "RAM",
    "response_time",
    "cpu_rolling_mean",
    "ram_rolling_mean",
    "response_rolling_mean",
    "high_cpu",
    "high_ram",
    "is_peak_hour",
]

# Source column names and the names used here.
W3C_TO_SITE = {
    "cs_method": "method",
    "cs_uri_stem": "url",
    "c_ip": "client_ip",
    "sc_status": "status_code",
    "time_taken": "response_time",
    "datetime": "timestamp",
    "s_ip": "site",
}
W3C_TO_SERVER = {
    "cs_method": "method",
    "cs_uri_stem": "url",
    "s_port": "port",
    "c_ip": "client_ip",
    "sc_status": "status_code",
    "sc_substatus": "sub_status",
    "sc_win32_status": "win32_status",
    "time_taken": "response_time",
    "datetime": "timestamp",
    "s_ip": "server_ip",
}
W3C_SHORT = {
    "sc_status": "status_code",
    "time_taken": "response_time",
    "datetime": "timestamp",
    "cs_method": "method",
    "cs_uri_stem": "url",
    "c_ip": "client_ip",
}
HOST_TO_COMMON = {"cpu_percent": "CPU", "ram_percent": "RAM"}
HOST_EXPORT_TO_COMMON = {"Date": "datetime"}
SQL_SOURCE_TO_COMMON = {
    "datetime": "timestamp",
    "time_taken": "response_time",
    "sc_status": "status_code",
}

# Columns shared by all request logs, and the order of the joined table.
COMMON_COLUMNS = [
    "date", "time", "method", "url", "site", "client_ip",
    "status_code", "response_time", "timestamp", "hour",
    "day_of_week", "request_path_depth", "endpoint_base", "service",
    "is_error", "is_success", "is_peak_hour", "CPU", "RAM",
]
FINAL_COLUMNS = [
    "date", "time", "server_ip", "method", "url", "site", "client_ip",
    "status_code", "response_time", "timestamp", "hour", "day_of_week",
    "request_path_depth", "endpoint_base", "service", "is_error",
    "is_success", "is_peak_hour", "CPU", "RAM",
]
COMMON_TYPES = {
    "date": "date", "time": "string", "method": "string", "url": "string",
    "site": "string", "client_ip": "string", "status_code": "int",
    "response_time": "double", "timestamp": "timestamp_ntz", "hour": "int",
    "day_of_week": "int", "request_path_depth": "int", "endpoint_base": "string",
    "service": "string", "is_error": "int", "is_success": "int",
    "is_peak_hour": "int", "CPU": "double", "RAM": "double",
}

# Columns that validation and training need, and the hours that scoring reads.
REQUIRED_TO_VALIDATE = ["timestamp", "response_time", "CPU", "RAM"]
REQUIRED_TO_TRAIN = ["timestamp", "response_time", "CPU", "RAM", "is_error"]

SCORING_HOURS = 24

REQUEST_LOG = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("response_time", T.DoubleType()),
        T.StructField("CPU", T.DoubleType()),
        T.StructField("RAM", T.DoubleType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("is_error", T.IntegerType()),
        T.StructField("site", T.StringType()),
    ]
)
PREDICTIONS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("confidence", T.StringType()),
    ]
)
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
