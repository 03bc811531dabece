"""Explicit schemas for every record kind the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Visit-log record: pipe-delimited, all strings.
TRACKER_LOG = T.StructType([
    T.StructField("log_type", T.StringType()),
    T.StructField("log_server_time", T.StringType()),
    T.StructField("cookie", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("url", T.StringType()),
])

# One row per cut session.
TRACKER_SESSION = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("session_server_time", T.StringType()),
    T.StructField("cookie", T.StringType()),
    T.StructField("cookie_label", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("landing_url", T.StringType()),
    T.StructField("pageview_count", T.IntegerType()),
    T.StructField("click_count", T.IntegerType()),
    T.StructField("domain", T.StringType()),
    T.StructField("domain_label", T.StringType()),
])

COOKIE_LABEL = T.StructType([
    T.StructField("cookie", T.StringType()),
    T.StructField("cookie_label", T.StringType()),
])

FLIGHT_DATE = T.StructType([
    T.StructField(n, T.IntegerType()) for n in ("year", "month", "dayOfMonth", "dayOfWeek")
])

FLIGHT_TIMES = T.StructType([
    T.StructField(n, T.IntegerType()) for n in (
        "depTime", "crsDepTime", "arrTime", "crsArrTime", "actualElapsedTime",
        "crsElapsedTime", "airTime", "arrDelay", "depDelay", "taxiIn", "taxiOut")
])

FLIGHT = T.StructType([
    T.StructField("date", FLIGHT_DATE),
    T.StructField("times", FLIGHT_TIMES),
    T.StructField("uniqueCarrier", T.StringType()),
    T.StructField("flightNum", T.IntegerType()),
    T.StructField("tailNum", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("distance", T.IntegerType()),
    T.StructField("canceled", T.IntegerType()),
    T.StructField("cancellationCode", T.StringType()),
    T.StructField("diverted", T.IntegerType()),
    T.StructField("carrierDelay", T.IntegerType()),
    T.StructField("weatherDelay", T.IntegerType()),
    T.StructField("nasDelay", T.IntegerType()),
    T.StructField("securityDelay", T.IntegerType()),
    T.StructField("lateAircraftDelay", T.IntegerType()),
])

AIRPORT = T.StructType([
    T.StructField("iata", T.StringType()),
    T.StructField("airport", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lng", T.DoubleType()),
])

DEVICE_ROW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("device", T.StringType()),
])

DEVICE_JSON = T.StructType([
    T.StructField("battery_level", T.LongType()),
    T.StructField("c02_level", T.LongType()),
    T.StructField("cca3", T.StringType()),
    T.StructField("cn", T.StringType()),
    T.StructField("device_id", T.LongType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("signal", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("temp", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

GEO = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
])

DATACENTER_DEVICE = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("temp", T.LongType()),
    T.StructField("c02_level", T.LongType()),
    T.StructField("geo", GEO),
])

DATACENTER = T.StructType([
    T.StructField("dc_id", T.StringType()),
    T.StructField("source", T.MapType(T.StringType(), DATACENTER_DEVICE)),
])

REJECT = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()),
])
