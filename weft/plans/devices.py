"""Device JSON reports (id::json lines) and nested data-center JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft import schemas
from weft.functions.columns import exact_round_ratio
from weft.operators import jsonops
from weft.sources.formats import Parsed, parse_id_payload, read_json, read_lines


def load_devices(spark: SparkSession, path: str) -> Parsed:
    return parse_id_payload(read_lines(spark, path))


def device_fields(devices: DataFrame) -> DataFrame:
    """id, device_type, ip, cca3 by JSON path."""
    return jsonops.extract_fields(devices, "device", {
        "device_type": "$.device_type", "ip": "$.ip", "cca3": "$.cca3"}, keep=("id",))


def parsed_devices(devices: DataFrame) -> DataFrame:
    """Typed device columns."""
    p = jsonops.parse_column(devices, "device", schemas.DEVICE_JSON, "devices")
    return jsonops.expand(p, "devices")


def active_devices(devices: DataFrame, min_temp: int = 10, min_signal: int = 15) -> DataFrame:
    """temp > 10 and signal > 15."""
    d = parsed_devices(devices)
    return d.filter((F.col("temp") > min_temp) & (F.col("signal") > min_signal))


def country_devices(devices: DataFrame, cca3: str = "USA") -> DataFrame:
    """Active devices of one country by signal desc, temp desc."""
    return (active_devices(devices).where(F.col("cca3") == cca3)
            .orderBy(F.col("signal").desc(), F.col("temp").desc()))


def devices_as_json(devices: DataFrame) -> DataFrame:
    """Each row as one JSON text column named ``devices``."""
    return jsonops.serialise(devices).toDF("devices")


def cast_columns(devices: DataFrame) -> DataFrame:
    """SQL-expression projection with casts (C10, I15); an id beyond the range of INT is null."""
    return devices.selectExpr("try_cast(id AS INT) AS id", "CAST(device AS STRING) AS device")


def co2_ratio(devices: DataFrame) -> DataFrame:
    """c02_level / temp rounded half-up to 2 places, descending."""
    d = active_devices(devices)
    return (d.select("c02_level",
                     exact_round_ratio("c02_level", "temp", 2, 0).alias("ratio_c02_temperature"))
             .orderBy(F.col("ratio_c02_temperature").desc()))


def load_datacenters(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.DATACENTER, multiline)


def datacenter_devices(dc: DataFrame) -> DataFrame:
    """One row per device in each data center's map."""
    e = jsonops.explode_map(dc, "source", keep=("dc_id",))
    return e.select(F.col("dc_id").alias("id"),
                    F.col("key").alias("deviceType"),
                    jsonops.nested("value", "description").alias("description"),
                    jsonops.nested("value", "geo", "lat").alias("lat"))


def device_analysis(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All device reports from one ``id::json`` file, as DataFrames."""
    d = load_devices(spark, path).rows
    return {"fields": device_fields(d), "active": active_devices(d), "country": country_devices(d),
            "json": devices_as_json(d), "casts": cast_columns(d), "co2_ratio": co2_ratio(d)}


def datacenter_analysis(spark: SparkSession, path: str, multiline: bool = False) -> dict[str, DataFrame]:
    """The nested data-center file: as read, exploded, and device fields."""
    dc = load_datacenters(spark, path, multiline)
    return {"datacenters": dc, "exploded": jsonops.explode_map(dc, "source", keep=("dc_id",)),
            "devices": datacenter_devices(dc)}
