"""JSON operators on the device / data-center samples, and the sinks."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from conftest import DEVICE_LINES, write_lines
from weft import schemas
from weft.operators import jsonops
from weft.plans import devices
from weft.sinks.writers import as_text_lines, read_text_records, select_sink, write_csv
from weft.sources.formats import read_json


@pytest.fixture
def dev(spark, tmp_path):
    path = write_lines(tmp_path / "device_info.txt", DEVICE_LINES)
    return devices.load_devices(spark, path).rows


def test_extract_and_parse(dev):
    ex = {r.id: (r.device_type, r.ip, r.cca3) for r in devices.device_fields(dev).collect()}
    assert ex[3] == ("probe-c", "10.9.0.3", "USA")
    active = devices.active_devices(dev)
    assert sorted(r.device_id for r in active.collect()) == [0, 1, 2]
    us = devices.country_devices(dev).collect()
    assert [r.device_id for r in us] == [0]
    assert us[0].timestamp.astimezone(dt.timezone.utc) == dt.datetime(2023, 11, 14, 22, 13, 20, tzinfo=dt.timezone.utc)


def test_ratio_serialise_and_casts(dev):
    assert [tuple(r) for r in devices.co2_ratio(dev).collect()] == [(900, 75.0), (1100, 68.75), (1001, 50.05)]
    js = devices.devices_as_json(dev)
    assert js.columns == ["devices"]
    first = json.loads(sorted(r.devices for r in js.collect())[0])
    assert first["id"] == 0 and json.loads(first["device"])["device_id"] == 0
    casted = devices.cast_columns(dev)
    assert dict(casted.dtypes) == {"id": "int", "device": "string"}


NESTED = json.dumps({"dc_id": "north-1", "source": {
    name: {"id": n, "ip": f"10.8.0.{n}", "description": f"{place} probe", "temp": 20 + n, "c02_level": 1000 + n,
           "geo": {"lat": 40.0 + n / 4, "long": -n / 2}}
    for n, (name, place) in enumerate([("probe-a", "Wall"), ("probe-b", "Door"), ("probe-c", "Roof"), ("probe-d", "Pipe")])}})


def test_nested_map_explode(spark, tmp_path):
    path = write_lines(tmp_path / "dc.json", [NESTED, '{"dc_id": "dc-0", "source": null}',
                                              '{"dc_id": "dc-1", "source": {"s": {"description": "no geo"}}}'])
    dc = devices.load_datacenters(spark, path)
    got = {(r.id, r.deviceType): (r.description, r.lat) for r in devices.datacenter_devices(dc).collect()}
    assert got[("north-1", "probe-b")] == ("Door probe", 40.25)
    assert got[("north-1", "probe-a")][1] == 40.0
    assert got[("dc-1", "s")] == ("no geo", None)
    assert len(got) == 5   # the null map yields no row


def test_multiline_json_array_of_maps(spark, tmp_path):
    doc = [{"garden": {"beds": {"north": {"plant": "leek", "shade": True, "litres": 12}},
                       "trees": {"old": {"kind": "pear", "fruit": {"colour": "green", "grams": 170}}}}},
           {"garden": {"beds": {"south": {"plant": "kale", "shade": False, "litres": 9}}}}]
    p = tmp_path / "gardens.json"
    p.write_text(json.dumps(doc, indent=2))
    schema = ("garden struct<beds: map<string, struct<plant: string, shade: boolean, litres: bigint>>, "
              "trees: map<string, struct<kind: string, fruit: struct<colour: string, grams: bigint>>>>")
    from pyspark.sql import types as T
    df = read_json(spark, str(p), T._parse_datatype_string(schema), multiline=True)
    beds = jsonops.explode_map(df, "garden.beds")
    assert sorted((r.key, r.value.litres) for r in beds.collect()) == [("north", 12), ("south", 9)]
    trees = jsonops.explode_map(df, "garden.trees").select(jsonops.nested("value", "fruit", "grams").alias("g"))
    assert [r.g for r in trees.collect()] == [170]


def test_sink_selection_and_text_roundtrip(spark, tmp_path):
    assert select_sink("Text") is select_sink("text")
    with pytest.raises(ValueError):
        select_sink("avro")
    df = spark.createDataFrame([(1, "a/b", dt.datetime(2020, 1, 1, 0, 0, 0, 123456))],
                               "id long, s string, t timestamp_ntz")
    line = as_text_lines(df).first().value
    assert line.startswith("(null,{") and line.endswith("})")
    path = str(tmp_path / "t")
    select_sink("TEXT")(df, path)
    back = read_text_records(spark, path, df.schema).first()
    assert tuple(back) == (1, "a/b", dt.datetime(2020, 1, 1, 0, 0, 0, 123456))
    write_csv(df.select("id", "s"), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c")).first()[1] == "a/b"
    # overwrite replaces only its own folder
    write_csv(df.select("id"), str(tmp_path / "c"))
    assert spark.read.text(path).count() == 1
    assert schemas.TRACKER_SESSION.fieldNames()[0] == "session_id"
