from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from weft.session import get_spark

    s = get_spark("local[*]", shuffle_partitions=8, app_name="weft-tests")
    yield s


def write_lines(path, lines: list[str]) -> str:
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


# Invented records: a header, ten rows of the kept types, two of other types.
VISIT_LOG = [
    "#kind|time|visitor|address|page",
    "pageview|2024-03-05 08:00:00|v-ann|10.1.0.7|https://jd.com/a",
    "click|2024-03-05 08:10:00|v-ann|10.1.0.7|https://jd.com/a",
    "pageview|2024-03-05 08:05:00|v-bob|10.1.0.8|http://www.ali.com/deals",
    "scroll|2024-03-05 08:20:00|v-ann|10.1.0.7|https://jd.com/a",
    "click|2024-03-05 08:39:59|v-ann|10.1.0.7|https://jd.com/b",
    "pageview|2024-03-05 08:06:00|v-bob|10.1.0.8|https://blog.example.net/p1",
    "click|2024-03-05 08:06:30|v-bob|10.1.0.8|https://blog.example.net/p1",
    "pageview|2024-03-05 09:30:00|v-ann|10.1.0.9|https://shop.example.org/x",
    "click|2024-03-05 09:31:00|v-ann|10.1.0.9|https://shop.example.org/x",
    "click|2024-03-05 09:32:00|v-ann|10.1.0.9|https://shop.example.org/x",
    "hover|2024-03-05 09:32:00|v-bob|10.1.0.8|https://youku.com/v",
    "pageview|2024-03-05 08:07:00|v-bob|10.1.0.8|https://youku.com/v",
]

COOKIE_LABELS = ["v-ann|regular", "v-bob|night owl", "v-cid|new"]


def _device(n, kind, cca3, country, temp, signal, co2, battery=5):
    return (f'{n}::{{"device_id": {n}, "device_type": "{kind}", "ip": "10.9.0.{n}", "cca3": "{cca3}", "cn": "{country}", '
            f'"temp": {temp}, "signal": {signal}, "battery_level": {battery}, "c02_level": {co2}, "timestamp": {1_700_000_000 + n}}}')


DEVICE_LINES = [_device(0, "probe-a", "USA", "United States", 20, 30, 1001),
                _device(1, "probe-b", "NOR", "Norway", 16, 22, 1100),
                _device(2, "probe-a", "ITA", "Italy", 12, 25, 900),
                _device(3, "probe-c", "USA", "United States", 40, 9, 1300)]
