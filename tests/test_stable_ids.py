"""Ids and tie order of the visit job do not depend on how its files are read."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from weft.plans.visits import build_sessions, read_log
from weft.sources.formats import parse_visit_log, read_lines


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def many_lines(seed, n=4000):
    rnd = random.Random(seed)
    kinds = ["pageview", "click", "scroll"]
    # few seconds, so that ties are frequent
    return ["#head", *[f"{rnd.choice(kinds)}|2024-03-05 {8 + rnd.randrange(6):02d}:{rnd.randrange(2) * 45:02d}:0{rnd.randrange(2)}|v{rnd.randrange(40)}|{seed}.{k}|https://h{k % 5}.com/{k}"
                       for k in range(n)], "short|line"]


def sessions(spark, path, strategy):
    return {tuple(r) for r in build_sessions(read_log(spark, path).rows, None, strategy=strategy).collect()}


@pytest.fixture
def split_bytes(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("strategy", ["gap", "pageview"])
def test_sessions_are_the_same_at_any_split_size_and_after_a_file_is_added(spark, tmp_path, split_bytes, strategy):
    folder = str(tmp_path / "log")
    write(folder, "b.txt", many_lines(1))
    write(folder, "c.txt", many_lines(2))
    split_bytes(128 << 20)
    whole = sessions(spark, folder, strategy)
    split_bytes(7_001)
    assert sessions(spark, folder, strategy) == whole and len({r[0] for r in whole}) == len(whole) > 100
    write(folder, "a.txt", [line.replace("|v", "|new") for line in many_lines(3, 500)])
    for size in (7_001, 64 << 20):
        split_bytes(size)
        after = sessions(spark, folder, strategy)
        assert {r for r in after if not r[2].startswith("new")} == whole and len(after) > len(whole)


def test_line_numbers_are_the_places_in_the_file(spark, tmp_path, split_bytes):
    folder = str(tmp_path / "log")
    lines = [f"click|2024-03-05 08:00:00|v|{k}|u{'x' * (k % 50)}" for k in range(2000)]
    write(folder + "/part=1", "z.txt", lines[:700])
    write(folder + "/part=1", "zz.txt", lines[700:1500])
    write(folder + "/part=2", "a.txt", lines[1500:])
    for size in (997, 10_007, 1 << 20):
        split_bytes(size)
        parsed = parse_visit_log(read_lines(spark, folder, places=True, file_key=F.col("part"))).numbered("at")
        got = {int(r.ip): (r["at"].file, r["at"].line) for r in parsed.rows.collect()}
        assert got == {k: (1, k) if k < 1500 else (2, k - 1500) for k in range(2000)}
    with pytest.raises(ValueError):
        parse_visit_log(spark.createDataFrame([("a|b",)], "value string")).derive(lambda a, b: (a, b)).rows_or_fail()


def test_lines_of_no_place_cannot_be_numbered(spark):
    from weft.sources.formats import Parsed
    df = spark.createDataFrame([("a",)], "value string")
    with pytest.raises(ValueError):
        Parsed(df, df).numbered("at")
