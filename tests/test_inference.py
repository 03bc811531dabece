"""Types inferred while the rows pass are those of Spark's own inference."""

from __future__ import annotations

import pytest

from weft.sources.formats import infer_csv, read_csv

COLUMNS = {
    "ints": ["1", "-2", "+3", ""], "longs": ["1", "3000000000", "", "7"], "big": ["1", "99999999999999999999999", "5", "6"],
    "over": ["9999999999999999999", "9999999999999999998", "", ""], "doubles": ["1", "2.5", "-1e3", ".5"], "special": ["1.5", "NaN", "Inf", "-Inf"],
    "big_and_double": ["99999999999999999999999", "1.5", "", "2"], "days": ["2024-01-31", "2024-02-29", "", "1999-12-31"],
    "times": ["2024-01-31 10:00:00", "2024-02-29 23:59:59.5", "", "1999-12-31T00:00:00"], "days_and_times": ["2024-01-31", "2024-02-29 10:00:00", "", "2024-02-01"],
    "flags": ["true", "False", "", "TRUE"], "flag_and_int": ["true", "1", "", "0"], "day_and_int": ["2024-01-31", "1", "", "2"],
    "text": ["a", "1", "2.5", ""], "none": ["", "", "", ""], "codes": ["1a", "0x10", "1,5", "--"], "dotted": ["1.2.3", "4", "5", "6"],
}


def write(tmp_path, header):
    names = list(COLUMNS)
    lines = [";".join(names)] if header else []
    lines += [";".join(COLUMNS[n][k] for n in names) for k in range(4)]
    (tmp_path / "in").mkdir()
    for k, some in enumerate((lines[:3], ([lines[0]] if header else []) + lines[3:])):
        (tmp_path / "in" / f"{k}.csv").write_text("\n".join(some) + "\n")
    return str(tmp_path / "in")


@pytest.mark.parametrize("header", [True, False])
def test_types_and_values_are_spark_s_own(spark, tmp_path, header):
    path = write(tmp_path, header)
    own = infer_csv(spark, path, str(tmp_path / "staged"), header=header, sep=";")
    theirs = read_csv(spark, path, header=header, infer_schema=True, sep=";")
    assert own.dtypes == theirs.dtypes
    assert sorted(map(str, own.collect())) == sorted(map(str, theirs.collect()))
    assert len({t for _, t in own.dtypes}) >= 8


def test_a_file_without_rows(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_text("a,b.c\n")
    df = infer_csv(spark, str(p), str(tmp_path / "staged"), header=True)
    assert df.dtypes == [("a", "string"), ("b.c", "string")] and df.count() == 0
