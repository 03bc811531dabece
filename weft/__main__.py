"""Command line for the three jobs: ``python -m weft …`` (or ``spark-submit``
with the package shipped through ``--py-files``).

    python -m weft visits [text|parquet|csv] [--strategy gap|pageview]
    python -m weft flights FLIGHTS_CSV --out DIR [--sink parquet] [--routes-out DIR]
    python -m weft devices DEVICE_TXT --out DIR [--sink parquet] [--datacenters JSON [--multiline]]

The paths of ``visits`` come from ``spark.weft.visits.logPath``,
``spark.weft.visits.labelPath`` and ``spark.weft.visits.outputPath``
(``--conf`` on ``spark-submit``). The reports of the other jobs are written
whole, each to a folder of its name under ``--out``; the console shows a preview.
"""

from __future__ import annotations

import argparse
import json

from weft.session import get_spark, scratch_path


def _write_reports(reports: dict, out: str, sink: str) -> None:
    from weft.sinks.writers import preview, select_sink

    write = select_sink(sink)
    for name, df in reports.items():
        write(df, f"{out.rstrip('/')}/{name}")
        print(name)
        preview(df, 20, False)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="weft")
    sub = ap.add_subparsers(dest="job", required=True)
    s = sub.add_parser("visits")
    s.add_argument("sink", nargs="?", default="text")
    s.add_argument("--strategy", default="gap")
    s.add_argument("--gap", default="30 minutes")
    s.add_argument("--together", action="store_true", help="make the outputs visible together")
    f = sub.add_parser("flights")
    f.add_argument("flights")
    f.add_argument("--routes-out")
    d = sub.add_parser("devices")
    d.add_argument("devices")
    d.add_argument("--datacenters")
    d.add_argument("--multiline", action="store_true")
    for p in (f, d):
        p.add_argument("--out", required=True)
        p.add_argument("--sink", default="parquet")
    a = ap.parse_args(argv)

    spark = get_spark()
    if a.job == "visits":
        from weft.plans.visits import run_visit_job
        print(json.dumps(run_visit_job(spark, sink=a.sink, strategy=a.strategy, gap=a.gap, together=a.together)))
    elif a.job == "flights":
        from weft.plans.flights import flight_analysis, load_flights
        parsed = load_flights(spark, a.flights).written(scratch_path(spark, "flights"))  # one pass over the input
        _write_reports(flight_analysis(spark, routes_out=a.routes_out, parsed=parsed), a.out, a.sink)
    else:
        from weft.plans.devices import datacenter_analysis, device_analysis
        outs = device_analysis(spark, a.devices)
        if a.datacenters:
            outs.update(datacenter_analysis(spark, a.datacenters, a.multiline))
        _write_reports(outs, a.out, a.sink)


if __name__ == "__main__":
    main()
