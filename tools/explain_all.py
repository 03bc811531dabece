"""Write the formatted physical plan of every registered query.

    python tools/explain_all.py [sf_dir] [out_dir]

Plans are taken before execution (AQE shows its initial plan); they show
the pushed filters, read schemas, exchanges and aggregate modes. A plan that
a query checkpoints on the way is written before the final one.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql.classic.dataframe import DataFrame  # noqa: E402

from weft.plans import catalog  # noqa: E402
from weft.session import get_spark  # noqa: E402

SKIP = {"streaming_gap_sessions", "streaming_pageview_sessions"}  # their plans live in the streaming query, not the read-back


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(__file__), "..", "docs", "plans")
    os.makedirs(out, exist_ok=True)
    spark = get_spark("local[8]", 8)
    checkpoint = DataFrame.checkpoint

    def shown(df: DataFrame, *args, **kwargs) -> DataFrame:
        print("== Checkpointed on the way ==")
        df.explain("formatted")
        return checkpoint(df, *args, **kwargs)

    DataFrame.checkpoint = shown
    for name, fn in catalog.QUERIES.items():
        if name in SKIP:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf).explain("formatted")
        with open(os.path.join(out, f"{name}.txt"), "w") as fh:
            fh.write(buf.getvalue())
        print(name)


if __name__ == "__main__":
    main()
