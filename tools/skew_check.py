"""Hot-key experiment: a per-key running scan where one key holds a third of the
rows, as a plain window (one task sorts the whole hot key) versus the segmented
scan (the hot key spreads over its day segments). Prints one JSON line.

    python tools/skew_check.py [rows] [cpus]
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from pitchlake.operators.windows import fill_down, lag_default  # noqa: E402
from pitchlake.session import local_session  # noqa: E402


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = local_session(cpus, shuffle_partitions=4 * cpus, app="skew-check")
    h = F.xxhash64(F.col("id"))
    df = spark.range(rows).select(
        "id",
        F.when(F.pmod(h, 100) < 34, F.lit(0)).otherwise(F.pmod(h, 5000) + 1).alias("user"),
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64(F.col("id"), F.lit(1)), 365 * 86400)).alias("ts"),
        F.when(F.pmod(h, 7) == 0, F.pmod(h, 1000).cast("double")).alias("v"),
    )
    order = ["ts", "id"]
    seg = F.to_date("ts")
    cases = {
        "lag_plain": lambda: lag_default(df, "v", ["user"], order, "p"),
        "lag_segmented": lambda: lag_default(df, "v", ["user"], order, "p", segment=seg),
        "fill_plain": lambda: fill_down(df, "v", ["user"], order, out="f", default=0.0),
        "fill_segmented": lambda: fill_down(df, "v", ["user"], order, out="f", default=0.0, segment=seg),
    }
    out = {}
    for name, make in cases.items():
        make().write.format("noop").mode("overwrite").save()  # warm-up
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t0, 2)
    print(json.dumps({"rows": rows, "hot_key_share": 0.34, "cpus": cpus, "seconds": out}))
    spark.stop()


if __name__ == "__main__":
    main()
