"""Benchmark the headline queries.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: one warm-up, then ``$BENCH_RUNS`` (default 3) timed
runs; reports the median per query (``value`` is their sum). Then every
registered query once, the payload storage forms, the upsert write path and the
play-by-play flattening. Each run executes the full plan into Spark's
``noop`` sink, so nothing is collected to the driver. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pitchlake.plans.catalog import QUERIES  # noqa: E402
from pitchlake.session import local_session  # noqa: E402

HEADLINE = [
    "arsenal",
    "fanout_check",
    "orphans_pair",
    "orphans_parent",
    "unpack_view",
    "view_filter",
    "upsert",
    "upsert_partial",
    "locf_zero",
    "lag_zero",
    "first_per_group",
    "pivot_wide",
    "top_entities",
    "null_rates",
    "entity_year_counts",
    "dup_keys",
    "pack_json",
    "work_plan",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def payload_formats(spark, sf_dir: str, runs: int) -> dict[str, float]:
    """The same typed view of ``events.props`` from three storage forms: JSON
    text parsed at query time, VARIANT parsed once on load, and the typed view
    materialised. Setup writes are not timed."""
    from pyspark.sql import functions as F

    from pitchlake.functions.payload import to_variant
    from pitchlake.operators.views import unpack_view
    from pitchlake.plans.catalog import EVENT_KEEP, EVENT_PAYLOAD
    from pitchlake.session import scratch_path, table

    events = table(spark, sf_dir, "events")
    var_path = scratch_path(spark, "bench-variant")
    events.withColumn("props", to_variant(F.col("props"))).write.parquet(var_path)
    mat_path = scratch_path(spark, "bench-typed")
    unpack_view(events, "props", EVENT_PAYLOAD, EVENT_KEEP).write.parquet(mat_path)

    forms = {
        "payload_text": lambda: unpack_view(table(spark, sf_dir, "events"), "props", EVENT_PAYLOAD, EVENT_KEEP),
        "payload_variant": lambda: unpack_view(spark.read.parquet(var_path), "props", EVENT_PAYLOAD, EVENT_KEEP),
        "payload_materialized": lambda: spark.read.parquet(mat_path),
    }
    out = {}
    for name, make in forms.items():
        make().write.format("noop").mode("overwrite").save()
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    return out


def flatten_throughput(spark, n_docs: int, runs: int) -> dict[str, float]:
    """Play-by-play flattening of ``n_docs`` game documents (copies of the golden
    fixture game under distinct ids) into event, pitch and play rows, with
    lineups; the three outputs are run into the noop sink. Bench-only input."""
    import json as _json

    sys.path.insert(0, str(Path(__file__).resolve().parent / "tests"))
    from fixtures import games as G

    from pitchlake.operators.nested import flatten_games
    from pitchlake.session import scratch_path
    from pitchlake.sources.landed import read_game_feed

    from pyspark.sql import functions as F

    template = _json.dumps(G.g1("GAMEID"))
    ids = spark.range(n_docs).select(F.format_string("b%06d", F.col("id")).alias("gid"))
    docs_path = scratch_path(spark, "bench-docs")
    ids.select(F.replace(F.lit(template), F.lit("GAMEID"), F.col("gid")).alias("value")).write.text(docs_path)
    slots = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(p).alias("p"), F.lit(pid).alias("pid"))
                      for _, h, p, pid in G.lineup_rows("x")])
    lineup = ids.select("gid", F.explode(slots).alias("s")).select(
        F.col("gid").alias("game_id"), F.col("s.h").alias("half_inning"),
        F.col("s.p").alias("position"), F.col("s.pid").alias("player_id"),
    )

    def once() -> float:
        t0 = time.perf_counter()
        out = flatten_games(read_game_feed(spark, docs_path, multiline=False), lineup=lineup, cut_lineage=True)
        for df in out.values():
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    once()
    return {f"flatten_{n_docs}_games": round(statistics.median(once() for _ in range(runs)), 3)}


def upsert_write(spark, sf_dir: str, runs: int) -> dict[str, float]:
    """The full upsert write path (key index, one write, one version) into a
    year-partitioned copy of ``orders``, for a batch of which 1 % or 50 % of the
    keys already exist. Batches are date windows: the batch covers
    [2000-01-01, end] and the table everything before ``cut``, so the overlap
    is the matched share. The table is rebuilt (untimed) before every run."""
    from pyspark.sql import functions as F

    from pitchlake.operators.merge import upsert_table
    from pitchlake.session import scratch_path, table

    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    start = ts("2000-01-01")
    batch = orders.filter(F.col("o_orderdate") >= start).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    out = {}
    for label, cut in (("1pct", "2000-01-07"), ("50pct", "2000-10-16")):
        base = orders.filter(F.col("o_orderdate") < ts(cut))
        times = []
        for i in range(runs + 1):
            path = scratch_path(spark, f"bench-upsert-{label}")
            upsert_table(spark, path, base, ["o_orderkey"], orders.schema, ["year"], stamp_col=None)
            t0 = time.perf_counter()
            upsert_table(spark, path, batch, ["o_orderkey"], orders.schema, ["year"], stamp_col=None)
            if i:  # first run is the warm-up
                times.append(time.perf_counter() - t0)
        out[f"upsert_write_{label}"] = round(statistics.median(times), 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="pitchlake-bench")
    out = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        out[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    # every registered query once (after the headline runs warmed the JVM)
    catalog = {}
    if os.environ.get("BENCH_ALL_QUERIES", "1") == "1":
        for name in sorted(QUERIES):
            catalog[name] = round(run_once(spark, name, sf_dir), 3)
    extra = payload_formats(spark, sf_dir, runs) if os.environ.get("BENCH_PAYLOAD_FORMATS", "1") == "1" else {}
    write = upsert_write(spark, sf_dir, runs) if os.environ.get("BENCH_UPSERT_WRITE", "1") == "1" else {}
    n_docs = int(os.environ.get("BENCH_GAME_DOCS", "2000"))
    nested = flatten_throughput(spark, n_docs, runs) if n_docs > 0 else {}
    sf = Path(sf_dir).name.replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(out.values()), 3),
                "unit": "sec",
                "queries": out,
                "all_queries_single_run": catalog,
                "all_queries_total": round(sum(catalog.values()), 3),
                "payload_formats": extra,
                "write_path": write,
                "nested": nested,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
