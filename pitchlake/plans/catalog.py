"""The query catalog: every operator of the survey run on the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables; filters
below are the query's own predicates (categories, date ranges), never subsets
chosen to make a check cheap. The matching DuckDB SQL lives in ``oracle.py``.

Role of the driver tables: orders = games / ledger rows, lineitem = pitches,
customer and supplier = player dimension, events.props = JSON payload,
documents LEFT JOIN labels = completeness and coverage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.functions import columns as C
from pitchlake.functions.payload import pack_json, payload_struct, to_variant, typed_field
from pitchlake.operators import audit as A
from pitchlake.operators import windows as W
from pitchlake.operators.merge import ACTION, keep_last, merge_counts, merge_frames, read_stored, upsert_table
from pitchlake.operators.views import materialize, unpack_view
from pitchlake.plans import ledger as L
from pitchlake.plans.game_queries import GAME_QUERIES
from pitchlake.plans.storage_queries import STORAGE_QUERIES
from pitchlake.schemas import COVERAGE_ALARM_PCT
from pitchlake.session import Tables, scratch_path
from pitchlake.sources.landed import csv_round_trip

Query = Callable[[SparkSession, str], DataFrame]

# Payload spec of events.props: the stored key plus two keys that are absent in
# the data (they must come back as typed NULLs, not as missing columns).
EVENT_PAYLOAD = [("k", "int"), ("label", "text"), ("score", "numeric")]
EVENT_PAYLOAD_CORE = [("k", "int")]
EVENT_KEEP = ["event_id", "user_id", "ts", "event_type", "value"]
EVENT_TYPES = ["view", "signup", "purchase", "error", "click"]
EVENT_ORDER = ["ts", "event_id"]


def _day_segment() -> F.Column:
    """Order-monotone bucket for per-user scans: the calendar day of ``ts``."""
    return F.to_date(F.col("ts"))


def _events_view(spark: SparkSession, sf: str, spec=EVENT_PAYLOAD, with_names: bool = True) -> DataFrame:
    t = Tables(spark, sf)
    return unpack_view(
        t.events,
        "props",
        spec,
        EVENT_KEEP,
        dim=t.customer if with_names else None,
        dim_key="c_custkey",
        dim_cols={"customer_name": "c_name"},
        join_field="k",
    )


# --- audit queries (Q1-Q23, A13, A14) ---------------------------------------

def q_arsenal(spark, sf):
    li = Tables(spark, sf).lineitem
    return A.summary_with_share(
        li,
        ["l_returnflag", "l_linestatus"],
        {
            "avg_qty": ("l_quantity", 1),
            "avg_price": ("l_extendedprice", 0),
            "avg_disc": ("l_discount", 2),
            "avg_tax": ("l_tax", 2),
        },
        count_alias="n_lines",
        share_alias="usage_pct",
    )


def q_name_lookup(spark, sf):
    return A.name_lookup(Tables(spark, sf).part, "p_name", "ring", ["p_partkey", "p_name", "p_brand", "p_type"])


def q_top_entities(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.filter(
        (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderstatus") == "F")
    ).select("o_orderkey")
    j = t.lineitem.select("l_orderkey", "l_suppkey").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return A.top_k_counts(j, "l_suppkey", 30, "n_lines")


def q_ledger_audit(spark, sf):
    o = Tables(spark, sf).orders
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    return (
        o.filter((F.col("o_orderdate") >= ts("2001-01-01")) | (F.col("o_orderdate") < ts("1995-02-01")))
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
        .orderBy("o_orderstatus", "o_orderdate")
    )


def q_ledger_failed(spark, sf):
    e = Tables(spark, sf).events
    return e.filter(F.col("event_type") == "error").select("event_id", "user_id", "ts", "value").orderBy(F.col("ts").desc())


def _week_cover(spark, sf):
    o = Tables(spark, sf).orders
    return o.filter(
        (F.col("o_orderstatus") == "F")
        & (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderdate") >= F.lit("1997-03-07").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1997-11-01").cast("timestamp_ntz"))
    )


def q_week_gaps(spark, sf):
    return L.week_gaps(_week_cover(spark, sf), "o_orderdate", "1997-03-07", "1997-10-31", aligned=False)


def q_week_gaps_aligned(spark, sf):
    return L.week_gaps(_week_cover(spark, sf), "o_orderdate", "1997-03-07", "1997-10-31", aligned=True)


def q_games_by_year(spark, sf):
    o = Tables(spark, sf).orders.filter(F.col("o_orderstatus") == "F")
    return A.count_by(o, [F.year("o_orderdate").alias("year")], "n_orders")


def q_counts_by_year(spark, sf):
    return A.count_by(Tables(spark, sf).lineitem, [F.year("l_shipdate").alias("year")], "n_lines")


def q_events_by_day(spark, sf):
    return A.count_by(Tables(spark, sf).events, [F.to_date("ts").alias("day")], "n_events")


def q_view_rows_by_day(spark, sf):
    v = _events_view(spark, sf, EVENT_PAYLOAD_CORE)
    return (
        v.groupBy(F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("view_rows"), F.count("customer_name").alias("named_rows"))
        .orderBy("day")
    )


def q_entity_year_counts(spark, sf):
    li = Tables(spark, sf).lineitem.withColumn("year", F.year("l_shipdate"))
    return A.count_and_distinct(li, ["l_suppkey", "year"], "l_orderkey", "n_lines", "n_orders")


def q_fanout_check(spark, sf):
    t = Tables(spark, sf)
    return A.fanout_check(
        parent=t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name"),
        child=t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey"),
        grandchild=t.lineitem.select("l_orderkey", "l_linenumber"),
        parent_key="c_custkey",
        child_parent_key="o_custkey",
        child_key="o_orderkey",
        grandchild_child_key="l_orderkey",
        grandchild_count_col="l_linenumber",
        group_cols=["c_custkey", "c_name"],
        distinct_alias="n_orders",
        count_alias="n_lines",
        child_unique=True,  # o_orderkey is the primary key of orders
    )


def q_orphans_pair(spark, sf):
    li = Tables(spark, sf).lineitem
    flagged = li.filter(F.col("l_returnflag") == "R")
    return A.orphan_count(li, flagged, ["l_orderkey", "l_suppkey"], "orphaned_lines")


def q_orphans_parent(spark, sf):
    t = Tables(spark, sf)
    return A.orphan_count(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}, "orders_without_lines")


def q_orphans_child(spark, sf):
    t = Tables(spark, sf)
    return A.orphan_count(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"}, "lines_without_order")


def q_missing_dim_ids(spark, sf):
    t = Tables(spark, sf)
    return A.missing_dim_ids(t.documents, "doc_id", t.labels, "doc_id", 20)


def _docs_labels(spark, sf):
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", "lang", "source")
    lab = t.labels.select(F.col("doc_id").alias("l_doc_id"), "quality", "toxic")
    return d.join(lab, F.col("doc_id") == F.col("l_doc_id"), "left")


def q_null_rates(spark, sf):
    return A.null_rates(
        _docs_labels(spark, sf),
        ["lang"],
        {
            "pct_has_label": "l_doc_id",
            "pct_has_quality": "quality",
            "pct_has_toxic": "toxic",
            "pct_has_source": "source",
        },
        total_alias="total_docs",
    )


def q_source_coverage(spark, sf):
    t = Tables(spark, sf)
    docs = t.documents.select("doc_id", "lang")
    labelled = t.labels.select("doc_id").join(docs, "doc_id")
    return A.coverage(docs, labelled, "lang", "n_docs", "n_labels", "label_coverage_pct")


def q_view_filter(spark, sf):
    t = Tables(spark, sf)
    v = unpack_view(
        t.events, "props", EVENT_PAYLOAD_CORE, EVENT_KEEP,
        dim=t.customer, dim_key="c_custkey",
        dim_cols={"customer_name": "c_name", "segment": "c_mktsegment"}, join_field="k",
    )
    return (
        v.filter((F.col("segment") == "BUILDING") & (F.col("event_type") == "purchase"))
        .select("event_id", "ts", "customer_name", "value", "k")
        .orderBy("ts")
    )


def q_metric_by_group(spark, sf):
    v = _events_view(spark, sf, EVENT_PAYLOAD_CORE, with_names=False)
    return (
        v.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 2).alias("avg_value"))
        .orderBy("event_type")
    )


def q_metric_trend(spark, sf):
    e = Tables(spark, sf).events
    daily = e.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("_sum")
    )
    # One row per day: a running frame without a partition key is fine here.
    w = Window.orderBy("day").rowsBetween(-6, 0)
    return daily.select(
        "day",
        "n",
        F.round(F.col("_sum") / F.col("n"), 3).alias("avg_value"),
        F.round(F.sum("_sum").over(w) / F.sum("n").over(w), 3).alias("avg_value_7d"),
    ).orderBy("day")


def q_event_rate(spark, sf):
    e = Tables(spark, sf).events
    return A.rate_by(e, ["user_id"], F.col("event_type") == "purchase", "n_events", "n_purchases", "purchase_rate")


def q_dup_keys(spark, sf):
    return A.duplicate_keys(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"], "n")


def q_not_null_check(spark, sf):
    return A.null_counts(_docs_labels(spark, sf), ["lang", "source", "quality", "toxic"])


# --- scans, sources, column operators ---------------------------------------

def q_scan_filter_window(spark, sf):
    o = Tables(spark, sf).orders
    return o.filter(
        F.col("o_orderdate").between(F.lit("1997-03-01").cast("timestamp_ntz"), F.lit("1997-03-31").cast("timestamp_ntz"))
        & F.col("o_orderstatus").isin("F", "O")
    ).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def q_union_stamped(spark, sf):
    t = Tables(spark, sf)
    c = C.stamp(
        C.rename_keep(
            t.customer,
            {"c_custkey": "entity_id", "c_name": "name", "c_nationkey": "nationkey", "c_acctbal": "acctbal", "c_mktsegment": "segment"},
        ),
        kind="customer",
    )
    s = C.stamp(
        C.rename_keep(
            t.supplier,
            {"s_suppkey": "entity_id", "s_name": "name", "s_nationkey": "nationkey", "s_acctbal": "acctbal", "s_segment": "segment"},
        ),
        kind="supplier",
    )
    return c.unionByName(s, allowMissingColumns=True).select("entity_id", "name", "nationkey", "acctbal", "segment", "kind")


def q_csv_round_trip(spark, sf):
    sup = Tables(spark, sf).supplier
    return csv_round_trip(sup, scratch_path(spark, "csv-round-trip"))


def q_csv_round_trip_texts(spark, sf):
    return csv_round_trip(Tables(spark, sf).documents, scratch_path(spark, "csv-round-trip"))


def q_select_tolerant(spark, sf):
    return C.select_tolerant(Tables(spark, sf).supplier, ["s_suppkey", "s_name", "s_phone", "s_nationkey", "year"])


def q_rename_keep(spark, sf):
    return C.rename_keep(
        Tables(spark, sf).customer,
        {"c_custkey": "customer_id", "c_name": "name", "c_phone": "phone", "c_mktsegment": "segment"},
    )


COERCE_TARGET = "event_id BIGINT, user_id BIGINT, value DOUBLE, k INT, day DATE, is_error BOOLEAN"


def q_coerce_types(spark, sf):
    e = Tables(spark, sf).events
    text = e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit(" "), F.col("value").cast("string")).alias("value"),  # space-padded number
        F.get_json_object("props", "$.k").alias("k"),
        F.col("ts").cast("string").alias("day"),
        F.when(F.col("event_type") == "error", "TRUE").otherwise("false").alias("is_error"),
    )
    return C.coerce_to_schema(text, T.StructType.fromDDL(COERCE_TARGET))


def q_json_extract(spark, sf):
    e = Tables(spark, sf).events
    p = e.select("event_id", payload_struct(F.col("props"), ["k", "missing"]).alias("_p"))
    s = F.col("_p")
    return p.select(
        "event_id",
        typed_field(s, "k", "text").alias("k_text"),
        typed_field(s, "k", "int").alias("k_int"),
        typed_field(s, "k", "numeric").alias("k_double"),
        typed_field(s, "missing", "text").alias("missing_text"),
    )


def q_unpack_view(spark, sf):
    return _events_view(spark, sf, EVENT_PAYLOAD)


def q_unpack_view_core(spark, sf):
    return _events_view(spark, sf, EVENT_PAYLOAD_CORE)


def q_pack_json(spark, sf):
    return pack_json(Tables(spark, sf).customer, ["c_custkey"])


# --- upsert -----------------------------------------------------------------

def _upsert_target(spark, sf):
    o = Tables(spark, sf).orders
    return o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))


def _upsert_batch(spark, sf):
    o = Tables(spark, sf).orders
    return o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))


# The batches below are keyed by o_orderkey, the primary key of orders, so the
# duplicate-key check of merge_frames (a job run while the query is built) is
# skipped; upsert_table always runs it.


def q_upsert(spark, sf):
    src = _upsert_batch(spark, sf).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    m = merge_frames(_upsert_target(spark, sf), src, ["o_orderkey"], check_duplicates=False)
    return m.withColumnRenamed(ACTION, "merge_action")


def q_upsert_partial(spark, sf):
    src = _upsert_batch(spark, sf).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.lower("o_orderstatus")).alias("o_orderstatus"),
    )
    m = merge_frames(_upsert_target(spark, sf), src, ["o_orderkey"], check_duplicates=False)
    return m.withColumnRenamed(ACTION, "merge_action")


def q_upsert_insert_only(spark, sf):
    src = _upsert_batch(spark, sf).select("o_orderkey")
    m = merge_frames(_upsert_target(spark, sf), src, ["o_orderkey"], check_duplicates=False)
    return m.withColumnRenamed(ACTION, "merge_action")


def q_upsert_counts(spark, sf):
    src = _upsert_batch(spark, sf).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return merge_counts(merge_frames(_upsert_target(spark, sf), src, ["o_orderkey"], check_duplicates=False))


# --- joins, arrays, windows -------------------------------------------------

def q_many_to_many(spark, sf):
    t = Tables(spark, sf)
    home = t.nation.select(F.col("n_nationkey").alias("_nk"), F.col("n_regionkey").alias("_rk"))
    peers = t.nation.select(F.col("n_regionkey").alias("_prk"), F.col("n_nationkey").alias("peer_nationkey"))
    s = t.supplier.select("s_suppkey", "s_nationkey").join(home, F.col("s_nationkey") == F.col("_nk"))
    return s.join(peers, F.col("_rk") == F.col("_prk"), "left").select("s_suppkey", "s_nationkey", "peer_nationkey")


def q_array_cond_count(spark, sf):
    e = Tables(spark, sf).embeddings
    return e.select(
        "vec_id",
        F.size("embedding").alias("n_dims"),
        F.size(F.filter("embedding", lambda x: x > 0)).alias("n_positive"),
    )


def q_array_flatten_first(spark, sf):
    d = Tables(spark, sf).documents
    words = F.flatten(F.transform(F.split(F.col("text"), "\n"), lambda line: F.split(line, " ")))
    return d.select("doc_id", words.alias("_w")).select(
        "doc_id", F.size("_w").alias("n_words"), F.get(F.col("_w"), 0).alias("first_word")
    )


def q_first_per_group(spark, sf):
    e = Tables(spark, sf).events
    return W.first_per_group(e, ["user_id", "event_type"], EVENT_ORDER, ["event_id", "ts", "value"])


def q_group_min_flag(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts", "value")
    return W.keep_on_group_min(e, "value", ["user_id"], "ts", out="first_value").select(
        "event_id", "user_id", "ts", "first_value"
    )


def q_lag_zero(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts", "value")
    return W.lag_default(e, "value", ["user_id"], EVENT_ORDER, "prev_value", 0, segment=_day_segment())


def q_locf_zero(spark, sf):
    e = Tables(spark, sf).events.select(
        "event_id", "user_id", "ts", "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_value"),
    )
    out = W.fill_down(e, "purchase_value", ["user_id"], EVENT_ORDER, out="last_purchase_value", default=0.0, segment=_day_segment())
    return out.drop("purchase_value")


def q_pivot_wide(spark, sf):
    e = Tables(spark, sf).events
    return W.pivot_first(e, ["user_id"], "event_type", EVENT_TYPES, "value", EVENT_ORDER, name="first_{}")


def q_lineup_fill(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts", "event_type", "value")
    e = W.keep_on_group_min(e, "value", ["user_id"], "ts", out="start_value")
    e = e.withColumn("sub_value", F.when(F.col("event_type") == "purchase", F.col("value")))
    out = W.merge_then_fill(e, "start_value", "sub_value", ["user_id"], EVENT_ORDER, "filled_value", segment=_day_segment())
    return out.select("event_id", "user_id", "ts", "filled_value")


# --- ledger, planning -------------------------------------------------------

def q_date_chunks(spark, sf):
    o = Tables(spark, sf).orders
    r = o.agg(F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e"))
    return L.chunk_dates(r, "s", "e", 7)


PLAN_DAYS = 2


def q_work_plan(spark, sf):
    o = Tables(spark, sf).orders.select(F.col("o_orderstatus").alias("data_source"), "o_orderdate")
    r = o.groupBy("data_source").agg(
        F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e")
    )
    units = L.chunk_dates(r, "s", "e", PLAN_DAYS, keep=["data_source"]).withColumnsRenamed(
        {"chunk_start": "date_start", "chunk_end": "date_end"}
    )
    # A unit is done when at least one row landed in it (the "success" ledger).
    done = (
        o.join(r, "data_source")
        .select("data_source", L.chunk_of(F.col("o_orderdate"), F.col("s"), PLAN_DAYS).alias("date_start"), "e")
        .select("data_source", "date_start", F.least(F.date_add("date_start", PLAN_DAYS - 1), F.col("e")).alias("date_end"))
        .distinct()
    )
    return L.work_plan(units, done, keys=("data_source", "date_start", "date_end"))


def _event_states(spark, sf):
    e = Tables(spark, sf).events
    return e.select("user_id", "event_id", "ts", F.col("event_type").alias("status"), "value")


def q_ledger_latest(spark, sf):
    return L.latest_state(_event_states(spark, sf), key="user_id", at=("ts", "event_id"))


def q_ledger_get(spark, sf):
    e = Tables(spark, sf).events
    failing = q_ledger_latest(spark, sf).filter(F.col("status") == "error").select(F.col("event_id").alias("_id"))
    return e.join(failing, F.col("event_id") == F.col("_id"), "left_semi")


def q_scalar_strings(spark, sf):
    p = Tables(spark, sf).part
    words = F.split(F.col("p_name"), " ")
    return p.select(
        "p_partkey",
        F.size(words).alias("n_words"),
        L.join_levels(words).alias("name_csv"),
        F.get(words, 0).alias("first_word"),
    )


def q_scalar_arrays(spark, sf):
    p = Tables(spark, sf).part
    words = F.split(F.col("p_name"), " ")
    return p.select(
        "p_partkey",
        F.size(F.array_except(words, F.array(F.lit("ring"), F.lit("bolt")))).alias("n_other_words"),
        F.array_contains(words, "ring").alias("has_ring"),
    )


def q_coverage_alarm(spark, sf):
    t = Tables(spark, sf)
    docs = t.documents.select("doc_id", "lang")
    labelled = t.labels.select("doc_id").join(docs, "doc_id")
    cov = A.coverage(docs, labelled, "lang", "n_docs", "n_labels", "label_coverage_pct")
    return cov.withColumn("below_alarm", F.col("label_coverage_pct") < COVERAGE_ALARM_PCT)


def q_uncovered_days(spark, sf):
    o = Tables(spark, sf).orders.select(F.col("o_orderstatus").alias("data_source"), "o_orderdate")
    r = o.groupBy("data_source").agg(
        F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e")
    )
    units = L.chunk_dates(r, "s", "e", 30, keep=["data_source"]).withColumnsRenamed(
        {"chunk_start": "date_start", "chunk_end": "date_end"}
    )
    # a day with at least one row counts as a finished one-day window
    done = o.select("data_source", F.to_date("o_orderdate").alias("date_start")).distinct().withColumn(
        "date_end", F.col("date_start")
    )
    return L.uncovered_days(units, done, keys=("data_source",))


def q_unpack_view_variant(spark, sf):
    t = Tables(spark, sf)
    ev = t.events.withColumn("props", to_variant(F.col("props")))
    return unpack_view(
        ev, "props", EVENT_PAYLOAD, EVENT_KEEP,
        dim=t.customer, dim_key="c_custkey", dim_cols={"customer_name": "c_name"}, join_field="k",
    )


def q_dedupe_last(spark, sf):
    li = Tables(spark, sf).lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return keep_last(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


def q_stale_runs(spark, sf):
    states = _event_states(spark, sf)
    return L.stale_runs(
        states, now=F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), hours=12, key="user_id",
        at=("ts", "event_id"), status_col="status", started_col="ts", running="view",
    )


def q_materialized_view(spark, sf):
    # The typed view written once (partitioned by event type, range-clustered), then queried from the materialised copy.
    view = _events_view(spark, sf, EVENT_PAYLOAD_CORE)
    path = materialize(spark, view, scratch_path(spark, "materialized-view"), partition_by=("event_type",),
                       sort_within=("user_id", "ts"))
    mv = read_stored(spark, path)
    return mv.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count("customer_name").alias("named"), F.sum("k").alias("sum_k")
    )


def q_upsert_partition_move(spark, sf):
    """Stored table: load all orders by year, then move the late ones a year on
    by a second batch, and read the table back."""
    orders = Tables(spark, sf).orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("date").alias("day"))
    orders = orders.withColumn("part_year", F.year("day"))
    schema, path = orders.schema, scratch_path(spark, "upsert-move")
    late = orders.filter(F.col("day") >= F.lit("1997-01-01").cast("date"))
    moved = late.select("o_orderkey", F.lit("M").alias("status"), (F.col("part_year") + 1).alias("part_year"))
    for batch in (orders, moved):
        upsert_table(spark, path, batch, ["o_orderkey"], schema, ["part_year"], stamp_col=None)
    return read_stored(spark, path)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
} | GAME_QUERIES | STORAGE_QUERIES
