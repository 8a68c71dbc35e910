"""Streaming jobs: the log fan-out, the visitor facts, the change-log facts.

Sources give ``seq, value`` text streams (``sources.kafka``); sinks take
``route, value`` or ``value`` frames (``sinks.writers``). Every query needs a
``checkpointLocation`` under the shared checkpoint folder, so a restarted job
resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.operators import cdc, logs
from shoal.streaming.stateful import FIX_OUT, FixIsNewProcessor, by_device


def log_split_stream(raw: DataFrame, granularity: str = "day", history: DataFrame | None = None) -> DataFrame:
    """Log text stream -> ``route, mid, value, record_id`` rows for the six topics (dirty,
    error, start, display, action, page), with the new-visitor flag
    repaired by keyed state on the device id (NULL for dirty text). A new query starts
    from ``history`` (``visitors.first_visits``), if there is one."""
    clean, dirty = logs.split_dirty(raw, keep_text=True)
    # the original text travels through the state processor; only the control
    # columns are read from the parse here
    fixed = clean.select("mid", "seq", "ts", "is_new", "last_page_id", "value").groupBy("mid").transformWithState(
        FixIsNewProcessor(granularity), FIX_OUT, "Append", "None", initialState=by_device(history))
    again = logs.parse_log(fixed.select("seq", F.col("is_new").alias("flag"), "value"))
    routed = logs.route_log(again.withColumn("is_new", F.col("flag")))
    return routed.unionByName(dirty.select(F.lit("dirty").alias("route"), F.lit(None).cast("string").alias("mid"), "value",
                                           F.col("seq").cast("string").alias("record_id")))


def event_time(df: DataFrame, seconds_col: str = "ts", name: str = "event_time",
               delay: str = "5 seconds") -> DataFrame:
    """Event time from a seconds-since-epoch text column, with a watermark."""
    return df.withColumn(name, F.timestamp_seconds(F.col(seconds_col).cast("long"))) \
        .withWatermark(name, delay)


def stream_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str,
                left_time: str, right_time: str, bound: str = "5 seconds") -> DataFrame:
    """Equi-join of two streams, inner or outer. Both sides need a watermark
    on their time column; ``bound`` limits how far apart matching rows may
    be, which is what lets Spark drop join state (and emit the NULL side of
    an outer join once the watermark has passed)."""
    cond = ((left[left_key] == right[right_key])
            & right[right_time].between(left[left_time] - F.expr(f"INTERVAL {bound}"),
                                        left[left_time] + F.expr(f"INTERVAL {bound}")))
    return left.join(right, cond, {"full": "full_outer", "left": "left_outer",
                                   "right": "right_outer"}.get(how, how))


def foreach_batch_with(lookup: Callable[[], DataFrame],
                       build: Callable[[DataFrame, DataFrame], DataFrame],
                       write: Callable[[DataFrame, int], None]):
    """``foreachBatch`` body that joins each micro-batch with the lookup
    table as of that batch (``lookup`` may be a ``CachedDimension.get``)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(build(batch, lookup()), batch_id)
    return run


def cart_add_batch(changes: DataFrame, dic: DataFrame) -> DataFrame:
    return cdc.cart_add(cdc.filter_change_envelope(changes), dic)


# The branches of the order job are filters of one topic: the time that any of
# them has reached is the time all have reached, and with the least of them a
# change table that is silent would hold every row back for ever.
ORDER_STREAM_CONF = {"spark.sql.streaming.multipleWatermarkPolicy": "max"}


def order_joined_stream(changes: DataFrame, bound: str = "5 seconds", delay: str = "5 seconds") -> DataFrame:
    """Details of a change stream joined with their order and, where there are
    any, activity and coupon rows: detail ⋈ order ⟕ activity ⟕ coupon as
    stream-stream joins, each side with an event time from its ``ts`` (seconds)
    and a watermark, rows matching only within ``bound`` of the detail (this is
    what bounds the join state, as an idle-state retention does).

    Append mode: a left-joined detail is emitted once, after the watermark
    has passed its bound, with or without its activity / coupon. Start it with
    ``ORDER_STREAM_CONF`` set: time then advances with the branch that is furthest
    on, and a row more than ``delay`` behind it is late and may be dropped, as may
    an order record more than ``bound`` after its detail."""
    from shoal.operators.joins import activity_rows, coupon_rows, order_detail_rows, order_info_rows
    kept = cdc.filter_change_envelope(changes)
    od = event_time(order_detail_rows(kept), "od_ts", "od_time", delay)
    oi = event_time(order_info_rows(kept), "oi_ts", "oi_time", delay)
    act = event_time(activity_rows(kept, with_ts=True), "act_ts", "act_time", delay)
    cou = event_time(coupon_rows(kept, with_ts=True), "cou_ts", "cou_time", delay)
    j = stream_join(od, oi, "order_id", "oi_id", "inner", "od_time", "oi_time", bound)
    j = stream_join(j, act, "id", "act_detail_id", "left", "od_time", "act_time", bound)
    j = stream_join(j, cou, "id", "cou_detail_id", "left", "od_time", "cou_time", bound)
    return j.drop("od_time", "oi_time", "act_time", "cou_time")


def order_changes_stream(changes: DataFrame, idle_ms: int | None = 5000) -> DataFrame:
    """The order wide rows as a change stream: detail ⋈ order ⟕ activity ⟕ coupon.

    A detail comes out as soon as its order record is there, without activity and coupon
    if they are not, and is taken back when one comes. Rows that nothing meets for
    ``idle_ms`` of processing time are dropped (None: kept for ever); there is no
    watermark, so no record is late."""
    from shoal.operators.joins import activity_rows, coupon_rows, order_detail_rows, order_info_rows
    from shoal.streaming.changes import retracting_join
    kept = cdc.filter_change_envelope(changes)
    j = retracting_join(order_detail_rows(kept), order_info_rows(kept), "order_id", "oi_id", "inner", idle_ms)
    j = retracting_join(j, activity_rows(kept), "id", "act_detail_id", "left", idle_ms)
    return retracting_join(j, coupon_rows(kept), "id", "cou_detail_id", "left", idle_ms)


def order_wide_batch(joined: DataFrame, dic: DataFrame) -> DataFrame:
    """Wide rows of a micro-batch of joined details, the dictionary as of that batch."""
    from shoal.operators.joins import with_dictionary
    return with_dictionary(joined, dic)


def order_detail_batch(joined: DataFrame, dic: DataFrame) -> DataFrame:
    """Order-placed details of a micro-batch."""
    from shoal.operators.joins import order_placed
    return order_placed(order_wide_batch(joined, dic))


def dim_sink_batch(config: Callable[[], DataFrame], path: str, database: str | None = None,
                   tables: str | None = None, snapshot_every: int = 20):
    """``foreachBatch`` body of the dimension job.

    Each micro-batch is routed with the configuration current when the batch
    runs (``config`` re-reads it), and its entries are written under
    ``path/entries/batch=<id>/``. A replayed batch id overwrites its own folder only,
    so a restart after a failure writes each batch once. Every ``snapshot_every``
    batches the newest entry of each key and column is written to
    ``path/snapshots/upto=<id>/``; a read starts from the last whole snapshot, so it
    doesn't grow with the history. With ``database`` the configured tables are
    created (under ``tables``) when their configuration arrives, and filled at
    each snapshot and when a table is new."""
    from shoal.operators import dims
    from shoal.sinks.writers import read_dim_state, write_dim_batch, write_dim_snapshot

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        current = config()
        write_dim_batch(dims.route_dimensions(batch, current), path, batch_id)
        due = batch_id % snapshot_every == snapshot_every - 1
        if due:
            write_dim_snapshot(spark, path, batch_id)
        if database:
            before = {r[0] for r in spark.sql(f"SHOW TABLES IN `{database}`").select("tableName").toLocalIterator()} \
                if spark.catalog.databaseExists(database) else set()
            names = dims.ensure_dim_tables(spark, current, database, tables)
            if due or any(n.split(".")[1] not in before for n in names):
                dims.fill_dim_tables(spark, read_dim_state(spark, path), current, database)
    return run


def dim_store_batch(config: Callable[[], DataFrame], store):
    """``foreachBatch`` body of the dimension job on a ``DimStore``: a micro-batch, routed with the
    configuration as of now, writes only the buckets that its keys fall into."""
    from shoal.operators import dims

    def run(batch: DataFrame, batch_id: int) -> None:
        store.merge(dims.route_dimensions(batch, config()), batch_id)
    return run


def late_rows(progress: dict) -> int:
    """Rows that a micro-batch's stateful operators dropped as late (of ``query.recentProgress``).
    A chain of operators may count a row's pairs more than once; 0 means nothing was lost."""
    return sum(o.get("numRowsDroppedByWatermark", 0) for o in progress["stateOperators"])


def interval_join_stream(left: DataFrame, right: DataFrame, key: str, left_time: str,
                         right_time: str, lower_ms: int, upper_ms: int,
                         right_key: str | None = None) -> DataFrame:
    """Keyed interval join of two streams on event-time timestamp columns
    (each with a watermark): ``right_time`` in
    ``[left_time + lower, left_time + upper]``, both ends included. The bounds
    let Spark drop state older than the watermarks; rows later than the
    watermark are dropped, as the interval join drops late records."""
    rk = right_key or key
    lo = F.expr(f"INTERVAL {lower_ms / 1000:.3f} SECONDS")
    hi = F.expr(f"INTERVAL {upper_ms / 1000:.3f} SECONDS")
    cond = (left[key] == right[rk]) & right[right_time].between(left[left_time] + lo,
                                                                left[left_time] + hi)
    return left.join(right, cond, "inner")


def stop_when_idle(query, poll_seconds: float = 1.0, idle_polls: int = 3,
                   timeout_seconds: float | None = None) -> None:
    """Wait for a query to finish its input, then stop it.

    An ``availableNow`` query stops by itself, except when processing-time
    state expiry keeps scheduling batches (the unique-visitor TTL): then it is
    stopped once its progress reports show no input left.
    """
    import time
    start, idle = time.time(), 0
    while query.isActive:
        p = query.lastProgress
        idle = idle + 1 if (p and p["numInputRows"] == 0
                            and not query.status["isDataAvailable"]) else 0
        if idle >= idle_polls or (timeout_seconds and time.time() - start > timeout_seconds):
            query.stop()
            break
        time.sleep(poll_seconds)
