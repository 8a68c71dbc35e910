"""Run the warehouse jobs as streaming queries.

    python -m shoal <job> --source <dir | kafka:servers> --sink <dir | kafka:servers>
                    --checkpoint <dir> [--once] [job options]

Jobs (one per flow of the warehouse):

  log-split          log text -> dirty / error / start / display / action / page
  unique-visitor     page log -> first entry page per device and visit date
  user-jump          page log -> bounced visits (match / timeout)
  dim                change records + configuration (--config dir) -> dimension entries and tables
  cart-add           change records + dictionary (--dictionary dir) -> cart additions
  order-pre-process  change records + dictionary -> order wide table
  order-detail       change records + dictionary -> order-placed details

A folder source is the file form of a topic: JSON lines ``{"seq": n, "value":
"<text>"}``. ``--once`` processes what is there and stops (availableNow).
The checkpoint folder must be shared storage on a cluster; a restarted job
resumes from it. Master, memory and shuffle partitions are the launcher's
(spark-submit); for a streaming query the number of shuffle partitions is fixed
in its checkpoint when it first starts.

``--source-option`` / ``--dictionary-option name=value`` go to the readers as they
are (startingOffsets, kafka.security.protocol, user, password, driver ...).
A value ``env:NAME`` is read from the environment, so that no password need stand on
a command line. ``--per-trigger`` bounds a micro-batch (Kafka offsets, or files);
what is beyond it waits for the next one.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Topic names (input, output) of each job, so the jobs can take
# over the existing topics.
TOPICS = {
    "log-split": ("topic_log", None),
    "unique-visitor": ("dwd_traffic_page_log", "dwd_traffic_unique_visitor_detail"),
    "user-jump": ("dwd_traffic_page_log", "dwd_traffic_user_jump_detail"),
    "dim": ("topic_db", None),
    "cart-add": ("topic_db", "dwd_trade_cart_add"),
    "order-pre-process": ("topic_db", "dwd_trade_order_pre_process"),
    "order-detail": ("topic_db", "dwd_trade_order_detail"),
}
# Records (Kafka) or files (folders) of a micro-batch, unless --per-trigger says otherwise.
KAFKA_PER_TRIGGER, FILES_PER_TRIGGER = 5_000_000, 100


def _options(pairs: list[str] | None) -> dict[str, str]:
    out = {}
    for pair in pairs or []:
        name, eq, value = pair.partition("=")
        if not eq:
            raise SystemExit(f"expected name=value, got {pair!r}")
        out[name] = os.environ[value[4:]] if value.startswith("env:") else value
    return out


def _source(spark: SparkSession, args, topic: str) -> DataFrame:
    from shoal.sources.kafka import read_kafka_text, read_text_stream
    given = _options(args.source_option)
    if args.source.startswith("kafka:"):
        given.setdefault("maxOffsetsPerTrigger", str(args.per_trigger or KAFKA_PER_TRIGGER))
        return read_kafka_text(spark, args.source[len("kafka:"):], args.source_topic or topic,
                               given.pop("startingOffsets", "earliest"), **given)
    return read_text_stream(spark, args.source, args.per_trigger or FILES_PER_TRIGGER, **given)


def _trigger(writer, args):
    return writer.trigger(availableNow=True) if args.once else writer


def _write_values(df: DataFrame, args, topic: str | None):
    """``value`` text to Kafka, or JSON lines to a folder."""
    from shoal.sinks.writers import write_kafka_stream
    if args.sink.startswith("kafka:"):
        return write_kafka_stream(df, args.sink[len("kafka:"):], args.checkpoint, args.sink_topic or topic,
                                  {"availableNow": True} if args.once else None)
    w = (df.select("value").writeStream.format("text").option("path", args.sink)
         .option("checkpointLocation", args.checkpoint))
    return _trigger(w, args).start()


def _beside(rows: DataFrame, args) -> None:
    """What the job can't use, written by a second query to the ``--dirty`` folder."""
    if args.dirty:
        w = rows.writeStream.format("text").option("path", args.dirty) \
            .option("checkpointLocation", args.checkpoint.rstrip("/") + "-dirty").queryName(f"{args.job}-dirty")
        _trigger(w, args).start()


def _history(spark: SparkSession, args) -> DataFrame | None:
    """The devices' state after the ``--history`` folder's log text (the same form as the source)."""
    if not args.history:
        return None
    from shoal.operators import logs, visitors
    clean, _ = logs.split_dirty(spark.read.schema("seq long, value string").json(args.history))
    make = visitors.last_visits if args.job == "unique-visitor" else visitors.first_visits
    return make(clean, args.granularity)


def _write_with_late(out: DataFrame, args, topic: str | None):
    """Facts to the sink and late records to the ``--late`` folder; a replayed batch id overwrites
    its own folders only (in a topic its records come again)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            facts = df.where(F.col("reason") != "late").select(F.col("mid").alias("key"), "value")
            if args.sink.startswith("kafka:"):
                facts.write.format("kafka").option("kafka.bootstrap.servers", args.sink[len("kafka:"):]) \
                    .option("topic", args.sink_topic or topic).save()
            else:
                facts.select("value").write.mode("overwrite").text(f"{args.sink}/batch={batch_id}")
            df.where(F.col("reason") == "late").select("value").write.mode("overwrite").text(f"{args.late}/batch={batch_id}")
        finally:
            df.unpersist()
    w = out.writeStream.foreachBatch(write).option("checkpointLocation", args.checkpoint)
    return _trigger(w, args).start()


def _upserts(df: DataFrame) -> DataFrame:
    """Records keyed by ``id``; of a change stream a key's records are in order, in one partition."""
    from shoal.sinks.writers import as_upsert_records
    if "op" not in df.columns:
        return as_upsert_records(df, ["id"])
    return as_upsert_records(df, ["id"], carry=["change"]).repartition("key").sortWithinPartitions("key", "change")


def _batch_writer(args, topic: str):
    """Write rows of a micro-batch keyed by ``id``; a replayed batch id overwrites only its own folder."""
    def write(df: DataFrame, batch_id: int) -> None:
        if args.sink.startswith("kafka:"):
            (_upserts(df).drop("change").write.format("kafka")
             .option("kafka.bootstrap.servers", args.sink[len("kafka:"):])
             .option("topic", args.sink_topic or topic).save())
            return
        if "op" in df.columns:
            df = _upserts(df)
        df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch").json(args.sink)
    return write


def _dictionary(spark: SparkSession, args):
    from shoal.sources.jdbc import CachedDimension
    from shoal.schemas import BASE_DIC
    path = args.dictionary

    def load():
        if path.startswith("jdbc:"):
            from shoal.sources.jdbc import read_jdbc_table
            return read_jdbc_table(spark, path, args.dictionary_table, **_options(args.dictionary_option))
        return spark.read.schema(BASE_DIC).options(**_options(args.dictionary_option)).json(path)
    return CachedDimension(load, ttl_seconds=args.dictionary_ttl)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m shoal", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=sorted(TOPICS))
    p.add_argument("--source", required=True)
    p.add_argument("--sink", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--once", action="store_true")
    p.add_argument("--source-topic", help="instead of the job's own input topic")
    p.add_argument("--sink-topic", help="instead of the job's own output topic")
    p.add_argument("--source-option", action="append", metavar="NAME=VALUE")
    p.add_argument("--per-trigger", type=int, help="most offsets (Kafka) or files of a micro-batch")
    p.add_argument("--granularity", default="day", choices=["day", "second"])
    p.add_argument("--dirty", help="folder for text that the visitor jobs can't place, or change records that are none")
    p.add_argument("--late", help="folder for records behind the watermark (user-jump)")
    p.add_argument("--history", help="folder of the log records before the source's (log-split, unique-visitor; new queries)")
    p.add_argument("--buckets", type=int, help="keep the dimension tables in this many buckets each, only touched ones written anew (dim)")
    p.add_argument("--config", help="folder of configuration change records (dim)")
    p.add_argument("--database", help="database of the dimension tables, created and filled by the job (dim)")
    p.add_argument("--tables", help="folder of the dimension tables (dim)")
    p.add_argument("--snapshot-every", type=int, default=20, help="batches between dimension snapshots")
    p.add_argument("--dictionary", help="folder of dictionary JSON rows, or a JDBC url")
    p.add_argument("--dictionary-table", default="base_dic")
    p.add_argument("--dictionary-option", action="append", metavar="NAME=VALUE")
    p.add_argument("--dictionary-ttl", type=float, default=3600.0, help="seconds until the dictionary is read again")
    p.add_argument("--bound", default="5 seconds", help="how far apart an order's records may be (order jobs)")
    p.add_argument("--delay", default="5 seconds", help="how late a record may come (order jobs)")
    p.add_argument("--retract", action="store_true",
                   help="order-pre-process: rows come out at once and are taken back (upserts and tombstones)")
    p.add_argument("--idle", type=float, default=5.0, help="with --retract: seconds until rows that nothing meets are dropped; 0: never")
    return p


def run(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = _parser().parse_args(argv)
    from shoal.session import job_session
    spark = spark or job_session(f"shoal-{args.job}")
    topic_in, topic_out = TOPICS[args.job]
    src = _source(spark, args, topic_in)

    if args.job == "log-split":
        from shoal.sinks.writers import with_record_headers, write_kafka_stream, write_routed_files
        from shoal.streaming.jobs import log_split_stream
        routed = log_split_stream(src, args.granularity, _history(spark, args))
        trigger = {"availableNow": True} if args.once else None
        if args.sink.startswith("kafka:"):
            topic = F.when(F.col("route") == "dirty", F.lit("dirty_data")) \
                .otherwise(F.concat(F.lit("dwd_traffic_"), F.col("route"), F.lit("_log")))
            # keyed by device, so that a device's records stay in order
            records = routed.select(topic.alias("topic"), F.col("mid").alias("key"), "value", "record_id")
            return write_kafka_stream(with_record_headers(records), args.sink[len("kafka:"):], args.checkpoint, trigger=trigger)
        return write_routed_files(routed, args.sink, args.checkpoint, trigger)

    if args.job in ("unique-visitor", "user-jump"):
        from shoal.operators import logs
        from shoal.streaming import stateful
        clean, dirty = logs.split_dirty(src, keep_text=True)
        _beside(dirty.select("value"), args)
        log = clean.drop("record")
        if args.job == "unique-visitor":
            out = stateful.unique_visitor_stream(log, args.granularity, history=_history(spark, args))
        else:
            out = stateful.user_jump_stream(log, keep_late=bool(args.late))
        if args.late:
            return _write_with_late(out, args, topic_out)
        return _write_values(out.select(F.col("mid").alias("key"), "value"), args, topic_out)

    from shoal.operators import cdc
    from shoal.streaming import jobs
    _beside(cdc.split_change_log(src)[1].select(F.to_json(F.struct("seq", "reason", "value")).alias("value")), args)
    judged = cdc.judge_change_log(src)
    if args.job in ("dim", "cart-add"):  # the order jobs read the records in four branches, which would count them four times
        judged = cdc.counted(judged, "change_log", cdc.UNREADABLE, cdc.NO_DATA, cdc.NO_TYPE, cdc.MARKER)
    changes = judged.where(F.col("reason").isNull()).drop("reason", "value")

    if args.job == "dim" and args.buckets:
        from shoal.sinks.dim_store import DimStore
        from shoal.sources.config import ConfigState
        state = ConfigState(spark, args.config, args.checkpoint.rstrip("/") + "-config")
        body = jobs.dim_store_batch(state.current, DimStore(spark, args.sink, args.buckets))
    elif args.job == "dim":
        from shoal.sources.config import read_config
        body = jobs.dim_sink_batch(lambda: read_config(spark, args.config), args.sink, args.database, args.tables,
                                   args.snapshot_every)
    else:
        dic = _dictionary(spark, args)
        build = {"cart-add": jobs.cart_add_batch, "order-pre-process": jobs.order_wide_batch,
                 "order-detail": jobs.order_detail_batch}[args.job]
        body = jobs.foreach_batch_with(dic.get, build, _batch_writer(args, topic_out))
        if args.retract:
            if args.job != "order-pre-process":
                raise SystemExit("--retract is an option of order-pre-process")
            changes = jobs.order_changes_stream(changes, int(args.idle * 1000) or None)
        elif args.job != "cart-add":
            for k, v in jobs.ORDER_STREAM_CONF.items():
                spark.conf.set(k, v)
            changes = jobs.order_joined_stream(changes, args.bound, args.delay)
    w = changes.writeStream.foreachBatch(body).option("checkpointLocation", args.checkpoint)
    return _trigger(w, args).start()


def main() -> None:
    q = run(sys.argv[1:])
    streams = SparkSession.active().streams
    if "--once" in sys.argv:
        from shoal.streaming.jobs import stop_when_idle
        stop_when_idle(q)
        for other in streams.active:  # the dirty text's query, too
            other.awaitTermination()
        streams.resetTerminated()
    else:
        streams.awaitAnyTermination()  # raises what ended a query


if __name__ == "__main__":
    main()
