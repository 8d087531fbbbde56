"""The registered queries: (spark, folder of the tables) -> DataFrame.

Streaming queries drain the whole input into a fresh folder under the shared root
and return the table they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from streamweir.functions.codec import decode_messages, encode_messages, faults, undecodable
from streamweir.functions.timing import time_bucket
from streamweir.operators import aggregate, bags, joins, skew
from streamweir.plans import inputs
from streamweir.plans.datasets import DatasetFlow
from streamweir.schemas import (
    BRONZE_CLICK, BRONZE_IMPRESSION, CDC, CLICK_LONG, IMPRESSION_LONG,
)
from streamweir.session import new_run_dir, qualified, tune
from streamweir.sources import generate
from streamweir.sources.shards import land_shards, read_shards
from streamweir.sources.streams import rate_per_batch, read_messages
from streamweir.sources.tables import read_table, select_from_path
from streamweir.streaming import stateful
from streamweir.streaming.delivery import (
    DELIVERED, MAX_BYTES, MAX_RECORDS, FolderTransport, RefusingTransport, export_stream, pack_requests,
    read_delivered, read_receipts,
)
from streamweir.streaming.incremental import IncrementalLeftJoin
from streamweir.streaming.merged import MergedSink, read_merged
from streamweir.streaming.message_sink import export_committed, read_committed
from streamweir.streaming.run import drain, drain_to_table, run_stream, run_until_idle, state_partitions_for
from streamweir.streaming.sinks import ReplaceSink, append_table, ensure_table, read_replaced
from streamweir.streaming.state import read_state
from streamweir.streaming.static_join import RefreshedStaticJoin

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

# Parameters fitted to tables that span 30 days.
WINDOW = "1 hour"
SLIDE = "30 minutes"
AGG_DELAY = "20 minutes"
GROUPS = 4
HORIZON = timedelta(hours=6)
IMPRESSION_DELAY = "10 seconds"
CLICK_DELAY = "20 seconds"
SEED = 7
WINDOW_KEYS = ["window_start", "window_end", "group"]

# The parameters of a live stream.
LIVE_WINDOW = "10 seconds"
LIVE_AGG_DELAY = "20 seconds"
LIVE_GROUPS = 2000
LIVE_HORIZON = timedelta(minutes=1)
LIVE_SLIDE = "5 seconds"
LIVE_APPEND_DELAY = "20 minutes"
REPLAY_BATCHES = 10
SHARDS = 8
FETCH = 1000
FETCHES = 100
REFUSED_DIGITS = "3b"
REFUSALS = 2


def query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return inputs.without_zone(make(tune(spark), sf_dir.rstrip("/")))

    REGISTERED[make.__name__] = run
    return make


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _feed(
    spark: SparkSession, sf_dir: str, parts: int, order: list[int], landing: str,
    step: Callable[[DataFrame], object],
) -> None:
    """Land the events one slice of time after the other; ``step`` drains the stream in between."""
    source = inputs.raw_events(spark, sf_dir)
    slices = inputs.time_slices(source, parts)
    ensure_table(spark, landing, source.schema)
    for number in order:
        append_table(slices[number], landing)
        step(inputs.landed_event_stream(spark, landing, source))


def _drained(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The table that a watermarked query over all events has written.

    All events are one micro-batch unless ``spark.streamweir.backlogSlices`` asks for more:
    a large backlog then arrives in time order, so that the state is that of one slice. The
    result is the same.
    """
    root = new_run_dir(spark, name)
    slices = int(spark.conf.get("spark.streamweir.backlogSlices", "1"))
    if slices == 1:
        return drain_to_table(build(inputs.event_stream(spark, sf_dir, limits=False)), root)
    _feed(
        spark, sf_dir, slices, list(range(slices)), f"{root}/landing",
        lambda stream: drain_to_table(build(stream), root),
    )
    return read_table(spark, f"{root}/data")


# Sources


@query
def scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")

    by_path = select_from_path(spark, f"{sf_dir}/lineitem.parquet")
    return bags.bag_union(
        counted(by_path, "lineitem"),
        *[counted(read_table(spark, f"{sf_dir}/{t}.parquet"), t) for t in ("events", "orders")],
    )


@query
def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drain_to_table(inputs.raw_event_stream(spark, sf_dir), new_run_dir(spark, "stream_scan"))


def _numbered(df: DataFrame, key: str, root: str) -> DataFrame:
    """``number`` from 0 without gaps in the order of the key: rows before in earlier ranges, and place in the own one.

    Ranges are cut by sampling and written, so that their numbers are counted over what is then read.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(_cores(spark), F.col(key).asc_nulls_last())
    append_table(ranged.withColumn("part", F.spark_partition_id()), f"{root}/ranges")
    rows = read_table(spark, f"{root}/ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    starts = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col(key).asc_nulls_last())) - 1
    return rows.withColumn("place", place).join(starts, "part").withColumn("number", F.col("start") + F.col("place")).drop("part", "place", "start")


def _paced(ticks: DataFrame, stored: DataFrame, batch: int) -> DataFrame:
    """The rows of one batch with the time of their ticks; only that batch's folder is read."""
    return ticks.join(stored.where(F.col("batch") == batch), F.col("value") == F.col("number")).select(
        "event_id", "user_id", "event_type", F.col("timestamp").alias("replayed_at")
    )


@query
def rate_micro_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event at the pace of the rate source: tick n is the event that n others come before.

    The source makes a tenth of the ticks per batch, one second after the batch before; a run takes one
    batch, so one checkpoint is drained until all events have had their tick. The numbered events are stored by batch.
    """
    root = new_run_dir(spark, "rate_micro_batch")
    numbered = _numbered(inputs.events(spark, sf_dir).select("event_id", "user_id", "event_type"), "event_id", root)
    per_batch = -(-read_table(spark, f"{root}/ranges").count() // REPLAY_BATCHES)
    ensure_table(spark, f"{root}/data", "event_id LONG, user_id LONG, event_type STRING, replayed_at TIMESTAMP")
    if per_batch:
        append_table(numbered.withColumn("batch", F.floor(F.col("number") / per_batch).cast("int")), f"{root}/stored", by=["batch"])
        stored = read_table(spark, f"{root}/stored")
        for batch in range(REPLAY_BATCHES):
            ticks = rate_per_batch(spark, per_batch, start_ms=100, advance_ms=1000, partitions=max(10, _cores(spark)))
            drain_to_table(_paced(ticks, stored, batch), root)
    return read_table(spark, f"{root}/data")


# Generators: one generated row per stored row


def _row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt out before the rows are made, while they are only a number each."""
    rows = read_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey")
    return rows.repartition(max(10, _cores(spark)))


@query
def gen_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _row_numbers(spark, sf_dir)
    made = generate.cdc_table(
        rows, "Table1", "o_orderkey", SEED, generate.random_time(F.col("o_orderkey"), SEED)
    )
    path = new_run_dir(spark, "gen_cdc")
    append_table(made, path, by=["table"])
    return spark.read.schema(made.schema).parquet(path)  # without rows there is no file to take it from


@query
def gen_cdc_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _row_numbers(spark, sf_dir)
    made = generate.cdc_table(
        rows, "Table2", "o_orderkey", SEED, generate.random_time(F.col("o_orderkey"), SEED)
    )
    path = new_run_dir(spark, "gen_cdc_wide")
    append_table(made, path)
    return read_table(spark, path)


@query
def gen_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = inputs.event_stream(spark, sf_dir).selectExpr("ts AS timestamp", "event_id AS value")
    shown = generate.impressions(ticks).selectExpr("adId", "impressionTime AS at", "'impression' AS kind")
    clicked = generate.clicks(ticks, SEED).selectExpr("adId", "clickTime AS at", "'click' AS kind")
    return drain_to_table(bags.bag_union(shown, clicked), new_run_dir(spark, "gen_ads"))


# Messages


def _land(spark: SparkSession, df: DataFrame, key: str, time: str, name: str) -> str:
    """A folder of message envelopes, each taken in one second after its event."""
    envelopes = encode_messages(df, key, **{
        "approximateArrivalTimestamp": F.col(time) + F.expr("interval 1 second")
    })
    path = new_run_dir(spark, name)
    append_table(envelopes, path)
    return path


@query
def msg_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = encode_messages(inputs.cdc(inputs.events(spark, sf_dir)), "id")
    read = sent.select(
        "partitionKey",
        F.col("data").cast("string").alias("payload"),
        F.from_json(F.col("data").cast("string"), CDC).alias("row"),
    )
    return read.select("partitionKey", "payload", "row.*")


@query
def msg_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _land(spark, inputs.cdc(inputs.events(spark, sf_dir)), "id", "ts", "messages_cdc")
    decoded = decode_messages(read_messages(spark, path), CDC, processing=None)
    return drain_to_table(decoded, new_run_dir(spark, "msg_decode"))


@query
def msg_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in shards by key, fetched a thousand at a time from each shard, up to a hundred times a micro-batch, until there are no more."""
    root = new_run_dir(spark, "msg_fetch")
    rows = inputs.cdc(inputs.events(spark, sf_dir))
    sent = encode_messages(rows, "id", approximateArrivalTimestamp=F.col("ts") + F.expr("interval 1 second"))
    land_shards(sent, f"{root}/topic", F.pmod(F.xxhash64("partitionKey"), F.lit(SHARDS)))
    decoded = decode_messages(read_shards(spark, f"{root}/topic", FETCH, FETCHES), CDC, processing=None)
    ensure_table(spark, f"{root}/data", decoded.schema)
    run_until_idle(decoded, path=f"{root}/data", checkpoint=f"{root}/checkpoint")
    return spark.read.schema(decoded.schema).parquet(f"{root}/data")


@query
def msg_undecodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads per table that are, and are not, readable as {"k": integer}."""
    props = inputs.events(spark, sf_dir).select(F.lit("events").alias("origin"), F.col("props").alias("text"))
    talk = read_table(spark, f"{sf_dir}/conversations.parquet").select(F.lit("conversations"), "text")
    bad = undecodable(F.col("text").cast("binary"), "k INT")
    return (
        props.union(talk.toDF("origin", "text"))
        .groupBy("origin")
        .agg(F.count("*").alias("n_messages"), F.count_if(bad).alias("n_undecodable"))
    )


@query
def msg_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the events as payloads of {"k": integer, "day": date}: what is wrong with how many."""
    payloads = {
        "props": F.col("props"),
        "some props": F.expr("IF(event_type = 'view', NULL, props)"),
        "type": F.col("event_type"),
        "user": F.col("user_id").cast("string"),
        "row": F.to_json(F.struct(F.col("event_type").alias("k"), F.to_date("ts").alias("day"))),
        "days": F.to_json(F.struct(F.col("user_id").alias("k"), F.col("event_type").alias("day"))),
        "other": F.to_json(F.struct("user_id")),
    }
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("origin"), c.cast("binary").alias("data")) for n, c in payloads.items()]))
    # parsing is most of the work: dealt out before there are seven payloads of a row
    rows = inputs.events(spark, sf_dir).select("event_type", "user_id", "ts", "props").repartition(max(10, 4 * _cores(spark)))
    found = rows.select(each.alias("m")).select("m.origin", faults(F.col("m.data"), "k INT, day DATE").alias("fault"))
    return found.groupBy("origin", "fault.reason", F.array_join("fault.fields", ",").alias("fields")).agg(F.count("*").alias("n_messages"))


@query
def bronze_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown, clicked = _bronze_tables(spark, sf_dir, "bronze_land")
    return bags.bag_union(
        shown.selectExpr("'impression' AS kind", "adId", "impressionTime AS at", "arrival_time"),
        clicked.selectExpr("'click' AS kind", "adId", "clickTime AS at", "click_arrival_time AS arrival_time"),
    )


@query
def bronze_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown, clicked = _bronze_tables(spark, sf_dir, "bronze_latency")
    landed = bags.bag_union(
        shown.select("arrival_time", "processing_time"),
        clicked.selectExpr("click_arrival_time AS arrival_time", "click_processing_time AS processing_time"),
    )
    in_order = F.col("arrival_time") <= F.col("processing_time")
    return landed.agg(F.count("*").alias("n_rows"), F.count_if(in_order).alias("n_in_order"))


def _bronze_tables(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    source = inputs.events(spark, sf_dir)
    root = new_run_dir(spark, name)
    landed_shown = _land(spark, inputs.impressions(source), "adId", "impressionTime", "messages_shown")
    landed_clicks = _land(spark, inputs.clicks(source, "adId"), "adId", "clickTime", "messages_clicks")
    shown = decode_messages(read_messages(spark, landed_shown), IMPRESSION_LONG)
    clicked = (
        decode_messages(read_messages(spark, landed_clicks), CLICK_LONG)
        .withColumnRenamed("arrival_time", "click_arrival_time")
        .withColumnRenamed("processing_time", "click_processing_time")
    )
    ensure_table(spark, f"{root}/shown/data", BRONZE_IMPRESSION)
    ensure_table(spark, f"{root}/clicks/data", BRONZE_CLICK)
    return drain_to_table(shown, f"{root}/shown"), drain_to_table(clicked, f"{root}/clicks")


# Aggregations


def _cdc_stream(spark: SparkSession, sf_dir: str, limits: bool = True) -> DataFrame:
    return inputs.cdc(inputs.event_stream(spark, sf_dir, limits))


def windowed(df: DataFrame, slide: str | None = None) -> DataFrame:
    group = aggregate.bucketed("id", GROUPS)
    return aggregate.flat_window(
        aggregate.windowed_sum(df, "ts", AGG_DELAY, WINDOW, group, "amount", slide)
    )


@query
def agg_global_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "agg_global_complete")
    total = aggregate.running_sum(_cdc_stream(spark, sf_dir), "amount")
    run_stream(total, mode="complete", checkpoint=f"{root}/checkpoint", each_batch=ReplaceSink(root))
    return read_replaced(spark, root)


@query
def agg_keyed_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "agg_keyed_complete")
    totals = aggregate.keyed_sum(_cdc_stream(spark, sf_dir), "id", "amount")
    run_stream(totals, mode="complete", checkpoint=f"{root}/checkpoint", each_batch=ReplaceSink(root))
    return read_replaced(spark, root)


@query
def state_keyed_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a sum without a watermark keeps for ever, read back from its checkpoint: a row per key it has ever seen."""
    root = new_run_dir(spark, "state_keyed_sums")
    totals = aggregate.keyed_sum(_cdc_stream(spark, sf_dir), "id", "amount")
    report = run_stream(totals, mode="complete", checkpoint=f"{root}/checkpoint", fmt="noop")
    if not report.batches:  # nothing came, nothing is kept
        return spark.createDataFrame([], totals.schema)
    return read_state(spark, f"{root}/checkpoint").select(F.col("key.id").alias("id"), F.col("value.sum").alias("sum"))


@query
def agg_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(spark, sf_dir, "agg_tumbling", lambda stream: windowed(inputs.cdc(stream)))


@query
def agg_tumbling_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the wire: decode messages, then ten-second windows over 2,000 groups."""
    path = _land(spark, inputs.cdc(inputs.events(spark, sf_dir)), "id", "ts", "messages_cdc")
    decoded = decode_messages(read_messages(spark, path, limits=False), CDC, arrival=None, processing=None)
    sums = aggregate.windowed_sum(
        decoded, "ts", LIVE_AGG_DELAY, LIVE_WINDOW, aggregate.bucketed("id", LIVE_GROUPS), "amount"
    )
    return drain_to_table(aggregate.flat_window(sums), new_run_dir(spark, "agg_tumbling_live"))


def _live_sums(spark: SparkSession, sf_dir: str, delay: str) -> DataFrame:
    group = aggregate.bucketed("id", LIVE_GROUPS)
    return aggregate.flat_window(
        aggregate.windowed_sum(_cdc_stream(spark, sf_dir, limits=False), "ts", delay, LIVE_WINDOW, group, "amount", LIVE_SLIDE)
    )


@query
def agg_sliding_update_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "agg_sliding_update_live")
    sums = _live_sums(spark, sf_dir, LIVE_AGG_DELAY)
    run_stream(sums, mode="update", checkpoint=f"{root}/checkpoint", each_batch=MergedSink(root, WINDOW_KEYS))
    return read_merged(spark, root, WINDOW_KEYS)


@query
def agg_sliding_append_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drain_to_table(_live_sums(spark, sf_dir, LIVE_APPEND_DELAY), new_run_dir(spark, "agg_sliding_append_live"))


@query
def agg_sliding_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "agg_sliding_update")
    sums = windowed(_cdc_stream(spark, sf_dir, limits=False), SLIDE)
    run_stream(sums, mode="update", checkpoint=f"{root}/checkpoint", each_batch=MergedSink(root, WINDOW_KEYS))
    return read_merged(spark, root, WINDOW_KEYS)


@query
def agg_sliding_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(spark, sf_dir, "agg_sliding_append", lambda stream: windowed(inputs.cdc(stream), SLIDE))


@query
def late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second quarter of the events comes after the third: the watermark has passed it."""
    root = new_run_dir(spark, "late_drop")
    _feed(
        spark, sf_dir, 4, [0, 2, 1, 3], f"{root}/landing",
        lambda stream: drain_to_table(windowed(inputs.cdc(stream)), root),
    )
    return read_table(spark, f"{root}/data")


# Joins


def _hot_ads(
    spark: SparkSession, sf_dir: str, root: str, horizon: timedelta | None = None
) -> DataFrame:
    """Hot ads among the stored events; with a horizon, those that are hot inside one of its buckets."""
    stored = inputs.events(spark, sf_dir).where("event_type IN ('view', 'click')")
    within = time_bucket(F.col("ts"), horizon) if horizon else None
    return skew.pinned_hot_keys(stored, "user_id", f"{root}/hot_keys", within=within)


def _hot_clicks(spark: SparkSession, sf_dir: str, root: str, horizon: timedelta) -> DataFrame | None:
    """Ads whose clicks are hot inside a bucket of the horizon; none if there are none, since they need a join of their own."""
    stored = inputs.events(spark, sf_dir).where("event_type = 'click'")
    hot = skew.pinned_hot_keys(stored, "user_id", f"{root}/hot_clicks", within=time_bucket(F.col("ts"), horizon))
    return None if hot.isEmpty() else hot


def _streamed_interval_join(
    spark: SparkSession, sf_dir: str, name: str, how: str, horizon: timedelta
) -> DataFrame:
    root = new_run_dir(spark, name)
    hot = _hot_ads(spark, sf_dir, root, horizon)
    hot_right = _hot_clicks(spark, sf_dir, root, horizon) if how == "left" else None

    def build(stream: DataFrame) -> DataFrame:
        return joins.interval_join(
            inputs.impressions(stream), inputs.clicks(stream), "adId", "clickAdId",
            "impressionTime", "clickTime", horizon, how, IMPRESSION_DELAY, CLICK_DELAY, hot=hot,
            hot_right=hot_right,
        )

    return _drained(spark, sf_dir, name, build).select("adId", "impressionTime", "clickTime")


@query
def join_interval_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_interval_join(spark, sf_dir, "join_interval_inner", "inner", HORIZON)


@query
def join_interval_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_interval_join(spark, sf_dir, "join_interval_left", "left", HORIZON)


@query
def join_interval_inner_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_interval_join(spark, sf_dir, "join_interval_inner_live", "inner", LIVE_HORIZON)


@query
def join_interval_left_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_interval_join(spark, sf_dir, "join_interval_left_live", "left", LIVE_HORIZON)


@query
def join_stream_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "join_stream_unbounded")
    stream = inputs.event_stream(spark, sf_dir)
    joined = joins.equi_join(inputs.shown_ads(stream), inputs.clicked_ads(stream, SEED), "adId", "clickAdId")
    return drain_to_table(joined, root).select("adId", "impressionTime", "clickTime")


@query
def join_stream_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "join_stream_static")
    joined = joins.interval_join(
        inputs.impressions(inputs.event_stream(spark, sf_dir)),
        inputs.clicks(inputs.events(spark, sf_dir)),
        "adId", "clickAdId", "impressionTime", "clickTime", HORIZON, left_delay=IMPRESSION_DELAY,
        hot=_hot_ads(spark, sf_dir, root, HORIZON),
    )
    return drain_to_table(joined, root).select("adId", "impressionTime", "clickTime")


@query
def join_static_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click table is filled after the query was planned, and is seen all the same."""
    root = new_run_dir(spark, "join_static_refreshed")
    step = RefreshedStaticJoin(
        f"{root}/clicks", f"{root}/out", ["clickAdId", "clickTime"],
        "adId", "clickAdId", "impressionTime", "clickTime", HORIZON,
    )
    shown = inputs.impressions(inputs.event_stream(spark, sf_dir))
    append_table(inputs.clicks(inputs.events(spark, sf_dir)), f"{root}/clicks")
    run_stream(shown, checkpoint=f"{root}/checkpoint", each_batch=step)
    schema = StructType([*shown.schema.fields, *inputs.clicks(inputs.events(spark, sf_dir)).schema.fields])
    return step.result(spark, schema).select("adId", "impressionTime", "clickTime")


def _ads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every event shows an ad of its own, and a tenth of the ads are clicked later: pairs grow with the rows."""
    source = inputs.events(spark, sf_dir)
    return inputs.shown_ads(source), inputs.clicked_ads(source, SEED)


@query
def join_batch_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.equi_join(*_ads(spark, sf_dir), "adId", "clickAdId")
    return joined.select("adId", "impressionTime", "clickTime")


@query
def join_batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views times clicks per user: the product is counted and never made."""
    source = inputs.events(spark, sf_dir)
    return joins.join_count(inputs.impressions(source), inputs.clicks(source), "adId", "clickAdId")


def _batch_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.equi_join(*_ads(spark, sf_dir), "adId", "clickAdId", "left")
    return joined.select("adId", "impressionTime", "clickTime")


@query
def join_batch_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_left(spark, sf_dir)


@query
def matched_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.matched_only(_batch_left(spark, sf_dir), "clickTime")


def _incremental(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = new_run_dir(spark, name)
    shown, clicked = _ads(spark, sf_dir)
    kept = IncrementalLeftJoin(spark, f"{root}/join", shown.schema, clicked.schema, ["adId"], ["clickAdId"])

    def step(stream: DataFrame) -> None:
        drain(kept.start(inputs.shown_ads(stream), inputs.clicked_ads(stream, SEED)))

    _feed(spark, sf_dir, 4, [2, 0, 3, 1], f"{root}/landing", step)
    return kept.result().select("adId", "impressionTime", "clickTime")


@query
def incremental_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, "incremental_left")


@query
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the batch join and the incremental one, and of their differences."""
    truth = _batch_left(spark, sf_dir)
    result = _incremental(spark, sf_dir, "reconcile")
    return bags.gaps(bags.tally(truth, result)).agg(*[
        F.coalesce(F.sum(name), F.lit(0)).alias(name)
        for name in ("n_truth", "n_result", "n_missing", "n_surplus")
    ])


@query
def reconcile_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored left join against a copy that lacks some ads and has others twice: found by sums of hashes."""
    root = new_run_dir(spark, "reconcile_hashed")
    joined = _batch_left(spark, sf_dir)
    append_table(joined, f"{root}/truth")
    copies = F.when(F.col("adId") % 1000 == 7, 0).when(F.col("adId") % 1000 == 13, 2).otherwise(1)
    truth = spark.read.schema(joined.schema).parquet(f"{root}/truth")
    append_table(truth.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("copy"), f"{root}/result")
    return bags.reconcile_hashed(truth, spark.read.schema(joined.schema).parquet(f"{root}/result"))


@query
def bag_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views per user and day that clicks do not match one for one, and the reverse."""
    source = inputs.events(spark, sf_dir)

    def days(kind: str) -> DataFrame:
        return source.where(F.col("event_type") == kind).select("user_id", F.to_date("ts").alias("day"))

    views, clicks = days("view"), days("click")
    return bags.bag_union(
        bags.bag_difference(views, clicks).withColumn("surplus_of", F.lit("view")),
        bags.bag_difference(clicks, views).withColumn("surplus_of", F.lit("click")),
    )


@query
def union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = inputs.event_stream(spark, sf_dir)
    both = bags.bag_union(
        inputs.impressions(stream).selectExpr("adId", "impressionTime AS eventTime", "'impression' AS kind"),
        inputs.clicks(stream, "adId").selectExpr("adId", "clickTime AS eventTime", "'click' AS kind"),
    )
    return drain_to_table(both, new_run_dir(spark, "union_streams"))


def _pairs_in_state(stream: DataFrame) -> DataFrame:
    union = stateful.tagged_union(
        inputs.impressions(stream), inputs.clicks(stream, "adId"), "adId", "impressionTime", "clickTime"
    )
    return stateful.stateful_join(union, "adId", buckets=16 * state_partitions_for(stream.sparkSession))


@query
def stateful_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs_in_state(inputs.event_stream(spark, sf_dir, limits=False))
    return drain_to_table(pairs, new_run_dir(spark, "stateful_join"))


@query
def stateful_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four drains: each moves the watermark past all state, so no pair spans two of them."""
    root = new_run_dir(spark, "stateful_timeout")
    _feed(
        spark, sf_dir, 4, [0, 1, 2, 3], f"{root}/landing",
        lambda stream: drain_to_table(_pairs_in_state(stream), root),
    )
    return read_table(spark, f"{root}/data")


# Named datasets


@query
def dataset_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = inputs.events(spark, sf_dir)
    landed_shown = _land(spark, inputs.impressions(source), "adId", "impressionTime", "messages_shown")
    landed_clicks = _land(spark, inputs.clicks(source, "adId"), "adId", "clickTime", "messages_clicks")
    root = new_run_dir(spark, "dataset_left_join")
    flow = DatasetFlow(spark, root)

    @flow.dataset
    def impressions_raw() -> DataFrame:
        return read_messages(spark, landed_shown)

    @flow.dataset
    def clicks_raw() -> DataFrame:
        return read_messages(spark, landed_clicks)

    @flow.dataset
    def impressions_bronze() -> DataFrame:
        return decode_messages(flow.read_stream("impressions_raw"), IMPRESSION_LONG)

    @flow.dataset
    def clicks_bronze() -> DataFrame:
        return decode_messages(
            flow.read_stream("clicks_raw"), CLICK_LONG, "clicks_arrival_time", "clicks_processing_time"
        )

    @flow.dataset
    def impressions_with_clicks() -> DataFrame:
        return joins.interval_join(
            flow.read_stream("impressions_bronze", limits=False).withColumnRenamed("adId", "impressionAdId"),
            flow.read_stream("clicks_bronze", limits=False).withColumnRenamed("adId", "clickAdId"),
            "impressionAdId", "clickAdId", "impressionTime", "clickTime", HORIZON, "left",
            IMPRESSION_DELAY, CLICK_DELAY, hot=_hot_ads(spark, sf_dir, root, HORIZON),
            hot_right=_hot_clicks(spark, sf_dir, root, HORIZON),
        )

    return flow.refresh("impressions_with_clicks").drop("processing_time", "clicks_processing_time")


# Delivery


@query
def sink_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests over a limit, and requests that the next one's first record would have fitted into: none of either."""
    messages = encode_messages(_cdc_stream(spark, sf_dir), "id")
    requests = drain_to_table(pack_requests(messages), new_run_dir(spark, "sink_batches"))
    too_many = F.col("n_records") > MAX_RECORDS
    too_large = (F.col("n_bytes") > MAX_BYTES) & (F.col("n_records") > 1)
    first = F.octet_length(F.col("records")[0]["data"])
    following = F.lead(first).over(Window.partitionBy("batch", "partition").orderBy("request_no"))
    requests = requests.select("n_records", "n_bytes", following.alias("next_bytes"))
    loose = (F.col("n_records") < MAX_RECORDS) & (F.col("n_bytes") + F.col("next_bytes") <= MAX_BYTES)
    return requests.agg(
        F.sum("n_records").alias("n_records"),
        F.sum("n_bytes").alias("n_bytes"),
        F.count_if(too_many | too_large).alias("n_over_limit"),
        F.count_if(loose).alias("n_loose"),
    )


@query
def export_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables exported side by side."""
    root = new_run_dir(spark, "export_messages")
    stream = inputs.event_stream(spark, sf_dir)
    tables = {"impressions": inputs.impressions(stream), "clicks": inputs.clicks(stream, "adId")}
    drain(*[
        export_committed(
            df, "adId", FolderTransport(qualified(spark, f"{root}/{name}/messages")), f"{root}/{name}/checkpoint",
            f"{root}/{name}/manifests", partitions=_cores(spark), name=name,
        )
        for name, df in tables.items()
    ])
    return bags.bag_union(*[
        read_committed(spark, f"{root}/{name}/messages", f"{root}/{name}/manifests").select(
            F.lit(name).alias("topic"), "partitionKey", F.col("data").cast("string").alias("payload")
        )
        for name in tables
    ])


@query
def export_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was delivered, and what the receipts say."""
    root = new_run_dir(spark, "export_receipts")
    transport = FolderTransport(f"{root}/messages")
    drain(export_stream(
        _cdc_stream(spark, sf_dir), "id", transport, f"{root}/checkpoint", receipts=f"{root}/receipts"
    ))
    said = read_receipts(spark, f"{root}/receipts").select(
        F.lit("receipts").alias("origin"), F.col("n_records").cast("long"), "n_bytes"
    )
    delivered = read_delivered(spark, f"{root}/messages", f"{root}/receipts").select(
        F.lit("messages").alias("origin"), F.lit(1).cast("long").alias("n_records"),
        F.octet_length("data").cast("long").alias("n_bytes"),
    )
    return said.unionByName(delivered).groupBy("origin").agg(
        F.sum("n_records").alias("n_records"), F.sum("n_bytes").alias("n_bytes")
    )


@query
def export_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transport that twice refuses the records of two digits: what arrived, and what was sent for it, per digit."""
    root = new_run_dir(spark, "export_retries")
    transport = RefusingTransport(f"{root}/messages", REFUSED_DIGITS, REFUSALS)
    drain(export_stream(
        _cdc_stream(spark, sf_dir), "id", transport, f"{root}/checkpoint", receipts=f"{root}/receipts", base_ms=1
    ))
    sent = read_delivered(spark, f"{root}/messages", f"{root}/receipts", f"{DELIVERED}, tries INT")
    return sent.groupBy(F.substring(F.md5("data"), 32, 1).alias("digit")).agg(
        F.count("*").alias("n_delivered"), F.count_distinct("data").alias("n_payloads"),
        F.sum(F.col("tries") - 1).alias("n_refused"),
    )
