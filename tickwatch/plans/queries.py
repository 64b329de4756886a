"""The registered queries. Each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.operators import compare, distinct, markets, metrics, moves, quality, serving, sketches
from tickwatch.operators.ticks import metric_events, rename_long, to_json_value
from tickwatch.operators.ticks import publish_envelope as envelope
from tickwatch.operators.ticks import publish_rejects as rejected
from tickwatch.plans import views
from tickwatch.settings import as_table, run_dir
from tickwatch.sources import append, buckets, files
from tickwatch.streaming import clocks, jobs, ledger, panes, sinks, splits
from tickwatch.streaming.runner import (
    drop_late_at_once,
    dropped_late,
    open_state,
    run_available,
    run_until_closed,
    start_files,
    state_on_disk,
    wait_until_closed,
)

Query = Callable[[SparkSession, str], DataFrame]

HOUR = "1 hour"
WIDE = {"size": "6 hours", "slide": "1 hour"}


def _comparable(df: DataFrame) -> DataFrame:
    """Give results one form in every engine.

    Times lose their zone (it is UTC), decimals become text, and sums of products,
    whose last digits depend on the order of addition, are rounded.
    """
    columns = []
    for field in df.schema:
        column, kind = F.col(field.name), field.dataType.simpleString()
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind.startswith("decimal"):
            column = column.cast("string")
        elif field.name in ("total_trade_volume_krw", "trade_volume_krw"):
            column = F.round(column, 3)
        columns.append(column.alias(field.name))
    return df.select(*columns)


# Ticks ----------------------------------------------------------------------


def tick_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_events(views.ticks(spark, sf_dir)).drop("ingest_time", "seq")


def tick_parse_by_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_events(views.ticks(spark, sf_dir), rules="market").drop("ingest_time", "seq")


def tick_rename_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(rename_long(views.short_named_ticks(spark, sf_dir)))


def publish_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(views.ticks(spark, sf_dir))


def publish_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(views.ticks(spark, sf_dir)).select("tick_id", "value")


def publish_envelope_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(views.ticks(spark, sf_dir), key_fields=("code", "cd"))


def publish_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured ticks as messages, encoded anew, and what they hold when they are read again."""
    long = rename_long(views.short_named_ticks(spark, sf_dir))
    sent = to_json_value(long, ["tick_id", "code", "trade_price", "trade_volume", "stream_type", "market_state"])
    read = metric_events(sent.select("value", F.lit(None).cast("timestamp").alias("ingest_time")))
    texts = ("tick_id", "code", "trade_price", "stream_type", "market_state")
    fields = sent.select(*[F.get_json_object("value", f"$.{name}").alias(name) for name in texts])
    bad = read.agg(F.count_if(F.col("market").isNull()).alias("without_market")).first()[0]
    typed = {"tick_id": F.col("tick_id").cast("bigint"), "trade_price": F.col("trade_price").cast("double")}
    return fields.withColumns(typed).withColumn("without_market", F.lit(bad))


# Health ---------------------------------------------------------------------


def _health(spark: SparkSession, sf_dir: str, bucket: str) -> DataFrame:
    return metrics.health_metrics(metric_events(views.ticks(spark, sf_dir)), bucket)


def _market_health(spark: SparkSession, sf_dir: str, bucket: str) -> DataFrame:
    return metrics.market_metrics(metric_events(views.ticks(spark, sf_dir), rules="market"), bucket)


def health_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_health(spark, sf_dir, "1 second"))


def health_metrics_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_health(spark, sf_dir, HOUR))


def market_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_market_health(spark, sf_dir, "1 second"))


def market_metrics_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_market_health(spark, sf_dir, HOUR))


def health_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = clocks.with_ingest_clock(metric_events(views.tick_stream(spark, sf_dir)))
    return _comparable(run_available(metrics.health_metrics(events, HOUR), "health"))


def market_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = clocks.with_ingest_clock(metric_events(views.tick_stream(spark, sf_dir), rules="market"))
    return _comparable(run_available(metrics.market_metrics(events, HOUR), "market-health"))


def _arrivals(spark: SparkSession, sf_dir: str, rules: str) -> DataFrame:
    return metric_events(clocks.with_arrival_clock(views.lagging_stream(spark, sf_dir), jobs.ARRIVED), rules)


def health_stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all buckets of the health job add up to, though one of its files lags far behind."""
    health = metrics.health_metrics(_arrivals(spark, sf_dir, "global"), "1 second", jobs.ARRIVED)
    return _health_totals(run_until_closed(health, "health-totals"))


def _health_totals(health: DataFrame) -> DataFrame:
    return health.agg(
        F.sum("total_collected_count").alias("collected"),
        F.sum("total_error_count").alias("errors"),
        F.max("max_latency_ms").alias("max_latency_ms"),
        F.round(F.sum("total_trade_volume_krw"), 2).alias("trade_volume_krw"),
    )


def market_health_stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = metrics.market_metrics(_arrivals(spark, sf_dir, "market"), "1 second", jobs.ARRIVED)
    return _market_health_totals(run_until_closed(health, "market-totals"))


def _market_health_totals(health: DataFrame) -> DataFrame:
    return health.groupBy("market").agg(
        F.sum("collected_count").alias("collected"),
        F.sum("error_count").alias("errors"),
        F.max("max_latency_ms").alias("max_latency_ms"),
    )


def health_metrics_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``health_metrics_stream``, added batch by batch in inserts and read back."""
    events = clocks.with_ingest_clock(metric_events(views.tick_stream(spark, sf_dir)))
    health = metrics.health_metrics(events, HOUR)
    folder = run_dir(spark, "appended")
    append.start(health, f"{folder}/table", f"{folder}/checkpoint", append.HEALTH_INSERT, available_now=True).awaitTermination()
    return _comparable(ledger.read(spark, f"{folder}/table", health.schema))


def _timed(spark: SparkSession, sf_dir: str, start: Callable, label: str, empty: DataFrame) -> DataFrame:
    """What a health job with timers writes until all ticks are read and all its buckets closed."""
    folder = run_dir(spark, label)
    write = sinks.batch_folder(f"{folder}/rows")
    query = start(views.lagging_stream(spark, sf_dir), write, f"{folder}/checkpoint", every="1 second")
    wait_until_closed(query)
    return spark.read.schema(empty.schema).parquet(f"{folder}/rows")


def health_timer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all buckets that timers closed add up to; no row but the ticks goes through the job."""
    empty = metrics.health_metrics(metric_events(views.ticks(spark, sf_dir)))
    return _health_totals(_timed(spark, sf_dir, jobs.start_timed_health, "timed-health", empty))


def market_health_timer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = metrics.market_metrics(metric_events(views.ticks(spark, sf_dir), rules="market"))
    return _market_health_totals(_timed(spark, sf_dir, jobs.start_timed_market_health, "timed-markets", empty))


# Price moves ----------------------------------------------------------------


def price_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(moves.price_moves(views.ticks(spark, sf_dir)))


def price_moves_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(moves.price_moves(views.ticks(spark, sf_dir), **WIDE))


def price_moves_valid_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(moves.price_moves(views.ticks(spark, sf_dir), valid_only=True, **WIDE))


def price_moves_record_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(moves.price_moves(views.ticks(spark, sf_dir), record_time="ingest_time", **WIDE))


def move_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moves.move_rejects(views.ticks(spark, sf_dir))


def price_moves_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    moving = moves.price_moves(views.tick_stream(spark, sf_dir), delay="1 second", **WIDE)
    with drop_late_at_once(spark):
        return _comparable(run_available(moving, "moves"))


def price_moves_panes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moves of ``price_moves_stream`` from panes in state, the ticks read in several batches by time."""
    moving = panes.price_moves(views.ordered_stream(spark, sf_dir), **WIDE)
    with state_on_disk(spark):
        return _comparable(run_available(moving, "pane-moves"))


def price_moves_split_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moves over four folders with a watermark each, of which one lags far behind and loses nothing."""
    moving = splits.price_moves(views.split_streams(spark, sf_dir), **WIDE)
    with splits.least_watermark(spark), drop_late_at_once(spark):
        return _comparable(run_available(moving, "split-moves"))


def price_moves_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by market that a job closed, and those it holds open, after it was stopped and started again, and its late rows."""
    parts, folder = views.ordered_parts(spark, sf_dir, 4)
    checkpoint, out, late = f"{folder}/checkpoint", f"{folder}/rows", 0
    for landed in (parts[:2], parts[2:]):
        for part in landed:
            part.write.mode("append").parquet(f"{folder}/ticks")
        ticks = spark.readStream.schema(part.schema).parquet(f"{folder}/ticks")
        moving = moves.price_moves(ticks, delay="1 second", **WIDE)
        with drop_late_at_once(spark):
            query = start_files(moving, out, checkpoint, available_now=True)
        query.awaitTermination()
        late += dropped_late(query)
    closed = spark.read.schema(moving.schema).parquet(out).select("market_code", F.lit("closed").alias("state"))
    held = open_state(spark, checkpoint).select("key.market_code", F.lit("open").alias("state"))
    counts = closed.unionByName(held).groupBy("market_code", "state").agg(F.count("*").alias("windows"))
    return counts.withColumn("late_rows", F.lit(late))


def move_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moves.move_status_counts(moves.price_moves(views.ticks(spark, sf_dir), **WIDE))


def market_moves_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = moves.price_moves(views.ticks(spark, sf_dir), **WIDE)
    return _comparable(moves.known_market_moves(found, views.tick_markets(spark, sf_dir)))


# Quality --------------------------------------------------------------------


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.route(views.ticks(spark, sf_dir, full=True), views.tick_markets(spark, sf_dir))


def stored_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(quality.stored(_routed(spark, sf_dir), keep=("tick_id",)).drop("created_at"))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dead_letters(_routed(spark, sf_dir), keep=("tick_id",)).drop("created_at")


def skipped_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.skipped(_routed(spark, sf_dir), keep=("tick_id",))


def unstorable_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unstorable(_routed(spark, sf_dir), keep=("tick_id",))


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).groupBy(quality.outcome().alias("outcome")).agg(F.count("*").alias("ticks"))


def routed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks and load times of each outcome in a written table."""
    path = run_dir(spark, "routed")
    sinks.write_routed(_routed(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("outcome").agg(
        F.count("*").alias("ticks"), F.count_distinct("created_at").alias("load_times")
    )


def routed_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of each outcome in a table of many small batches, one of them run twice, after they were put together."""
    path, markets = run_dir(spark, "compacted"), views.tick_markets(spark, sf_dir)
    parts = 8
    rows = views.ticks(spark, sf_dir, full=True).withColumn("part", F.col("tick_id") % parts)
    for part in [*range(parts), 2]:
        write = sinks.routed_table(lambda: markets, path)
        write(rows.where(F.col("part") == part).select("value"), part)
    before = len(ledger.Ledger(path).entries())
    ledger.compact(spark, path, partition_by=["outcome"])
    after = len(ledger.Ledger(path).entries())
    counts = ledger.read(spark, path).groupBy("outcome").agg(F.count("*").alias("ticks"))
    return counts.withColumns({"batches": F.lit(before), "compacted": F.lit(after)})


def dead_letter_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dead_letter_collapse(views.wide_dead_letters(spark, sf_dir))


# Markets --------------------------------------------------------------------


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.sync_changes(views.existing_markets(spark, sf_dir), views.market_feed(spark, sf_dir))


def market_feed_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.flatten_feed(views.market_feed(spark, sf_dir))


def market_sync_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.sync_snapshot(views.existing_markets(spark, sf_dir), views.market_feed(spark, sf_dir))


def market_sync_keep_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.sync_snapshot(
        views.existing_markets(spark, sf_dir), views.market_feed(spark, sf_dir), reactivate=False
    )


def market_sync_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.sync_report(_changes(spark, sf_dir))


def market_listing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.listing_report(_changes(spark, sf_dir))


def market_new_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.new_listings(views.existing_markets(spark, sf_dir), views.market_feed(spark, sf_dir))


def market_delistings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.delistings(views.existing_markets(spark, sf_dir), views.market_feed(spark, sf_dir))


def market_sync_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of ``market_sync_snapshot`` from a written market table and a reply in a file."""
    folder, feed = run_dir(spark, "markets"), views.landed_feed(spark, sf_dir)
    path = files.write_markets(views.existing_markets(spark, sf_dir), folder, "1")
    path, _ = jobs.sync_markets(spark, path, feed, folder, "2")
    return files.read_markets(spark, path)


def market_sync_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of ``market_sync_snapshot`` from a table in buckets."""
    store = buckets.MarketStore(spark, run_dir(spark, "markets"))
    store.write(views.existing_markets(spark, sf_dir), {})
    store.sync(views.market_feed(spark, sf_dir))
    return store.read()


def market_sync_one_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of 64 buckets a second reply rewrites that names one market differently, and the names after it."""
    feed = views.market_feed(spark, sf_dir)
    store = buckets.MarketStore(spark, run_dir(spark, "markets"))
    store.write(views.existing_markets(spark, sf_dir), {})
    store.sync(feed)
    changed = F.when(F.col("market") == "S-1", F.lit("renamed")).otherwise(F.col("korean_name"))
    rewritten = [len(store.sync(feed)), len(store.sync(feed.withColumn("korean_name", changed)))]
    names = store.read().agg(F.count_if(F.col("korean_name") == "renamed").alias("renamed"), F.count("*").alias("markets"))
    return names.withColumns({"without_change": F.lit(rewritten[0]), "with_one": F.lit(rewritten[1])})


def market_changes_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of ``market_listing_report``, compared by digests of ranges."""
    active = views.existing_markets(spark, sf_dir).where("is_active")
    new, gone = compare.only_in(views.market_feed(spark, sf_dir), active)
    listing = [F.lit("new").alias("listing"), "market"], [F.lit("delisted").alias("listing"), "market"]
    return new.select(*listing[0]).unionByName(gone.select(*listing[1]))


# Serving --------------------------------------------------------------------


def latest_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(serving.latest(_health(spark, sf_dir, HOUR)))


def recent_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(serving.recent(_health(spark, sf_dir, HOUR)))


def market_metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(serving.market_history(_market_health(spark, sf_dir, HOUR)))


def _stored_by_day(spark: SparkSession, metric_rows: DataFrame, label: str) -> str:
    path = run_dir(spark, label)
    sinks.write_by_day(metric_rows, path, 0)
    return path


def latest_metric_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(serving.stored_latest(spark, _stored_by_day(spark, _health(spark, sf_dir, HOUR), "daily")))


def recent_metrics_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(serving.stored_recent(spark, _stored_by_day(spark, _health(spark, sf_dir, HOUR), "daily")))


def market_history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_by_day(spark, _market_health(spark, sf_dir, HOUR), "market-daily")
    return _comparable(serving.stored_market_history(spark, path, "MKT-VIEW", "2024-01-05", "2024-01-20"))


def recent_response_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = serving.recent_response(_health(spark, sf_dir, HOUR))
    return body.select(
        F.get_json_object("body", "$.count").cast("bigint").alias("count"),
        F.json_array_length(F.get_json_object("body", "$.results")).cast("bigint").alias("results"),
    )


def latest_response_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_response(_health(spark, sf_dir, HOUR).where("total_collected_count < 0"))


def experiment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = serving.experiment_summary(as_table(_health(spark, sf_dir, "1 second"), "health"))
    means = ("mean_throughput", "mean_latency_ms", "p95_latency_ms", "error_rate_percentage")
    return summary.withColumns({name: F.round(name, 6) for name in means})


def experiment_summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary from hourly figures, and whether its percentile is within the sketch's bound of the exact one."""
    seconds = as_table(_health(spark, sf_dir, "1 second"), "health")
    hourly = as_table(sketches.span_figures(seconds), "hourly")
    found = sketches.summary(hourly).first()
    error, p95 = sketches.rank_error(), found["p95_latency_ms"]
    # How many rows lie below the percentile found, and how many not above it.
    ranks = seconds.agg(
        F.avg((F.col("average_latency_ms") < p95).cast("double")).alias("below"),
        F.avg((F.col("average_latency_ms") <= p95).cast("double")).alias("upto"),
    )
    names = ("samples", "mean_throughput", "max_throughput", "mean_latency_ms", "max_latency_ms", "error_rate_percentage")
    exact = {name: F.lit(round(found[name], 6) if isinstance(found[name], float) else found[name]) for name in names}
    within = (F.col("below") <= 0.95 + error) & (F.col("upto") >= 0.95 - error)
    return ranks.select(*[value.alias(name) for name, value in exact.items()], within.alias("p95_within_bound"))


def distinct_markets_rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct markets of hours and days, from the bitmaps of seconds."""
    events = metric_events(views.ticks(spark, sf_dir))
    numbers = distinct.numbered(events.select("market"))
    hours = as_table(distinct.rolled_up(distinct.market_bitmaps(events, numbers), HOUR), "hours")
    found = [
        distinct.distinct_counts(bitmaps).withColumn("time_unit", F.lit(unit))
        for unit, bitmaps in (("1h", hours), ("1d", distinct.rolled_up(hours, "1 day")))
    ]
    return _comparable(found[0].unionByName(found[1]))


# Streams without state ------------------------------------------------------


def monotone_watermark_echo(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = clocks.with_event_clock(views.tick_stream(spark, sf_dir), clocks.MONOTONE, "ingest_time")
    return _comparable(run_available(stream.drop("seq"), "echo"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        tick_parse,
        tick_parse_by_market,
        tick_rename_long,
        publish_envelope,
        publish_envelope_by_code,
        publish_rejects,
        publish_encoded,
        health_metrics,
        health_metrics_hourly,
        health_metrics_stream,
        market_metrics,
        market_metrics_hourly,
        market_metrics_stream,
        health_metrics_appended,
        health_stream_totals,
        market_health_stream_totals,
        health_timer_totals,
        market_health_timer_totals,
        price_moves,
        price_moves_wide,
        price_moves_valid_only,
        price_moves_record_time,
        price_moves_stream,
        price_moves_panes_stream,
        price_moves_split_stream,
        price_moves_restarted,
        move_rejects,
        move_status_counts,
        market_moves_referential,
        stored_ticks,
        dead_letters,
        skipped_ticks,
        unstorable_ticks,
        outcome_counts,
        routed_table,
        routed_compacted,
        dead_letter_collapse,
        market_feed_flat,
        market_sync_snapshot,
        market_sync_keep_active,
        market_sync_report,
        market_listing_report,
        market_new_listings,
        market_delistings,
        market_sync_landed,
        market_sync_buckets,
        market_sync_one_change,
        market_changes_by_digest,
        latest_metric,
        recent_metrics,
        market_metric_history,
        latest_metric_stored,
        recent_metrics_stored,
        market_history_stored,
        recent_response_count,
        latest_response_empty,
        experiment_summary,
        experiment_summary_merged,
        distinct_markets_rolled_up,
        monotone_watermark_echo,
    )
}
