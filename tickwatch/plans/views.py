"""Views over the test tables that stand in for the live inputs.

``events`` rows become ticks, rendered to JSON text so that the operators have to
decode them. A fault number per row breaks some of them in every known way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.schemas import CAUTION_FLAGS, SHORT_TO_LONG
from tickwatch.settings import run_dir
from tickwatch.sources.files import stream_table

# Fields of a short tick besides price and volume: (field, SQL over the clean tick).
SHORT_FIELDS = (
    ("code", "CASE WHEN fault IN (5, 6, 16) THEN NULL WHEN fault = 10 THEN 'MKT-NONE' ELSE code END"),
    ("market", "CASE WHEN fault IN (6, 16) THEN code END"),
    ("change", "CASE WHEN fault IN (7, 13) THEN 'UP' ELSE change END"),
    ("timestamp", "CASE WHEN fault <> 1 THEN event_ms END"),
    ("stream_type", "CASE WHEN fault IN (8, 13) THEN 'X' ELSE stream_type END"),
)

# The other fields of a full tick: constants and multiples of the price.
FULL_FIELDS = (
    ("type", "'ticker'"),
    ("opening_price", "price"),
    ("high_price", "price * 2"),
    ("low_price", "price * 0.5"),
    ("prev_closing_price", "price"),
    ("acc_trade_price", "price * 64"),
    ("change_price", "price * 0.5"),
    ("signed_change_price", "price * -0.5"),
    ("change_rate", "price"),
    ("signed_change_rate", "price * -1"),
    ("ask_bid", "'ASK'"),
    ("acc_trade_volume", "price * 4"),
    ("trade_date", "'20240101'"),
    ("trade_time", "'000000'"),
    ("trade_timestamp", "event_ms"),
    ("acc_ask_volume", "price"),
    ("acc_bid_volume", "price * 2"),
    ("highest_52_week_price", "price * 4"),
    ("highest_52_week_date", "'2024-01-01'"),
    ("lowest_52_week_price", "price * 0.5"),
    ("lowest_52_week_date", "'2024-01-01'"),
    ("market_state", "CASE WHEN fault = 14 THEN repeat('x', 41) ELSE 'ACTIVE' END"),
    ("is_trading_suspended", "false"),
    ("market_warning", "'NONE'"),
    ("acc_trade_price_24h", "price * 64"),
    ("acc_trade_volume_24h", "price * 8"),
)

PRICE_TOKEN = (
    "CASE fault WHEN 0 THEN '-1' WHEN 9 THEN '0' WHEN 11 THEN '\"abc\"' "
    "WHEN 4 THEN concat('\"', CAST(price AS {text}), '\"') ELSE CAST(price AS {text}) END"
)
VOLUME_TOKEN = "CASE fault WHEN 3 THEN 'null' WHEN 12 THEN '-2' ELSE CAST(volume AS {text}) END"
# A code that is no text and counts as false.
ZERO_CODE = """CASE WHEN fault = 16 THEN '"code":0,' ELSE '' END"""
MALFORMED_TEXT = "{not-valid-json"
# Two objects for a reader that puts the text into a list.
REOPENING_TEXT = '{"code":"A","trade_price":1,"trade_volume":1,"timestamp":1}],"x":[{}'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The test tables hold UTC wall-clock times.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_ticks(events: DataFrame) -> DataFrame:
    """``events`` as ticks, before any fault."""
    timed = events.withColumn("ms", F.expr("unix_millis(CAST(ts AS TIMESTAMP))"))
    return timed.selectExpr(
        "event_id AS tick_id",
        "concat('MKT-', upper(event_type)) AS code",
        # Every fifth tick falls on the hour, so that many share their time.
        "CASE WHEN event_id % 5 = 0 THEN ms - ms % 3600000 ELSE ms END AS event_ms",
        "1000 + value / 5 AS price",
        "CAST(1 + event_id % 7 AS DOUBLE) AS volume",
        "CASE event_id % 3 WHEN 0 THEN 'RISE' WHEN 1 THEN 'EVEN' ELSE 'FALL' END AS change",
        "CASE WHEN event_id % 10 = 0 THEN 'SNAPSHOT' ELSE 'REALTIME' END AS stream_type",
        "event_id % 40 AS fault",
    )


def tick_text(clean: DataFrame, full: bool = False) -> DataFrame:
    """Ticks as messages: arrival number, time of arrival, JSON text."""
    fields = SHORT_FIELDS + (FULL_FIELDS if full else ())
    rest = F.to_json(F.struct(*[F.expr(sql).alias(name) for name, sql in fields]))
    text = F.concat(
        F.lit('{"trade_price":'),
        F.expr(PRICE_TOKEN.format(text="STRING")),
        F.lit(',"trade_volume":'),
        F.expr(VOLUME_TOKEN.format(text="STRING")),
        F.lit(","),
        F.expr(ZERO_CODE),
        F.substr(rest, F.lit(2)),
    )
    text = F.when(F.col("fault") == 2, MALFORMED_TEXT).when(F.col("fault") == 15, REOPENING_TEXT).otherwise(text)
    return clean.select(
        "tick_id",
        F.col("tick_id").alias("seq"),
        F.timestamp_millis(F.expr("event_ms + (tick_id * 37) % 2500 - 100")).alias("ingest_time"),
        text.alias("value"),
    )


def ticks(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    return tick_text(clean_ticks(table(spark, sf_dir, "events")), full)


def tick_stream(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return tick_text(clean_ticks(stream_table(spark, sf_dir, "events")), full)


def quarter_of(spark: SparkSession, sf_dir: str) -> Column:
    """Which of four equal ranges of tick numbers a tick is in."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    return F.floor(F.col("tick_id") * 4 / (last + 1)).cast("int")


def ordered_parts(spark: SparkSession, sf_dir: str, parts: int) -> tuple[list[DataFrame], str]:
    """All ticks in parts of equal spans of event time, and a folder to land them in."""
    rows, part = _by_time(spark, sf_dir, parts)
    return [rows.where(part == number).drop("event_ms") for number in range(parts)], run_dir(spark, "landed")


def _in_parts(rows: DataFrame, parts: list[Column], label: str) -> DataFrame:
    """Rows as a stream that reads one part after the other; each is written by as many tasks as the rows have."""
    folder = run_dir(rows.sparkSession, label)
    tasks = 1 + (rows.select(F.spark_partition_id().alias("task")).agg(F.max("task")).first()[0] or 0)
    for part in parts:
        rows.where(part).repartition(tasks).write.mode("append").parquet(folder)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", tasks).parquet(folder)


def lagging_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks as a stream read by quarters, of which the third comes after the fourth."""
    quarter = quarter_of(spark, sf_dir)
    return _in_parts(ticks(spark, sf_dir), [quarter == number for number in (0, 1, 3, 2)], "lagging")


def ordered_stream(spark: SparkSession, sf_dir: str, parts: int = 4) -> DataFrame:
    """All ticks as a stream read in parts of equal spans of event time, so that none comes too late.

    Within an hour ticks are out of order, as those of the full hour come with the rest of theirs.
    """
    rows, part = _by_time(spark, sf_dir, parts)
    return _in_parts(rows, [part == number for number in range(parts)], "ordered").drop("event_ms")


def _by_time(spark: SparkSession, sf_dir: str, parts: int) -> tuple[DataFrame, Column]:
    """Ticks with their event time, and which of so many equal spans of whole hours they are in."""
    clean = clean_ticks(table(spark, sf_dir, "events"))
    ends = clean.agg(F.min("event_ms"), F.max("event_ms")).first()
    first, last = ((ms or 0) // 3600000 for ms in ends)
    rows = ticks(spark, sf_dir).join(clean.select("tick_id", "event_ms"), "tick_id")
    return rows, F.floor((F.floor(F.col("event_ms") / 3600000) - first) * parts / (last + 1 - first))


def split_streams(spark: SparkSession, sf_dir: str, splits: int = 4, parts: int = 4) -> list[DataFrame]:
    """All ticks in folders by tick number, each a stream; the last is read span by span and lags behind the others."""
    rows, part = _by_time(spark, sf_dir, parts)
    streams = []
    for number in range(splits):
        mine = rows.where(F.col("tick_id") % splits == number)
        spans = [part == span for span in range(parts)] if number == splits - 1 else [F.lit(True)]
        streams.append(_in_parts(mine, spans, f"split-{number}").drop("event_ms"))
    return streams


def tick_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The markets that tick."""
    codes = clean_ticks(table(spark, sf_dir, "events")).select(F.col("code").alias("market")).distinct()
    return codes.withColumn("is_active", F.col("market") != "MKT-SIGNUP")


def short_named_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean ticks in columns with the old short names."""
    values = dict(SHORT_FIELDS + FULL_FIELDS) | {
        "trade_price": "price",
        "trade_volume": "volume",
        "change": "change",
        "timestamp": "event_ms",
        "stream_type": "stream_type",
        "delisting_date": "CAST(NULL AS STRING)",
    }
    clean = clean_ticks(table(spark, sf_dir, "events"))
    return clean.select("tick_id", "code", *[F.expr(values[n]).alias(s) for s, n in SHORT_TO_LONG.items()])


def wide_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters in the old layout, one column per field."""
    clean = clean_ticks(table(spark, sf_dir, "events"))
    return clean.select(
        F.col("code").alias("market_code"),
        "tick_id",
        F.col("price").alias("trade_price"),
        F.expr("CASE WHEN fault <> 3 THEN volume END").alias("trade_volume"),
        "stream_type",
        F.expr("concat('fault ', CAST(fault AS STRING))").alias("error_log"),
    )


def existing_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market table: all parts and all customers."""
    no_flags = [F.lit(False).alias(flag) for flag in ("warning", *CAUTION_FLAGS)]
    part = table(spark, sf_dir, "part").select(
        F.expr("concat('P-', p_partkey)").alias("market"),
        F.col("p_name").alias("korean_name"),
        F.col("p_brand").alias("english_name"),
        *no_flags,
        F.expr("p_type <> 'PROMO'").alias("is_active"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.expr("concat('C-', c_custkey)").alias("market"),
        F.col("c_name").alias("korean_name"),
        F.col("c_mktsegment").alias("english_name"),
        *no_flags,
        F.expr("c_acctbal >= 0").alias("is_active"),
    )
    return part.unionByName(customer)


def market_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed: all parts, the economy parts a second time under a new name, all suppliers."""
    event = F.when(
        F.col("p_size") > 5,
        F.struct(
            F.expr("p_size & 1 = 1").alias("warning"),
            F.struct(*[F.expr(f"p_size & {2 << i} <> 0").alias(n) for i, n in enumerate(CAUTION_FLAGS.values())]).alias(
                "caution"
            ),
        ),
    ).alias("market_event")
    parts = table(spark, sf_dir, "part")
    code, brand = F.expr("concat('P-', p_partkey)").alias("market"), F.col("p_brand").alias("english_name")
    first = parts.select(F.expr("p_partkey * 2").alias("seq"), code, F.col("p_name").alias("korean_name"), brand, event)
    second = parts.where("p_type = 'ECONOMY'").select(
        F.expr("p_partkey * 2 + 1").alias("seq"),
        code,
        F.expr("concat('new ', p_name)").alias("korean_name"),
        brand,
        event,
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("seq"),
        F.expr("concat('S-', s_suppkey)").alias("market"),
        F.col("s_name").alias("korean_name"),
        F.col("s_name").alias("english_name"),
        F.lit(None).cast(first.schema["market_event"].dataType).alias("market_event"),
    )
    return first.unionByName(second).unionByName(suppliers)


def landed_feed(spark: SparkSession, sf_dir: str) -> str:
    """The feed as it comes: one reply, a JSON array in one file with an entry a line, in a folder of its own."""
    text = F.to_json(F.struct("market", "korean_name", "english_name", "market_event")).alias("text")
    entries = market_feed(spark, sf_dir).select(F.lit(False).alias("end"), "seq", "market", text)
    end = spark.range(1).selectExpr("true AS end", "CAST(NULL AS BIGINT) AS seq", "CAST(NULL AS STRING) AS market", "']' AS text")
    folder = run_dir(spark, "feed")
    # A reply is one file, so one task writes it; its entries are in order within it.
    lines = entries.unionByName(end).repartition(1).sortWithinPartitions("end", "seq", "market")
    lines = lines.select("end", "text", F.monotonically_increasing_id().alias("at"))
    mark = F.when(F.col("at") == 0, "[").when(F.col("end"), "").otherwise(",")
    lines.select(F.concat(mark, "text").alias("text")).write.text(folder)
    return folder
