"""Check every tick against the storage rules and route it to one of four outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.functions.barrier import computed_once
from tickwatch.operators.ticks import decode_columns
from tickwatch.schemas import STORAGE, StorageColumn

STORED, DEAD, SKIPPED, UNSTORABLE = "stored", "dead_letter", "skipped", "unstorable"

SEPARATOR = " | "

# Fields a tick must have, and the texts two of them may hold.
REQUIRED = ("code", "trade_price", "timestamp")
CHANGES = ("RISE", "EVEN", "FALL")
STREAM_TYPES = ("SNAPSHOT", "REALTIME")

# Wording of the reasons.
MISSING = "Missing Field: {}"
NEGATIVE = "Negative Value Error: price or volume is negative"
BAD_CHANGE = "Invalid Change Type: "
BAD_STREAM_TYPE = "Invalid Stream Type: "
MALFORMED = "Malformed JSON"

_COLUMN_OF = {column.field: column.column for column in STORAGE}


def _is_missing(column: str) -> Column:
    """Neither a value that fits nor one that does not."""
    return F.col(f"saved.{column}").isNull() & ~F.array_contains("unread", column)


def _outside(column: str, allowed: tuple[str, ...], wording: str) -> Column:
    value = F.col(f"saved.{column}")
    inside = F.coalesce(value.isin(*allowed), F.lit(False))
    return F.when(~inside, F.concat(F.lit(wording), F.coalesce(value, F.lit("None"))))


def _reasons() -> Column:
    """All reasons in rule order, empty text when there are none."""
    rules = [F.when(_is_missing(_COLUMN_OF[field]), MISSING.format(field)) for field in REQUIRED]
    rules.append(F.when(F.col("below_zero"), NEGATIVE))
    rules.append(_outside("change", CHANGES, BAD_CHANGE))
    rules.append(_outside("stream_type", STREAM_TYPES, BAD_STREAM_TYPE))
    return F.when(F.col("saved").isNull(), MALFORMED).otherwise(F.concat_ws(SEPARATOR, *rules))


def _storage_problem(column: StorageColumn) -> Column:
    """Why this column cannot be stored, null if it can."""
    saved = F.col(f"saved.{column.column}")
    if column.nullable:
        return F.lit(None).cast("string")
    if column.is_text:
        too_long = F.when(F.length(saved) > column.max_length, f"{column.column}: longer than {column.max_length}")
        return F.when(saved.isNull(), f"{column.column}: missing").otherwise(too_long)
    unfit = F.when(F.array_contains("unread", column.column), f"{column.column}: not {column.type}")
    return F.when(saved.isNull(), unfit.otherwise(f"{column.column}: missing"))


def validate(df: DataFrame, value: str = "value") -> DataFrame:
    """Decode to storage columns and add ``error_log``, null for a tick that breaks no rule.

    The payload is kept as ``raw_data``.
    """
    rest = [name for name in df.columns if name != value]
    decoded = decode_columns(df.withColumn("raw_data", F.col(value)), STORAGE, value)
    checked = {"error_log": F.nullif(_reasons(), F.lit(""))}
    return computed_once(decoded, [*rest, "raw_data", "saved", "unread"], checked)


def shares(spark: SparkSession) -> int:
    """How many partitions the ticks of one market are dealt to: a quarter of those of a shuffle."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)


def route(df: DataFrame, markets: DataFrame, value: str = "value") -> DataFrame:
    """One row per tick with what decides its outcome, and its load time ``created_at``.

    A tick that breaks a rule is a dead letter; one of an unknown market is skipped;
    one that does not fit the storage columns is unstorable; the rest is stored.
    One decode and one join give all four. The join is left to the planner: it
    broadcasts the markets while their measured size allows and otherwise
    shuffles. A hot market is dealt to several partitions, as the markets stand
    there in as many shares; AQE splits what is still too large, but never what one
    task wrote.
    """
    checked = validate(df, value)
    lookup = F.when(F.col("error_log").isNull(), F.col("saved.market_code"))
    dealt = shares(df.sparkSession)
    # AQE splits a join only where both sides come straight from a shuffle. On the
    # market alone the distinct markets would lie right already and not be shuffled.
    known = markets.select(F.col("market").alias("_known")).distinct()
    known = known.withColumn("_known_share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(dealt - 1).cast("bigint"))))
    # A share hangs on what a tick holds, so that a task that runs again deals alike. Ticks
    # that look nothing up match no market whatever their share; they go anywhere.
    spread = F.xxhash64(*[name for name in checked.columns if name not in ("saved", "unread", "error_log")])
    share = F.when(lookup.isNull(), spread).otherwise(F.pmod(spread, F.lit(dealt)))
    joined = checked.withColumns({"_code": lookup, "_code_share": share}).join(
        known, (F.col("_code") == F.col("_known")) & (F.col("_code_share") == F.col("_known_share")), "left"
    )
    rest = [name for name in checked.columns if name != "unread"]
    may_store = F.col("error_log").isNull() & F.col("_known").isNotNull()
    # An array keeps the generated method small enough to be compiled.
    problems = F.array_join(F.array_compact(F.array(*[_storage_problem(column) for column in STORAGE])), SEPARATOR)
    return joined.select(
        *rest,
        F.col("_known").isNotNull().alias("is_known"),
        F.when(may_store, F.nullif(problems, F.lit(""))).alias("save_error"),
        F.current_timestamp().alias("created_at"),
    )


def outcome() -> Column:
    """Name of the output a routed tick goes to."""
    return (
        F.when(F.col("error_log").isNotNull(), DEAD)
        .when(~F.col("is_known"), SKIPPED)
        .when(F.col("save_error").isNotNull(), UNSTORABLE)
        .otherwise(STORED)
    )


def stored(routed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ticks in storage columns, with their load time."""
    fits = F.col("error_log").isNull() & F.col("is_known") & F.col("save_error").isNull()
    return routed.where(fits).select(*keep, "saved.*", "created_at")


def dead_letters(routed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole payload and all reasons of the ticks that break a rule."""
    return routed.where(F.col("error_log").isNotNull()).select(
        *keep, "raw_data", "error_log", "created_at"
    )


def skipped(routed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ticks of a market that the market table does not have."""
    return routed.where(F.col("error_log").isNull() & ~F.col("is_known")).select(
        *keep, "saved.market_code", "raw_data"
    )


def unstorable(routed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ticks that pass the rules but do not fit the storage columns, and why."""
    return routed.where(F.col("save_error").isNotNull()).select(*keep, "raw_data", "save_error")


OUTPUTS = {STORED: stored, DEAD: dead_letters, SKIPPED: skipped, UNSTORABLE: unstorable}


def dead_letter_collapse(df: DataFrame, error_log: str = "error_log") -> DataFrame:
    """Wide dead letters to (raw_data, error_log), all other columns kept in the payload."""
    payload = [name for name in df.columns if name != error_log]
    return df.select(
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("raw_data"),
        F.col(error_log).alias("error_log"),
    )
