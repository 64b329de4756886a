"""Decode ticks, judge them, and rename or publish them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.functions.barrier import computed_once
from tickwatch.functions.numbers import (
    as_decimal,
    as_flag,
    as_float,
    as_int,
    first_text,
    is_given,
    is_negative,
    truthy_text,
)
from tickwatch.schemas import BACKFILL, SHORT_TO_LONG, STORAGE, StorageColumn

_DECODED_AS = {column.field: column.decoded_as for column in STORAGE} | {"market": "string"}

METRIC_FIELDS = {
    "code": "string",
    "market": "string",
    "trade_price": "double",
    "trade_volume": "double",
    "timestamp": "bigint",
}

# Fields whose sign the rules look at.
SIGNED_FIELDS = ("trade_price", "trade_volume")


def _parsed(value: str, members: dict[str, str], *flags: str) -> Column:
    """The text read as the one entry of a list, in an object with a last member ``end``.

    A parser that stops after the first object would accept whatever follows it.
    Inside the list that is an error or a second entry. A text that closes the list
    itself, and perhaps opens another, is told by the members the object then has: it
    cannot name its own digest as the last. Only texts with a closing bracket are
    looked at for that. The locale only matters for numeric text: the default one
    would drop commas from it.
    """
    inner = ", ".join(f"{name}: {kind}" for name, kind in members.items())
    outer = ", ".join([f"ticks ARRAY<STRUCT<{inner}>>, end BOOLEAN", *(f"{flag} STRING" for flag in flags)])
    options = {"allowSingleQuotes": "false", "locale": "de-CH"}
    if flags:
        options["columnNameOfCorruptRecord"] = flags[0]
    text, digest = F.col(value), F.sha2(F.col(value).cast("binary"), 256)
    named = F.concat(F.lit('{"ticks":['), text, F.lit('],"'), digest, F.lit('":true}'))
    members = F.map_keys(F.from_json(named, "MAP<STRING, STRING>", {"allowSingleQuotes": "false"}))
    stays_inside = ~F.contains(text, F.lit("]")) | members.eqNullSafe(F.array(F.lit("ticks"), digest))
    wrapped = F.concat(F.lit('{"ticks":['), text, F.lit('],"end":true}'))
    return F.from_json(F.when(stays_inside, wrapped), outer, options)


def _only(read: str) -> Column:
    """The entry of a read text, null if that is not exactly one object."""
    whole = F.col(f"{read}.end") & (F.size(f"{read}.ticks") == 1)
    return F.when(whole, F.get(f"{read}.ticks", 0))


def decode(df: DataFrame, fields: Iterable[str], value: str = "value", into: str = "tick") -> DataFrame:
    """Replace the JSON text by a struct of the named fields.

    The struct is null when the text is not exactly one JSON object. Only the
    named fields are built. Numbers and flags keep their JSON kind (VARIANT).
    """
    rest = [name for name in df.columns if name != value]
    members = {name: _DECODED_AS.get(name, "string") for name in fields}
    read = df.select(*rest, _parsed(value, members).alias("_read"))
    return read.select(*rest, _only("_read").alias(into))


def _read_twice(
    df: DataFrame, value: str, plain: dict[str, str], exact: dict[str, str], needed: Iterable[str] = ()
) -> DataFrame:
    """Read each text in plain types (``_plain``) or, where the parser objects or a
    needed field is null, with its JSON kinds (``_again``). Both are null for text
    that is not one object."""
    rest = [name for name in df.columns if name != value]
    read = df.select(*rest, value, _parsed(value, plain, "_objection").alias("_read"))
    settled = F.col("_read._objection").isNull()
    for name in needed:
        settled = settled & F.get("_read.ticks", 0)[name].isNotNull()
    again = read.select(
        *rest,
        F.when(settled, _only("_read")).alias("_plain"),
        F.when(~settled, _parsed(value, exact)).alias("_reread"),
    )
    return again.select(*rest, "_plain", _only("_reread").alias("_again"))


def decode_numbers(
    df: DataFrame,
    fields: Mapping[str, str],
    value: str = "value",
    into: str = "tick",
    absent: str | None = None,
) -> DataFrame:
    """Replace the JSON text by a struct of fields of type string, double or bigint.

    Numeric text and flags count as numbers, anything else as null, and a null
    struct stands for text that is not one JSON object. Nearly all ticks hold plain
    numbers, which the parser reads as such; where it has no objection, a null is a
    field that is missing or null. Only the other texts are read again with their
    JSON kinds kept. ``absent`` names a number for which ``<into>_absent`` tells a
    field that is not there at all from one that is null.
    """
    rest = [name for name in df.columns if name != value]
    kinds = {name: "string" if kind == "string" else "variant" for name, kind in fields.items()}
    again = _read_twice(df, value, dict(fields), kinds, [absent] if absent else [])
    turn = {"string": lambda c: c, "double": as_float, "bigint": as_int}
    turned = F.struct(*[turn[kind](F.col(f"_again.{name}")).alias(name) for name, kind in fields.items()])
    columns = [
        F.when(F.col("_plain").isNotNull(), F.col("_plain"))
        .when(F.col("_again").isNotNull(), turned)
        .alias(into)
    ]
    if absent is not None:
        not_there = F.col("_again").isNotNull() & F.col(f"_again.{absent}").isNull()
        columns.append(not_there.alias(f"{into}_absent"))
    return again.select(*rest, *columns)


def decode_columns(df: DataFrame, columns: Sequence[StorageColumn], value: str = "value") -> DataFrame:
    """Replace the JSON text by its storage columns.

    ``saved`` holds the columns in their storage types, null where a value is
    missing or does not fit, and is null itself for text that is not one JSON
    object. ``unread`` lists the columns whose value is there but does not fit, and
    ``below_zero`` tells whether a signed field is negative before any rounding.

    As in ``decode_numbers`` plain values are read in their types at once, and the
    texts the parser objects to are read again.
    """
    rest = [name for name in df.columns if name != value]
    exact = {c.field: c.decoded_as for c in columns}
    plain = {c.field: exact[c.field] if c.field in SIGNED_FIELDS else c.read_as for c in columns}
    again = _read_twice(df, value, plain, exact)
    is_plain, is_again = F.col("_plain").isNotNull(), F.col("_again").isNotNull()
    plain_values = [
        (_stored("_plain", c) if c.field in SIGNED_FIELDS else F.col(f"_plain.{c.field}")).alias(c.column)
        for c in columns
    ]
    exact_values = [_stored("_again", c).alias(c.column) for c in columns]
    misfits = [
        F.when(is_given(F.col(f"_again.{c.field}")) & _stored("_again", c).isNull(), c.column)
        for c in columns
        if c.decoded_as == "variant"
    ]
    signed = [F.coalesce(F.col(f"_plain.{f}"), F.col(f"_again.{f}")).alias(f) for f in SIGNED_FIELDS]
    turned = again.select(
        *rest,
        F.when(is_plain, F.struct(*plain_values)).when(is_again, F.struct(*exact_values)).alias("saved"),
        F.when(is_again, F.array_compact(F.array(*misfits))).alias("_misfits"),
        F.struct(*signed).alias("_signed"),
    )
    # A stored value above zero settles the sign; only the others are looked at again.
    below_zero, plain_misfits = F.lit(False), []
    for field in SIGNED_FIELDS:
        stored, given = F.col(f"saved.{field}"), F.col(f"_signed.{field}")
        below_zero = below_zero | F.when(F.coalesce(stored <= 0, F.lit(True)), is_negative(given)).otherwise(False)
        plain_misfits.append(F.when(stored.isNull() & is_given(given), field))
    return turned.select(
        *rest,
        "saved",
        F.coalesce("_misfits", F.array_compact(F.array(*plain_misfits))).alias("unread"),
        below_zero.alias("below_zero"),
    )


def _stored(source: str, column: StorageColumn) -> Column:
    """The field's value in its storage type, null if it does not fit."""
    value = F.col(f"{source}.{column.field}")
    if column.type.startswith("decimal"):
        return as_decimal(value, column.type)
    if column.type == "bigint":
        return as_int(value)
    if column.type == "boolean":
        return as_flag(value)
    return value


def _judged(df: DataFrame, require_market: bool, market: Column, ingest: str, value: str) -> DataFrame:
    rest = [name for name in df.columns if name != value]
    price, volume, sent = F.col("tick.trade_price"), F.col("tick.trade_volume"), F.col("tick.timestamp")
    # A missing field and one that is no number are both null by now.
    broken = price.isNull() | volume.isNull() | sent.isNull()
    if require_market:
        broken = broken | market.isNull()
    broken = broken | (price <= 0) | (volume < 0) | (sent <= 0)
    latency = F.unix_micros(ingest) / F.lit(1000.0) - sent
    decoded = decode_numbers(df.withColumn("_source", F.col(value)), METRIC_FIELDS, value)
    judged = decoded.select(*rest, "tick", market.alias("market"), broken.alias("is_error"))
    return judged.select(
        *rest,
        "is_error",
        "market",
        F.when(F.col("is_error"), 0.0).otherwise(F.greatest(F.lit(0.0), latency)).alias("latency_ms"),
        F.when(F.col("is_error"), 0.0).otherwise(price * volume).alias("trade_amount_krw"),
    )


def metric_events(
    df: DataFrame, rules: str = "global", ingest: str = "ingest_time", value: str = "value"
) -> DataFrame:
    """Turn every tick text into one judged event; bad text is an error event.

    ``global`` rules need a market; ``market`` rules count a tick without one
    under UNKNOWN. A code that counts as false, such as 0, gives way to the market.
    Latency runs from the tick's own time to the ingest column, never below zero. All
    input columns but the text are kept.
    """
    code, market = truthy_text(F.col("tick.code"), F.col("_source"), "code"), F.col("tick.market")
    if rules == "global":
        return _judged(df, True, first_text(code, market), ingest, value)
    if rules == "market":
        market = truthy_text(market, F.col("_source"), "market")
        return _judged(df, False, first_text(code, market, default="UNKNOWN"), ingest, value)
    raise ValueError(f"rules must be 'global' or 'market', not {rules!r}")


def publish_envelope(
    df: DataFrame, key_fields: Sequence[str] = ("cd",), value: str = "value", topic: str | None = None
) -> DataFrame:
    """Key and value to publish: the first key field the tick has, else ``unknown``.

    Text that is not one JSON object is not published; ``publish_rejects`` has it.
    With the single field ``cd`` every long-named tick shares the key ``unknown`` and
    so one partition of the topic; ``("code", "cd")`` spreads them by market.
    """
    decoded = decode(df.select(value, F.col(value).alias("_text")), key_fields, value)
    found = computed_once(decoded, ["_text"], {"tick": F.col("tick")}).where(F.col("tick").isNotNull())
    keys = [F.col(f"tick.{name}") for name in key_fields]
    columns = [F.coalesce(*keys, F.lit("unknown")).alias("key"), F.col("_text").alias("value")]
    if topic is not None:
        columns.append(F.lit(topic).alias("topic"))
    return found.select(*columns)


def publish_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """The rows whose text is not one JSON object, with all their columns."""
    decoded = decode(df.withColumn("_text", F.col(value)), (), value)
    kept = [name for name in df.columns if name != value]
    found = computed_once(decoded, [*kept, "_text"], {"tick": F.col("tick")}).where(F.col("tick").isNull())
    return found.select(*kept, F.col("_text").alias(value))


def to_json_value(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Structured ticks as one JSON text each; text beyond ASCII stays as it is."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def rename_long(df: DataFrame) -> DataFrame:
    """Short tick column names to long ones, and the columns old rows lack filled in."""
    renamed = df.withColumnsRenamed(SHORT_TO_LONG)
    filled = {}
    for name, (default, kind) in BACKFILL.items():
        given = F.col(name).cast(kind) if name in renamed.columns else F.lit(None).cast(kind)
        filled[name] = F.coalesce(given, F.lit(default).cast(kind))
    return renamed.withColumns(filled)
