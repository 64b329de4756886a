"""Column names, types and fixed lookup tables of the tick data model."""

from __future__ import annotations

from dataclasses import dataclass

# The wire fields of one tick in message order, as
# (wire field, storage column, storage type, may be null).
WIRE_FIELDS = (
    ("type", "data_type", "varchar(20)", False),
    ("code", "market_code", "varchar(20)", False),
    ("opening_price", "opening_price", "decimal(20,4)", False),
    ("high_price", "high_price", "decimal(20,4)", False),
    ("low_price", "low_price", "decimal(20,4)", False),
    ("trade_price", "trade_price", "decimal(20,4)", False),
    ("prev_closing_price", "prev_closing_price", "decimal(20,4)", False),
    ("acc_trade_price", "acc_trade_price", "decimal(30,4)", False),
    ("change", "change", "varchar(10)", False),
    ("change_price", "change_price", "decimal(20,4)", False),
    ("signed_change_price", "signed_change_price", "decimal(20,4)", False),
    ("change_rate", "change_rate", "decimal(10,6)", False),
    ("signed_change_rate", "signed_change_rate", "decimal(10,6)", False),
    ("ask_bid", "ask_bid", "varchar(3)", False),
    ("trade_volume", "trade_volume", "decimal(25,8)", False),
    ("acc_trade_volume", "acc_trade_volume", "decimal(30,8)", False),
    ("trade_date", "trade_date", "varchar(8)", False),
    ("trade_time", "trade_time", "varchar(6)", False),
    ("trade_timestamp", "trade_timestamp", "bigint", False),
    ("acc_ask_volume", "acc_ask_volume", "decimal(30,8)", False),
    ("acc_bid_volume", "acc_bid_volume", "decimal(30,8)", False),
    ("highest_52_week_price", "highest_52_week_price", "decimal(20,4)", False),
    ("highest_52_week_date", "highest_52_week_date", "varchar(10)", False),
    ("lowest_52_week_price", "lowest_52_week_price", "decimal(20,4)", False),
    ("lowest_52_week_date", "lowest_52_week_date", "varchar(10)", False),
    ("market_state", "market_state", "varchar(40)", False),
    ("is_trading_suspended", "is_trading_suspended", "boolean", False),
    ("delisting_date", "delisting_date", "json", True),
    ("market_warning", "market_warning", "varchar(20)", False),
    ("timestamp", "timestamp", "bigint", False),
    ("acc_trade_price_24h", "acc_trade_price_24h", "decimal(30,4)", False),
    ("acc_trade_volume_24h", "acc_trade_volume_24h", "decimal(30,8)", False),
    ("stream_type", "stream_type", "varchar(20)", False),
)

# Short tick column names and the long names they became.
SHORT_TO_LONG = {
    "op": "opening_price",
    "hp": "high_price",
    "lp": "low_price",
    "tp": "trade_price",
    "pcp": "prev_closing_price",
    "atp": "acc_trade_price",
    "c": "change",
    "cp": "change_price",
    "scp": "signed_change_price",
    "cr": "change_rate",
    "scr": "signed_change_rate",
    "ab": "ask_bid",
    "tv": "trade_volume",
    "atv": "acc_trade_volume",
    "tdt": "trade_date",
    "ttm": "trade_time",
    "ttms": "trade_timestamp",
    "tms": "timestamp",
    "h52wp": "highest_52_week_price",
    "h52wdt": "highest_52_week_date",
    "l52wp": "lowest_52_week_price",
    "l52wdt": "lowest_52_week_date",
    "ms": "market_state",
    "its": "is_trading_suspended",
    "dd": "delisting_date",
    "mw": "market_warning",
    "atp24h": "acc_trade_price_24h",
    "acv24h": "acc_trade_volume_24h",
    "st": "stream_type",
}

# Columns that older rows lack and the value they are given.
BACKFILL = {
    "acc_ask_volume": ("1", "decimal(30,8)"),
    "acc_bid_volume": ("1", "decimal(30,8)"),
}

# Market flag columns and the caution names they come from.
CAUTION_FLAGS = {
    "price_fluc": "PRICE_FLUCTUATIONS",
    "vol_soar": "TRADING_VOLUME_SOARING",
    "dep_amt_soar": "DEPOSIT_AMOUNT_SOARING",
    "global_diff": "GLOBAL_PRICE_DIFFERENCES",
    "small_acc_conc": "CONCENTRATION_OF_SMALL_ACCOUNTS",
}

MARKET_ATTRIBUTES = ("korean_name", "english_name", "warning", *CAUTION_FLAGS)

MARKET_SCHEMA = (
    "market STRING, korean_name STRING, english_name STRING, warning BOOLEAN, "
    + ", ".join(f"{flag} BOOLEAN" for flag in CAUTION_FLAGS)
    + ", is_active BOOLEAN"
)

FEED_ITEM_SCHEMA = (
    "STRUCT<market: STRING, korean_name: STRING, english_name: STRING, "
    "market_event: STRUCT<warning: BOOLEAN, caution: STRUCT<"
    + ", ".join(f"{name}: BOOLEAN" for name in CAUTION_FLAGS.values())
    + ">>>"
)

# Health of the whole stream, one row per bucket.
HEALTH_COLUMNS = {
    "checked_at": "timestamp",
    "time_unit": "string",
    "total_collected_count": "bigint",
    "total_error_count": "int",
    "error_rate_percentage": "double",
    "average_latency_ms": "double",
    "max_latency_ms": "double",
    "unique_market_count": "int",
    "total_trade_volume_krw": "double",
}

# Health of one market, one row per bucket and market.
MARKET_HEALTH_COLUMNS = {
    "checked_at": "timestamp",
    "market": "string",
    "time_unit": "string",
    "collected_count": "bigint",
    "error_count": "int",
    "error_rate_percentage": "double",
    "average_latency_ms": "double",
    "max_latency_ms": "double",
    "trade_volume_krw": "double",
}

# Price move of one market over one sliding window.
MOVE_COLUMNS = {
    "window_start": "timestamp",
    "window_end": "timestamp",
    "start_price": "double",
    "end_price": "double",
    "change_rate": "double",
    "status": "string",
    "market_code": "string",
}


@dataclass(frozen=True)
class StorageColumn:
    """How one wire field is stored."""

    field: str
    column: str
    type: str
    nullable: bool

    @property
    def is_text(self) -> bool:
        return self.type.startswith("varchar")

    @property
    def max_length(self) -> int:
        return int(self.type[len("varchar("):-1])

    @property
    def read_as(self) -> str:
        """The type a plain value of this field has."""
        return "string" if self.is_text or self.type == "json" else self.type

    @property
    def decoded_as(self) -> str:
        """Text stays text; numbers and flags keep their JSON kind."""
        return "string" if self.is_text or self.type == "json" else "variant"


STORAGE = tuple(StorageColumn(*row) for row in WIRE_FIELDS)


def typed(df, columns: dict[str, str]):
    """Project to exactly these columns, in order, with these types."""
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in columns.items()])
