"""Keep the market table in step with the daily feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.schemas import CAUTION_FLAGS, MARKET_ATTRIBUTES

CREATED, UPDATED, DEACTIVATED, UNCHANGED = "created", "updated", "deactivated", "unchanged"


def flatten_feed(feed: DataFrame, order: str = "seq") -> DataFrame:
    """One row per market: flags lifted out of the nested event, absent ones false.

    Of several entries for a market the last in feed order wins; ``feed_rows`` says
    how many there were. The pick is an aggregate, not a ranking, so copies of a
    market are folded before the shuffle.
    """
    caution = F.col("market_event.caution")
    flags = {"warning": F.col("market_event.warning")}
    flags |= {name: caution[source] for name, source in CAUTION_FLAGS.items()}
    flat = feed.select(
        "market",
        F.col(order).alias("_order"),
        F.struct(
            "korean_name",
            "english_name",
            *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in flags.items()],
        ).alias("_entry"),
    )
    last = flat.groupBy("market").agg(
        F.max_by("_entry", "_order").alias("_entry"), F.count("*").alias("feed_rows")
    )
    return last.select("market", "_entry.*", "feed_rows")


def _active(existing: DataFrame) -> DataFrame:
    return existing.where("is_active").select("market")


def _listed(feed: DataFrame) -> DataFrame:
    """Markets of the feed, copies folded before they are compared."""
    return feed.select("market").distinct()


def new_listings(existing: DataFrame, feed: DataFrame) -> DataFrame:
    """Markets of the feed that are not active now; a relisted market counts as new."""
    return _listed(feed).subtract(_active(existing))


def delistings(existing: DataFrame, feed: DataFrame) -> DataFrame:
    """Active markets that the feed no longer has."""
    return _active(existing).subtract(_listed(feed))


def sync_changes(existing: DataFrame, feed: DataFrame, reactivate: bool = True, order: str = "seq") -> DataFrame:
    """Every market with its next attributes and the ``action`` that led there.

    With ``reactivate`` a market in the feed becomes active and an active one that
    is missing from it becomes inactive; without, ``is_active`` is left as it is.
    """
    fresh = flatten_feed(feed, order).select(
        "market", F.struct(*MARKET_ATTRIBUTES).alias("_new"), "feed_rows"
    )
    current = existing.select("market", F.struct(*MARKET_ATTRIBUTES).alias("_old"), "is_active")
    both = current.join(fresh, "market", "full_outer")
    in_feed, on_file = F.col("feed_rows").isNotNull(), F.col("_old").isNotNull()
    action = F.when(in_feed & on_file, UPDATED).when(in_feed, CREATED)
    if reactivate:
        action = action.when(F.col("is_active"), DEACTIVATED)
        still_active: Column = in_feed
    else:
        still_active = F.coalesce("is_active", F.lit(True))
    newest = F.when(in_feed, F.col("_new")).otherwise(F.col("_old"))
    return both.select(
        "market",
        newest.alias("_entry"),
        still_active.alias("is_active"),
        action.otherwise(UNCHANGED).alias("action"),
        F.coalesce("feed_rows", F.lit(0)).alias("feed_rows"),
        F.col("is_active").alias("was_active"),
    ).select("market", "_entry.*", "is_active", "action", "feed_rows", "was_active")


def sync_snapshot(existing: DataFrame, feed: DataFrame, reactivate: bool = True, order: str = "seq") -> DataFrame:
    """The next market table."""
    return sync_changes(existing, feed, reactivate, order).select("market", *MARKET_ATTRIBUTES, "is_active")


def sync_report(changes: DataFrame) -> DataFrame:
    """One row of counts.

    Each feed entry after the one that creates a market updates it, so repeated
    entries count as updates. The lists of codes behind ``new_count`` and
    ``delisted_count`` are rows, see ``listing_report``.
    """
    created = F.col("action") == CREATED
    relisted = (F.col("feed_rows") > 0) & ~F.coalesce("was_active", F.lit(False))
    return changes.agg(
        F.count_if(created).alias("created_count"),
        F.coalesce(F.sum(F.col("feed_rows") - created.cast("bigint")), F.lit(0)).alias("updated_count"),
        F.count_if(F.col("action") == DEACTIVATED).alias("deactivated_count"),
        F.count_if(relisted).alias("new_count"),
        F.count_if((F.col("feed_rows") == 0) & F.coalesce("was_active", F.lit(False))).alias("delisted_count"),
    )


def listing_report(changes: DataFrame) -> DataFrame:
    """The codes behind the counts, one row each, so no task holds a whole list."""
    was_active = F.coalesce("was_active", F.lit(False))
    listing = F.when((F.col("feed_rows") > 0) & ~was_active, "new").when(
        (F.col("feed_rows") == 0) & was_active, "delisted"
    )
    return changes.select(listing.alias("listing"), "market").where(F.col("listing").isNotNull())
