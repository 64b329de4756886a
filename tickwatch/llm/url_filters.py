"""Allow and block rules for URLs by a sort-merge range join.

A rule is a host and a path prefix; it fits its host, all subdomains, and paths that
start with its own. The key of a rule is its host with the labels reversed, a slash,
and its path. A URL probes with one key for each host its own host ends in, so that a
rule fits exactly where its key begins a probe: an interval of the sorted keys.
Intervals are nested or apart, so one sweep in order needs only a stack.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.frames import quoted, unused, with_struct
from tickwatch.settings import as_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CARRIED, RULE, PROBE = 0, 1, 2
COLUMNS = ["host", "path", "rule", "verdict"]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both are empty for null and for a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path)


def rule_rows(rules: DataFrame) -> DataFrame:
    """Keyed rules, one for each host and path; of several verdicts for it the last in the alphabet (block) holds."""
    host, path = F.translate(F.col("host"), UPPER, LOWER), F.coalesce("path", F.lit(""))
    named = rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull()).select(
        host.alias("host"), path.alias("path"), "verdict"
    )
    one = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return one.select(
        reversed_key(F.split("host", r"\."), F.col("path")).alias("key"),
        F.lit(RULE).alias("kind"),
        "host",
        "path",
        F.concat("host", "path").alias("rule"),
        "verdict",
    )


def probe_rows(places: DataFrame) -> DataFrame:
    """One key for each host that the URL's own host ends in, itself included."""
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.slice(labels, i, F.size(labels) - i + 1))
    spread = places.select("host", "path", F.explode(tails).alias("tail"))
    nothing = F.lit(None).cast("string")
    return spread.select(
        reversed_key(F.col("tail"), F.col("path")).alias("key"),
        F.lit(PROBE).alias("kind"),
        "host",
        "path",
        nothing.alias("rule"),
        nothing.alias("verdict"),
    )


def carried_rules(blocks: DataFrame) -> DataFrame:
    """For each block of sorted keys, the rules of earlier blocks that still hold at its first key.

    Those are the rules whose keys begin the first key: no more than it has characters.
    """
    firsts = blocks.groupBy("block").agg(F.min("key").alias("first"))
    lengths = F.sequence(F.lit(1), F.char_length("first"))
    starts = firsts.select("block", F.explode(F.transform(lengths, lambda n: F.substring("first", F.lit(1), n))).alias("key"))
    rules = blocks.where(F.col("kind") == RULE).drop("block", "kind")
    return starts.join(rules, "key").select("block", "key", F.lit(CARRIED).alias("kind"), "host", "path", "rule", "verdict")


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Go through blocks in the order of their keys with a stack of the rules that hold; give each probe the top one."""
    stack: list[tuple[str, str, str, str]] = []
    current = None
    for batch in batches:
        found = {name: [] for name in ("host", "path", "rule", "verdict", "rule_host")}
        for row in batch.to_pylist():
            if row["block"] != current:
                stack, current = [], row["block"]
            while stack and not row["key"].startswith(stack[-1][0]):
                stack.pop()
            if row["kind"] != PROBE:
                stack.append((row["key"], row["rule"], row["verdict"], row["host"]))
            elif stack:
                _, rule, verdict, host = stack[-1]
                for name, value in zip(found, (row["host"], row["path"], rule, verdict, host)):
                    found[name].append(value)
        yield pa.RecordBatch.from_pydict({name: pa.array(values, pa.string()) for name, values in found.items()})


def best_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of each host and path that has one: the longest text, then the longest host."""
    keyed = rule_rows(rules).unionByName(probe_rows(places))
    # Cut by ranges of keys; equal keys may part, as what holds at a block's start is carried.
    ranged = keyed.repartitionByRange("key", "kind", "host").withColumn("block", F.spark_partition_id())
    blocks = as_table(ranged, "url-keys")
    both = blocks.unionByName(carried_rules(blocks)).repartition("block").sortWithinPartitions("block", "key", "kind")
    fitting = both.mapInArrow(sweep, "host string, path string, rule string, verdict string, rule_host string")
    order = F.struct(F.char_length("rule").alias("length"), F.char_length("rule_host").alias("host_length"))
    best = fitting.groupBy("host", "path").agg(F.max(F.struct(order.alias("order"), "rule", "verdict")).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, the deciding ``rule`` (host and path as one text) and its ``verdict``.

    ``rules`` has host, path and verdict; a null path fits all, rules without host or
    verdict are left out. A URL that no rule fits has a null rule and the verdict
    ``otherwise``. So have null URLs and texts without ``://``, whose host and path
    are empty. Rows stay as they are, repeated rows too; same-named columns of the
    input are replaced. Without any rules, or rows, nothing fits. URLs may be of any length.
    """
    # Equal URLs are judged once, so that a frequent one is one probe.
    host, path = url_parts(F.col(quoted(url_col)).cast("string"))
    best = best_rules(df.select(host.alias("host"), path.alias("path")).distinct(), rules)
    names = unused(df, "host", "path", "best_host", "best_path", "rule", "verdict")
    its_host, its_path, best_host, best_path, rule, verdict = names
    renamed = dict(zip(COLUMNS, (best_host, best_path, rule, verdict)))
    best = best.select(*[F.col(old).alias(new) for old, new in renamed.items()])
    parted = df.select("*", host.alias(its_host), path.alias(its_path))
    same = (F.col(its_host) == F.col(best_host)) & (F.col(its_path) == F.col(best_path))
    result = F.struct(
        F.col(its_host).alias("host"),
        F.col(its_path).alias("path"),
        F.col(rule).alias("rule"),
        F.coalesce(F.col(verdict), F.lit(otherwise)).alias("verdict"),
    )
    return with_struct(parted.join(best, same, "left"), result, COLUMNS).drop(*names)
