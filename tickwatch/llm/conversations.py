"""Repair of the order of roles in conversations: a generalised LR parse with weighted edits.

The roles of a conversation, by their first letters, should read ``(s?(ua)+)?``. A parser
for that grammar reads the turns in order, and each turn gives it several ways to go on:
keep it, give it another role, delete it, insert turns before it. All ways are followed
at once on a graph-structured stack: after each turn there is one node for every top of
the stack, with a link to the node it came from. Ways that end on equal tops go on alike,
so they are merged by the least (cost, audit), the audit being the initials of the edits
so far.

A conversation may be of any length. Turns are sorted over all tasks and cut into segments
of bounded size. Each segment is parsed from every top it may start on, which gives a small
table: cost and order of the audits from each first top to each last one. Tables are
composed, by levels where there are many, the least way through them gives each segment its
first and last top, and a second parse of the segments gives the edits.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.frames import quoted
from tickwatch.settings import as_table

# Turns of a segment, as a power of two, and tables composed in one go, likewise.
SEGMENT_BITS, FAN_BITS = 12, 10
ROWS_OUT = 10_000

BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
# Roles that edits may give.
GIVEN = {"u": "user", "a": "assistant"}

# The LR automaton of  Start: (nothing) | Body   Body: Pair | s Pair | Body Pair   Pair: u a
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (4, "u"): 2, (2, "a"): 6}
REDUCE = {3: ("Body", 1), 5: ("Body", 2), 7: ("Body", 2), 6: ("Pair", 2)}
GOTO = {(0, "Pair"): 3, (1, "Pair"): 5, (4, "Pair"): 7, (0, "Body"): 4}
ACCEPT = (0, 4)
# Tops between two turns, each with one stack that has it; all stacks of a top go on alike.
STACKS = {0: (0,), 1: (0, 1), 2: (0, 2), 4: (0, 4)}
TOPS = tuple(STACKS)


def advance(stack: tuple[int, ...], role: str) -> tuple[int, ...] | None:
    """The stack after a role is shifted and all that is complete is reduced; None if the role can't come here."""
    state = SHIFT.get((stack[-1], role))
    if state is None:
        return None
    stack += (state,)
    while stack[-1] in REDUCE:
        left, length = REDUCE[stack[-1]]
        stack = stack[:-length]
        stack += (GOTO[stack[-1], left],)
    return stack


def top_after(top: int, role: str) -> int | None:
    stack = advance(STACKS[top], role)
    return None if stack is None else stack[-1]


# The one role that may be inserted on each top, the top after it, and how many it takes until the parse may end.
INSERTED = {top: next(role for role in GIVEN if top_after(top, role) is not None) for top in TOPS}
AFTER_INSERT = {top: top_after(top, INSERTED[top]) for top in TOPS}


def closing(top: int) -> int:
    return 0 if top in ACCEPT else 1 + closing(AFTER_INSERT[top])


def ways(top: int, initial: str, cut: bool) -> Iterator[tuple[str, int, int]]:
    """(edits, cost, top after) of every way to go on from a top with a turn.

    No turn is inserted right before a deleted one: the other order costs the same and
    comes first. More than two inserted turns lead back to a top that was there before.
    """
    yield DELETE, DELETE_COST, top
    for inserts in range(3):
        before, paid = INSERT * inserts, INSERT_COST * inserts + TRUNCATED_COST * cut
        kept = top_after(top, initial)
        if kept is not None:
            yield before + KEEP, paid, kept
        for role in GIVEN:
            given = top_after(top, role)
            if given is not None:
                yield before + REROLE, paid + REROLE_COST, given
        top = AFTER_INSERT[top]


# Nodes of the stack after a turn: for each top (cost, order of the audit), or None.
Nodes = tuple
WAYS = {
    (initial, cut): {top: list(ways(top, initial, cut)) for top in TOPS} for initial in "sua-" for cut in (False, True)
}
_steps: dict[tuple, tuple[Nodes, int, tuple]] = {}


def merged(found: dict[int, tuple]) -> tuple[Nodes, int, tuple]:
    """Nodes of the least (cost, place of the audit) by top, costs counted from the least, that cost, and the links."""
    places = {place: rank for rank, place in enumerate(sorted(place for _, place, _ in found.values()))}
    least = min(cost for cost, _, _ in found.values())
    nodes = tuple((found[t][0] - least, places[found[t][1]]) if t in found else None for t in TOPS)
    return nodes, least, tuple(found[t][2] if t in found else None for t in TOPS)


def step(nodes: Nodes, turn: tuple[str, bool]) -> tuple[Nodes, int, tuple]:
    """Nodes after one more turn, the cost they have in common, and for each its link (top before, edits).

    Audits of two nodes differ before either ends, as both end with the edit of the same
    turn. So the order of two longer ones is that of the nodes they come from, or, from
    one node, that of the new edits. Costs and orders repeat, so each step is made once.
    """
    done = _steps.get((nodes, turn))
    if done is None:
        found: dict[int, tuple] = {}
        for at, top in enumerate(TOPS):
            if nodes[at] is None:
                continue
            cost, order = nodes[at]
            for edits, paid, after in WAYS[turn][top]:
                way = (cost + paid, (order, edits), (top, edits))
                if after not in found or way[:2] < found[after][:2]:
                    found[after] = way
        done = _steps[nodes, turn] = merged(found)
    return done


def start(top: int) -> Nodes:
    return tuple((0, 0) if t == top else None for t in TOPS)


def segment_table(turns: Iterable[tuple[str, bool] | None], paid: int) -> tuple[list[int], list[int]]:
    """Costs (-1: no way) and orders of audits from each first top to each last one; None is a turn that must go."""
    held = [(start(top), paid) for top in TOPS]
    for turn in turns:
        if turn is not None:
            for at, (nodes, cost) in enumerate(held):
                nodes, more, _ = step(nodes, turn)
                held[at] = nodes, cost + more
    costs = [-1 if node is None else cost + node[0] for nodes, cost in held for node in nodes]
    return costs, [-1 if node is None else node[1] for nodes, _ in held for node in nodes]


def through(nodes: Nodes, costs: list[int], orders: list[int]) -> tuple[Nodes, int, tuple]:
    """Nodes after a segment, the cost in common, and for each the top before it; as ``step``."""
    found: dict[int, tuple] = {}
    for at, top in enumerate(TOPS):
        if nodes[at] is None:
            continue
        cost, order = nodes[at]
        for to, after in enumerate(TOPS):
            paid = costs[at * len(TOPS) + to]
            if paid >= 0:
                way = (cost + paid, (order, orders[at * len(TOPS) + to]), top)
                if after not in found or way[:2] < found[after][:2]:
                    found[after] = way
    return merged(found)


def composed(tables: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
    """The table of segments that follow one another."""
    costs, orders = [], []
    for top in TOPS:
        nodes, cost = start(top), 0
        for table in tables:
            nodes, more, _ = through(nodes, *table)
            cost += more
        costs += [-1 if node is None else cost + node[0] for node in nodes]
        orders += [-1 if node is None else node[1] for node in nodes]
    return costs, orders


def last_top(nodes: Nodes) -> int:
    """The top a conversation best ends on: least cost with the turns inserted at the end, then least audit."""
    ends = [(nodes[at][0] + INSERT_COST * closing(top), nodes[at][1], top) for at, top in enumerate(TOPS) if nodes[at]]
    return min(ends)[2]


def tops_between(tables: list[tuple[list[int], list[int]]], first: int, last: int | None) -> list[tuple[int, int]]:
    """First and last top of each of the segments on the least way through them; the best end if none is given."""
    nodes, links = start(first), []
    for table in tables:
        nodes, _, came = through(nodes, *table)
        links.append(came)
    top, out = last_top(nodes) if last is None else last, []
    for came in reversed(links):
        before = came[TOPS.index(top)]
        out.append((before, top))
        top = before
    return out[::-1]


def edits_between(turns: list[tuple[str, bool] | None], first: int, last: int) -> list[tuple[str, int]]:
    """(edits, top before them) for each turn on the least way from one top to another."""
    nodes, links = start(first), []
    for turn in turns:
        if turn is not None:
            nodes, _, came = step(nodes, turn)
            links.append(came)
    top, out = last, []
    for turn in reversed(turns):
        edits = DELETE
        if turn is not None:
            top, edits = links.pop()[TOPS.index(top)]
        out.append((edits, top))
    return out[::-1]


def inserted(top: int, count: int) -> tuple[str, int]:
    """Initials of so many turns inserted on a top, and the top after them."""
    roles = ""
    for _ in range(count):
        roles += INSERTED[top]
        top = AFTER_INSERT[top]
    return roles, top


# Rows through Python ---------------------------------------------------------------


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def batches_of(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(itertools.islice(rows, ROWS_OUT)):
        arrays = [pa.array(column, field.type) for column, field in zip(zip(*some), schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def streamed(df: DataFrame, make: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """Run a generator of rows over the sorted rows of each partition."""
    kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64())}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(make(rows_of(batches)), fields)

    return df.mapInArrow(run, schema)


ORDER = ["turn", "role", "head", "key"]


def turns_of(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text) with the columns that order and tell texts: their first characters and a digest."""
    named = df.select(
        F.col(quoted(conv_col)).cast("string").alias("conv"),
        F.col(quoted(turn_col)).cast("bigint").alias("turn"),
        F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(" ")).alias("text"),
    )
    return named.select(
        "conv", "turn", "role", F.substring("text", 1, 32).alias("head"), F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("key"), "text"
    )


def judged_turns(turns: DataFrame) -> DataFrame:
    """Different turns, how often each is there, and the fault of the first of them.

    Equal turns lie side by side, so all but the first are duplicates, or blank.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    told = turns.withColumns({"blank": trimmed == "", "cut": ~F.substring(trimmed, -1, 1).isin(*ENDS)})
    different = told.groupBy("conv", *ORDER, "blank", "cut").agg(F.count("*").alias("copies"))
    said = ["conv", "role", "key"]
    repeated = different.groupBy(*said).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
    names = [F.col(name).alias(f"_{name}") for name in said]
    on = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key"))
    joined = different.join(repeated.select(*names, "first"), on, "left")
    seen = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    fault = F.when(F.col("blank"), BLANK).when(seen, DUPLICATE).when(F.col("cut"), TRUNCATED)
    return joined.select("conv", *ORDER, "copies", fault.alias("fault"))


def placed(judged: DataFrame) -> DataFrame:
    """The turns in order over all tasks, numbered, as a written table."""
    spread = judged.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER)
    return as_table(spread.withColumn("place", F.monotonically_increasing_id()), "turns")


def symbol(role: str, fault: str | None) -> tuple[str, bool] | None:
    """What the parser sees of a turn; None if it must go. A role without a letter of the grammar can't be kept."""
    if fault in (BLANK, DUPLICATE):
        return None
    return role[:1] if role[:1] in ("s", "u", "a") else "-", fault == TRUNCATED


TABLE = "conv string, node bigint, place bigint, costs array<bigint>, orders array<bigint>"


def segment_tables(rows: Iterator[tuple]) -> Iterator[tuple]:
    for (node, conv), run in itertools.groupby(rows, key=lambda row: row[:2]):
        run = list(run)
        # Further copies of a turn only add the price of deleting them.
        paid = sum(DELETE_COST * (copies - (symbol(role, fault) is not None)) for *_, role, copies, fault in run)
        yield conv, node, run[0][2], *segment_table((symbol(role, fault) for *_, role, _, fault in run), paid)


def composed_tables(rows: Iterator[tuple]) -> Iterator[tuple]:
    for (node, conv), run in itertools.groupby(rows, key=lambda row: row[:2]):
        run = list(run)
        yield conv, node, run[0][2], *composed([(costs, orders) for *_, costs, orders in run])


TOPS_OF = "conv string, node bigint, place bigint, first int, last int, ends int"


def spread_tops(rows: Iterator[tuple]) -> Iterator[tuple]:
    """First and last top of each table, from those of the tables above (which come first) or from the start."""
    for (_, conv), run in itertools.groupby(rows, key=lambda row: row[:2]):
        run = list(run)
        first, last, ends = 0, None, 1
        if run[0][4] is None:
            first, last, ends = run.pop(0)[6:]
        tables = [(costs, orders) for *_, costs, orders, _, _, _ in run]
        for at, (row, tops) in enumerate(zip(run, tops_between(tables, first, last))):
            yield conv, row[3], row[2], *tops, int(ends and at == len(run) - 1)


def segment_tops(tables: DataFrame, fan_bits: int) -> DataFrame:
    """First and last top of each segment of each conversation."""
    levels = [as_table(tables, "segments")]
    while (levels[-1].groupBy("conv").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > 1 << fan_bits:
        above = levels[-1].withColumn("node", F.shiftright("node", fan_bits))
        above = above.repartition("conv", "node").sortWithinPartitions("node", "conv", "place")
        above = streamed(above.select("node", "conv", "place", "costs", "orders"), composed_tables, TABLE)
        levels.append(as_table(above, "segments"))
    columns = ["parent", "conv", "place", "node", "costs", "orders", "first", "last", "ends"]
    blank = {name: F.lit(None).cast("int") for name in ("first", "last", "ends")}
    tops = None
    for level in reversed(levels):
        parent = F.lit(0).cast("bigint") if tops is None else F.shiftright("node", fan_bits)
        rows = level.withColumns(blank).withColumn("parent", parent).select(*columns)
        if tops is not None:
            none = {name: F.lit(None).cast("array<bigint>") for name in ("costs", "orders")}
            rows = rows.unionByName(tops.withColumn("parent", F.col("node")).withColumns(none).select(*columns))
        # Rows of the level above come first.
        rows = rows.repartition("conv", "parent").sortWithinPartitions("parent", "conv", "place", F.col("costs").isNotNull())
        tops = streamed(rows, spread_tops, TOPS_OF)
    return tops


EDITS = (
    "conv string, turn bigint, role string, head string, key binary, place bigint, copies bigint, fault string, "
    "cost bigint, before string, edit string, given string, after string"
)


def made_edits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The edits of each segment; its tops come before its turns."""
    for (_, conv), run in itertools.groupby(rows, key=lambda row: row[:2]):
        *_, first, last, ends = next(run)
        run = [row[2:9] for row in run]
        turns = [symbol(role, fault) for _, _, role, _, _, _, fault in run]
        edits = edits_between(turns, first, last)
        for at, ((place, turn, role, head, key, copies, fault), (word, top)) in enumerate(zip(run, edits)):
            before, top = inserted(top, len(word) - 1)
            edit, given = word[-1], None
            cost = INSERT_COST * len(before) + DELETE_COST * (copies - 1)
            if edit == DELETE:
                cost += DELETE_COST
            else:
                cost += TRUNCATED_COST * (fault == TRUNCATED)
                given = role
                if edit == REROLE:
                    cost, given = cost + REROLE_COST, GIVEN[next(r for r in GIVEN if top_after(top, r) is not None)]
            after = inserted(last, closing(last))[0] if ends and at == len(run) - 1 else ""
            cost += INSERT_COST * len(after)
            yield conv, turn, role, head, key, place, copies, fault, cost, before, edit, given, after


def repair(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    segment_bits: int = SEGMENT_BITS,
    fan_bits: int = FAN_BITS,
) -> DataFrame:
    """The cheapest edits that give every conversation roles that read ``(s?(ua)+)?``.

    One row for each different turn of a conversation (``conv``, as text), ordered by
    ``place``: the ``edit`` of its first copy (K keep, R another role, D delete), the role
    ``given`` to it, the initials of the empty user and assistant turns inserted ``before``
    it and, at the end of a conversation, ``after`` it, and the ``cost`` of all that. The
    other ``copies`` are deleted. ``summaries`` and ``repaired`` take these rows.

    Turns are ordered by number, null first, then by role and text. The first fault of a
    turn counts: ``blank``, ``duplicate`` (role and text were there before) or
    ``truncated`` (does not end in . ! ?). Keeping costs 0, another role 2, deleting 3,
    inserting 2, and a truncated turn that stays 1; blank and duplicate turns must go. Of
    equally cheap ways the least audit wins. Null roles and texts count as one space, null
    conversations are one conversation. An empty or unknown role can't be kept. Other
    columns are not looked at; an empty table gives no rows. A conversation may have any number of turns: tasks hold a
    segment of 4096 turns, without their texts, at a time.
    """
    turns = placed(judged_turns(turns_of(df, conv_col, turn_col, role_col, text_col)))
    turns = turns.withColumn("node", F.shiftright("place", segment_bits))
    cut = turns.select("node", "conv", "place", "role", "copies", "fault")
    tables = streamed(cut.repartition("node").sortWithinPartitions("place"), segment_tables, TABLE)
    columns = ["node", "conv", "place", *ORDER, "copies", "fault", "first", "last", "ends"]
    kinds = {"turn": "bigint", "role": "string", "head": "string", "key": "binary", "copies": "bigint", "fault": "string"}
    tops = segment_tops(tables, fan_bits).withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items()})
    blank = {name: F.lit(None).cast("int") for name in ("first", "last", "ends")}
    rows = turns.withColumns(blank).select(*columns).unionByName(tops.select(*columns))
    # The tops of a segment have the place of its first turn and come before it.
    rows = rows.repartition("node").sortWithinPartitions("place", F.col("key").isNotNull())
    return streamed(rows, made_edits, EDITS)


def edits_with_texts(df: DataFrame, edits: DataFrame, names: tuple[str, str, str, str], *more: DataFrame) -> DataFrame:
    """Edits followed by the turns they are for, to be partitioned and sorted by ``PAIRED``."""
    texts = turns_of(df, *names).withColumn("kind", F.lit(2))
    rows = edits.withColumn("kind", F.lit(1)).unionByName(texts, allowMissingColumns=True)
    for markers in more:
        rows = rows.unionByName(markers, allowMissingColumns=True)
    return rows.select("conv", *ORDER, "kind", "copies", "fault", "cost", "before", "edit", "given", "after", "place", "text")


PAIRED = ["conv", *ORDER, "kind"]


def paired(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Edits, each with the text of its turn: (turn, role, copies, fault, cost, before, edit, given, after, place, text)."""
    edit = None
    for _, turn, role, _, _, kind, *rest, text in rows:
        if kind == 1:
            edit = turn, role, *rest
        elif edit is not None:
            yield *edit, text
            edit = None


def summary(conv: str | None, rows: Iterable[tuple]) -> tuple:
    """What ``summaries`` gives for one conversation, turn by turn."""
    counts = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
    illegal = cost = different = 0
    least = most = initial = None
    audit, digest, lead = [], hashlib.sha256(), ""
    for turn, role, copies, fault, paid, before, edit, given, after, _, text in paired(rows):
        if turn is not None:
            different += turn != most
            least, most = turn if least is None else least, turn
        if fault is not None:
            counts[fault] += copies if fault != TRUNCATED else 1
        if fault not in (BLANK, DUPLICATE):
            counts[DUPLICATE] += copies - 1
        illegal += copies - 1 + (initial is not None and initial + role[:1] not in ("su", "ua", "au"))
        initial = role[:1]
        cost += paid
        audit.append(INSERT * len(before) + edit + DELETE * (copies - 1) + INSERT * len(after))
        kept = [f"{GIVEN[r]}:" for r in before] + [f"{given}:{text}"] * (edit != DELETE) + [f"{GIVEN[r]}:" for r in after]
        for line in kept:
            digest.update((lead + line).encode())
            lead = "\n"
    gaps = 0 if least is None else most - least + 1 - different
    return conv, gaps, *counts.values(), illegal, cost, "".join(audit), digest.hexdigest()


SUMMARY = (
    "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def summaries(
    df: DataFrame,
    edits: DataFrame,
    conversations: DataFrame | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row for each conversation: faults, cost, audit and the digest of what it is after the edits.

    ``edits`` come from ``repair`` of the same rows. Conversations named in
    ``conversations`` that have no turns get zeros, no audit and the digest of nothing.
    ``gaps`` counts the numbers missing between the least and the greatest turn, and
    ``illegal`` the neighbours whose initials are not su, ua or au. The digest is that of
    ``role:text`` joined by line ends.

    A digest needs its turns one after the other, so a conversation is read by one task;
    nothing of it but the audit, one letter a turn, is held.
    """
    names = conv_col, turn_col, role_col, text_col
    listed = df if conversations is None else conversations
    kind = listed.schema[conv_col].dataType
    markers = listed.select(F.col(quoted(conv_col)).cast("string").alias("conv")).distinct().withColumn("kind", F.lit(0))
    rows = edits_with_texts(df, edits, names, markers).repartition("conv").sortWithinPartitions(*PAIRED)

    def summed(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, run in itertools.groupby(rows, key=lambda row: row[0]):
            yield summary(conv, run)

    return streamed(rows, summed, SUMMARY).withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv_col)


def repaired(
    df: DataFrame,
    edits: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The turns after the edits: (conv, turn, role, text, edit), to be ordered by ``place`` and ``part``.

    Inserted turns have an empty text and the number of the turn they stand by. The turns
    of a long conversation lie in many tasks.
    """
    names = conv_col, turn_col, role_col, text_col
    kind = df.schema[conv_col].dataType
    rows = edits_with_texts(df, edits, names).repartition("conv", *ORDER).sortWithinPartitions(*PAIRED)

    def turns(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, run in itertools.groupby(rows, key=lambda row: row[0]):
            for turn, _, _, _, _, before, edit, given, after, place, text in paired(run):
                made = [(GIVEN[r], "", INSERT) for r in before] + [(given, text, edit)] * (edit != DELETE)
                for part, one in enumerate(made + [(GIVEN[r], "", INSERT) for r in after]):
                    yield conv, turn, *one, place, part

    schema = "conv string, turn bigint, role string, text string, edit string, place bigint, part int"
    return streamed(rows, turns, schema).withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv_col)
