"""Chat formatting by minimum-cost role repair.

A legal conversation is a path of an automaton: start, an optional system turn, then user and assistant in turn,
ending with the assistant. Each turn is kept, given another role, merged into the turn before, or put behind an
inserted empty turn; dynamic programming finds the cheapest sequence of such repairs. Turns are ranked by range
partitions and cut into blocks of equal numbers of ranks. A block acts on the states as a min-plus matrix, and so does a
run of blocks, so a conversation of any length is solved in levels: matrices upwards, the states between them downwards,
then the repairs inside each block. Only roles go through these steps; texts join their repairs at the end.

The result has one row for each turn and each inserted turn; ``rendered`` pieces in order are the chat.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.llm import common

#: States are the role of the turn before; START has none.
ROLES = ("system", "user", "assistant")
START = 3
LEGAL = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
ALIASES = {"system": 0, "developer": 0, "user": 1, "human": 1, "prompter": 1, "assistant": 2, "bot": 2, "gpt": 2, "model": 2, "ai": 2}
RELABEL, RELABEL_UNKNOWN, MERGE, INSERT = 1.0, 0.4, 0.6, 0.8
INF = float("inf")
#: Blank signs that may surround a role.
BLANKS = " \t\n\r\x0b\x0c"
#: Blocks, or runs of blocks, that one step of a level takes.
FAN = 512


def role_number(role: str | None) -> int | None:
    return ALIASES.get((role or "").strip(BLANKS).lower())


def label_cost(role: int | None, to: int) -> float:
    return 0.0 if role == to else RELABEL_UNKNOWN if role is None else RELABEL


def steps(role: int | None) -> list[tuple[int, int, float, str, tuple[int, ...]]]:
    """(from, to, cost, action, inserted roles) by which a turn can be taken; cheaper kinds of action first."""
    out = []
    for state in (START, 0, 1, 2):
        for to in range(3):
            cost = label_cost(role, to)
            kind = "keep" if role == to else "relabel"
            if to in LEGAL[state]:
                out.append((state, to, cost, kind, ()))
            if state == to:
                out.append((state, to, cost + MERGE, "merge", ()))
            for x in LEGAL[state]:
                if to in LEGAL[x]:
                    out.append((state, to, cost + INSERT, kind, (x,)))
    return out


_STEPS = {role: steps(role) for role in (None, 0, 1, 2)}
#: Cost to end after each state, and what is inserted for that.
ENDING = {0: (2 * INSERT, (1, 2)), 1: (INSERT, (2,)), 2: (0.0, ()), START: (INF, ())}


def matrix(roles: list[int | None]) -> list[list[float]]:
    """Min-plus matrix of a block: the cheapest way from each state to each."""
    rows = []
    for start in range(4):
        cost = [INF] * 4
        cost[start] = 0.0
        for role in roles:
            after = [INF] * 4
            for a, b, c, _, _ in _STEPS[role]:
                if cost[a] + c < after[b]:
                    after[b] = cost[a] + c
            cost = after
        rows.append(cost)
    return rows


def product(found: list[list[float]]) -> list[float]:
    """Min-plus product of flat matrices in order."""
    out = [0.0 if a == z else INF for a in range(4) for z in range(4)]
    for m in found:
        out = [min(out[4 * a + x] + m[4 * x + z] for x in range(4)) for a in range(4) for z in range(4)]
    return out


def states_between(found: list[list[float]], entry: int, leave: int | None) -> list[tuple[int, int]]:
    """State before and after each of some matrices on the cheapest way from ``entry`` to ``leave`` (none: the cheapest end)."""
    cost, trail = [INF] * 4, []
    cost[entry] = 0.0
    for m in found:
        ways = [min((cost[a] + m[4 * a + z], a) for a in range(4)) for z in range(4)]
        trail.append([w[1] for w in ways])
        cost = [w[0] for w in ways]
    state = min(range(4), key=lambda z: (cost[z] + ENDING[z][0], z)) if leave is None else leave
    out = []
    for back in reversed(trail):
        out.append((back[state], state))
        state = back[state]
    return out[::-1]


def repair(roles: list[int | None], entry: int, last: int) -> list[tuple[int, str, tuple[int, ...]]]:
    """Role, action and inserted roles of each turn on the cheapest way from one state to another."""
    cost = [INF] * 4
    cost[entry] = 0.0
    trail = []
    for role in roles:
        after, back = [INF] * 4, [None] * 4
        for step in _STEPS[role]:
            if (c := cost[step[0]] + step[2]) < after[step[1]]:
                after[step[1]], back[step[1]] = c, step
        trail.append(back)
        cost = after
    out, state = [], last
    for back in reversed(trail):
        step = back[state]
        out.append((step[1], step[3], step[4]))
        state = step[0]
    return out[::-1]


def ranked(turns: DataFrame, piece: int) -> tuple[DataFrame, DataFrame]:
    """The turns in order, as (at, conv_id, turn, role, text, copies), and (at, conv_id, kind, rank).

    ``at`` rises with conversation and order and tells turns apart, ``kind`` is the number of a known role, ``rank`` counts a
    conversation's turns from 0. Ranks come from sorted range partitions of about ``piece`` rows and the sizes of those before.
    """
    # Of turns without a number even exact copies are turns of their own; where they were read tells them apart.
    copy = F.when(F.col("turn").isNull(), F.monotonically_increasing_id()).alias("copy")
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"), copy)
    rows = common.written(rows, "chat-turns")
    pieces = 1 + rows.count() // piece
    rows = rows.groupBy("conv_id", "turn", "role", "text", "copy").agg(F.count("*").alias("copies"))
    rows = rows.withColumns({"late": F.col("turn").isNull(), "h": F.xxhash64("text")})
    order = ["conv_id", "late", "turn", "role", "h", "copy"]
    rows = rows.repartitionByRange(pieces, *order).sortWithinPartitions(*order, "text").withColumn("at", F.monotonically_increasing_id())
    rows = common.written(rows.select("at", "conv_id", "turn", "role", "text", "copies"), "chat-order")

    aliases = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    kind = aliases[F.lower(F.btrim("role", F.lit(BLANKS)))].alias("kind")
    short = rows.select("at", F.shiftright("at", 33).alias("piece"), "conv_id", kind)  # the id of a partition, as Spark documents it
    sizes = short.groupBy("conv_id", "piece").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"))
    placed = short.join(sizes, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p")))
    return rows, placed.select("at", "conv_id", "kind", (F.col("at") + F.col("shift")).alias("rank"))


def block_states(blocks: DataFrame, fan: int) -> DataFrame:
    """(c, b, entry, exit, last): the states before and after each (conv_id, block) of ``blocks``, which has its turns' ``kinds``.

    Matrices of ``fan`` neighbours are multiplied until a conversation has at most ``fan`` of them; then states go down level by level.
    """
    conv = dict(blocks.dtypes)["conv_id"]

    def to_matrix(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            flat = [[x for row in matrix(kinds) for x in row] for kinds in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(flat, pa.list_(pa.float64()))], names=["conv_id", "block", "m"])

    def multiply(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            flat = [product([b["m"] for b in found]) for found in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(flat, pa.list_(pa.float64()))], names=["conv_id", "block", "m"])

    def spread(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            out = []
            for conv_id, found, entry, leave, last in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                ways = states_between([b["m"] for b in found], entry, leave)
                out += [(conv_id, b["block"], *way, last and b is found[-1]) for b, way in zip(found, ways, strict=True)]
            kinds = (batch.column(0).type, pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["c", "b", "entry", "exit", "last"])

    def listed(level: DataFrame) -> DataFrame:  # at most ``fan`` matrices a row
        run = F.floor(F.col("block") / fan).alias("block")
        return level.groupBy("conv_id", run).agg(F.sort_array(F.collect_list(F.struct("block", "m"))).alias("found"))

    schema = f"conv_id {conv}, block long, m array<double>"
    levels = [common.written(blocks.select("conv_id", "block", "kinds").mapInArrow(to_matrix, schema), "chat-matrices")]
    top = blocks.agg(F.max("block")).first()[0] or 0
    while top >= fan:
        top //= fan
        levels.append(common.written(listed(levels[-1]).mapInArrow(multiply, schema), "chat-matrices"))
    states = None
    for level in reversed(levels):
        runs = listed(level)
        if states is None:
            asked = runs.select("conv_id", "found", F.lit(START).alias("entry"), F.lit(None).cast("int").alias("exit"), F.lit(True).alias("last"))
        else:
            same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
            asked = runs.join(states, same).select("conv_id", "found", "entry", "exit", "last")
        states = asked.mapInArrow(spread, f"c {conv}, b long, entry int, exit int, last boolean")
    return states


def formatted(turns: DataFrame, block: int = 512, start: str = "<|im_start|>", end: str = "<|im_end|>", piece: int = 1 << 16, fan: int = FAN) -> DataFrame:
    """(conv_id, block, place, turn, role_was, role, action, text, rendered, copies) of all turns, repaired.

    Turns go by ``turn``, then role, then a hash of the text; null turns come last, each a turn of its own. Exact repetitions of
    a numbered turn are one turn, whose ``copies`` counts them. A null text is empty, a null or unknown role may become any. Conversations
    with a null id are one conversation, of any size. ``place`` orders the rows inside a ``block`` of ranks, blocks go by number. Concatenated,
    ``rendered`` gives ``start`` + role + newline + text + ``end`` + newline for each turn; a merged turn continues the one before after a newline.
    Other columns are ignored. ``piece``: turns that a task ranks; ``fan``: matrices that a step takes.
    """
    spark = turns.sparkSession
    common.small_batches(spark)
    rows, placed = ranked(turns, piece)
    of_block = F.sort_array(F.collect_list(F.struct("at", "kind"))).alias("turns")  # of ``block`` ranks, without texts
    blocks = placed.groupBy("conv_id", F.floor(F.col("rank") / block).alias("block")).agg(of_block)
    blocks = common.written(blocks.select("conv_id", "block", F.col("turns.at").alias("ats"), F.col("turns.kind").alias("kinds")), "chat-blocks")
    states = block_states(blocks, fan)
    both = blocks.join(states, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))

    def to_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            out = []
            for conv, number, ats, kinds, entry, leave, last in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                made = []
                for at, (role, action, inserted) in zip(ats, repair(kinds, entry, leave), strict=True):
                    made += [(at, x, "insert") for x in inserted] + [(at, role, action)]
                if last:
                    made += [(ats[-1], x, "insert") for x in ENDING[leave][1]]
                for place, (at, role, action) in enumerate(made):
                    opened = action != "merge" and (place > 0 or entry != START)
                    out.append((conv, number, place, at, ROLES[role], action, opened, last and place == len(made) - 1))
            kinds = (batch.column(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
            names = ["conv_id", "block", "place", "at", "role", "action", "opened", "closes"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    schema = f"conv_id {dict(blocks.dtypes)['conv_id']}, block long, place long, at long, role string, action string, opened boolean, closes boolean"
    fixed = both.select("conv_id", "block", "ats", "kinds", "entry", "exit", "last").mapInArrow(to_rows, schema)
    texts = rows.select("at", "turn", F.col("role").alias("role_was"), "text", "copies")
    own = F.col("action") != "insert"
    text = F.when(own, F.col("text")).otherwise("")
    close = F.lit(f"{end}\n")
    head = F.concat(F.when(F.col("opened"), close).otherwise(""), F.lit(start), "role", F.lit("\n"))
    rendered = F.concat(F.when(F.col("action") == "merge", F.lit("\n")).otherwise(head), text, F.when(F.col("closes"), close).otherwise(""))
    return fixed.join(texts, "at").select(
        "conv_id",
        "block",
        "place",
        F.when(own, F.col("turn")).alias("turn"),
        F.when(own, F.col("role_was")).alias("role_was"),
        "role",
        "action",
        text.alias("text"),
        rendered.alias("rendered"),
        F.when(own, F.col("copies")).otherwise(0).alias("copies"),
    )
