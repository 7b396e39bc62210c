"""Prefix trie of conversations: a z-fast trie over turns, filled in batches.

A prefix is known by its depth and a 128-bit key, the exclusive or of a hash of each of its turns and its place. The trie is compacted:
a node stands for the edge above it, (low, high] in turns. In the dictionary a node lies under its handle: the depth in (low, high] that
the highest power of two divides, with the key of that prefix. So a fat binary search finds where a sequence leaves the
trie with a logarithmic number of look-ups, each a join. Edges end at multiples of BLOCK, so sequences of any length are
cut into units of bounded size, which enter the trie side by side.

A batch: every unit that is not in the trie yet is located; of those that leave at one place by one turn, one enters as a
new leaf, edges are split where units left them, and the others look on from there. Which one enters is up to a hash, so the
batches are about as many as the logarithm of the units. What is asked of a subtree is summed by doubling the way to
the ancestors; at the end the edges are expanded to one row for each prefix.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.llm import common
from ledgerforge.operators.browse import in_pieces

#: Turns of an edge at most; a power of two.
BLOCK = 512
_KEY = "struct<k1: bigint, k2: bigint, chars: bigint>"
_NODES = f"low bigint, low_at {_KEY}, high bigint, labels array<{_KEY}>"


def two_fattest(low: Column, high: Column) -> Column:
    """The number over ``low`` and up to ``high`` that the highest power of two divides; ``low`` is under ``high``."""
    bits = F.length(F.bin(low.bitwiseXOR(high)))
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), bits - 1))


def ranked(turns: DataFrame, piece: int = 1 << 16) -> DataFrame:
    """(conv_id, rank, role, digest, chars): turns from 0 by number (null first), then role, then digest of the text, by range pieces, so that
    no conversation is one task. Null roles and texts are empty; repeated rows are turns each; turns of no conversation are left out."""
    text = F.coalesce("text", F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.md5(text.cast("binary")).alias("digest"), F.length(text).cast("long").alias("chars"))
    held = in_pieces(rows.where("conv_id is not null"), ["conv_id", "turn", "role", "digest"], piece)
    sizes = held.groupBy(F.col("conv_id").alias("c"), F.col("_piece").alias("p")).agg(F.min("_at").alias("low"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("c", "p", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"))
    placed = held.join(sizes, (F.col("conv_id") == F.col("c")) & (F.col("_piece") == F.col("p")))
    return common.written(placed.select("conv_id", (F.col("_at") + F.col("shift")).alias("rank"), "role", "digest", "chars"), "ranked-turns")


def rebuilt(turns: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(steps, convs): each conversation c as the first h turns of conversation c - c % ``every``, then its own after its first h, h being the
    hash of c modulo ``heads``. Steps are (conv_id, depth, role, digest, chars), depth from 1; convs are (conv_id)."""
    rows = ranked(turns)
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    c = F.col("conv_id")
    convs = sizes.select("conv_id", (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"), (c - c % every).alias("base"))
    known = convs.join(sizes.select(c.alias("base"), F.col("n").alias("base_n")), "base", "left")
    known = common.written(known.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))), "conversations")
    own = rows.join(known.select("conv_id", "h", "taken"), "conv_id").where("rank >= h")
    own = own.select("conv_id", (F.col("taken") + F.col("rank") - F.col("h") + 1).alias("depth"), "role", "digest", "chars")
    first = rows.where((c % every == 0) & (F.col("rank") < heads - 1)).withColumnRenamed("conv_id", "base")
    lent = first.join(known.select("conv_id", "h", "base"), "base").where("rank < h")
    lent = lent.select("conv_id", (F.col("rank") + 1).alias("depth"), "role", "digest", "chars")
    return common.written(own.unionByName(lent), "steps"), known.select("conv_id")


def prefixes(steps: DataFrame, piece: int = 1 << 16) -> DataFrame:
    """(conv_id, depth, at): the key of each prefix and the code points of its turns, as running sums by range pieces."""
    named = steps.select("conv_id", "depth", F.xxhash64("depth", "role", "digest").alias("k1"), F.xxhash64(F.lit(1), "depth", "role", "digest").alias("k2"), "chars")
    held = in_pieces(named, ["conv_id", "depth"], piece)
    sums = {"k1": F.bit_xor, "k2": F.bit_xor, "chars": F.sum}
    inside = Window.partitionBy("_piece", "conv_id").orderBy("depth")
    before = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    ends = held.groupBy(F.col("conv_id").alias("c"), F.col("_piece").alias("p")).agg(*[f(x).alias(x) for x, f in sums.items()])
    ends = ends.select("c", "p", *[F.coalesce(f(x).over(before), F.lit(0)).alias(f"_{x}") for x, f in sums.items()])
    run = held.select("conv_id", "_piece", "depth", *[f(x).over(inside).alias(x) for x, f in sums.items()])
    both = run.join(ends, (F.col("conv_id") == F.col("c")) & (F.col("_piece") == F.col("p")))
    at = F.struct(F.col("k1").bitwiseXOR(F.col("_k1")).alias("k1"), F.col("k2").bitwiseXOR(F.col("_k2")).alias("k2"), (F.col("chars") + F.col("_chars")).alias("chars"))
    return common.written(both.select("conv_id", "depth", at.alias("at")), "prefixes")


def _root() -> Column:
    return F.struct(*[F.lit(0).cast("long").alias(x) for x in ("k1", "k2", "chars")])


def _units(rows: DataFrame, block: int) -> DataFrame:
    """(start, stand, stand_at, end, keys): the distinct pieces of at most ``block`` turns, from ``start``, with the keys of their prefixes."""
    number = F.floor((F.col("depth") - 1) / block)
    of = F.when(F.col("depth") % block == 0, F.array(number, number + 1)).otherwise(F.array(number))
    each = rows.select("conv_id", "depth", "at", F.explode(of).alias("b"))
    each = each.groupBy("conv_id", "b").agg(F.sort_array(F.collect_list(F.struct("depth", "at"))).alias("l"))
    later = F.col("b") > 0  # begins with the prefix that the block before ends with
    keys = F.transform(F.when(later, F.slice("l", 2, block)).otherwise(F.col("l")), lambda x: x["at"])
    each = each.select((F.col("b") * block).alias("start"), F.when(later, F.col("l")[0]["at"]).otherwise(_root()).alias("at"), keys.alias("keys")).where(F.size("keys") > 0)
    end = F.col("start") + F.size("keys")
    last = F.element_at("keys", -1)
    each = each.groupBy(end.alias("end"), last["k1"].alias("k1"), last["k2"].alias("k2")).agg(F.first(F.struct("start", "at", "keys")).alias("u"))
    return each.select("u.start", F.col("u.start").alias("stand"), F.col("u.at").alias("stand_at"), "end", "u.keys")


def _key(depth: Column) -> Column:
    """The key of a unit's prefix at a depth behind its start."""
    return F.get("keys", (depth - F.col("start") - 1).cast("int"))


def _same(a: Column, b: Column) -> Column:
    return (a["k1"] == b["k1"]) & (a["k2"] == b["k2"])


def locate(units: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """The units with ``stand``, the depth at which they leave the trie, its key, and ``edge``, the node on whose edge that lies, if it lies inside one.

    ``steps``: look-ups of the fat binary search, the binary logarithm of the longest unit and one. Afterwards one look-up tells the edge that
    begins with the next turn, and its labels are compared.
    """
    fat = two_fattest(F.col("low"), F.col("high"))
    handle = F.element_at("labels", (fat - F.col("low")).cast("int"))
    book = nodes.select(fat.alias("_f"), handle["k1"].alias("_f1"), handle["k2"].alias("_f2"), F.struct("low", "low_at", "high", F.element_at("labels", -1).alias("high_at")).alias("_n"))
    s = units.withColumn("_top", F.col("end"))
    for _ in range(steps):
        open_ = F.col("stand") < F.col("_top")
        s = s.withColumn("_at", F.when(open_, two_fattest(F.col("stand"), F.col("_top"))).otherwise(0))
        # Units that are through ask for depth 0, which has no entry, under keys of their own.
        key = F.coalesce(_key(F.col("_at")), F.element_at("keys", -1))
        s = s.withColumns({"_1": key["k1"], "_2": key["k2"]})
        s = s.join(book, (F.col("_at") == F.col("_f")) & (F.col("_1") == F.col("_f1")) & (F.col("_2") == F.col("_f2")), "left")
        hit, n = F.col("_n").isNotNull(), F.col("_n")
        whole = hit & (n["high"] <= F.col("end")) & F.coalesce(_same(_key(n["high"]), n["high_at"]), F.lit(False))
        stand = F.when(whole, n["high"]).when(hit, n["low"]).otherwise(F.col("stand"))
        stand_at = F.when(whole, n["high_at"]).when(hit, n["low_at"]).otherwise(F.col("stand_at"))
        top = F.when(whole, F.col("_top")).when(hit, n["low"]).when(F.col("_at") > 0, F.col("_at") - 1).otherwise(F.col("_top"))
        s = s.select("start", stand.alias("stand"), stand_at.alias("stand_at"), "end", "keys", top.alias("_top"))
    first = F.col("labels")[0]
    edges = nodes.select(F.col("low").alias("_l"), first["k1"].alias("_l1"), first["k2"].alias("_l2"), F.col("high").alias("_h"), "labels")
    key = F.coalesce(_key(F.col("stand") + 1), F.element_at("keys", -1))
    s = s.withColumns({"_1": key["k1"], "_2": key["k2"], "_s": F.when(F.col("stand") < F.col("end"), F.col("stand")).otherwise(-1)})
    s = s.join(edges, (F.col("_s") == F.col("_l")) & (F.col("_1") == F.col("_l1")) & (F.col("_2") == F.col("_l2")), "left")
    own = F.slice("keys", (F.col("stand") - F.col("start") + 1).cast("int"), F.size("labels"))
    agree = F.coalesce(F.size(F.filter(F.zip_with("labels", own, _same), lambda x: x)), F.lit(0))
    agree = F.when(F.col("labels").isNotNull(), agree).otherwise(0)
    s = s.withColumn("_m", agree)
    inside = (F.col("_m") > 0) & (F.col("stand") + F.col("_m") < F.col("_h"))
    last = F.element_at("labels", -1)
    edge = F.when(inside, F.struct(F.col("_h").alias("high"), last["k1"].alias("k1"), last["k2"].alias("k2")))
    at = F.when(F.col("_m") > 0, F.get("labels", F.col("_m").cast("int") - 1)).otherwise(F.col("stand_at"))
    return s.select("start", (F.col("stand") + F.col("_m")).alias("stand"), at.alias("stand_at"), "end", "keys", edge.alias("edge"))


def build(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The compacted nodes (low, low_at, high, labels) of the ``prefixes``: an edge from depth ``low`` to ``high`` with the keys of its depths."""
    spark = rows.sparkSession
    pending = common.written(_units(rows, block), "units")
    longest = pending.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 1
    steps = math.ceil(math.log2(longest)) + 1
    nodes, held = spark.createDataFrame([], _NODES), False
    while not pending.isEmpty():
        found = locate(pending, nodes, steps) if held else pending.withColumn("edge", F.lit(None).cast("struct<high: bigint, k1: bigint, k2: bigint>"))
        found = common.written(found, "exits")
        left, next_, end = found.where("stand < end"), _key(F.col("stand") + 1), F.element_at("keys", -1)
        one = F.struct(end["k1"].alias("order"), "start", "end", "stand_at", "keys")
        leaves = left.groupBy("stand", F.col("stand_at.k1").alias("s1"), F.col("stand_at.k2").alias("s2"), next_["k1"].alias("n1"), next_["k2"].alias("n2")).agg(F.min(one).alias("u"))
        keys = F.slice("u.keys", (F.col("stand") - F.col("u.start") + 1).cast("int"), (F.col("u.end") - F.col("stand")).cast("int"))
        leaves = leaves.select(F.col("stand").alias("low"), F.col("u.stand_at").alias("low_at"), F.col("u.end").alias("high"), keys.alias("labels"))
        leaves = common.written(leaves, "leaves")
        if held:
            cuts = found.where("edge is not null").groupBy("edge.high", "edge.k1", "edge.k2").agg(F.collect_set("stand").alias("cuts"))  # under BLOCK of them
            last = F.element_at("labels", -1)
            named = nodes.select("*", last["k1"].alias("k1"), last["k2"].alias("k2")).join(cuts, ["high", "k1", "k2"], "left")
            stops = F.array_sort(F.concat(F.coalesce("cuts", F.array().cast("array<bigint>")), F.array("high")))
            named = named.withColumn("stops", stops).select("*", F.posexplode("stops").alias("i", "stop"))
            named = named.withColumn("begin", F.when(F.col("i") == 0, F.col("low")).otherwise(F.get("stops", F.col("i") - 1)))
            begin_at = F.when(F.col("i") == 0, F.col("low_at")).otherwise(F.get("labels", (F.col("begin") - F.col("low") - 1).cast("int")))
            part = F.slice("labels", (F.col("begin") - F.col("low") + 1).cast("int"), (F.col("stop") - F.col("begin")).cast("int"))
            cut = named.select(F.col("begin").alias("low"), begin_at.alias("low_at"), F.col("stop").alias("high"), part.alias("labels"))
            leaves_and_nodes = cut.unionByName(leaves)
        else:
            leaves_and_nodes = leaves
        nodes, held = common.written(leaves_and_nodes, "trie-nodes"), True
        entered = F.element_at("labels", -1)
        entered = leaves.select(F.col("high").alias("end"), entered["k1"].alias("e1"), entered["k2"].alias("e2"))
        left = left.withColumns({"e1": end["k1"], "e2": end["k2"]}).join(entered, ["end", "e1", "e2"], "left_anti")
        pending = left.select("start", "stand", "stand_at", "end", "keys")
    return nodes


def _summed(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """(id, up, n, conv, spent, chars, leaves, children): of each node what its subtree holds. ``up`` is the parent, null for the root."""
    name = lambda depth, at: F.struct(depth.alias("depth"), at["k1"].alias("k1"), at["k2"].alias("k2"))
    last = F.element_at("labels", -1)
    base = nodes.select(name(F.col("high"), last).alias("id"), F.when(F.col("low") > 0, name(F.col("low"), F.col("low_at"))).alias("up"), last["chars"].alias("_c"), (last["chars"] - F.col("low_at.chars")).alias("chars"))
    children = base.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.count("*").alias("children"))
    base = base.join(ends.select("id", "n", "conv"), "id", "left").join(children, "id", "left")
    n, children = F.coalesce("n", F.lit(0)), F.coalesce("children", F.lit(0))
    now = base.select("id", "up", F.col("up").alias("far"), n.alias("n"), "conv", (n * F.col("_c")).alias("spent"), "chars", (children == 0).cast("long").alias("leaves"), children.alias("children"))
    now = common.written(now, "subtrees")
    sums = ("n", "spent", "chars", "leaves")
    while not now.where("far is not null").isEmpty():
        # What the nodes at the distance reached so far, a power of two, hold themselves comes to their ancestor there.
        more = now.where("far is not null").groupBy(F.col("far").alias("id")).agg(*[F.sum(x).alias(f"_{x}") for x in sums], F.min("conv").alias("_conv"))
        further = now.select(F.col("id").alias("far"), F.col("far").alias("_far"))
        now = now.join(more, "id", "left").join(further, "far", "left")
        now = now.select("id", "up", F.col("_far").alias("far"), *[(F.col(x) + F.coalesce(f"_{x}", F.lit(0))).alias(x) for x in sums], F.least("conv", "_conv").alias("conv"), "children")
        now = common.written(now, "subtrees")
    return now


def _digests(ends: DataFrame) -> DataFrame:
    """(id, ends): the digest of the ids, in order, that end at a node. Rows stream through in order, so a node may have any number of them."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in common.batches(stream):
            out = []
            for *name, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if name != now:
                    if now:
                        out.append((*now, digest.hexdigest()))
                    now, digest = name, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            yield of(out)
        if now:
            yield of([(*now, digest.hexdigest())])

    def of(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["depth", "k1", "k2", "ends"])

    named = ends.select("id.depth", "id.k1", "id.k2", "conv_id").repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "conv_id")
    return named.mapInArrow(run, "depth long, k1 long, k2 long, ends string")


def prefix_trie(steps: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each distinct prefix of the conversations: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``steps``: (conv_id, depth, role, digest, chars), the turns of each conversation from depth 1 without a gap; ``convs``: (conv_id), once each,
    those without turns too. ``conv_id`` is the least id of a prefix's conversations, so (conv_id, depth) names the prefix and finds its last turn; the root
    has depth 0. ``saved_tokens``: code points that are stored once in place of once for each conversation, in the subtree. ``ends_sha256``: of the ids
    that end there, ascending, comma-joined. No conversation: no row. Other columns are ignored.
    """
    common.small_batches(steps.sparkSession)
    rows = prefixes(steps)
    nodes = build(rows, block)
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2"))).alias("id"))
    zero = F.struct(*[F.lit(0).cast("long").alias(x) for x in ("depth", "k1", "k2")])
    ends = common.written(convs.join(last, "conv_id", "left").select("conv_id", F.coalesce("id", zero).alias("id")), "conversation-ends")
    at_end = ends.groupBy("id").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    sums = _summed(nodes, at_end)
    known = ends.agg(F.count("*"), F.min("conv_id")).first()
    least = F.lit(known[1]).cast("long")

    parent = sums.select(F.col("id").alias("up"), F.col("conv").alias("up_conv"))
    label = F.element_at("labels", -1)
    edges = nodes.select(F.struct(F.col("high").alias("depth"), label["k1"].alias("k1"), label["k2"].alias("k2")).alias("id"), "low", "low_at", "high", "labels")
    edges = edges.join(sums, "id").join(parent, "up", "left").withColumn("up_conv", F.coalesce("up_conv", least))
    edges = edges.withColumn("own", F.element_at("labels", -1)["chars"] - F.col("low_at.chars"))
    each = edges.select("*", F.posexplode("labels").alias("i", "at"))
    above = F.when(F.col("i") == 0, F.col("low_at.chars")).otherwise(F.get("labels", F.col("i") - 1)["chars"])
    below = F.col("chars") - F.col("own") + F.element_at("labels", -1)["chars"] - above
    inner = F.col("low") + F.col("i") + 1 < F.col("high")
    out = each.select(
        F.col("conv").alias("conv_id"),
        (F.col("low") + F.col("i") + 1).alias("depth"),
        F.when(F.col("i") == 0, F.col("up_conv")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(inner, 1).otherwise(F.col("children")).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("spent") - F.col("n") * above - below).alias("saved_tokens"),
        F.col("at.k1").alias("k1"),
        F.col("at.k2").alias("k2"),
    )
    top = sums.where("up is null").agg(F.count("*").alias("children"), F.coalesce(F.sum("leaves"), F.lit(1)).alias("leaves"), F.coalesce(F.sum(F.col("spent") - F.col("chars")), F.lit(0)).alias("saved"))
    none = F.lit(0).cast("long")
    root = top.select(least.alias("conv_id"), none.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(known[0]).alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), none.alias("k1"), none.alias("k2"))
    out = out.unionByName(root.where(F.lit(known[0] > 0)))
    out = out.join(_digests(ends), ["depth", "k1", "k2"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"))
