"""Merkle manifest of a data set: hashed rows, one tree per group, one tree over the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints

#: Characters of a digest in hex, and of a step of a path: a side and the sibling's digest.
HEX, STEP = 64, 65
#: Sides of a step: the sibling stands before the node, after it, or there is none (the node is hashed alone).
BEFORE, AFTER, ALONE = "<", ">", "."


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value: no two rows are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest of a row: of its fields one after the other."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _parents(level: Column) -> Column:
    """The next level of a level: digests of fixed-width substrings of two nodes each, the last of one if the count is odd."""
    pairs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / F.lit(2 * HEX)).cast("int"))
    return F.array_join(F.transform(pairs, lambda i: F.sha2(F.substr(level, i * 2 * HEX + 1, F.lit(2 * HEX)), 256)), "")


def _below(k: Column, total: Column) -> Column:
    """Whether several of ``total`` nodes remain at level ``k``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), k) < total


def _levels(first: Column, total: Column, levels: int) -> Column:
    """The block's levels, from its nodes to its root, as hex strings; levels end where the whole tree does."""
    step = lambda made, k: F.when(_below(k, total), F.concat(made, F.array(_parents(F.element_at(made, -1))))).otherwise(made)
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), F.array(first), step)


def _segment(at: Column, made: Column, total: Column, levels: int) -> Column:
    """Steps from node ``at`` of a block to the block's root, cut from the flanks of the node's substring at each level."""

    def step(k: Column) -> Column:
        here = F.call_function("shiftright", at, k)
        other = F.substr(F.element_at(made, k + 1), here.bitwiseXOR(F.lit(1)) * HEX + 1, F.lit(HEX))
        side = F.when(here.bitwiseAND(F.lit(1)) == 1, BEFORE).otherwise(AFTER)
        return F.when(other == "", F.lit(ALONE * STEP)).otherwise(F.concat(side, other))

    return F.array_join(F.transform(F.filter(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: _below(k, total)), step), "")


def fold(node: Column, path: Column) -> Column:
    """The root that a node and the siblings of its path give."""

    def up(got: Column, k: Column) -> Column:
        side, other = F.substr(path, k * STEP + 1, F.lit(1)), F.substr(path, k * STEP + 2, F.lit(HEX))
        return F.sha2(F.when(side == BEFORE, F.concat(other, got)).when(side == AFTER, F.concat(got, other)).otherwise(got), 256)

    return F.when(path == "", node).otherwise(F.aggregate(F.sequence(F.lit(0), (F.length(path) / STEP).cast("int") - 1), node, up))


def siblings(path: Column) -> Column:
    """The digests of a path, level by level, one after the other."""
    return F.translate(path, BEFORE + AFTER + ALONE, "")


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos`` and ``total``: the row's place in its group ``g`` by ``order``, and the group's size.

    Rows are dealt by ranges of (group, order), so that a large group takes many tasks, and numbered within their
    task; a group's rows before a task are sums over at most one row per task and group.
    """
    spark = nodes.sparkSession
    salted = nodes.withColumn("salt", F.monotonically_increasing_id())
    keys = ["grp", *order, "salt"]
    dealt = salted.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys).drop("salt")
    dealt = dealt.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()).checkpoint()
    parts = dealt.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("g", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"), F.sum("n").over(Window.partitionBy("g")).alias("total"))
    return dealt.join(parts, ["g", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("earlier")).drop("at", "part", "first", "earlier")


def _climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every round, each with its nodes and levels, and the root of each group.

    Input: ``g, grp, pos, total, node`` and whatever else travels with a node. A block holds ``2^levels`` neighbours of
    a group; its root is a node of the next round, until each group has one node.
    """
    rounds, other = [], [c for c in nodes.columns if c not in ("g", "grp", "pos", "total", "node")]
    while True:
        held = F.struct("pos", "node", *other)
        blocks = nodes.groupBy("g", "grp", F.call_function("shiftright", F.col("pos"), F.lit(levels)).alias("block")).agg(F.array_sort(F.collect_list(held)).alias("nodes"), F.max("total").alias("total"))
        blocks = blocks.withColumn("made", _levels(F.array_join(F.transform("nodes", lambda x: x["node"]), ""), F.col("total"), levels)).checkpoint()
        rounds.append(blocks)
        size = 1 << levels
        nodes = blocks.select("g", "grp", F.col("block").alias("pos"), F.ceil(F.col("total") / F.lit(size)).cast("long").alias("total"), F.element_at("made", -1).alias("node"))
        other = []
        # one number for all groups: whether any has more than one block
        if not nodes.filter("total > 1").limit(1).count():
            return rounds, nodes.select("g", "grp", "node")


def _paths(rounds: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """Nodes of the first round with ``path``, from blocks of the last round downwards; ``top``: ``g`` and its own ``path``."""
    above = rounds[-1].join(top, "g")
    for k in range(len(rounds) - 1, -1, -1):
        steps = above.select("*", F.explode("nodes").alias("x"))
        at = (F.col("x.pos") - F.call_function("shiftleft", F.col("block"), F.lit(levels))).cast("int")
        found = steps.withColumn("path", F.concat(_segment(at, F.col("made"), F.col("total"), levels), F.col("path"))).drop("nodes", "made", "block", "total")
        if not k:
            return found
        above = rounds[k - 1].join(found.select("g", F.col("x.pos").alias("block"), *[c for c in found.columns if c not in ("g", "grp", "x")]), ["g", "block"])
    raise AssertionError


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), keep: dict[str, Column] | None = None, levels: int = 8) -> DataFrame:
    """One row per input row: ``id, grp, leaf, subroot, root, path`` and the columns of ``keep``.

    A row's leaf is the digest of its ``fields``. Per ``group`` leaves ascend by ``doc_id`` (as a number, null first;
    rows that repeat an id by leaf); two neighbours become the digest of their hex digests, a last odd one that of its
    own alone, until one is left: the ``subroot``. Subroots by group (null first, bytewise) give ``root`` likewise.
    ``path`` holds a step of ``STEP`` characters for each level from the leaf to the root: ``fold(leaf, path)`` is the
    root, ``siblings(path)`` the proof. Whoever holds a row, its path and the root can check the row without the rest.

    Blocks of ``2^levels`` aligned leaves keep each level as one hex string: parents are digests of fixed-width
    substrings, siblings the substrings beside. Block roots are the nodes of the next round, so one round is needed for
    every ``levels`` levels. Texts are read twice (ranges, leaves) and never shuffled; leaves are shuffled twice.

    Nulls in any field are ``-``; an empty text is ``0:``. Repeated rows are leaves of their own, with paths of their
    own. A group of one leaf has the leaf as its subroot. An empty table gives an empty result. Columns that aren't
    ``fields`` don't matter, whatever their names. ``n_chars`` and other numbers are written in decimal.
    """
    use_checkpoints(docs.sparkSession)
    kept = {f"keep_{k}": v for k, v in (keep or {}).items()}
    base = docs.select(field(F.col(f"`{group}`")).alias("g"), F.col(f"`{group}`").cast("string").alias("grp"), F.col(f"`{doc_id}`").alias("id"), leaf(*[F.col(f"`{c}`") for c in fields]).alias("node"), *[v.alias(k) for k, v in kept.items()])
    rounds, subroots = _climb(_placed(base, ["id", "node"]), levels)
    groups = subroots.select(F.lit("").alias("g"), F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("g").alias("of"), "node").checkpoint()
    over, roots = _climb(_placed(groups, ["name"]), levels)
    top = _paths(over, roots.select("g", F.col("node").alias("root"), F.lit("").alias("path")), levels)
    top = top.select(F.col("x.of").alias("g"), F.col("x.node").alias("subroot"), "root", "path").checkpoint()
    found = _paths(rounds, top, levels)
    return found.select(F.col("x.id").alias("id"), "grp", F.col("x.node").alias("leaf"), "subroot", "root", "path", *[F.col(f"x.{k}").alias(k.removeprefix("keep_")) for k in kept])
