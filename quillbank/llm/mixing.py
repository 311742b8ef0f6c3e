"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints
from quillbank.llm.text import whole

#: Masses are whole numbers of this part of a word, so transfers lose nothing.
UNIT = 1 << 20
#: Documents that one array fold rounds; the tree's fan-in.
FAN_IN = 128


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, n, target``: ``share`` of all words dealt by weight, at most ``most`` times each source.

    Sources take the weights in turn by code point, null last. The final targets are
    ``min(most * size, level * weight)``; the level is found from running sums over the sources, ordered by
    ``most * size / weight``. Only the table of sources, one row each, is ordered in one place.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int")))
    by = by.withColumn("top", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("top") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    up_to, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    free = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("top").over(up_to), F.lit(0.0))
    # the level if just the sources before this one were full; the first that stays below its top sets it
    by = by.withColumn("level", free / F.sum("w").over(after))
    # (levels fall from there on, so it is the largest that does)
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(Window.partitionBy())
    target = F.least("top", F.coalesce(level, F.lit(float("inf"))) * F.col("w"))
    return by.select("source", F.col("source_size").cast("long").alias("source_size"), "n", target.alias("target"))


def _fold(items: Column, seed: int) -> Column:
    """Round an array of ``(id, copy, size, .., base, s, m)`` but for one: mass ``m`` of a possible ``s`` moves between the carried and the next item.

    Moving up fills the carried item or empties the next; moving down the reverse; odds keep each expectation.
    """
    none = "cast(null as struct<id:bigint,copy:bigint,size:bigint,source_size:bigint,target:double,base:bigint,s:bigint,m:bigint>)"
    done = "cast(array() as array<struct<id:bigint,copy:bigint,size:bigint,source_size:bigint,target:double,base:bigint,s:bigint,m:bigint>>)"

    def step(acc: Column, x: Column) -> Column:
        c = acc["carry"]
        up, down = F.least(c["s"] - c["m"], x["m"]), F.least(c["m"], x["s"] - x["m"])
        # 52 bits of a hash of both ids, both masses and the seed: the same in each rerun
        draw = F.shiftrightunsigned(F.xxhash64(c["id"], c["copy"], x["id"], x["copy"], c["m"], x["m"], F.lit(seed)), 12).cast("double") / float(1 << 52)
        moved = F.when(draw * (up + down) < down, up).otherwise(-down)
        c2, x2 = c.withField("m", c["m"] + moved), x.withField("m", x["m"] - moved)
        both = F.transform(F.array(F.struct(c2.alias("c"), x2.alias("x"))), lambda p: p)
        pair = F.transform(both, lambda p: F.struct(
            F.filter(F.array(p["c"], p["x"]), lambda y: (y["m"] > 0) & (y["m"] < y["s"])).alias("open"),
            F.filter(F.array(p["c"], p["x"]), lambda y: (y["m"] <= 0) | (y["m"] >= y["s"])).alias("shut")))
        next_ = F.transform(pair, lambda p: F.struct(F.get(p["open"], F.lit(0)).alias("carry"), F.concat(acc["done"], p["shut"]).alias("done")))
        return F.when(c.isNull(), F.struct(x.alias("carry"), acc["done"].alias("done"))).otherwise(F.get(next_, F.lit(0)))

    return F.aggregate(items, F.struct(F.expr(none).alias("carry"), F.expr(done).alias("done")), step)


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 7) -> DataFrame:
    """Choose how many words of each document a mix takes: ``id, size, source_size, target, taken``, a row per input row.

    A document of a source whose target is ``f`` times its size is due ``f`` copies: ``floor(f)`` whole ones, and one
    more by pivotal rounding of the rest. Words are the mass: a transfer leaves the sum of a pair unchanged, so a
    source keeps its target through the whole reduction tree. Blocks of about ``FAN_IN`` documents, dealt by a hash
    within a source (a source with a third of all rows is just more blocks), are folded; the one document that each
    leaves open enters the next level. The last open document of a source gives only its open number of words, so a
    source's words differ from its target by less than a word and rounding of masses.

    Null text: size 0, nothing taken. A null source is a source of its own. Reruns agree: all draws are hashes of ids
    and masses. Rows that repeat an id are rounded one by one. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    use_checkpoints(spark)
    sizes = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(source).alias("source"), F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"))
    # rows that repeat an id are told apart by a number, so that they are dealt over blocks like any other
    sizes = sizes.groupBy("id", "source", "size").agg(F.count("*").alias("rows")).select("id", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy")).checkpoint()
    targets = source_targets(sizes, weights, share, most)
    due = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.least(F.floor(copies), F.lit(most)).cast("long")
    mass = F.floor((F.col("f") - F.col("base")) * F.col("size") * UNIT).cast("long")
    due = due.withColumn("f", copies).withColumn("base", base).withColumn("s", F.col("size") * UNIT).withColumn("m", F.greatest(F.lit(0).cast("long"), F.least(F.col("s"), mass)))
    item = F.struct("id", "copy", "size", "source_size", "target", "base", "s", "m")
    level = due.select("source", item.alias("item"), (F.col("n") / FAN_IN).alias("blocks"))
    shut = level.filter("item.m <= 0 or item.m >= item.s").select("item")
    level = level.filter("item.m > 0 and item.m < item.s")
    done = [shut]
    rows, depth = targets.agg(F.max("n")).first()[0] or 0, 0
    while rows:
        depth += 1
        block = F.pmod(F.xxhash64("item.id", "item.copy", F.lit(seed + depth)), F.greatest(F.lit(1), F.ceil("blocks")).cast("long"))
        folded = level.groupBy("source", block.alias("block")).agg(F.array_sort(F.collect_list("item")).alias("items"), F.max("blocks").alias("blocks"))
        folded = folded.select("source", "blocks", _fold(F.col("items"), seed).alias("r")).select("source", "blocks", "r.*").checkpoint()
        done.append(folded.select(F.explode("done").alias("item")))
        open_ = folded.filter("carry is not null")
        if rows <= FAN_IN:
            done.append(open_.select(F.col("carry").alias("item")))
            break
        level = open_.select("source", F.col("carry").alias("item"), (F.col("blocks") / FAN_IN).alias("blocks"))
        rows = -(-rows // FAN_IN)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    taken = F.col("item.base") * F.col("item.size") + F.round(F.col("item.m") / UNIT).cast("long")
    return out.select("item.id", "item.size", "item.source_size", "item.target", F.least(taken, most * F.col("item.size")).alias("taken"))
