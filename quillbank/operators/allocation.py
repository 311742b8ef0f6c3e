"""Quotas, sampling and withdrawal under coverage limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints
from quillbank.operators.verdicts import first_per_group, hash_order


def examples_with_fallback(rows: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """Up to ``n`` rows per group: its own first, then others, by id. Only ``n`` rows of the pool are needed for the rest, so no group meets the whole pool."""
    own = first_per_group(rows, ["category"], [F.col("item_id")], n).drop("rank")
    # the first 2n of all: tasks keep 2n rows each, and no more meet
    pool = own.orderBy("item_id", "category").limit(2 * n).select(F.col("category").alias("from_category"), "item_id")
    mine = groups.join(own, "category").select("category", F.lit(0).alias("tier"), "item_id")
    other = groups.crossJoin(F.broadcast(pool)).filter("category <> from_category").select("category", F.lit(1).alias("tier"), "item_id")  # 2n rows, whatever the pool's size
    return first_per_group(mine.union(other), ["category"], [F.col("tier"), F.col("item_id")], n).select("category", "tier", "item_id", "rank")


def evenly_spaced(rows: DataFrame, by: str, order: str, k: int) -> DataFrame:
    """``k`` rows per group at ``round(i * (n - 1) / (k - 1))``, halves to even; all rows if there are no more than ``k``."""
    w = Window.partitionBy(by)
    r = rows.withColumn("pos", F.row_number().over(w.orderBy(order)) - 1).withColumn("n", F.count("*").over(w))
    picks = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("n") - 1) / F.lit(float(k - 1)), 0).cast("int"))
    return r.filter((F.col("n") <= k) | F.array_contains(picks, F.col("pos"))).drop("n")


def stratified_sample(rows: DataFrame, stratum: str, quotas: DataFrame, seed: str) -> DataFrame:
    """The first ``quota`` rows of each stratum in hash order."""
    r = rows.withColumn("rank", F.row_number().over(Window.partitionBy(stratum).orderBy(hash_order(F.col("item_id"), seed=seed), "item_id")))
    return r.join(quotas, stratum).filter("rank <= quota")


def random_sample(rows: DataFrame, n: int, seed: str) -> DataFrame:
    return rows.orderBy(hash_order(F.col("item_id"), seed=seed), "item_id").limit(n)


def percentile_profile(rows: DataFrame, by: str, value: str, least: int = 5) -> DataFrame:
    """Nearest-rank median, 75th and 90th percentile of groups with at least ``least`` rows."""
    p = [F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {value})").alias(n) for q, n in ((0.5, "p50"), (0.75, "p75"), (0.9, "p90"))]
    return rows.groupBy(by).agg(F.count("*").alias("n"), *p).filter(F.col("n") >= least)


def percentile_anchors(rows: DataFrame, by: str, value: str, key: str, most: int = 3, least: int = 5) -> DataFrame:
    """``by, anchor, key, value``: of each profiled group the first ``most`` rows at its median (MEDIAN) and from its 75th percentile up (HIGH), in the order of their keys."""
    met = rows.select(by, key, value).join(percentile_profile(rows, by, value, least).select(by, "p50", "p75"), by)
    kinds = F.array(F.when(F.col(value) == F.col("p50"), "MEDIAN"), F.when(F.col(value) >= F.col("p75"), "HIGH"))
    each = met.select(by, key, value, F.explode(F.array_compact(kinds)).alias("anchor"))
    return each.withColumn("r", F.row_number().over(Window.partitionBy(by, "anchor").orderBy(key, value))).filter(F.col("r") <= most).select(by, "anchor", key, value)


def largest_remainder(weights: DataFrame, by: list[str], key: str, total: Column) -> DataFrame:
    """Whole quotas in proportion to ``weight`` that sum to the total; the largest remainders get one more, ties by key."""
    w = Window.partitionBy(*by)
    quota = F.col("weight") * total / F.sum("weight").over(w)
    q = weights.withColumn("exact", F.round(quota, 9)).withColumn("floor", F.floor("exact"))
    q = q.withColumn("rest", total - F.sum("floor").over(w)).withColumn("r", F.row_number().over(w.orderBy(F.desc(F.col("exact") - F.col("floor")), key)))
    return q.select(*by, key, (F.col("floor") + F.when(F.col("r") <= F.col("rest"), 1).otherwise(0)).cast("long").alias("quota"))


def cycle_select(rows: DataFrame, by: str, quotas: DataFrame, seed: str) -> DataFrame:
    """``quota`` picks per group with no reuse before every row was used: ``item_id, turn``. Each row repeats as often as its group's quota needs."""
    n = rows.groupBy(by).agg(F.count("*").alias("n"))
    r = rows.join(n, by).join(quotas, by).withColumn("turn", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.col("quota") / F.col("n"))).cast("int"))))
    pick = F.row_number().over(Window.partitionBy(by).orderBy("turn", hash_order(F.col("item_id"), F.col("turn"), seed=seed), "item_id"))
    return r.withColumn("pick", pick).filter("pick <= quota").select(by, "item_id", "turn", "pick")


def round_robin_groups(rows: DataFrame, by: str, n: int, seed: str) -> DataFrame:
    """One row per group before any group repeats. Only each group's first ``n`` rows can be picked."""
    h = hash_order(F.col("item_id"), seed=seed)
    r = first_per_group(rows, [by], [h, F.col("item_id")], n)
    return r.orderBy("rank", hash_order(F.col("item_id"), seed=seed), "item_id").limit(n)


def deficit_fill(topics: DataFrame, candidates: DataFrame, k: int, seed: str) -> DataFrame:
    """Give ``k`` new items to the topics with fewest items, one at a time, in parallel form: the j-th candidate of a topic stands at level load + j - 1."""
    c = first_per_group(candidates, ["topic_id"], [hash_order(F.col("ref_id"), seed=seed), F.col("ref_id")], k)
    slots = c.join(topics.select("topic_id", "load"), "topic_id").withColumn("level", F.col("load") + F.col("rank") - 1)
    return slots.orderBy("level", hash_order(F.col("topic_id"), seed=seed), "topic_id").limit(k).select("topic_id", "ref_id", "level")


def norm_quota_sequence(refs: DataFrame, total: int, seed: str) -> DataFrame:
    """Quota per norm by its distinct (article, topic) pairs, and the references picked for it."""
    w = refs.filter("norm_id is not null").groupBy("call_id", "norm_id").agg(F.count_distinct("article_asked", "topic_id").alias("weight"))
    quotas = largest_remainder(w, ["call_id"], "norm_id", F.lit(total))
    ranked = refs.withColumn("rank", F.row_number().over(Window.partitionBy("call_id", "norm_id").orderBy(hash_order(F.col("ref_id"), seed=seed), "ref_id")))
    return ranked.join(quotas, ["call_id", "norm_id"]).filter("rank <= quota").select("call_id", "norm_id", "ref_id", "quota")


def protected_withdrawal(easy: DataFrame, scopes: DataFrame, needs: DataFrame, multiplier: int) -> DataFrame:
    """Items to withdraw: easy ones, but in each scope enough of the lowest score are given back to keep ``multiplier`` times its need.

    ``easy``: item_id, score; ``scopes``: scope, item_id (all included items); ``needs``: scope, need. Giving an item
    back helps every scope that holds it, so the largest deficits go first, until none is left; each round is one
    aggregation over the scopes and cut by a checkpoint.
    """
    use_checkpoints(easy.sparkSession)
    out = easy.select("item_id", "score").checkpoint()
    while True:
        held = scopes.join(out.select("item_id", F.lit(1).alias("gone")), "item_id", "left").groupBy("scope").agg(F.count("*").alias("n"), F.count("gone").alias("lost"))
        short = held.join(needs, "scope").select("scope", F.least(F.col("lost"), F.col("need") * multiplier - (F.col("n") - F.col("lost"))).alias("deficit")).filter("deficit > 0")
        rank = F.row_number().over(Window.partitionBy("scope").orderBy("score", "item_id"))
        back = scopes.join(out, "item_id").join(short, "scope").withColumn("r", rank).filter("r <= deficit").select("item_id").distinct().checkpoint()
        if back.isEmpty():
            return out
        out = out.join(back, "item_id", "left_anti").checkpoint()


def retention(files: DataFrame, keep: int, cutoff: str) -> DataFrame:
    """Files to drop: beyond the newest ``keep`` of their family, or older than the cutoff."""
    r = files.withColumn("family", F.regexp_replace("name", "[0-9]+", "#")).withColumn("rank", F.row_number().over(Window.partitionBy("family").orderBy(F.desc("ts"), "name")))
    return r.filter((F.col("rank") > keep) | (F.col("ts") < F.lit(cutoff).cast("timestamp")))


def top_unvisited_aspects(rows: DataFrame, n: int, seed: str) -> DataFrame:
    """``n`` distinct starts of stems in hash order."""
    t = F.substring(F.regexp_replace("stem", "[ \t\n\x0b\f\r]+", " "), 1, 110)
    return rows.select(t.alias("aspect")).filter("aspect <> ''").distinct().orderBy(F.md5(F.concat("aspect", F.lit(seed))), "aspect").limit(n)


def blueprint_sequence(blueprint: DataFrame, parts: DataFrame, refs: DataFrame, seed: str) -> DataFrame:
    """References picked for each block of each part: those of its norm, or for free blocks of norms that no block names.

    ``refs``: ref_id, part_id, norm_id. A part's size is dealt over its blocks that have candidates by their amounts.
    """
    named = blueprint.filter("block_type = 'NORMA'").select("part_id", "norm_id", "block_order", "amount")
    fixed = refs.join(named, ["part_id", "norm_id"])
    free = refs.join(named.select("part_id", "norm_id").distinct(), ["part_id", "norm_id"], "left_anti").join(blueprint.filter("block_type = 'LIBRE'").select("part_id", "block_order", "amount"), "part_id")
    columns = ["part_id", "block_order", "amount", "ref_id"]
    rows = fixed.select(*columns).unionByName(free.select(*columns))
    live = rows.select("part_id", "block_order", F.col("amount").alias("weight")).distinct().join(parts.select("part_id", "n_items"), "part_id")
    quotas = largest_remainder(live, ["part_id"], "block_order", F.col("n_items"))
    picked = cycle_select(rows.select(F.concat_ws("/", "part_id", "block_order").alias("block"), F.col("ref_id").alias("item_id")), "block", quotas.select(F.concat_ws("/", "part_id", "block_order").alias("block"), "quota"), seed)
    return picked.select("block", F.col("item_id").alias("ref_id"), "turn")
