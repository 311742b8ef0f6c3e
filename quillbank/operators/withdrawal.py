"""Withdrawal of easy items under coverage limits, scope after scope."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.session import kept as kept_rows

#: Least score and multiple of the first rule, least level and multiple of the second, and sources that it spares.
SCORE, TIMES_BY_SCORE, LEVEL, TIMES_BY_LEVEL = 20, 8, 2, 3
OFFICIAL = ("apoyo", "AYTO-examen", "modelo")


def easy_by_score(items: DataFrame, exclusions: DataFrame, least: int = SCORE) -> DataFrame:
    """``item_id, score``: generated legal items with an answer, not excluded in any way, whose clues score ``least`` or more."""
    found = items.filter("kind = 'JURIDICA' and source_type = 'ia_generada' and upper(trim(answer_key)) in ('A', 'B', 'C', 'D')").filter(F.col("score") >= least)
    return found.join(exclusions.select("item_id"), "item_id", "left_anti").select("item_id", F.col("score").cast("long").alias("score"))


def easy_by_level(items: DataFrame, exclusions: DataFrame, exams: DataFrame, least: int = LEVEL) -> DataFrame:
    """``item_id, score`` (the level): legal theory of unofficial sources, of a level of ``least`` or more, neither excluded nor of an official exam."""
    out = exclusions.filter("state in ('CUARENTENA', 'RETIRADA')").select("item_id").union(exams.select("item_id"))
    found = items.filter(F.col("kind") == "JURIDICA").filter(F.upper(F.coalesce("theory_practice", F.lit(""))) != "PRACTICA")
    found = found.filter(~F.coalesce(F.col("source_type").isin(*OFFICIAL), F.lit(False))).filter(F.coalesce("level", F.lit(1)) >= least)
    return found.join(out, "item_id", "left_anti").select("item_id", F.col("level").cast("long").alias("score"))


def protected_scopes(parts: DataFrame, blueprint: DataFrame, links: DataFrame, items: DataFrame, excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scopes to keep stocked: ``scope, item_id`` and ``scope, place, need``.

    Each part of a call (its included links that aren't excluded; as many items as the part asks) and, within it, each
    norm that its blueprint names (the theory of that norm; the sum of the amounts). Parts go by id, a part before its
    norms, those by their first block. Scopes are named ``part`` or ``part/norm``.
    """
    live = links.filter("state = 'INCLUIDA' and part_id is not null").select("part_id", "item_id").distinct().join(excluded.select("item_id"), "item_id", "left_anti")
    named = blueprint.filter("block_type = 'NORMA' and norm_id is not null").groupBy("part_id", "norm_id").agg(F.sum("amount").alias("need"), F.min("block_order").alias("block"))
    theory = items.filter("upper(theory_practice) = 'TEORICA'").select("item_id", "norm_id").distinct()
    whole = F.col("part_id").cast("string")
    of_norm = F.concat_ws("/", "part_id", "norm_id")
    held = live.join(parts.select("part_id"), "part_id", "left_semi")
    scopes = held.select(whole.alias("scope"), "item_id").unionByName(held.join(theory, "item_id").join(named.select("part_id", "norm_id"), ["part_id", "norm_id"]).select(of_norm.alias("scope"), "item_id"))
    place = lambda block: F.struct(F.col("part_id").cast("long").alias("part"), block.cast("long").alias("block"), F.coalesce("norm_id", F.lit(0)).cast("long").alias("norm"))
    needs = parts.select("part_id", F.lit(None).cast("long").alias("norm_id"), F.col("n_items").cast("long").alias("need")).select(whole.alias("scope"), place(F.lit(-1)).alias("place"), "need")
    return scopes, needs.unionByName(named.join(parts.select("part_id"), "part_id", "left_semi").select(of_norm.alias("scope"), place(F.col("block")).alias("place"), F.col("need").cast("long").alias("need")))


#: Fixed value: items that the sequential step may see; needs beyond it are walked scope by scope.
_ROWS = 1 << 20


def _given_back(held: DataFrame, bound: DataFrame) -> DataFrame:
    """``item_id, kept_by`` of :func:`ordered_withdrawal`, one scope after the other, each by many tasks.

    ``held``: place, scope, score, item_id of the easy items of short scopes; ``bound``: place, scope, short. The items lie
    sorted in parts; counts of those that aren't given back yet, by part, tell which parts a scope gives back whole, and
    which one up to some row.
    """
    spark = held.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held.count() // _ROWS))
    ranked = held.repartitionByRange(parts, "place", "scope", "score", "item_id").select("scope", "score", F.col("item_id").cast("long").alias("item_id"), F.spark_partition_id().alias("part"))
    ranked = kept_rows(ranked)
    done = None
    for scope, short in [(r["scope"], r["short"]) for r in bound.select("scope", "place", "short").sort("place", "scope").collect()]:
        free = ranked.filter(F.col("scope") == scope).select("score", "item_id", "part")
        if done is not None:
            short -= free.join(done, "item_id", "left_semi").count()
            free = free.join(done, "item_id", "left_anti")
        if short <= 0:
            continue
        whole, last = -1, None
        for part, n in sorted(map(tuple, free.groupBy("part").count().collect())):
            if n > short:
                last = part
                break
            whole, short = part, short - n
        took = free.filter(F.col("part") <= whole).select("item_id")
        if last is not None and short > 0:
            took = took.unionByName(free.filter(F.col("part") == last).sort("score", "item_id").limit(short).select("item_id"))
        took = kept_rows(took.withColumn("kept_by", F.lit(scope)))
        done = took if done is None else done.unionByName(took)
    return done if done is not None else spark.createDataFrame([], "item_id long, kept_by string")


def ordered_withdrawal(easy: DataFrame, scopes: DataFrame, needs: DataFrame, multiplier: int) -> DataFrame:
    """``item_id, score, kept_by``: easy items, and the scope that gave each back (null: withdrawn).

    ``easy``: item_id, score; ``scopes``: scope, item_id (all items that the scope has); ``needs``: scope, place, need.
    Scopes go by place. A scope that has fewer than ``multiplier`` times its need without the withdrawn items gives
    back its lowest scores (ties by id) until it has enough or none is left; what it gives back counts in every later
    scope. An enough-stocked scope stays so, so one pass is the fixpoint.

    Only the first ``multiplier * need`` easy items of a scope can be given back by it: what others give back in it
    lowers its deficit by as much. So tasks rank and count the scopes, and what the one sequential step sees is bounded
    by the needs of the scopes, whatever the number of items. Where the needs are large, scopes are walked one by one,
    each by many tasks (:func:`_given_back`).
    """
    held = scopes.distinct().join(easy.select("item_id", "score"), "item_id", "left")
    counts = held.groupBy("scope").agg(F.count("*").alias("n"), F.count("score").alias("n_easy"))
    bound = needs.select("scope", "place", (F.col("need") * multiplier).alias("least")).join(counts, "scope")
    bound = bound.select("scope", "place", (F.col("least") - F.col("n") + F.col("n_easy")).alias("short"), "least").filter("short > 0")
    # scopes and their counts are made once, and once more for the easy items of the scopes that run short
    bound = kept_rows(bound)
    most, every = (x or 0 for x in bound.agg(F.max("least"), F.sum("least")).first())
    held = kept_rows(held.filter("score is not null").join(bound, "scope"))
    if every > _ROWS:
        return easy.join(_given_back(held, bound), "item_id", "left").select("item_id", "score", "kept_by")
    rank = F.row_number().over(Window.partitionBy("scope").orderBy("score", "item_id"))
    # the constant limit prunes within tasks, before rows are shuffled by scope
    ranked = held.withColumn("r", rank).filter(F.col("r") <= F.lit(int(most))).filter("r <= least")
    some = ranked.select("item_id").distinct()
    members = held.join(some, "item_id", "left_semi").select("scope", "place", "short", "score", "item_id")

    def give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, runs, n = [], [], 0
        for b in batches:
            scope = b.column("scope")
            for at in [0, *(np.flatnonzero(pc.not_equal(scope[1:], scope[:-1])) + 1)] if len(scope) else []:
                name = scope[int(at)].as_py()
                if not runs or runs[-1][0] != name:
                    runs.append((name, b.column("short")[int(at)].as_py(), n + int(at)))
            items.append(np.asarray(b.column("item_id")))
            n += len(scope)
        ids, of = np.unique(np.concatenate([*items, np.zeros(0, np.int64)]), return_inverse=True)
        del items
        kept = np.zeros(len(ids), bool)
        for (name, short, lo), hi in zip(runs, [*(r[2] for r in runs[1:]), n], strict=True):
            inside = of[lo:hi]
            back = kept[inside]
            took = inside[~back][: max(0, short - int(back.sum()))]
            kept[took] = True
            yield pa.RecordBatch.from_arrays([pa.array(ids[took]), pa.repeat(pa.scalar(name, pa.string()), len(took))], ["item_id", "kept_by"])

    # the sequential step holds a number or two of each row, which come sorted
    one = members.repartition(1).sortWithinPartitions("place", "scope", "score", "item_id").select("scope", F.col("short").cast("long").alias("short"), F.col("item_id").cast("long").alias("item_id"))
    kept = one.mapInArrow(give_back, "item_id long, kept_by string")
    return easy.join(kept, "item_id", "left").select("item_id", "score", "kept_by")
