"""Literal evidence: phrases of items that occur in the texts of their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbank.functions.bits import places_in


def literal_evidence(items: DataFrame, texts: DataFrame, least: int = 9, most: int = 15, top: int = 5) -> DataFrame:
    """``item_id, state, text_id, origins, fragments``: a row for each text that holds a phrase of an item, one for items without.

    ``items``: item_id, norm_id, origin (``stem``, ``opt_a`` …), words; ``texts``: text_id, norm_id, words. A phrase is
    ``least`` to ``most`` neighbouring words of one origin; it occurs in a text of the item's norm as a string, so its
    first word may be the end of a longer word and its last one the beginning. ``fragments`` are the ``top`` longest
    (then by text), ``origins`` where phrases of the text come from. States: ``NO_SOURCE`` (the norm has no text),
    ``NONE``, ``UNIQUE`` (one text), ``SEVERAL``.

    The words of a phrase but its first and last are words of the text, so both sides meet at ``least - 2`` whole words
    by hash and the rest is compared in place: each meeting gives all phrases that begin there. Texts drop words that
    no item has by a bit filter before anything is shuffled; equal windows of a text or an item are sent once, so
    repeated lines don't multiply.
    """
    seed = least - 2
    h = lambda i: F.xxhash64(F.array_join(F.slice("words", i + 2, seed), " "))
    starts = F.sequence(F.lit(0), F.size("words") - least)
    window = lambda i: F.slice("words", i + 1, most)
    asked = items.filter(F.size("words") >= least).select("item_id", "norm_id", "origin", F.explode(F.transform(starts, lambda i: F.struct(h(i).alias("h"), window(i).alias("w")))).alias("s")).select("item_id", "norm_id", "origin", "s.h", F.col("s.w").alias("iw")).distinct()
    passing = places_in(asked.select("h").distinct(), "h")
    held = texts.filter(F.size("words") >= least).withColumn("at", passing(F.transform(starts, h)))
    held = held.select("text_id", "norm_id", F.explode(F.transform("at", lambda i: F.struct(h(i).alias("h"), window(i).alias("w")))).alias("s")).select("text_id", "norm_id", "s.h", F.col("s.w").alias("tw")).distinct()

    same = lambda j: F.coalesce(F.get(F.col("iw"), j) == F.get(F.col("tw"), j), F.lit(False))
    met = asked.join(held, ["norm_id", "h"]).filter(F.endswith(F.get("tw", F.lit(0)), F.get("iw", F.lit(0))) & (F.slice("iw", 2, seed) == F.slice("tw", 2, seed)))
    after = F.sequence(F.lit(least - 1), F.lit(most - 1))
    met = met.withColumn("whole", F.size(F.filter(after, lambda k: F.forall(F.sequence(F.lit(least - 1), k), same))))
    nxt = F.col("whole") + (least - 1)
    begins = F.coalesce(F.startswith(F.get("tw", nxt), F.get("iw", nxt)), F.lit(False))
    met = met.withColumn("longest", nxt + F.when(begins, 1).otherwise(0)).filter(F.col("longest") >= least)
    sizes = F.sequence(F.lit(least), "longest")
    phrase: Column = F.explode(F.transform(sizes, lambda n: F.struct((-n).alias("n"), F.array_join(F.slice("iw", F.lit(1), n), " ").alias("text"))))
    found = met.select("item_id", "text_id", "origin", phrase.alias("f")).groupBy("item_id", "text_id").agg(F.array_sort(F.collect_set("origin")).alias("origins"), F.array_sort(F.collect_set("f")).alias("f"))
    found = found.select("item_id", "text_id", "origins", F.transform(F.slice("f", 1, top), lambda x: x["text"]).alias("fragments"))

    counts = found.groupBy("item_id").agg(F.count("*").alias("n"))
    sourced = texts.select("norm_id").distinct().withColumn("sourced", F.lit(True))
    every = items.select("item_id", "norm_id").distinct().join(sourced, "norm_id", "left").join(counts, "item_id", "left")
    state = F.when(F.col("sourced").isNull(), "NO_SOURCE").when(F.col("n").isNull(), "NONE").when(F.col("n") == 1, "UNIQUE").otherwise("SEVERAL")
    return every.select("item_id", state.alias("state")).join(found, "item_id", "left").select("item_id", "state", "text_id", "origins", "fragments")
