"""Items from fragments of pages, merged field by field in the order of the document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.textnorm import collapsed

#: Fields that fragments add to, and fields that all fragments of an item must agree on (compared in this order).
TEXTS = ("stem", "opt_a", "opt_b", "opt_c", "opt_d", "footer")
SCALARS = ("answer", "kind", "norm_type", "norm_name", "article", "topic")
#: Fixed values of two scalars.
ANSWERS, KINDS = ("", "A", "B", "C", "D"), ("", "JURIDICA", "INFORMATICA", "OTRA")


def join_text(held: Column, new: Column) -> Column:
    """What a fragment makes of a field: a text that holds the other replaces it, others are joined by a blank."""
    return F.when((new == "") | held.contains(new), held).when(new.contains(held), new).otherwise(F.concat(held, F.lit(" "), new))


def clean_fragments(fragments: DataFrame) -> DataFrame:
    """Fragments with tidy fields and the reason why one can't be used (``BAD_ANSWER``, ``BAD_KIND``, ``EMPTY``)."""
    tidy = lambda c: collapsed(F.coalesce(F.col(c).cast("string"), F.lit("")))
    rows = fragments.select("doc", "frag", "page", tidy("number").alias("number"), F.coalesce("continues", F.lit(False)).alias("continues"), *[tidy(c).alias(c) for c in TEXTS], *[(F.upper(tidy(c)) if c in ("answer", "kind") else tidy(c)).alias(c) for c in SCALARS])
    content = reduce(lambda a, b: a | b, [F.col(c) != "" for c in ("number", *TEXTS, "answer")])
    bad = F.when(~F.col("answer").isin(*ANSWERS), "BAD_ANSWER").when(~F.col("kind").isin(*KINDS), "BAD_KIND").when(~content, "EMPTY")
    return rows.withColumn("bad", bad)


def merge_fragments(fragments: DataFrame) -> DataFrame:
    """Items: ``doc, item, number, first_page, last_page``, the texts, the scalars and ``errors`` (``frag, error``).

    ``fragments``: doc, frag (their order), page, number, continues, ``TEXTS`` and ``SCALARS``. A number opens an item;
    fragments without one that say that they continue join the item before, field by field (``join_text``). A scalar
    that differs from what the item has is an error ``CONFLICT:field``: the fragment's texts and the scalars before it
    count, the scalars from it on and its page don't.

    Rows with a null ``item`` are fragments that belong to none: ``ORPHAN`` (continues nothing), ``UNMARKED`` (no number,
    continues not) and unusable ones. A window numbers the items of a document, a fold over an item's few fragments
    merges them: nothing larger than an item meets in one place.
    """
    rows = clean_fragments(fragments)
    w = Window.partitionBy("doc").orderBy("frag").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.col("bad").isNull() & (F.col("number") != "")
    rows = rows.withColumn("item", F.sum(opens.cast("int")).over(w))
    error = F.coalesce("bad", F.when((F.col("number") == "") & ~F.col("continues"), "UNMARKED").when((F.col("number") == "") & (F.col("item") == 0), "ORPHAN"))
    rows = rows.withColumn("error", error)

    parts = F.array_sort(F.collect_list(F.struct("frag", "page", "number", *TEXTS, *SCALARS)))
    by = rows.filter("error is null").groupBy("doc", "item").agg(parts.alias("parts"))
    first = F.get("parts", F.lit(0))
    no_errors = F.expr("cast(array() as array<struct<frag: bigint, error: string>>)")
    start = F.struct(*[first[c].alias(c) for c in (*TEXTS, *SCALARS)], first["page"].cast("long").alias("last_page"), no_errors.alias("errors"))

    def step(acc: Column, x: Column) -> Column:
        differs = [(x[c] != "") & (acc[c] != "") & (x[c] != acc[c]) for c in SCALARS]
        clash = F.coalesce(*[F.when(d, F.lit(c)) for c, d in zip(SCALARS, differs, strict=True)])
        # scalars before the first that differs are taken
        open_until = [reduce(lambda a, b: a | b, differs[: k + 1]) for k in range(len(SCALARS))]
        scalars = [F.when(~stop & (x[c] != ""), x[c]).otherwise(acc[c]).alias(c) for c, stop in zip(SCALARS, open_until, strict=True)]
        page = F.when(clash.isNull(), F.greatest(acc["last_page"], x["page"].cast("long"))).otherwise(acc["last_page"])
        errors = F.when(clash.isNull(), acc["errors"]).otherwise(F.concat(acc["errors"], F.array(F.struct(x["frag"].cast("long").alias("frag"), F.concat(F.lit("CONFLICT:"), clash).alias("error")))))
        return F.struct(*[join_text(acc[c], x[c]).alias(c) for c in TEXTS], *scalars, page.alias("last_page"), errors.alias("errors"))

    merged = by.withColumn("m", F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), start, step))
    names = ["doc", "item", "number", "first_page", "last_page", *TEXTS, *SCALARS, "errors"]
    items = merged.select("doc", F.col("item").cast("long").alias("item"), first["number"].alias("number"), first["page"].cast("long").alias("first_page"), "m.last_page", *[f"m.{c}" for c in (*TEXTS, *SCALARS)], "m.errors")
    lost = rows.filter("error is not null").select(
        "doc", F.lit(None).cast("long").alias("item"), "number", F.col("page").cast("long").alias("first_page"), F.col("page").cast("long").alias("last_page"), *TEXTS, *SCALARS,
        F.array(F.struct(F.col("frag").cast("long").alias("frag"), F.col("error").alias("error"))).alias("errors"),
    )
    return items.select(*names).unionByName(lost.select(*names))
