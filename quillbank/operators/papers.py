"""Exam papers, syllabus texts and gazette pages: blocks, topics, headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.textnorm import collapsed, strip_gazette_lines
from quillbank.operators.extract import clean_boilerplate, missing_numbers

#: Header lines of gazettes, lines that are headers only beside one, and a header that stands within a line.
_T = r"(?:ES|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[LC]\s?[0-9]+[A-Z]?/[0-9]+|Diario Oficial de la Unión Europea)"
STRONG = (
    rf"^\s*(?:{_T}\s+)*(?:Diario Oficial de la Unión Europea|DO L de [0-9]{{1,2}}\.[0-9]{{1,2}}\.[0-9]{{4}}|ELI:\s*https?://\S+|[LC]\s?[0-9]+[A-Z]?/[0-9]+)(?:\s+{_T})*\s*$"
    r"|^\s*N[uú]m\.\s*[0-9]+\s*/\s*[0-9]{2}\.[0-9]{2}\.[0-9]{4}\s*$"
)
WEAK = r"^\s*(?:ES|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,4}/[0-9]{1,4})\s*$"
INLINE = (
    r"\s*Núm\.\s*[0-9]+\s+[\p{L}\p{N}_]+\s+[0-9]{1,2}\s+de\s+[\p{L}\p{N}_]+\s+de\s+[0-9]{4}\s+Sec\.\s*[IVX]+[A-Z]?\.?(?:\s*Pág\.\s*[0-9]+)?\s*cve:\s*BOE-[A-Z]-[0-9]{4}-[0-9]+"
    r"\s*Verificable en https?://www\.boe\.es\s*"
)
#: Numbers of topics that a part of a syllabus may have.
LARGEST = {"GENERAL": 15, "ESPECIAL": 60}


def clean_gazette(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, kept``: texts without gazette headers, first those within lines, then header lines and weak lines in a run with one."""
    return clean_boilerplate(texts.select(F.col(doc), F.regexp_replace(text, INLINE, " ").alias("_t")), doc, "_t", STRONG, WEAK)


def split_exam_blocks(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, number, text`` of each numbered block that has the options A) to D); what follows the mark of its tail is cut."""
    pieces = F.split(text, r"(?m)(?=^[ \t]*[0-9]{1,3}\.\s+\S)")
    has = lambda p, letter: p.rlike(rf"(?m)^\s*{letter}\)\s+")
    strip = lambda x: F.btrim(x, F.lit(" \n\t\r\x0b\f"))
    held = F.transform(pieces, lambda p: F.struct(F.regexp_extract(p, r"^[ \t]*([0-9]{1,3})\.\s+\S", 1).alias("number"), strip(F.get(F.split(p, r"(?m)^\s*Seguridad en la respuesta:", 2), F.lit(0))).alias("text"), (has(p, "A") & has(p, "B") & has(p, "C") & has(p, "D")).alias("whole")))
    rows = texts.select(F.col(doc).alias("doc"), F.explode(held).alias("b")).filter("b.number <> '' and b.whole")
    return rows.select("doc", F.col("b.number").cast("int").alias("number"), "b.text")


def split_syllabus(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, part, number, text`` of a syllabus: topics ``N.`` below the headings of its two parts.

    Page headers are left out (TX-41) and everything before the general part. A number beyond its part's (``LARGEST``)
    opens no topic and ends the one before; of topics with one number the first that has a text stays.
    """
    clean = strip_gazette_lines(F.col(text))
    start = F.locate("TEMARIO PARTE GENERAL", F.upper(clean))
    clean = F.when(start > 0, F.substr(clean, start)).otherwise(clean)
    mark = r"TEMARIO PARTE (GENERAL|ESPECIAL)|(?<![0-9])([0-9]{1,2})\.\s+"
    pieces = F.split(clean, rf"(?iu)(?={mark})")
    part = lambda p: F.upper(F.regexp_extract(p, rf"(?iu)\A(?:{mark})", 1))
    held = F.transform(pieces, lambda p: F.struct(part(p).alias("part"), F.regexp_extract(p, rf"(?iu)\A(?:{mark})", 2).cast("string").alias("number"), collapsed(F.regexp_replace(p, rf"(?iu)\A(?:{mark})", "")).alias("text")))
    rows = texts.select(F.col(doc).alias("doc"), F.posexplode(held).alias("k", "p"))
    w = Window.partitionBy("doc").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("doc", "k", F.last(F.nullif("p.part", F.lit("")), True).over(w).alias("part"), F.nullif("p.number", F.lit("")).cast("int").alias("number"), "p.text")
    fits = F.col("number").isNotNull() & (F.col("number") >= 1) & (F.col("number") <= F.when(F.col("part") == "GENERAL", LARGEST["GENERAL"]).otherwise(LARGEST["ESPECIAL"]))
    topics = rows.filter(F.col("part").isNotNull() & fits & (F.col("text") != ""))
    return topics.groupBy("doc", "part", "number").agg(F.min_by("text", "k").alias("text"))


def merge_review(groups: DataFrame, links: DataFrame, link_topics: DataFrame, simulations: DataFrame) -> DataFrame:
    """What merging each group of equal items would do: ``component, keep_id, item_id, state, equal_links, moved_links``.

    ``groups``: component, item_id; ``links``: link_id, call_id, item_id, part_id, link_type, state; ``link_topics``: link_id,
    topic_id; ``simulations``: item_id of items that simulations use. Of a pair the item that banks use stays, else the
    smaller id. The other one's links go where the kept item has one of the same call (``equal_links``), else move.
    States: ``NOT_A_PAIR``; ``SIMULATION`` (one uses the item to drop); ``LINKS`` or ``TOPICS`` (those of a common call
    differ); ``OK``.
    """
    used = links.select("item_id").distinct().withColumn("used", F.lit(True))
    g = groups.join(used, "item_id", "left").groupBy("component").agg(F.count("*").alias("n"), F.min("item_id").alias("lo"), F.max("item_id").alias("hi"), F.min(F.when(F.col("used"), F.col("item_id"))).alias("first"), F.count("used").alias("k"))
    keep = F.when(F.col("k") == 1, F.col("first")).otherwise(F.col("lo"))
    pairs = g.filter("n = 2").select("component", keep.alias("keep_id"), (F.col("lo") + F.col("hi") - keep).alias("item_id"))

    topics = link_topics.groupBy("link_id").agg(F.array_sort(F.collect_set("topic_id")).alias("topics"))
    last = links.join(topics, "link_id", "left").groupBy("item_id", "call_id").agg(F.max_by(F.struct(F.struct("part_id", "link_type", "state").alias("fields"), F.coalesce("topics", F.array().cast("array<bigint>")).alias("topics")), "link_id").alias("l"))
    lose = pairs.join(last.select("item_id", "call_id", F.col("l").alias("b")), "item_id")
    met = lose.join(last.select(F.col("item_id").alias("keep_id"), "call_id", F.col("l").alias("a")), ["keep_id", "call_id"], "left")
    by = met.groupBy("component").agg(
        F.count("a").alias("equal_links"), F.count_if(F.col("a").isNull()).alias("moved_links"),
        F.max(F.coalesce(F.col("a.fields") != F.col("b.fields"), F.lit(False)) | F.coalesce(~F.col("a.fields").eqNullSafe(F.col("b.fields")) & F.col("a").isNotNull(), F.lit(False))).alias("fields_differ"),
        F.max(F.coalesce(F.col("a.topics") != F.col("b.topics"), F.lit(False))).alias("topics_differ"),
    )
    simulated = simulations.select("item_id").distinct().withColumn("simulated", F.lit(True))
    out = pairs.join(by, "component", "left").join(simulated, "item_id", "left")
    state = F.when(F.col("simulated"), "SIMULATION").when(F.col("fields_differ"), "LINKS").when(F.col("topics_differ"), "TOPICS").otherwise("OK")
    zero: Column = F.lit(0)
    out = out.select("component", "keep_id", "item_id", state.alias("state"), F.coalesce("equal_links", zero).alias("equal_links"), F.coalesce("moved_links", zero).alias("moved_links"))
    none = F.lit(None).cast("long")
    return out.unionByName(g.filter("n <> 2").select("component", none.alias("keep_id"), none.alias("item_id"), F.lit("NOT_A_PAIR").alias("state"), zero.cast("long").alias("equal_links"), zero.cast("long").alias("moved_links")))


def split_numbered_items(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, number, stem, opt_a, opt_b, opt_c, opt_d, reason`` of items that a number opens at the start of a line, before ``¿`` or a capital.

    A body ends at the next number. It is the stem and what follows ``a)``, ``b)``, ``c)`` and ``d)`` in this order, all of
    them with content, else its ``reason`` is ``OPTIONS``. Numbers between a document's least and largest that open no item
    are rows with the reason ``MISSING``.
    """
    opens = r"^[ \t]*([0-9]{1,4})\s*(?=¿|[A-ZÁÉÍÓÚÜÑ])"
    body = r"(?isuU)\A(.*?)\ba\)\s*(.*?)\bb\)\s*(.*?)\bc\)\s*(.*?)\bd\)\s*(.*)\z"
    names = ("stem", "opt_a", "opt_b", "opt_c", "opt_d")
    inner = lambda p: F.btrim(F.regexp_replace(p, rf"\A{opens[1:]}", ""), F.lit(" \n\t\r\x0b\f"))
    held = F.transform(F.split(text, rf"(?m)(?={opens})"), lambda p: F.struct(F.regexp_extract(p, rf"\A{opens[1:]}", 1).try_cast("int").alias("number"), F.array(*[collapsed(F.regexp_extract(inner(p), body, k)) for k in range(1, 6)]).alias("parts")))
    items = texts.select(F.col(doc).alias("doc"), F.explode(held).alias("i")).filter("i.number is not null")
    whole = F.forall("i.parts", lambda x: x != "")
    items = items.select("doc", "i.number", *[F.when(whole, F.get("i.parts", F.lit(k))).alias(n) for k, n in enumerate(names)], F.when(~whole, "OPTIONS").alias("reason"))
    gaps = missing_numbers(items, "doc", "number").select("doc", "number", *[F.lit(None).cast("string").alias(n) for n in names], F.lit("MISSING").alias("reason"))
    return items.unionByName(gaps)
