"""Text to rows: items, keys, fragments, headings, windows, chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbank.functions.textnorm import collapsed, unaccented

ITEM = re.compile(r"(?:^|\n)\s*(\d{1,3})[.)\-]\s+")
OPTION = re.compile(r"(?:^|\s)([ABCDabcd])\)\s+")


def split_items(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, number, stem, opt_a..opt_d, reason``: a number marker opens an item, the next one ends it; incomplete ones keep their reason."""
    schema = "doc long, number int, stem string, opt_a string, opt_b string, opt_c string, opt_d string, reason string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for d, t in zip(pdf["doc"], pdf["text"], strict=True):
                marks = list(ITEM.finditer(t or ""))
                for m, end in zip(marks, [*(x.start() for x in marks[1:]), len(t or "")], strict=True):
                    parts = OPTION.split(t[m.end() : end])
                    letters, bodies = [x.upper() for x in parts[1::2]], [" ".join(x.split()) for x in parts[2::2]]
                    stem = " ".join(parts[0].split())
                    reason = "LABELS" if letters != list("ABCD") else "EMPTY" if not stem or not all(bodies) else None
                    rows.append((d, int(m[1]), stem, *(bodies[:4] + [None] * 4)[:4], reason))
            yield pd.DataFrame(rows, columns=["doc", "number", "stem", "opt_a", "opt_b", "opt_c", "opt_d", "reason"])

    return texts.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text")).mapInPandas(run, schema)


def answer_key_table(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """(number, letter) pairs; the last one of a number wins."""
    pairs = F.regexp_extract_all(text, F.lit(r"(?i)\b([0-9]{1,3}) *[.\-:)]? *([ABCD])\b"), F.lit(0))
    rows = texts.select(F.col(doc).alias("doc"), F.posexplode(pairs).alias("k", "p")).select("doc", "k", F.regexp_extract("p", "^([0-9]+)", 1).cast("int").alias("number"), F.upper(F.right("p", F.lit(1))).alias("letter"))
    return rows.groupBy("doc", "number").agg(F.max_by("letter", "k").alias("letter"))


def label_repair(labels: Column) -> Column:
    """Option labels with misread signs put right; A, B, C, C is A, B, C, D by place."""
    plain = F.transform(labels, lambda x: F.translate(F.upper(F.regexp_replace(x, r"[}\])]+$", "")), "€8", "CB"))
    return F.when(F.array_join(plain, "") == "ABCC", F.array(*map(F.lit, "ABCD"))).otherwise(plain)


def position_to_page(pages: DataFrame, positions: DataFrame) -> DataFrame:
    """Page of each offset in the joined text of a document: the last one that starts at or before it, by one sort of both."""
    w = Window.partitionBy("doc").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    starts = pages.select("doc", "page", F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0)).alias("pos"))
    both = starts.select("doc", "pos", "page", F.lit(None).cast("long").alias("mark_id"), F.lit(0).alias("side")).unionByName(positions.select("doc", "pos", F.lit(None).cast("long").alias("page"), "mark_id", F.lit(1).alias("side")))
    order = Window.partitionBy("doc").orderBy("pos", "side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("page", F.last("page", True).over(order)).filter("side = 1").select("doc", "mark_id", "page")


def stitch_fragments(fragments: DataFrame) -> DataFrame:
    """Items from page fragments: a numbered fragment opens one, continuations join it; ones before any number are orphans (null item)."""
    w = Window.partitionBy("doc").orderBy("frag").rowsBetween(Window.unboundedPreceding, 0)
    item = F.nullif(F.sum(F.when(F.col("visible_number").isNotNull(), 1).otherwise(0)).over(w), F.lit(0))
    rows = fragments.withColumn("item", item)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("frag", "text"))), lambda s: s["text"])
    return rows.groupBy("doc", "item").agg(F.min("visible_number").alias("number"), F.count("*").alias("fragments"), F.array_join(texts, "\n").alias("text"))


def merge_contained(texts: Column) -> Column:
    """Join pieces in order; a piece that the text already holds adds nothing, one that holds the text replaces it."""
    return F.aggregate(texts, F.lit(""), lambda acc, t: F.when(acc.contains(t), acc).when(t.contains(acc), t).otherwise(F.concat(acc, F.lit(" "), t)))


def missing_numbers(rows: DataFrame, doc: str, number: str) -> DataFrame:
    """Gaps between the least and greatest number of each document."""
    by = rows.groupBy(doc).agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.collect_set(number).alias("have"))
    return by.select(doc, F.explode(F.array_except(F.sequence("lo", "hi"), "have")).alias("number"))


def candidate_pages(present: DataFrame, missing: DataFrame) -> DataFrame:
    """Pages to search for a missing number: those of the nearest lower and nearest higher number of its document."""
    both = present.select("doc", "number", "page", F.lit(False).alias("gone")).unionByName(missing.select("doc", "number", F.lit(None).cast("long").alias("page"), F.lit(True).alias("gone")))
    w = Window.partitionBy("doc").orderBy("number")
    low = F.last("page", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    high = F.first("page", True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return both.withColumn("low", low).withColumn("high", high).filter("gone").select("doc", "number", "low", "high")


def clean_boilerplate(texts: DataFrame, doc: str, text: str, strong: str, weak: str) -> DataFrame:
    """Drop header lines, and weak lines in an unbroken run with one: ``doc, kept``. The run is found by islands, not by repetition to a fixpoint."""
    rows = texts.select(F.col(doc).alias("doc"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    rows = rows.withColumn("strong", F.col("line").rlike(strong)).withColumn("mark", F.col("line").rlike(strong) | F.col("line").rlike(weak))
    w = Window.partitionBy("doc").orderBy("pos")
    rows = rows.withColumn("island", F.sum(F.when(F.col("mark"), 0).otherwise(1)).over(w))
    rows = rows.withColumn("hit", F.max("strong").over(Window.partitionBy("doc", "island", "mark")))
    kept = F.filter(F.array_sort(F.collect_list(F.struct("pos", "line", (F.col("mark") & F.col("hit")).alias("gone")))), lambda s: ~s["gone"])
    return rows.groupBy("doc").agg(F.array_join(F.transform(kept, lambda s: s["line"]), "\n").alias("kept"))


def heading_inventory(headings: DataFrame) -> DataFrame:
    """Numbers of a document's articles: the run 1..n if there is a 1, else the longest run (the first of equals): ``doc, lo, hi, partial``."""
    n = headings.select("doc", "number").distinct().withColumn("island", F.col("number") - F.row_number().over(Window.partitionBy("doc").orderBy("number")))
    runs = n.groupBy("doc", "island").agg(F.min("number").alias("lo"), F.max("number").alias("hi"))
    best = runs.groupBy("doc").agg(F.max_by(F.struct("lo", "hi"), F.struct((F.col("lo") == 1).cast("int"), F.col("hi") - F.col("lo"), -F.col("lo"))).alias("b"))
    return best.select("doc", "b.lo", "b.hi", (F.col("b.lo") != 1).alias("partial"))


def toc_mode(headings: DataFrame) -> DataFrame:
    """Whether a document has an index before its body: 60 % of the numbers stand twice and 50 % return with the same heading."""
    h = headings.withColumn("r", F.row_number().over(Window.partitionBy("doc", "number").orderBy("pos"))).withColumn("first", F.first("line").over(Window.partitionBy("doc", "number").orderBy("pos")))
    by = h.groupBy("doc", "number").agg(F.count("*").alias("n"), F.max((F.col("r") > 1) & (F.col("line") == F.col("first"))).alias("again"))
    d = by.groupBy("doc").agg(F.count("*").alias("nums"), F.count_if(F.col("n") >= 2).alias("twice"), F.count_if("again").alias("same"))
    most = lambda share: F.greatest(F.lit(2), F.floor(F.col("nums") * share))
    return d.select("doc", ((F.col("twice") >= most(0.6)) & (F.col("same") >= most(0.5))).alias("toc"))


def choose_headings_in_order(headings: DataFrame) -> DataFrame:
    """Without an index: for each number in turn, its first appearance after the one chosen before: ``doc, number, pos`` (no row where none follows).

    A fold over the document's appearances, sorted by number and place.
    """
    rows = headings.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("number", "pos"))).alias("h"))
    zero = F.expr("cast(struct(array() as chosen, -1 as number, -1 as pos) as struct<chosen:array<struct<number:int,pos:int>>,number:int,pos:int>)")

    def step(acc: Column, h: Column) -> Column:
        take = (h["number"] != acc["number"]) & (h["pos"] > acc["pos"])
        return F.when(take, F.struct(F.concat(acc["chosen"], F.array(h)).alias("chosen"), h["number"].alias("number"), h["pos"].alias("pos"))).otherwise(acc)

    typed = F.transform("h", lambda x: F.struct(x["number"].cast("int").alias("number"), x["pos"].cast("int").alias("pos")))
    return rows.select("doc", F.inline(F.aggregate(typed, zero, step)["chosen"]))


def segment_bodies(texts: DataFrame, chosen: DataFrame, least: int = 20) -> DataFrame:
    """Text from each chosen heading to the next: ``doc, number, body, error`` (positions from 0)."""
    nxt = F.lead("pos").over(Window.partitionBy("doc").orderBy("pos"))
    met = chosen.withColumn("end", nxt).join(texts.select("doc", "text"), "doc")
    block = F.btrim(F.substring("text", F.col("pos") + 1, F.coalesce("end", F.length("text")) - F.col("pos")), F.lit(" \n\t\r"))
    rest = collapsed(F.when(F.locate("\n", block) > 0, F.substring(block, F.locate("\n", block) + 1, F.length(block))).otherwise(""))
    return met.select("doc", "number", F.length(block).alias("chars"), F.when(F.length(rest) < least, "SHORT").alias("error"))


def expand_article_ranges(expression: Column) -> Column:
    """Article numbers of ``1 a 5`` or ``3, 7 bis``."""
    lo, hi = F.regexp_extract(expression, r"^ *([0-9]+) +a +([0-9]+) *$", 1), F.regexp_extract(expression, r"^ *([0-9]+) +a +([0-9]+) *$", 2)
    listed = F.regexp_extract_all(expression, F.lit(r"[0-9]+(?: (?:bis|ter|quater))?"), F.lit(0))
    return F.when(lo != "", F.transform(F.sequence(lo.cast("int"), hi.cast("int")), lambda n: n.cast("string"))).otherwise(listed)


def resolve_scope(index: DataFrame, scopes: DataFrame) -> DataFrame:
    """Articles that a scope covers: listed ones that exist, or all of the norm, less the excluded ones; listed ones that don't exist are errors.

    ``index``: norm_id, article; ``scopes``: scope_id, norm_id, listed (array, null: all), excluded (array).
    """
    listed = scopes.filter("listed is not null").select("scope_id", "norm_id", "excluded", F.explode("listed").alias("article")).join(index.withColumn("known", F.lit(True)), ["norm_id", "article"], "left")
    every = scopes.filter("listed is null").drop("listed").join(index, "norm_id").select("norm_id", "article", "scope_id", "excluded", F.lit(True).alias("known"))
    both = listed.unionByName(every).filter(~F.coalesce(F.array_contains("excluded", F.col("article")), F.lit(False)))
    return both.select("scope_id", "article", F.when(F.col("known").isNull(), "MISSING").alias("error"))


def pack_chunks(rows: DataFrame, most_rows: int, most_chars: int) -> DataFrame:
    """Greedy packing of a key's ordered rows: ``key, row_id, chunk``; a chunk closes at ``most_rows`` rows or before it passes ``most_chars``.

    Rows are sorted by key and id and stream through a fold that holds one chunk's counts.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunk, n, c = object(), 0, 0, 0
        for batch in batches:
            chunks = []
            for k, x in zip(batch.column("key").to_pylist(), batch.column("chars").to_pylist(), strict=True):
                if k != key:
                    key, chunk, n, c = k, 0, 0, 0
                both = None if c is None or x is None else c + x
                if n > 0 and (n >= most_rows or (both is not None and both > most_chars)):
                    chunk, n, c = chunk + 1, 1, x
                else:
                    n, c = n + 1, both
                chunks.append(chunk)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("row_id"), pa.array(chunks, pa.int32())], ["key", "row_id", "chunk"])

    slim = rows.select("key", F.col("row_id").cast("long").alias("row_id"), F.col("chars").cast("long").alias("chars"))
    schema = T.StructType([slim.schema["key"], T.StructField("row_id", T.LongType()), T.StructField("chunk", T.IntegerType())])
    return slim.repartition("key").sortWithinPartitions("key", "row_id", "chars").mapInArrow(fold, schema)


def split_oversized(texts: DataFrame, doc: str, text: str, most: int) -> DataFrame:
    """Pieces of at most ``most`` characters where possible: ``doc, piece, text``, cut at lines, then sentences, then clauses, then anywhere."""
    levels = (re.compile(r"(?<=\n)"), re.compile(r"(?<=[.;:]) "), re.compile(r"(?<=,) "))

    def cut(t: str, level: int = 0) -> list[str]:
        if len(t) <= most:
            return [t]
        if level == len(levels):
            return [t[k : k + most] for k in range(0, len(t), most)]
        out: list[str] = []
        for x in levels[level].split(t):
            if out and len(out[-1]) + len(x) <= most:
                out[-1] += x
            else:
                out += cut(x, level + 1)
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame([(d, k, p) for d, t in zip(pdf["doc"], pdf["text"], strict=True) for k, p in enumerate(cut(t or ""))], columns=["doc", "piece", "text"])

    return texts.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text")).mapInPandas(run, "doc long, piece int, text string")


def phrase_windows(words: Column, least: int = 9, most: int = 15) -> Column:
    """Word n-grams of ``least`` to ``most`` words."""
    sizes = F.sequence(F.lit(least), F.least(F.lit(most), F.size(words)))
    grams = F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    return F.when(F.size(words) >= least, grams).otherwise(F.array().cast("array<string>"))


def split_topics(lines: DataFrame) -> DataFrame:
    """Topics of a syllabus from its lines: a part heading sets the part, ``N.`` opens a topic; the first of a (part, number) stays: ``doc, part, number, text``."""
    w = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    part = F.nullif(F.regexp_extract("line", r"^PART ([A-Z]+)$", 1), F.lit(""))
    number = F.nullif(F.regexp_extract("line", r"^([0-9]{1,2})\. ", 1), F.lit("")).cast("int")
    rows = lines.withColumn("part", F.last(part, True).over(w)).withColumn("start", number.isNotNull()).withColumn("own_number", number).filter(part.isNull() & F.col("part").isNotNull())
    rows = rows.withColumn("topic", F.sum(F.col("start").cast("int")).over(w)).filter("topic > 0")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), " ")
    by = rows.groupBy("doc", "part", "topic").agg(F.max("own_number").alias("number"), F.regexp_replace(text, r"^[0-9]{1,2}\. ", "").alias("text"))
    return by.withColumn("r", F.row_number().over(Window.partitionBy("doc", "part", "number").orderBy("topic"))).filter("r = 1").select("doc", "part", "number", "text")


def unique_titles(topics: DataFrame) -> DataFrame:
    """``topic_id, title``: the fewest first sentences of each topic that no other topic of its part begins with; all of them if there are none.

    Each prefix of sentences has a rolling hash (without accents, in lower case), and a topic's title ends at its first
    prefix that is counted once. So one count over the sentences of all topics replaces lengthening titles round by
    round, and equal topics are counted before they are shuffled.
    """
    strip = lambda x: F.btrim(x, F.lit(" ."))
    parts = F.filter(F.transform(F.split(collapsed(F.col("text")), r"\.\s+"), strip), lambda x: x != "")
    rows = topics.select("topic_id", "part", parts.alias("s"))
    step = lambda done, x: F.concat(done, F.array(F.xxhash64(F.element_at(done, -1), F.lower(unaccented(x)))))
    prefixes = rows.select("topic_id", "part", F.posexplode(F.aggregate("s", F.array(F.lit(0).cast("long")), step)).alias("depth", "h")).filter("depth > 0")
    once = prefixes.groupBy("part", "h").agg(F.count_distinct("topic_id").alias("n"), F.min(F.struct("topic_id", "depth")).alias("one")).filter("n = 1")
    first = once.groupBy(F.col("one.topic_id").alias("topic_id")).agg(F.min("one.depth").alias("depth"))
    met = rows.join(first, "topic_id", "left")
    title = F.array_join(F.slice("s", F.lit(1), F.coalesce("depth", F.size("s"))), ". ")
    return met.select("topic_id", F.rtrim(title, F.lit(".")).alias("title"))


def longest_block(blocks: DataFrame, least: int = 20) -> DataFrame:
    """Of several blocks with one number the longest, if it has ``least`` characters."""
    by = blocks.groupBy("doc", "number").agg(F.max_by("text", F.struct(F.length("text"), -F.col("pos"))).alias("text"))
    return by.filter(F.length("text") >= least)
