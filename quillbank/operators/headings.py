"""Articles of legal texts: headings found, an index aligned with the body, bodies cut out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.textnorm import BLANK, collapsed, unaccented

#: A heading: the word and a number at the start of a line, not the number of a section (``3.1``, or a dot and a digit further on).
HEADING = r"^[ \t]*(?:art[ií]culo|article)[ \t]+([0-9]+)(?![ \t]*\.\s*[0-9])(?:[ \t]*\.)?(?=[ \t]+|$)"
#: What stands after the number.
RUBRIC = rf"(?iud)^(?:art[ií]culo|article){BLANK}+[0-9]+(?:{BLANK}*\.)?{BLANK}*(.*)$"


def rubric(line: Column) -> Column:
    """A heading's text without accents, in lower case and without marks at its ends."""
    return F.btrim(collapsed(F.lower(unaccented(F.regexp_extract(line, RUBRIC, 1)))), F.lit(" .;:-"))


def find_headings(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """``doc, number, pos, line`` of every heading, positions from 0. Only lengths and lines are shuffled, no texts."""
    pieces = F.split(text, rf"(?iumd)(?={HEADING})")
    held = F.transform(pieces, lambda p: F.struct(F.length(p).cast("long").alias("n"), F.regexp_extract(p, f"(?iumd){HEADING}", 1).alias("number"), collapsed(F.substring_index(p, "\n", 1)).alias("line"), p.rlike(rf"(?iumd)\A(?:{HEADING[1:]})").alias("opens")))
    rows = texts.select(F.col(doc).alias("doc"), F.posexplode(held).alias("k", "h"))
    before = Window.partitionBy("doc").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("pos", F.coalesce(F.sum("h.n").over(before), F.lit(0)))
    return rows.filter("h.opens or k > 0").select("doc", F.col("h.number").cast("int").alias("number"), "pos", "h.line")


def _alike(a: Column, b: Column) -> Column:
    return (a != "") & (b != "") & (F.startswith(a, b) | F.startswith(b, a))


def choose_headings(headings: DataFrame) -> DataFrame:
    """The heading of each article that is counted: ``doc, toc, number, pos, line, error``.

    Counted are the numbers from 1 on without a gap, or, without a 1, the longest run (the first of equals). A document
    has an index before its body if 60 % of the numbers occur twice and 50 % return with a text like their first
    (equal, or one begins with the other); at least two each.

    With an index the heading in the body is the first later one like the first, or the second of just two
    (``NO_MATCH`` if neither). Without one it is the first after the heading of the number before (``NONE_AFTER``;
    ``PREVIOUS_MISSING`` for all that follow). A heading that doesn't stand after the last chosen one is ``OUT_OF_ORDER``.

    All steps are dealt by document: the windows and both groupings use one exchange.
    """
    number = Window.partitionBy("doc").orderBy("number")
    # a number 0 is never part of the run from 1 on
    nth = F.dense_rank().over(Window.partitionBy("doc", F.col("number") > 0).orderBy("number"))
    h = headings.withColumn("island", F.when(F.col("number") > 0, F.col("number") - nth).otherwise(-1))
    ends = Window.partitionBy("doc", "island")
    h = h.withColumn("lo", F.min("number").over(ends)).withColumn("hi", F.max("number").over(ends))
    best = F.max(F.struct((F.col("lo") == 1).alias("one"), (F.col("hi") - F.col("lo")).alias("n"), (-F.col("lo")).alias("first"))).over(Window.partitionBy("doc"))
    h = h.withColumn("best", best).filter("lo = -best.first")

    places = F.array_sort(F.collect_list(F.struct("pos", "line", rubric(F.col("line")).alias("rubric"))))
    by = h.groupBy("doc", "number").agg(places.alias("at"))
    like = F.get(F.filter(F.slice("at", F.lit(2), F.size("at")), lambda a: _alike(a["rubric"], F.get(F.col("at"), F.lit(0))["rubric"])), F.lit(0))
    again = F.coalesce(like, F.when(F.size("at") == 2, F.get("at", F.lit(1))))
    by = by.select("doc", F.struct("number", "at", like.isNotNull().alias("agrees"), again.alias("again")).alias("e"))
    docs = by.groupBy("doc").agg(F.array_sort(F.collect_list("e"), lambda a, b: a["number"] - b["number"]).alias("all"))
    enough = lambda share, test: F.size(F.filter("all", test)) >= F.greatest(F.lit(2), F.floor(F.size("all") * F.lit(share)))
    docs = docs.withColumn("toc", enough(0.6, lambda e: F.size(e["at"]) >= 2) & enough(0.5, lambda e: e["agrees"]))

    def out(number: Column, place: Column, error: Column) -> Column:
        return F.struct(number.alias("number"), place["pos"].alias("pos"), place["line"].alias("line"), F.when(place.isNull(), error).alias("error"))

    indexed = F.transform("all", lambda e: out(e["number"], e["again"], F.lit("NO_MATCH")))
    none = F.expr("cast(array() as array<struct<number: int, pos: bigint, line: string, error: string>>)")

    def follow(done: Column, e: Column) -> Column:
        last = F.get(done, F.size(done) - 1)  # null before the first
        later = F.get(F.filter(e["at"], lambda a: a["pos"] > last["pos"]), F.lit(0))
        place = F.when(F.size(done) == 0, F.get(e["at"], F.lit(0))).otherwise(later)
        error = F.when(last["pos"].isNull(), "PREVIOUS_MISSING").otherwise("NONE_AFTER")
        return F.concat(done, F.array(out(e["number"], place, error)))

    chosen = F.when(F.col("toc"), indexed).otherwise(F.aggregate("all", none, follow))
    rows = docs.select("doc", "toc", F.inline(chosen))
    earlier = F.last("pos", True).over(number.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("earlier", earlier).withColumn("error", F.when(F.col("pos") <= F.col("earlier"), "OUT_OF_ORDER").otherwise(F.col("error"))).drop("earlier")


def article_bodies(texts: DataFrame, chosen: DataFrame, least: int = 20, doc: str = "doc", text: str = "text") -> DataFrame:
    """Text from each chosen heading to that of the next number: ``doc, number, title, text, error``.

    ``NEXT_MISSING``: the next number has no heading; ``SHORT``: fewer than ``least`` characters below the heading's
    line. Neither has a text. Headings without a place aren't listed.
    """
    w = Window.partitionBy("doc").orderBy("number")
    ends = chosen.withColumn("end", F.lead("pos").over(w)).withColumn("is_last", F.lead("number").over(w).isNull()).filter("pos is not null")
    met = ends.join(texts.select(F.col(doc).alias("doc"), F.col(text).alias("whole")), "doc")
    size = F.greatest(F.lit(0), F.when(F.col("is_last"), F.length("whole")).otherwise(F.col("end")) - F.col("pos")).cast("int")
    met = met.withColumn("block", F.btrim(F.substring("whole", F.col("pos").cast("int") + 1, size), F.lit(" \n\t\r\x0b\f")))
    rest = F.when(F.locate("\n", "block") > 0, F.substr("block", F.locate("\n", "block") + 1)).otherwise("")
    error = F.when(~F.col("is_last") & F.col("end").isNull(), "NEXT_MISSING").when(F.length(collapsed(rest)) < least, "SHORT")
    return met.select("doc", "number", F.col("line").alias("title"), F.when(error.isNull(), F.col("block")).alias("text"), error.alias("error"))
