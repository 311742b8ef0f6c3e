"""Line dedup: drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbank.llm.text import SPACE, ascii_lower, whole


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop shared lines from every document; return ``id, kept, n_lines, n_dropped, row`` (``row``: the input row).

    Lines are split at ``\\n``; a line's key is the line stripped of white space with A-Z lower-cased.
    A key of at least ``min_chars`` code points held by at least ``min_docs`` documents loses its
    lines everywhere but in the largest document id that holds it.

    Only two 64-bit hashes of a key, the document and the position are shuffled for the counts; holders
    are counted after a distinct by (key, document), so one very common line is spread over all tasks.
    The texts are shuffled once, to meet their dropped positions.

    Null or empty text: one empty line, kept. A row with a null id holds no key and loses no line.
    Rows that repeat an id are one document for the counts, and each is cut by its own text.
    An empty table gives an empty result. Other columns travel in ``row``, whatever their names.
    """
    base = docs.select(F.col(doc_id).alias("id"), whole(text).alias("t"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"))
    base = base.select("id", F.xxhash64("t").alias("tid"), F.split("t", "\n").alias("lines"), "row")
    line = F.btrim(F.col("line"), F.lit(SPACE))
    keyed = (
        base.filter(F.col("id").isNotNull()).select("id", "tid", F.posexplode("lines").alias("pos", "line"))
        .select("id", "tid", "pos", line.alias("line")).filter(F.char_length("line") >= min_chars)
        .select("id", "tid", "pos", ascii_lower(F.col("line")).alias("k"))
        .select("id", "tid", "pos", F.xxhash64("k").alias("k1"), F.xxhash64(F.lit("second"), F.col("k")).alias("k2"))
    )
    common = keyed.select("k1", "k2", "id").distinct().groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("id").alias("keep")).filter(F.col("n") >= min_docs)
    lost = keyed.join(common.select("k1", "k2", "keep"), ["k1", "k2"]).filter("id < keep").groupBy("id", "tid").agg(F.collect_set("pos").alias("lost"))
    met = base.join(lost, ["id", "tid"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    kept = F.when(F.col("lost").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n"))
    return met.select("id", kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"), "row")
