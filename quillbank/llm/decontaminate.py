"""Benchmark decontamination over a distributed positional inverted index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints
from quillbank.llm.text import bit_filter, whole

#: A word: digits, a-z after lower-casing, and everything beyond ASCII (bytes of UTF-8).
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


def _key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


class _Chosen(dict):
    """Words to their keys if a bit filter holds them, else to None; forgets all when it has grown to a million words."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.last = bits, 8 * len(bits) - 1

    def __missing__(self, word: bytes) -> int | None:
        if len(self) >= 1_000_000:
            self.clear()
        key = _key(word)
        at = key & self.last
        found = key if self.bits[at >> 3] >> (at & 7) & 1 else None
        self[word] = found
        return found


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``item_id, wid, keys``: all runs of ``window`` words of each item (shorter, non-empty items are one), as word keys and their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items, wids, keys = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                every = np.array([_key(w) for w in words_of(t.as_py())], np.int64)
                for k in range(max(1, len(every) - window + 1) if len(every) else 0):
                    cut = every[k : k + window]
                    items.append(i)
                    wids.append(xxhash.xxh3_128_digest(cut.tobytes()))
                    keys.append(cut)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(wids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["item_id", "wid", "keys"])

    rows = benchmark.filter(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, "item_id string, wid binary, keys array<long>").dropDuplicates(["item_id", "wid"])


def frequencies(docs: DataFrame, text: str, bits: np.ndarray) -> DataFrame:
    """``term, n``: how often the words of a bit filter occur in all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = _Chosen(bits)
        for b in batches:
            seen: Counter[bytes] = Counter()
            for t in b.column(0):
                seen.update(words_of(t.as_py()))
            found = [(k, n) for w, n in seen.items() if (k := chosen[w]) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], names=["term", "n"])

    return docs.select(F.col(text).cast("binary")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def postings(docs: DataFrame, doc_id: str, text: str, bits: np.ndarray, reach: int) -> DataFrame:
    """The positional index: ``id, tid, n_words, found``, where ``found`` lists ``(term, pos, before, around)`` of a bit filter's terms.

    ``around`` holds the postings of the words at most ``reach`` positions away (``before`` of them come first), so
    that lists need not be fetched again to intersect them. Words are kept as 64-bit keys.
    """
    schema = pa.struct([("term", pa.int64()), ("pos", pa.int32()), ("before", pa.int32()), ("around", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = _Chosen(bits)
        for b in batches:
            n, rows = [], []
            for t in b.column(2):
                words = words_of(t.as_py())
                n.append(len(words))
                met = [(p, k) for p, w in enumerate(words) if (k := chosen[w]) is not None]
                rows.append([{"term": k, "pos": p, "before": min(p, reach), "around": list(map(_key, words[max(0, p - reach) : p + reach + 1]))} for p, k in met])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(rows, pa.list_(schema))], names=["id", "tid", "n_words", "found"])

    index = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(whole(text)).alias("tid"), F.col(text).cast("binary").alias("text"))
    return index.mapInArrow(run, "id long, tid long, n_words long, found array<struct<term:bigint,pos:int,before:int,around:array<bigint>>>")


def _least(keys: Column, overlap: float) -> Column:
    """Different words that a match needs."""
    return F.ceil(F.lit(overlap - 1e-9) * F.size(F.array_distinct(keys))).cast("int")


def rare_terms(windows: DataFrame, counts: DataFrame, overlap: float) -> DataFrame:
    """``term, first, offset, wid, keys``: of each window the rarest terms and those as rare, so many that one of them is in every match (``first``: the one for phrases)."""
    each = windows.select("wid", "keys", F.posexplode("keys").alias("offset", "term")).join(counts, "term")
    each = each.groupBy("wid", "term").agg(F.min("offset").alias("offset"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    by = each.groupBy("wid").agg(F.first("keys").alias("keys"), F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("terms"))
    by = by.withColumn("last", F.size("terms") - _least(F.col("keys"), overlap)).filter("last >= 0")
    by = by.select("wid", "keys", F.posexplode(F.filter("terms", lambda x: x["n"] <= F.get("terms", F.col("last"))["n"])).alias("k", "x"))
    by = by if overlap < 1 else by.filter("k = 0")
    return by.select("x.term", (F.col("k") == 0).alias("first"), "x.offset", "wid", "keys")


def find_matches(index: DataFrame, terms: DataFrame, overlap: float) -> DataFrame:
    """Join the index with test windows on their rare terms: ``id, tid, wid, start, size, kind``.

    The neighbours' lists are intersected after shifting them by the term's offset: a window with every word in place
    is a ``phrase``; one of which a share ``overlap`` of the different words stands within reach of one of its rare
    terms, in any order, is a ``proximity`` match. Rows of a very frequent term are split by adaptive execution;
    nothing grows with the square of a term's postings.
    """
    met = index.select("id", "tid", F.inline("found")).join(terms, "term")
    size, at = F.size("keys"), F.col("before") - F.col("offset")
    phrase = F.col("first") & (at >= 0) & (F.slice("around", F.greatest(at, F.lit(0)) + 1, size) == F.col("keys"))
    kind = F.when(phrase, "phrase")
    if overlap < 1:
        kind = kind.when(F.size(F.array_intersect("around", "keys")) >= _least(F.col("keys"), overlap), "proximity")
    return met.select("id", "tid", "wid", (F.col("pos") - F.col("offset")).alias("start"), size.alias("size"), kind.alias("kind")).filter("kind is not null")


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", *, item_id: str = "item_id", item_text: str = "text", window: int = 13, overlap: float = 1.0) -> DataFrame:
    """Judge each document: ``id, tid, n_words, n_hit, items, near`` (sorted item ids as strings).

    ``items`` are those with a window of ``window`` consecutive words (shorter, non-empty items are one window) that
    occurs; ``n_hit`` words stand in occurrences, each counted once. ``near`` are items of which no window occurs, but
    a share ``overlap`` of a window's different words lies within ``window - 1`` words of one of its rare terms (1: not
    looked for; below 1 each window has several terms, so many more postings are stored).

    Two passes over the texts: the first counts the benchmark's words in all training texts, the second indexes the
    positions of the windows' rarest terms; windows, rarity and matches are joins. Tasks know terms by a bit filter of
    bounded size, whose false positives find no window.

    Null or empty text has no words: ``n_hit`` 0, no items. Items with null text or id occur nowhere. Documents
    that repeat an id are judged by their own texts (``tid`` is the text's hash). An empty table gives an empty
    result, an empty benchmark no hits.
    """
    use_checkpoints(docs.sparkSession)
    of = benchmark_windows(benchmark, item_id, item_text, window).checkpoint()
    windows = of.groupBy("wid").agg(F.first("keys").alias("keys")).checkpoint()
    counts = frequencies(docs, text, bit_filter(windows.select(F.explode("keys").alias("term")).distinct(), "term"))
    terms = rare_terms(windows, counts, overlap).checkpoint()
    index = postings(docs, doc_id, text, bit_filter(terms.select("term").distinct(), "term"), window - 1).checkpoint()
    found = find_matches(index, terms, overlap)
    # repeated rows give repeated hits: positions and items are sets
    hits = found.filter("kind = 'phrase'").select("id", "tid", "wid", "start", "size").distinct()
    covered = hits.select("id", "tid", F.explode(F.expr("sequence(start, start + size - 1)")).alias("pos")).distinct().groupBy("id", "tid").agg(F.count("*").alias("n_hit"))
    named = found.select("id", "tid", "wid", (F.col("kind") == "phrase").alias("whole")).distinct().join(of.select("wid", "item_id"), "wid")
    named = named.groupBy("id", "tid", "item_id").agg(F.max("whole").alias("whole"))
    some = lambda whole: F.sort_array(F.collect_list(F.when(F.col("whole") == whole, F.col("item_id"))))
    both = named.groupBy("id", "tid").agg(some(True).alias("items"), some(False).alias("near")).join(covered.withColumnsRenamed({"id": "of", "tid": "t"}), F.col("id").eqNullSafe(F.col("of")) & (F.col("tid") == F.col("t")), "left")
    both = both.select(F.col("id").alias("of"), F.col("tid").alias("t"), "items", "near", "n_hit")
    met = index.join(both, F.col("id").eqNullSafe(F.col("of")) & (F.col("tid") == F.col("t")), "left")
    none = F.expr("cast(array() as array<string>)")
    return met.select("id", "tid", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near", none).alias("near"))
