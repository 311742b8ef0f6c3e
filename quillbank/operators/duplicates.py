"""Duplicates and similarity."""

from __future__ import annotations

import difflib
import itertools
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillbank.functions.bits import places_in
from quillbank.functions.session import use_checkpoints
from quillbank.functions.textnorm import norm_ascii_alnum, norm_spaces_lower
from quillbank.operators.components import connected_components

FIELDS = ["stem", "opt_a", "opt_b", "opt_c", "opt_d"]
_SEP = "\u0001"


def exact_duplicates(items: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """Items to delete, with the smallest id of their group; groups with a null field are reported elsewhere but never deleted."""
    w = Window.partitionBy(*fields)
    keep = items.dropna(subset=fields).withColumn("keep_id", F.min("item_id").over(w))
    return keep.filter("item_id <> keep_id").select("item_id", "keep_id")


def duplicate_groups(items: DataFrame, key: Column) -> DataFrame:
    """Groups of rows with equal keys: smallest id and size. The key is hashed before the shuffle."""
    return items.select("item_id", F.sha2(key, 256).alias("k")).groupBy("k").agg(F.min("item_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").select("first_id", "n")


def normalised_key(fields: list[str] = FIELDS) -> Column:
    return F.concat_ws(_SEP, *[norm_spaces_lower(F.col(f)) for f in fields])


def option_free_key() -> Column:
    """Stem and the options in sorted order."""
    return F.concat_ws(_SEP, norm_ascii_alnum(F.col("stem")), F.concat_ws(_SEP, F.array_sort(F.array(*[norm_ascii_alnum(F.col(f)) for f in FIELDS[1:]]))))


def near_duplicates_one_field(items: DataFrame, most: int = 5, fields: list[str] = FIELDS) -> DataFrame:
    """Pairs with all fields but one equal (normalised) and that one within ``most`` edits: ``id_a, id_b, field, distance``.

    Each row gives one hash per left-out field; rows meet only at equal hashes. Within a hash, equal values of the left-out
    field are one class (its smallest id stands for it), so copies aren't expanded into pairs.
    """
    norm = items.select("item_id", *[norm_spaces_lower(F.col(f)).alias(f) for f in fields])
    keys = F.array(*[F.struct(F.lit(f).alias("field"), F.sha2(F.concat_ws(_SEP, *[F.col(g) for g in fields if g != f]), 256).alias("k"), F.col(f).alias("value")) for f in fields])
    rows = norm.select("item_id", F.inline(keys)).groupBy("field", "k", "value").agg(F.min("item_id").alias("item_id"))
    a, b = rows.alias("a"), rows.alias("b")
    near = F.levenshtein("a.value", "b.value", most)
    met = a.join(b, (F.col("a.field") == F.col("b.field")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.item_id") < F.col("b.item_id")) & (F.abs(F.length("a.value") - F.length("b.value")) <= most) & (near >= 1))
    return met.select(F.col("a.item_id").alias("id_a"), F.col("b.item_id").alias("id_b"), "a.field", near.alias("distance"))


def components(pairs: DataFrame) -> DataFrame:
    return connected_components(pairs, "id_a", "id_b")


def keep_plan(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Who stays of each component: the only referenced member, else the smallest id; losers with their calls in common with the keeper."""
    used = links.groupBy("item_id").agg(F.array_sort(F.collect_set("call_id")).alias("calls"))
    g = groups.join(used, groups["node"] == used["item_id"], "left").select("component", "node", F.coalesce("calls", F.array().cast("array<bigint>")).alias("calls"))
    by = g.groupBy("component").agg(F.count_if(F.size("calls") > 0).alias("n"), F.min(F.when(F.size("calls") > 0, F.col("node"))).alias("one"), F.min("node").alias("least"))
    keep = by.select("component", F.when(F.col("n") == 1, F.col("one")).otherwise(F.col("least")).alias("keep_id"))
    kept = g.select(F.col("node").alias("keep_id"), F.col("calls").alias("keep_calls"))
    out = g.join(keep, "component").filter("node <> keep_id").join(kept, "keep_id")
    return out.select(F.col("node").alias("item_id"), "keep_id", F.array_join(F.array_sort(F.array_intersect("calls", "keep_calls")), ",").alias("collisions"))


def reassign_links(links: DataFrame, plan: DataFrame) -> DataFrame:
    """Links of the losers move to their keeper; one link per call and item stays."""
    p = plan.select("item_id", "keep_id")
    return links.select("call_id", "item_id").join(p, "item_id", "left").select("call_id", F.coalesce("keep_id", "item_id").alias("item_id")).distinct()


def conflicting_duplicates(items: DataFrame, key: Column, value: Column) -> DataFrame:
    """Groups of equal text whose answers differ."""
    by = items.select("item_id", F.sha2(key, 256).alias("k"), value.alias("v")).groupBy("k").agg(F.min("item_id").alias("first_id"), F.count("*").alias("n"), F.count_distinct("v").alias("answers"))
    return by.filter("answers > 1").select("first_id", "n", "answers")


def _agree(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


#: Products of lengths up to which difflib is the quickest and quick, and pairs of equal elements that are listed at once.
_TINY, _SMALL, _LISTED = 2_500, 40_000, 200_000


def _small(a: Sequence, b: Sequence) -> int:
    return sum(m.size for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks())


def _codes(a: list, b: list) -> tuple[np.ndarray, np.ndarray]:
    of = {x: k for k, x in enumerate(dict.fromkeys([*a, *b]))}
    return np.array([of[x] for x in a], np.int64), np.array([of[x] for x in b], np.int64)


def _common(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Size and places of the longest common block of two long sequences, the earliest one: halving over hashes of windows."""
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(len(a), len(b)), base), dtype=np.uint64)])
    # a sum of codes times powers, made comparable between places by the power that is missing
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum((x.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0xA5)) * power[: len(x)])]) for x in (a, b)]

    def met(n: int) -> tuple[int, int] | None:
        x, y = [(s[n:] - s[:-n]) * power[len(power) - 1 - np.arange(len(s) - n)] for s in sums]
        for i in np.flatnonzero(np.isin(x, y)):
            for j in np.flatnonzero(y == x[i]):
                if np.array_equal(a[i : i + n], b[j : j + n]):
                    return int(i), int(j)
        return None

    low, high, at = 0, min(len(a), len(b)), (0, 0)
    while low < high:
        mid = (low + high + 1) // 2
        if found := met(mid):
            low, at = mid, found
        else:
            high = mid - 1
    return low, *at


def _by_runs(a: np.ndarray, b: np.ndarray, order: np.ndarray | None = None, ordered: np.ndarray | None = None) -> int:
    """Elements in matching blocks, from the list of all runs of equal elements; each step cuts the runs to its part."""
    order = np.argsort(b, kind="stable") if order is None else order
    ordered = b[order] if ordered is None else ordered
    first, last = (np.searchsorted(ordered, a, side) for side in ("left", "right"))
    n = last - first
    i = np.repeat(np.arange(len(a)), n)
    j = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
    key = np.sort((i - j + len(b)) * (len(a) + 1) + i)  # by diagonal, then place
    starts = np.flatnonzero(np.diff(key, prepend=-2) != 1)
    size = np.diff(np.append(starts, len(key)))
    i = key[starts] % (len(a) + 1)
    j = i - key[starts] // (len(a) + 1) + len(b)
    done, todo = 0, [(i, j, size)]
    while todo:
        i, j, size = todo.pop()
        if not len(i):
            continue
        top = np.flatnonzero(size == size.max())
        top = top[np.lexsort((j[top], i[top]))[0]]
        n, p, q = size[top], i[top], j[top]
        done += int(n)
        before = np.minimum(size, np.minimum(p - i, q - j))
        skip = np.maximum(0, np.maximum(p + n - i, q + n - j))
        todo.append((i[before > 0], j[before > 0], before[before > 0]))
        rest = size - skip > 0
        todo.append((i[rest] + skip[rest], j[rest] + skip[rest], (size - skip)[rest]))
    return done


def _in_blocks(a: np.ndarray, b: np.ndarray, need: float = 0) -> int:
    """Elements in difflib's matching blocks of two sequences of codes, in bounded memory; some number below ``need`` if it can't be reached."""
    done, todo, possible = 0, [(a, b)], min(len(a), len(b))
    while todo and possible >= need:
        a, b = todo.pop()
        possible -= min(len(a), len(b))
        if not len(a) or not len(b):
            continue
        most = int(max(a.max(), b.max())) + 1
        x, y = np.bincount(a, minlength=most), np.bincount(b, minlength=most)
        if possible + int(np.minimum(x, y).sum()) < need:
            return 0
        if int(x @ y) <= _LISTED:
            n, parts = _by_runs(a, b), []
        else:
            n, i, j = _common(a, b)
            parts = [(a[:i], b[:j]), (a[i + n :], b[j + n :])] if n else []
        done += n
        possible += n + sum(min(map(len, p)) for p in parts)
        todo += parts
    return done


def _longest(a: str, b: str, most: int = 500) -> tuple[int, int, int] | None:
    """Size and places of the longest common block, the earliest one; None if it is short or its parts stand in too many places.

    A block of 2w - 1 characters holds one of the pieces of w into which ``a`` is cut, so the places of those in ``b`` give all of them.
    """
    w = (min(len(a), len(b)) + 1) // 2
    while w >= 12:
        best, tries = (0, 0, 0), 0
        for k in range(0, len(a) - w + 1, w):
            piece = a[k : k + w]
            j = b.find(piece)
            while j >= 0:
                tries += 1
                if tries > most:
                    return None
                left = _agree(a[:k][::-1], b[:j][::-1])
                best = min(best, (-left - w - _agree(a[k + w :], b[j + w :]), k - left, j - left))
                j = b.find(piece, j + 1)
        if -best[0] >= 2 * w - 1:
            return -best[0], best[1], best[2]
        w = (w + 1) // 2
    return None


def _ends(a: str, b: str) -> tuple[int, str, str]:
    """Characters that a common beginning or end surely matches, and what is left between.

    A common beginning or end is the longest block if every longer one would hold the middle of ``a``, and that doesn't
    stand elsewhere in ``b``.
    """
    done = 0
    while a and b:
        n = _agree(a, b)
        if n and (n == min(len(a), len(b)) or (2 * n >= len(a) and a[len(a) - n - 1 : n + 1] not in b)):
            done, a, b = done + n, a[n:], b[n:]
            continue
        n = _agree(a[::-1], b[::-1])
        # an equally long block further to the front would win
        if 2 * n > len(a) and b.find(middle := a[len(a) - n : n]) == b.rfind(middle) == len(b) - n:
            done, a, b = done + n, a[: len(a) - n], b[: len(b) - n]
            continue
        break
    return done, a, b


def matched(a: str, b: str, need: float = 0) -> int:
    """Characters in matching blocks: the longest block, then those on either side of it; the earliest of equal ones.

    Texts with few edits needn't be searched whole (:func:`_ends`). Some number below ``need`` is returned as soon as
    what is left can't reach it.
    """
    done, todo, possible = 0, [(a, b)], min(len(a), len(b))
    while todo and possible >= need:
        a, b = todo.pop()
        possible -= min(len(a), len(b))
        n, a, b = _ends(a, b)
        size, found, parts = len(a) * len(b), None, []
        if size >= _TINY:
            found = _longest(a, b)
        if found:
            m, i, j = found
            parts = [(a[:i], b[:j]), (a[i + m :], b[j + m :])]
            n += m
        elif size < _SMALL:
            n += _small(a, b) if size else 0
        else:
            n += _in_blocks(*_codes(list(a), list(b)), need - possible - n)
        done += n
        possible += n + sum(min(map(len, p)) for p in parts)
        todo += parts
    return done


def may_match(a: str, b: str, least: float) -> bool:
    """Whether the characters and then the character grams of two texts leave a ratio of ``least`` possible.

    Of T characters M >= least * T / 2 match, in at most T - 2M + 1 runs, each of which breaks q - 1 grams of q.
    """
    s, total = least - 1e-6, len(a) + len(b)
    if 2 * min(len(a), len(b)) < s * total or 2 * (Counter(a) & Counter(b)).total() < s * total:
        return False
    q = min(6, 1 + int((s - 0.3) / (2 * (1 - s))))
    need = s * total / 2 - (q - 1) * (total * (1 - s) + 1)
    if q < 2 or need <= 0 or total < 200:
        return True
    x, y = (Counter(t[i : i + q] for i in range(len(t) - q + 1)) for t in (a, b))
    return (x & y).total() >= need - 1e-6


def _looks_alike(a: str, b: str) -> bool:
    """Whether over half of some pieces of ``a`` stand in ``b``; no bound, just to spare such texts a closer look."""
    at = range(0, max(1, len(a) - 15), max(16, len(a) // 32))
    return 2 * sum(a[i : i + 16] in b for i in at) > len(at)


def ratio_or_less(a: str, b: str, least: float) -> float:
    """Ratio of two texts by matching blocks; some value below ``least`` if it is less than that."""
    if a == b:
        return 1.0
    total = len(a) + len(b)
    need = (least - 1e-6) * total / 2  # ratios are rounded
    if min(len(a), len(b)) < need:
        return 0.0
    # near copies need no counting of grams
    return 2 * matched(a, b, need) / total if _looks_alike(a, b) or may_match(a, b, least) else 0.0


def ratio_from(a: Column | str, b: Column | str, least: float) -> Column:
    """Similarity of two texts by matching blocks, with no junk heuristic; some value below ``least`` where it is less than that."""

    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([ratio_or_less(p, q, least) for p, q in zip(x.fillna(""), y.fillna(""), strict=True)], dtype=float)

    return run(a, b)


def _coded_words(text: str) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """Codes of a text's words and their order: made once for a reference that many texts are compared with."""
    words = text.split()
    of = {w: k for k, w in enumerate(dict.fromkeys(words))}
    codes = np.array([of[w] for w in words], np.int64)
    order = np.argsort(codes, kind="stable")
    return of, codes, order, codes[order]


def _word_ratio(a: str, b: str, coded: dict[str, tuple] | None = None) -> float:
    """``coded`` holds the last references."""
    if a == b:
        return 1.0
    coded = {} if coded is None else coded
    if b not in coded:
        if len(coded) > 3:
            coded.clear()
        coded[b] = _coded_words(b)
    p, (of, codes, order, ordered) = a.split(), coded[b]
    if not p and not len(codes):
        return 1.0
    if len(p) * len(codes) < _SMALL // 8:
        n = _small(p, b.split())
    else:
        # a word that the reference hasn't has a code beyond its own
        x = np.array([of.get(w, len(of)) for w in p], np.int64)
        listed = int(np.bincount(codes, minlength=len(of) + 1)[x].sum())
        n = _by_runs(x, codes, order, ordered) if listed <= _LISTED else _in_blocks(x, codes)
    return 2 * n / (len(p) + len(codes))


@F.pandas_udf(T.DoubleType())
def word_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two texts by matching blocks of words."""
    coded: dict[str, tuple] = {}
    return pd.Series([_word_ratio(x or "", y or "", coded) for x, y in zip(a, b, strict=True)], dtype=float)


def _numbered_grams(size: int):
    """All character ``size``-grams of a text, each with how often it came before, so that a bag of grams is a set."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str) -> list[str]:
            seen: Counter = Counter()
            out = []
            for i in range(len(t) - size + 1):
                g = t[i : i + size]
                out.append(f"{seen[g]} {g}")
                seen[g] += 1
            return out

        return texts.map(one)

    return run


def pairs_that_may_match(rows: DataFrame, block: list[str], least: float, one_side: bool) -> DataFrame:
    """``a, b``: every pair of ids of a block whose texts can have a ratio of ``least``, few others; no pair of a block is tried.

    ``rows``: side, id, block, t (not empty). With ``one_side``, a < b; else a is of side 0 and b of side 1. Of two texts
    with T characters, M >= least * T / 2 of them match, in at most T - 2M + 1 runs, and a run of n characters has
    n - q + 1 grams of q in common. So much of their gram bags is common, and a pair must share one of the rarest grams
    of either, the rest being fewer than the common ones. Texts too short for such a bound meet by single characters.
    """
    s = least - 1e-6  # similarities are rounded
    q = max(1, min(5, 1 + int((s - 0.3) / (2 * (1 - s)))))
    length = F.length("t")

    def prefix(some: DataFrame, size: int) -> DataFrame:
        total = 2 * length / (2 - s)  # of the text and its shortest partner
        need = F.ceil(total * (s / 2) - (size - 1) * (total * (1 - s) + 1) - 1e-9)
        grams = some.select("side", "id", length.alias("len"), (length - size + 2 - need).alias("most"), need.alias("need"), *block, "t").filter("need >= 1")
        grams = grams.select("side", "id", "len", "most", *block, F.explode(_numbered_grams(size)("t")).alias("g")).select("side", "id", "len", "most", F.xxhash64(F.lit(size), *block, "g").alias("g"))
        rare = grams.groupBy("g").agg(F.count("*").alias("df"))
        w = Window.partitionBy("side", "id").orderBy("df", "g")
        return grams.join(rare, "g").withColumn("r", F.row_number().over(w)).filter("r <= most and df > 1").select("side", "id", "len", "g")

    met = prefix(rows, q)
    if q > 1:
        short = q * (2 - s) / (s - 2 * (q - 1) * (1 - s))
        met = met.unionByName(prefix(rows.filter(length <= short * (2 - s) / s + 1), 1))
    a, b = met.alias("a"), met.alias("b")
    sides = F.col("a.id") < F.col("b.id") if one_side else (F.col("a.side") == 0) & (F.col("b.side") == 1)
    close = 2 * F.least("a.len", "b.len") >= s * (F.col("a.len") + F.col("b.len"))
    return a.join(b, (F.col("a.g") == F.col("b.g")) & sides & close).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def near_duplicates_same_block(items: DataFrame, block: list[str], texts: list[str], least: float) -> DataFrame:
    """Pairs of a block whose texts have a mean ratio of at least ``least``, text by text: ``id_a, id_b, similarity``.

    Rows with equal texts are one class, the smallest id stands for it; rows with a null in the block or the texts take
    no part. As no ratio is above 1, each of k texts needs ``k * least - (k - 1)``: an empty one has an empty partner,
    and a pair meets by its first text that isn't empty.
    """
    use_checkpoints(items.sparkSession)
    each = len(texts) * least - (len(texts) - 1)
    # rows are named by id and hash, as an id may stand in several blocks; whole texts are fetched for pairs only
    h = F.xxhash64(*block, *texts)
    whole = items.dropna(subset=["item_id", *block, *texts])
    first = F.coalesce(*[F.when(F.col(t) != "", F.struct(F.lit(k).alias("_k"), F.col(t).alias("t"))) for k, t in enumerate(texts)])
    rows = whole.select(h.alias("h"), F.xxhash64(F.lit(1), *block, *texts).alias("h1"), F.struct("item_id", *block, first.alias("first")).alias("r"))
    rows = rows.groupBy("h", "h1").agg(F.min("r").alias("r")).select(F.struct("r.item_id", "h").alias("id"), *[F.col("r")[c].alias(c) for c in block], "r.first.*").filter("t is not null")
    pairs = pairs_that_may_match(rows.withColumn("side", F.lit(0)), [*block, "_k"], each, True).filter("a.item_id < b.item_id").checkpoint()
    need = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    full = whole.select(F.struct("item_id", h.alias("h")).alias("id"), F.struct(*texts).alias("x")).join(need, "id", "left_semi").dropDuplicates(["id"])
    x, y = [full.select(F.col("id").alias(n), F.col("x").alias(f"t{n}")) for n in "ab"]
    both = pairs.join(x, "a").join(y, "b")
    mean = sum((ratio_from(F.col("ta")[t], F.col("tb")[t], each) for t in texts), F.lit(0.0)) / len(texts)
    return both.select(F.col("a.item_id").alias("id_a"), F.col("b.item_id").alias("id_b"), F.round(mean, 6).alias("similarity")).filter(F.col("similarity") >= least)


def _classes(rows: DataFrame, key: str, block: list[str]) -> DataFrame:
    return rows.dropna(subset=[*block, "t"]).filter("t <> ''").groupBy(*block, "t").agg(F.min(key).alias("id")).select("id", *block, "t")


def _grams(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and hash of every character gram; equal hashes of unequal grams do no harm, as grams only rule pairs out."""
    n = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(codes)) - np.repeat(np.cumsum(n) - n, n)
    gram = np.zeros(max(0, len(codes) - size + 1), np.uint64)
    for k in range(size):
        gram = (gram + codes[k : k + len(gram)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    own = np.flatnonzero(at[: len(gram)] + size <= n[row[: len(gram)]])
    return row[own], at[own], gram[own]


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, no less than what blocks match; the bits of one number are the places of ``a``."""
    places: dict[str, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    whole = (1 << len(a)) - 1
    v = whole
    for x in b:
        u = v & places.get(x, 0)
        v = (v + u | v - u) & whole
    return len(a) - v.bit_count()


def common_subsequences(pairs: list[tuple[str, str]]) -> np.ndarray:
    """``common_subsequence`` of many pairs at once, by columns of 64 places; pairs with a long text go one by one."""
    out = np.zeros(len(pairs), np.int64)
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][0]))
    while order and len(pairs[order[-1]][0]) > 2000:
        k = order.pop()
        out[k] = common_subsequence(*pairs[k])
    while order:
        words = len(pairs[order[-1]][0]) // 64 + 1
        some = order[-max(1, 2048 // words) :]
        del order[-len(some) :]
        # what fills the shorter texts up matches nothing
        size = [64 * words, max(1, *(len(pairs[k][1]) for k in some))]
        a, b = (np.frombuffer("".join(pairs[k][x].ljust(n, chr(x)) for k in some).encode("utf-32-le"), np.uint32).reshape(len(some), n).copy() for x, n in enumerate(size))
        for x, y in ((a, 0), (b, 1)):
            n = np.array([len(pairs[k][y]) for k in some])
            x[np.arange(x.shape[1]) >= n[:, None]] = 2**32 - 1 - y
        if not any((x[x < 2**32 - 2] > 253).any() for x in (a, b)):
            a, b = a.astype(np.uint8), b.astype(np.uint8)
        b = np.ascontiguousarray(b.T)
        v = np.full((words, len(some)), 2**64 - 1, np.uint64)
        for c in range(len(b)):
            u = np.packbits(a == b[c, :, None], axis=1, bitorder="little").view(np.uint64).T & v
            carry = np.zeros(len(some), np.uint64)
            for w in range(words):
                sums = v[w] + u[w]
                over = sums < u[w]
                sums += carry
                carry = (over | (sums < carry)).astype(np.uint64)
                v[w] = sums | (v[w] ^ u[w])
        out[some] = 64 * words - np.bitwise_count(v).sum(axis=0, dtype=np.int64)
    return out


def _bags(texts: list[str], size: int, bins: int) -> np.ndarray:
    """How many character grams of each text fall into each bin; a bin of several grams only makes bags more alike."""
    row, _, gram = _grams(texts, size)
    at = gram & np.uint64(bins - 1) if size == 1 else _mixed(gram) & np.uint64(bins - 1)
    return np.bincount(row * bins + at.astype(np.int64), minlength=len(texts) * bins).reshape(len(texts), bins).astype(np.int32)


#: Texts up to this length are compared by whole bags of characters, where those take so many columns at the most; bins of bags of larger grams.
_SHORT, _COLUMNS, _BINS = 600, 2000, {2: 128, 3: 512}


class _Held:
    """Texts by length with the places of their grams, to find those that other texts can have a ratio of ``least`` with."""

    def __init__(self, ids: list[int], texts: list[str], least: float) -> None:
        order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
        self.ids, self.texts = [ids[k] for k in order], [texts[k] for k in order]
        self.n, self.s = np.array([len(t) for t in self.texts], np.int64), least - 1e-6  # similarities are rounded
        self.of: dict[int, tuple] = {}

    def need(self, size: int, total: np.ndarray) -> np.ndarray:
        """Grams of ``size`` that matching blocks hold: of T characters M >= s * T / 2 match, in at most T - 2M + 1 runs."""
        return np.maximum(1, np.ceil(total * (self.s / 2) - (size - 1) * (total * (1 - self.s) + 1) - 1e-9)).astype(np.int64)

    def index(self, size: int) -> tuple:
        if size not in self.of:
            row, at, gram = _grams(self.texts, size)
            order = np.lexsort((row, gram))
            row, at = row[order], at[order]
            different, first = np.unique(gram[order], return_inverse=True)
            self.of[size] = different, first * len(self.n) + row, row, at
        return self.of[size]

    def short(self) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, dict]:
        """How many held texts a short one may match; bin and count of each column, the columns and bags of larger grams of those texts.

        A column tells whether a bin has at least so many characters, so the product of two texts' columns is how many
        characters their bags have in common. Counts beyond those of held texts need no column.
        """
        if 0 not in self.of:
            m = int(np.searchsorted(self.n, _SHORT * (2 - self.s) / self.s + 1, "right"))
            held = _bags(self.texts[:m], 1, 64)
            most = held.max(axis=0, initial=0)
            bins = np.repeat(np.arange(64), most)
            level = np.arange(len(bins)) - np.repeat(np.cumsum(most) - most, most) + 1
            columns = (held[:, bins] >= level).astype(np.float32) if len(bins) <= _COLUMNS else None
            self.of[0] = m, bins, level, columns, {q: _bags(self.texts[:m], q, bins).astype(np.uint16) for q, bins in _BINS.items()}
        return self.of[0]

    def alike_bags(self, texts: list[str]) -> Iterator[tuple[int, int]]:
        """Pairs of short texts whose bags of characters, pairs and triples of characters leave the ratio possible."""
        m, bins, level, columns, larger = self.short()
        n = np.array([len(t) for t in texts], np.int64)
        common = (_bags(texts, 1, 64)[:, bins] >= level).astype(np.float32) @ columns.T
        u, v = np.nonzero(2 * common >= self.s * (n[:, None] + self.n[:m]).astype(np.float32) - 0.01)
        for q, held in larger.items():
            mine, total, enough = _bags(texts, q, _BINS[q]).astype(np.uint16), n[u] + self.n[v], []
            for k in range(0, len(u), 1 << 14):
                part = slice(k, k + (1 << 14))
                need = total[part] * (self.s / 2) - (q - 1) * (total[part] * (1 - self.s) + 1)
                enough.append(np.minimum(mine[u[part]], held[v[part]]).sum(axis=1) >= need - 1e-6)
            enough = np.concatenate([*enough, np.zeros(0, bool)])
            u, v = u[enough], v[enough]
        return zip(u.tolist(), v.tolist(), strict=True)

    def candidates(self, texts: list[str], size: int) -> Iterator[tuple[int, int]]:
        """Pairs with enough common grams of ``size`` at places that one alignment can hold.

        Before a match at i and j at most la - M and lb - M characters are left out, so i - j lies between -(lb - M) and la - M.
        """
        grams, key, held, place = self.index(size)
        n, m = np.array([len(t) for t in texts], np.int64), len(self.n)
        row, at, gram = _grams(texts, size)
        found = np.minimum(np.searchsorted(grams, gram), max(0, len(grams) - 1))
        known = np.flatnonzero(grams[found] == gram) if len(grams) else np.zeros(0, np.int64)
        row, at, found = row[known], at[known], found[known]
        # partners by length
        lo, hi = np.searchsorted(self.n, n * (self.s / (2 - self.s)) - 1e-6), np.searchsorted(self.n, n * ((2 - self.s) / self.s) + 1e-6, "right")
        first, last = np.searchsorted(key, found * m + lo[row]), np.searchsorted(key, found * m + hi[row])
        some = np.flatnonzero(last > first)
        row, at, first, hits = row[some], at[some], first[some], (last - first)[some]
        count, done = np.zeros(len(texts) * m, np.int32), np.cumsum(hits)
        cuts = np.unique(np.concatenate([[0], np.searchsorted(done, np.arange(1, done[-1] // _HITS + 1) * _HITS), [len(hits)]])) if len(hits) else []
        for x, y in itertools.pairwise(cuts):
            k = hits[x:y]
            i = np.repeat(first[x:y] - np.cumsum(k) + k, k) + np.arange(k.sum())
            u, v, apart = np.repeat(row[x:y], k), held[i], np.repeat(at[x:y], k) - place[i]
            matching = (n[u] + self.n[v]) * (self.s / 2) - 1e-6
            near = (apart <= n[u] - matching) & (-apart <= self.n[v] - matching)
            count += np.bincount(u[near] * m + v[near], minlength=len(count)).astype(np.int32)
        pair = np.flatnonzero(count)
        u, v = pair // m, pair % m
        enough = count[pair] >= self.need(size, n[u] + self.n[v])
        return zip(u[enough].tolist(), v[enough].tolist(), strict=True)

    def matches(self, texts: list[str], held_first: bool) -> Iterator[tuple[int, int, float]]:
        """Place in ``texts``, id and ratio, which counts from the held text if ``held_first``, as the ratio depends on the order."""
        n = np.array([len(t) for t in texts], np.int64)
        # of the shortest partner; the longest grams that two or more must be common of
        shortest = n * (2 / (2 - self.s))
        size = np.ones(len(n), np.int64)
        for q in range(2, 6):
            size[self.need(q, shortest) >= 2] = q
        if self.short()[3] is not None:
            size[n <= _SHORT] = 0
        for q in np.unique(size).tolist():
            mine = np.flatnonzero(size == q)
            for part in np.array_split(mine, -(-len(mine) * len(self.n) // _HITS)):
                some = [texts[k] for k in part]
                found = [(int(part[u]), v) for u, v in (self.candidates(some, q) if q else self.alike_bags(some))]
                most = common_subsequences([(texts[u], self.texts[v]) for u, v in found])
                total = np.array([n[u] + self.n[v] for u, v in found], np.int64)
                for k in np.flatnonzero(2 * most >= self.s * total).tolist():
                    u, v = found[k]
                    a, b = texts[u], self.texts[v]
                    need = self.s * (len(a) + len(b)) / 2
                    if a == b:
                        yield u, self.ids[v], 1.0
                    elif may_match(a, b, self.s):
                        yield u, self.ids[v], 2 * (matched(b, a, need) if held_first else matched(a, b, need)) / (len(a) + len(b))


#: Characters of the texts that a task holds at once, and grams that are compared at once.
_HELD, _HITS = 1 << 21, 1 << 21


def matches_between(held: DataFrame, others: DataFrame, block: list[str], least: float, held_first: bool) -> DataFrame:
    """``held_id, other_id, similarity`` of the texts of both sides (id, block, t: not empty) of a block with a ratio of ``least`` or more.

    ``held``, best the smaller side, is cut into chunks of about ``_HELD`` characters, which tasks index by grams while the
    others stream past: those are shuffled once for each chunk, pairs never. Copies among the others each give a row.
    """
    spark = held.sparkSession
    key = F.to_json(F.struct(*block)) if block else F.lit("")
    held, others = [x.select(key.alias("k"), F.col("id").cast("long").alias("id"), "t") for x in (held, others)]
    chunks = held.groupBy("k").agg(F.ceil(F.sum(F.length("t")) / _HELD).cast("int").alias("chunks"))
    n = chunks.agg(F.sum("chunks")).first()[0] or 1
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    deals = max(1, 4 * tasks // n)
    if block:
        held, others = held.join(chunks, "k"), others.join(chunks, "k")
    else:
        held, others = held.withColumn("chunks", F.lit(n)), others.withColumn("chunks", F.lit(n))
    one = held.select("k", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("i"), F.pmod(F.xxhash64("t"), "chunks").cast("int").alias("j"), F.lit(0).alias("side"), "id", "t")
    two = others.select("k", F.pmod(F.xxhash64("id", "t"), F.lit(deals)).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"), F.lit(1).alias("side"), "id", "t")
    dealt = one.unionByName(two).repartition(tasks, "k", "i", "j").sortWithinPartitions("k", "i", "j", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, texts, found = None, [], None
        for batch in batches:
            group = list(zip(*(batch.column(c).to_pylist() for c in ("k", "i", "j", "side")), strict=True))
            cuts = [0, *(x for x in range(1, len(group)) if group[x] != group[x - 1]), len(group)]
            for lo, hi in itertools.pairwise(cuts):
                if lo == hi:
                    continue
                if group[lo][:3] != at:
                    at, texts, found = group[lo][:3], [], None
                ids, t = (batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("id", "t"))
                if group[lo][3] == 0:
                    texts += zip(ids, t, strict=True)
                    continue
                if not texts:
                    continue
                found = found or _Held(*map(list, zip(*texts, strict=True)), least)
                # copies are compared once
                places: dict[str, list[int]] = {}
                for x, y in zip(ids, t, strict=True):
                    places.setdefault(y, []).append(x)
                different = list(places)
                out = [(h, x, s) for u, h, s in found.matches(different, held_first) for x in places[different[u]]]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["held_id", "other_id", "similarity"])

    met = dealt.mapInArrow(run, "held_id long, other_id long, similarity double")
    return met.withColumn("similarity", F.round("similarity", 6)).filter(F.col("similarity") >= least)


def _gram_set(t: str, n: int) -> set[str]:
    """Distinct character n-grams of the text between two blanks."""
    t = f" {t} "
    return {t} if len(t) <= n else {t[i : i + n] for i in range(len(t) - n + 1)}


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a hash depends on all bits before."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Parts:
    """Keys at which texts meet whose gram sets have a Dice similarity of ``s``.

    Two such sets of a and b grams differ in at most (1 - s)(a + b) grams, so if grams are dealt to one part more than
    that by their hash, one part is the same in both. A size is in a class whose next sizes by the least ratio of sizes,
    s / (2 - s), are in the same class or the next one; each class of the smaller set deals by a number of parts of its
    own. So a text has the keys of its own class and of the class below, where it is the larger one.
    """

    def __init__(self, s: float, n: int) -> None:
        self.s, self.n = s, n
        self.first, self.parts = [1], []

    def grow(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        r = self.s / (2 - self.s)
        while self.first[-1] <= most:
            self.first.append(int(self.first[-1] / r + 1e-9) + 1)
            top = self.first[-1] - 1
            self.parts.append(int((1 - self.s) * (top + int(top / r + 1e-9)) + 1e-9) + 1)
        return np.array(self.first, np.int64), np.array(self.parts, np.int64)

    def keys(self, texts: list[str], blocks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]]:
        """Place in ``texts``, size, bits (the parity of the grams by 64 hashes) and key of every part; whether it is of the own class."""
        row, _, gram = _grams([f" {t} ".ljust(self.n, chr(0)) for t in texts], self.n)
        gram = _mixed(gram)
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        row, gram = row[new], gram[new]
        size = np.bincount(row, minlength=len(texts))
        bits = np.zeros(len(texts), np.uint64)
        np.bitwise_xor.at(bits, row, np.uint64(1) << (gram & np.uint64(63)))
        first, parts = self.grow(int(size.max(initial=0)))
        own = np.searchsorted(first, size, "right") - 1
        for level in (own, own - 1):
            k = np.where(level >= 0, parts[level], 0)
            start = np.cumsum(k) - k
            here = level[row] >= 0
            r, g = row[here], gram[here]
            sums = np.zeros(k.sum(), np.uint64)
            np.add.at(sums, start[r] + ((g >> np.uint64(6)) % k[r].astype(np.uint64)).astype(np.int64), g)
            at = np.repeat(np.arange(len(texts)), k)
            part = np.arange(len(at)) - start[at]
            key = _mixed(_mixed(sums) + blocks.astype(np.uint64)[at] + _mixed((level[at] << 32 | part).astype(np.uint64) + np.uint64(1)))
            yield at, size[at], bits[at], key, level is own


def _may_be_alike(rows: DataFrame, block: list[str], s: float, n: int) -> DataFrame:
    """``id_a, id_b``: every pair of a block (item_id, block, t) whose n-grams can have a Dice similarity of ``s``, and few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _Parts(s, n)
        for batch in batches:
            ids, blocks, texts = np.asarray(batch.column("item_id")), np.asarray(batch.column("b")), batch.column("t").to_pylist()
            done = np.cumsum([len(t) for t in texts]) // _CHARS
            for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(done)) + 1):
                for at, size, bits, key, own in parts.keys([texts[i] for i in some], blocks[some]):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some][at]), pa.array(size), pa.array(bits.view(np.int64)), pa.array(key.view(np.int64)), pa.array(np.full(len(at), own))], ["id", "n", "bits", "key", "own"])

    keyed = rows.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64(*block).alias("b"), "t").mapInArrow(run, "id long, n long, bits long, key long, own boolean")
    a, b = keyed.filter("own").alias("a"), keyed.alias("b")
    apart = (1 - s) * (F.col("a.n") + F.col("b.n")) + 1e-9
    # both of one class meet at their own keys only
    on = (F.col("a.key") == F.col("b.key")) & F.when(F.col("b.own"), F.col("a.id") < F.col("b.id")).otherwise(F.col("a.id") != F.col("b.id")) & (F.abs(F.col("a.n") - F.col("b.n")) <= apart)
    on = on & (F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= apart)
    return a.join(b, on).select(F.least("a.id", "b.id").alias("id_a"), F.greatest("a.id", "b.id").alias("id_b")).distinct()


#: Fixed value: characters whose grams a task holds at once.
_CHARS = 1 << 18


def near_duplicates_ngram(items: DataFrame, block: list[str], text: Column, least: float = 0.94, length_ratio: float = 0.72) -> DataFrame:
    """Pairs of a block with a Dice similarity of at least ``least`` over character 5-grams; meant for a ``least`` near 1.

    Gram sets are dealt to parts by hash, so many that a similar pair has a whole part in common; texts meet at equal parts
    (some eight grams each), so neither a big block nor frequent grams are compared pair by pair. Equal texts are one class.
    """
    rows = items.dropna(subset=block).select("item_id", *block, text.alias("t")).filter("t <> ''").groupBy(*block, "t").agg(F.min("item_id").alias("item_id")).filter("item_id is not null")
    # a text that stands alone in its block has no partner
    rows = rows.join(rows.groupBy(*block).agg(F.count("*").alias("_k")).filter("_k > 1").drop("_k"), block, "left_semi")
    pairs = _may_be_alike(rows, block, least - 1e-6, 5)  # similarities are rounded
    full = lambda x: rows.select(F.col("item_id").alias(f"id_{x}"), F.struct(*block).alias(f"b{x}"), F.col("t").alias(f"t{x}"))
    met = pairs.join(full("a"), "id_a").join(full("b"), "id_b").filter((F.col("ba") == F.col("bb")) & (F.least(F.length("ta"), F.length("tb")) >= length_ratio * F.greatest(F.length("ta"), F.length("tb"))))

    def dice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                x, y = _gram_set(a, 5), _gram_set(b, 5)
                out.append(2.0 * len(x & y) / (len(x) + len(y)))
            yield pa.RecordBatch.from_arrays([batch.column("id_a"), batch.column("id_b"), pa.array(out, pa.float64())], ["id_a", "id_b", "similarity"])

    out = met.select("id_a", "id_b", "ta", "tb").mapInArrow(dice, "id_a long, id_b long, similarity double")
    return out.withColumn("similarity", F.round("similarity", 6)).filter(F.col("similarity") >= least)


def originality_check(new: DataFrame, pool: DataFrame, block: list[str], least: float, floor: float | None = None) -> DataFrame:
    """Best match of each new row in its block of the pool: ``item_id, match_id, similarity, original``; the smallest id of equal ones.

    ``new`` and ``pool``: item_id, block, t. Matches below ``floor`` (``least`` if not given) aren't looked for and are
    null. Null and empty texts, and rows with a null in the block, match nothing.
    """
    x = _classes(new, "item_id", block)
    y = pool.dropna(subset=[*block, "t"]).filter("t <> ''").select(F.col("item_id").alias("id"), *block, "t")
    met = matches_between(x, y, block, least if floor is None else min(floor, least), True).select(F.col("held_id").alias("a"), F.col("other_id").alias("b"), "similarity")
    best = met.groupBy("a").agg(F.max(F.struct("similarity", (-F.col("b")).alias("m"))).alias("best"))
    of = new.join(x.withColumnRenamed("id", "a"), [*block, "t"]).select("item_id", "a").join(best, "a").select("item_id", "best")
    out = new.select("item_id").join(of, "item_id", "left")
    return out.select("item_id", (-F.col("best.m")).alias("match_id"), F.col("best.similarity").alias("similarity"), (F.coalesce("best.similarity", F.lit(0.0)) < least).alias("original"))


def anti_join_existing(new: DataFrame, pool: DataFrame, key: Column) -> DataFrame:
    """New rows whose key is neither in the pool nor taken by an earlier new row."""
    n = new.withColumn("_k", F.sha2(key, 256))
    first = n.groupBy("_k").agg(F.min("item_id").alias("item_id"))
    return n.join(first, ["_k", "item_id"], "left_semi").join(pool.select(F.sha2(key, 256).alias("_k")), "_k", "left_anti").drop("_k")


def internal_duplicates(items: DataFrame, key: Column) -> DataFrame:
    """Later copies with the id of the first."""
    return items.select("item_id", F.sha2(key, 256).alias("k")).withColumn("first_id", F.min("item_id").over(Window.partitionBy("k"))).filter("item_id <> first_id").select("item_id", "first_id")


def _held_tokens(articles: DataFrame, asked: DataFrame) -> DataFrame:
    """``norm_id, article_id, h``: each article's different tokens, hashed with its norm, that may be among ``asked`` (h)."""
    passing = places_in(asked.select("h").distinct(), "h")
    hashed = articles.filter("norm_id is not null").select("norm_id", "article_id", F.array_distinct(F.transform("tokens", lambda x: F.xxhash64("norm_id", x))).alias("h"))
    return hashed.withColumn("at", passing(F.col("h"))).select("norm_id", "article_id", F.transform("at", lambda i: F.get(F.col("h"), i)).alias("h"))


def _best_of_blocks(asked: DataFrame, held: DataFrame, k: int, score: Callable[[np.ndarray, float], np.ndarray], size: int = 1 << 14) -> DataFrame:
    """``item_id, article_id, s``: for each item the ``k`` best articles of every block of its norm, by ``score`` and then id.

    ``asked``: item_id, norm_id, h and w (arrays: hashed tokens and their weights), whole; ``held``: norm_id, article_id, h.
    ``score`` turns the sums of the weights of common tokens and the item's ``whole`` into whole numbers; articles
    without a positive sum are left out. A norm's articles are dealt to blocks of about ``size``, each an inverted
    index in memory, and its items stream past all of them: so articles are shuffled once, pairs of items and articles never.
    """
    blocks = held.groupBy("norm_id").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    n = blocks.agg(F.sum("blocks")).first()[0] or 1
    rows = held.join(blocks, "norm_id").select("norm_id", F.pmod(F.xxhash64("article_id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("side"), F.col("article_id").cast("long").alias("id"), "h", F.array().cast("array<double>").alias("w"), F.lit(0.0).alias("whole"))
    every = asked.join(blocks, "norm_id").select("norm_id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), F.col("item_id").cast("long").alias("id"), "h", "w", F.col("whole").cast("double").alias("whole"))
    # more partitions than blocks, so that few share one
    dealt = rows.unionByName(every).repartition(max(8, min(2000, 4 * n)), "norm_id", "block").sortWithinPartitions("norm_id", "block", "side", "id")

    def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return np.asarray(column.flatten()), np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths().fill_null(0), np.int64))])

    def best(index: tuple, b: pa.RecordBatch) -> pa.RecordBatch:
        ids, tokens, starts, at = index
        h, ends = lists(b.column("h"))
        w, whole, items = np.asarray(b.column("w").flatten()), np.asarray(b.column("whole")), np.asarray(b.column("id"))
        place = np.minimum(np.searchsorted(tokens, h), max(0, len(tokens) - 1))
        known = tokens[place] == h if len(tokens) else np.zeros(len(h), bool)
        out = []
        for i in range(len(items)):
            own = np.flatnonzero(known[ends[i] : ends[i + 1]]) + ends[i]
            if not len(own):
                continue
            runs = [at[starts[p] : starts[p + 1]] for p in place[own]]
            sums = np.bincount(np.concatenate(runs), np.repeat(w[own], [len(r) for r in runs]), len(ids))
            some = np.flatnonzero(sums > 0)
            s = score(sums[some], whole[i])
            if len(s) > k:
                least = np.partition(s, -k)[-k]
                more, same = np.flatnonzero(s > least), np.flatnonzero(s == least)
                took = np.sort(np.concatenate([more, same[: k - len(more)]]))
                some, s = some[took], s[took]
            out.append((np.full(len(s), items[i]), ids[some], s.astype(np.int64)))
        got = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else [(), (), ()])]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in got], ["item_id", "article_id", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, articles, index = None, [], None
        for batch in batches:
            norm, block, side = (batch.column(c).to_pylist() for c in ("norm_id", "block", "side"))
            cuts = [0, *(i for i in range(1, len(side)) if (norm[i], block[i], side[i]) != (norm[i - 1], block[i - 1], side[i - 1])), len(side)]
            for lo, hi in itertools.pairwise(cuts):
                if lo == hi:
                    continue
                b = batch.slice(lo, hi - lo)
                if (norm[lo], block[lo]) != key:
                    key, articles, index = (norm[lo], block[lo]), [], None
                if side[lo] == 0:
                    articles.append((np.asarray(b.column("id")), *lists(b.column("h"))))
                    continue
                if index is None and not articles:  # a block that no article was dealt to
                    continue
                if index is None:
                    ids = np.concatenate([a[0] for a in articles])
                    tokens = np.concatenate([a[1] for a in articles])
                    at = np.repeat(np.arange(len(ids)), np.concatenate([np.diff(a[2]) for a in articles]))
                    order = np.argsort(tokens, kind="stable")
                    different, starts = np.unique(tokens[order], return_index=True)
                    index, articles = (ids, different, np.append(starts, len(tokens)), at[order]), []
                yield best(index, b)

    return dealt.mapInArrow(run, "item_id long, article_id long, s long")


def idf_rank(items: DataFrame, articles: DataFrame, k: int) -> DataFrame:
    """For each item the ``k`` articles of its norm that cover most of its words, weighted by rarity among the norm's articles.

    ``items``: item_id, norm_id, tokens, article; ``articles``: article_id, norm_id, tokens, article. A word in ``df`` of a
    norm's ``n`` articles weighs ``ln((n + 1) / (df + 1))``, also one that no article has. Articles without a common
    word have the score 0. The first of the norm's articles with the item's own ``article`` comes last if it isn't
    among the ``k``. Words meet by hash, in blocks of articles, so pairs of items and articles are never shuffled.
    """
    use_checkpoints(items.sparkSession)
    asked = items.select("item_id", "norm_id", F.explode(F.array_distinct("tokens")).alias("token")).select("item_id", "norm_id", F.xxhash64("norm_id", "token").alias("h"))
    held = _held_tokens(articles, asked).checkpoint()
    n = articles.groupBy("norm_id").agg(F.count("*").alias("total"))
    df = held.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    idf = F.log((F.col("total") + 1) / (F.coalesce("df", F.lit(0)) + 1))
    weighed = asked.join(n, "norm_id").join(df, "h", "left").select("item_id", "norm_id", "df", F.struct("h", idf.alias("w")).alias("t"))
    # words that no article has weigh in the whole only
    of = weighed.groupBy("item_id", "norm_id").agg(F.array_sort(F.collect_list(F.when(F.col("df").isNotNull(), F.col("t")))).alias("t"), F.sum("t.w").alias("whole"))

    def score(s: np.ndarray, whole: float) -> np.ndarray:
        return np.floor(s / (whole or 1.0) * 1e6 + 0.5)

    met = _best_of_blocks(of.select("item_id", "norm_id", "t.h", "t.w", "whole"), held, k, score, 1 << 15)
    # the norm's first k articles are enough to fill up with scores of 0
    first = articles.select("norm_id", "article_id").withColumn("r", F.row_number().over(Window.partitionBy("norm_id").orderBy("article_id"))).filter(F.col("r") <= k).drop("r")
    own = items.join(articles.groupBy("norm_id", "article").agg(F.min("article_id").alias("article_id")), ["norm_id", "article"])
    rows = ((met, F.col("s"), False), (items.select("item_id", "norm_id").join(first, "norm_id"), F.lit(0), False), (own, F.lit(-1), True))
    every = reduce(DataFrame.unionByName, [x.select("item_id", "article_id", s.cast("long").alias("s"), F.lit(own).alias("own")) for x, s, own in rows])
    every = every.groupBy("item_id", "article_id").agg(F.max("s").alias("s"), F.max("own").alias("own"))
    # an own article that is no candidate comes after k others, as the norm's first k articles are
    ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("s"), "article_id"))).filter((F.col("rank") <= k) | F.col("own"))
    return ranked.select("item_id", "article_id", F.when(F.col("rank") <= k, F.col("s") / 1e6).alias("score"), F.least("rank", F.lit(k + 1)).alias("rank"))


def weighted_overlap_rank(items: DataFrame, articles: DataFrame, k: int) -> DataFrame:
    """Score 2.2 per answer word and 1 per context word that an article of the norm holds, and 4 more from 38 % of the answer. Words meet by hash, in blocks of articles."""
    # one number for both counts; a word of both is there twice
    h = lambda words, w: F.transform(F.array_distinct(words), lambda x: F.struct(F.xxhash64("norm_id", x).alias("h"), F.lit(float(w)).alias("w")))
    asked = items.filter("norm_id is not null and answer is not null and context is not null").select("item_id", "norm_id", F.concat(h("answer", 1), h("context", 4096)).alias("t"), F.size("answer").cast("double").alias("whole")).select("item_id", "norm_id", "t.h", "t.w", "whole")

    def score(s: np.ndarray, n: float) -> np.ndarray:
        c, a = np.divmod(s, 4096)
        return 22 * a + 10 * c + 40 * ((n > 0) & (a / max(n, 1) >= 0.38))

    s = _best_of_blocks(asked, _held_tokens(articles, asked.select(F.explode("h").alias("h"))), k, score).select("item_id", "article_id", (F.col("s") / 10).alias("score"))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "article_id"))).filter(F.col("rank") <= k)


def best_name_match(names: DataFrame, candidates: DataFrame, least: float, margin: float) -> DataFrame:
    """Candidate name of each name, ``id, cand, s``. ``names`` (id) and ``candidates`` (cand) have ``tokens`` and ``identity`` (kind, number and year of a norm; null if none).

    A name with an identity takes the one candidate that shares it, and none if several do. Else the best candidate
    counts if it has ``least`` and leads by ``margin``: two different identities have nothing in common, of a name with
    and one without an identity one must hold all words of the other, and two without are compared by token sets.
    Names meet at shared tokens only.
    """
    same = names.filter("identity is not null").join(candidates.select("cand", "identity"), "identity").groupBy("id").agg(F.count("*").alias("n"), F.min("cand").alias("cand"))
    left = names.join(same.select("id"), "id", "left_anti")
    a = left.select("id", F.explode("tokens").alias("token"), F.size("tokens").alias("na"), F.col("identity").isNotNull().alias("ia"))
    b = candidates.select("cand", F.explode("tokens").alias("token"), F.size("tokens").alias("nb"), F.col("identity").isNotNull().alias("ib"))
    both = a.join(b, "token").filter("not (ia and ib)").groupBy("id", "cand", "na", "nb", "ia", "ib").agg(F.count("*").alias("n"))
    least_, most = F.least("na", "nb"), F.greatest("na", "nb")
    score = F.when(F.col("ia") != F.col("ib"), F.when(F.col("n") == least_, least_ / most).otherwise(0.0)).otherwise(F.col("n") / (F.col("na") + F.col("nb") - F.col("n")))
    s = both.select("id", "cand", F.round(score, 6).alias("s"))
    w = Window.partitionBy("id").orderBy(F.desc("s"), "cand")
    top = s.withColumn("r", F.row_number().over(w)).withColumn("next", F.lead("s").over(w)).filter("r = 1")
    top = top.filter((F.col("s") >= least) & (F.round(F.col("s") - F.coalesce("next", F.lit(0.0)), 6) >= F.lit(margin))).select("id", "cand", "s")
    return same.filter("n = 1").select("id", "cand", F.lit(1.0).alias("s")).unionByName(top)


def phrase_evidence(items: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """How many texts hold a phrase of ``size`` words of each item: ``item_id, state, text_id`` (unique, several, none).

    ``items``: item_id, words; ``texts``: text_id, words. Phrases meet by hash.
    """

    def phrases(df: DataFrame, key: str) -> DataFrame:
        return df.filter(F.size("words") >= size).select(key, F.explode(F.array_distinct(grams)).alias("h")).distinct()

    grams = F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: F.xxhash64(F.array_join(F.slice("words", i, size), " ")))
    asked = phrases(items, "item_id")
    passing = places_in(asked.select("h").distinct(), "h")
    held = texts.filter(F.size("words") >= size).select("text_id", grams.alias("g")).withColumn("at", passing(F.col("g"))).select("text_id", F.explode(F.transform("at", lambda i: F.get(F.col("g"), i))).alias("h")).distinct()
    met = asked.join(held, "h").groupBy("item_id").agg(F.count_distinct("text_id").alias("n"), F.min("text_id").alias("text_id"))
    out = items.select("item_id").join(met, "item_id", "left")
    state = F.when(F.col("n").isNull(), "NONE").when(F.col("n") == 1, "UNIQUE").otherwise("SEVERAL")
    return out.select("item_id", state.alias("state"), F.when(F.col("n") == 1, F.col("text_id")).alias("text_id"))


def hash_groups(articles: DataFrame) -> DataFrame:
    """Equal texts with the list of their sources."""
    by = articles.groupBy("text_hash").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("source_id")), ",").alias("sources"))
    return by.filter("n > 1")


def duplicate_usage(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Components by how many members a bank uses."""
    used = links.select("item_id").distinct()
    by = groups.join(used, groups["node"] == used["item_id"], "left").groupBy("component").agg(F.count("item_id").alias("n"))
    return by.select("component", F.when(F.col("n") >= 2, "SEVERAL").when(F.col("n") == 1, "ONE").otherwise("NONE").alias("usage"))


def strict_quality_set(flagged: DataFrame, pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Ids with a quality flag or a near duplicate, their reasons, and how many links they have."""
    ids = flagged.select("item_id", F.lit("FLAG").alias("reason")).union(pairs.select(F.col("id_a"), F.lit("DUPLICATE"))).union(pairs.select(F.col("id_b"), F.lit("DUPLICATE")))
    by = ids.groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))
    n = links.groupBy("item_id").agg(F.count("*").alias("n"))
    return by.join(n, "item_id", "left").select("item_id", "reasons", F.coalesce("n", F.lit(0)).alias("links"))


def central_key(items: DataFrame, margin: float = 0.02) -> DataFrame:
    """Whether the key is the option most similar to the other three by more than ``margin``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for r in pdf.itertuples():
                opts = [(x or "").lower().split() for x in (r.opt_a, r.opt_b, r.opt_c, r.opt_d)]
                s = [sum(difflib.SequenceMatcher(None, a, b).ratio() for j, b in enumerate(opts) if j != i) for i, a in enumerate(opts)]
                top = sorted(s, reverse=True)
                out.append(s.index(top[0]) == "ABCD".find(r.answer_key) and (top[0] - top[1]) / max(top[1], 1e-9) > margin)
            yield pd.DataFrame({"item_id": pdf["item_id"], "central": out})

    return items.select("item_id", *FIELDS[1:], "answer_key").mapInPandas(run, "item_id long, central boolean")


def match_official(items: DataFrame, official: DataFrame, marks: DataFrame, block: list[str], least: float = 0.85) -> DataFrame:
    """New marks ``item_id, exam_id, similarity`` of items like an official exam's item; marks that exist are left alone.

    ``items``: item_id, block, t; ``official``: exam_id, block, t. An item with several texts gets its best. Null and
    empty texts match nothing.
    """
    # official classes have ids of their own, as an exam has several texts
    text_id = F.xxhash64(*block, "t")
    y = _classes(official.withColumn("_id", text_id), "_id", block)
    x = items.dropna(subset=[*block, "t"]).filter("t <> ''").select(F.col("item_id").alias("id"), *block, "t")
    met = matches_between(y, x, block, least, False).groupBy(F.col("held_id").alias("b"), F.col("other_id").alias("item_id")).agg(F.max("similarity").alias("similarity"))
    theirs = official.select("exam_id", text_id.alias("b")).distinct()
    near = met.join(theirs, "b").groupBy("item_id", "exam_id").agg(F.max("similarity").alias("similarity"))
    return near.join(marks.select("item_id", "exam_id"), ["item_id", "exam_id"], "left_anti")


def article_duplicates(articles: DataFrame) -> DataFrame:
    """Rows of one (source, article) with several texts: each whole text's similarity, word by word, to the longest, which is the reference."""
    texts = articles.groupBy("source_id", "article_no", "text").agg(F.min("article_id").alias("article_id"))
    # hashes and lengths find the reference; the text itself is fetched for groups with several only
    size = texts.select("source_id", "article_no", "article_id", F.length("text").alias("n"))
    ref = size.groupBy("source_id", "article_no").agg(F.count("*").alias("texts"), F.max(F.struct("n", (-F.col("article_id")).alias("m"))).alias("ref")).filter("texts > 1").select("source_id", "article_no", (-F.col("ref.m")).alias("ref_id"))
    other = texts.select(F.col("article_id").alias("ref_id"), F.col("text").alias("ref"))
    met = texts.join(ref, ["source_id", "article_no"]).join(other, "ref_id")
    return met.select("source_id", "article_no", "article_id", F.round(word_ratio("text", "ref"), 6).alias("similarity"))


def merge_precheck(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """For each (keeper, loser) and call: whether the loser's link moves, is dropped as equal, or blocks because the links differ."""
    k = links.select("call_id", F.col("item_id").alias("keep_id"), F.struct("part_id", "link_type", "topic_id").alias("k"))
    r = links.select("call_id", "item_id", F.struct("part_id", "link_type", "topic_id").alias("l"))
    met = pairs.join(r, "item_id").join(k, ["keep_id", "call_id"], "left")
    return met.select("keep_id", "item_id", "call_id", F.when(F.col("k").isNull(), "MOVE").when(F.col("k").eqNullSafe(F.col("l")), "DROP").otherwise("BLOCK").alias("action"))


def conflicts_with_text(items: DataFrame, articles: DataFrame, key: Column) -> DataFrame:
    """Groups of equal text with different answers, and how many texts their article has."""
    conflict = items.select("item_id", "norm_id", "article_no", F.sha2(key, 256).alias("k"), "answer_key")
    bad = conflict.groupBy("k").agg(F.count_distinct("answer_key").alias("answers")).filter("answers > 1")
    n = articles.groupBy("norm_id", "article_no").agg(F.count("*").alias("texts"), F.array_join(F.array_sort(F.collect_set("source_id")), ",").alias("sources"))
    met = conflict.join(bad, "k").join(n, ["norm_id", "article_no"], "left")
    return met.select("item_id", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("sources", F.lit("")).alias("sources"))
