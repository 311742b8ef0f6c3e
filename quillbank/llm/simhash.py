"""SimHash near-dedup with anchor points from a covering code."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints
from quillbank.operators.components import connected_components

#: A block of fingerprint bits that one perfect Hamming code [31, 26] covers with radius 1.
BLOCK = 31
#: Points of one group in a block; a task compares two blocks at once.
CHUNK = 2048
#: For similarities: bands that pairs meet at, and the shingle minima in each; shingles of a block that a task compares at once.
BANDS, ROWS, LOAD = 20, 6, 1 << 20
#: Shingles whose bits are counted at once.
SLICE = 255 * 64


def _majority(hashes: Iterator[np.ndarray], lanes: int) -> tuple[int, np.ndarray]:
    """``lanes`` words of 64 bits: a bit is set if set in over half of the hashes. Further lanes mix the hash anew."""
    n, ones = 0, np.zeros(64 * lanes, np.int64)
    for h in hashes:
        n += len(h)
        wide = np.stack([h] + [_mixed(h, k) for k in range(1, lanes)], axis=1)
        bits = np.unpackbits(np.ascontiguousarray(wide).view(np.uint8), bitorder="little").reshape(-1, 64 * lanes)
        whole = len(bits) // 255 * 255
        ones += np.add.reduce(bits[:whole].reshape(-1, 255, 64 * lanes), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)
    return n, np.packbits(2 * ones > n, bitorder="little").view(np.uint64)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    x = h + np.uint64((k * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingles(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all word shingles, in slices; fewer words are one shingle, none is none."""
    for start in range(0, max(1, len(words) - size + 1) if words else 0, SLICE):
        part = words[start : start + SLICE + size - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
        yield np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)


def simhash(words: list[bytes], size: int) -> int:
    """64-bit SimHash of word shingles, repeats included."""
    return int(_majority(_shingles(words, size), 1)[1][0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """``id, fp`` (signed 64 bits) per row; null or empty text has the fingerprint zero, a short one is one shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [simhash(t.as_py().lower().split(), shingle) if t.is_valid else 0 for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["id", "fp"])

    # bytes.lower and bytes.split know A-Z and the six white space characters only
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text")).mapInArrow(run, "id long, fp long")


def anchors(fp: Column) -> Column:
    """Keys of all anchors within covering radius (1) plus threshold (1) of each of two blocks.

    Two fingerprints that differ in at most 3 bits differ in at most 1 bit of one of the blocks 0-30 and 31-61.
    There, the codeword nearest to the one is within 1 + 1 of the other, so both are replicated to it.
    The codewords within 2 of a word are the nearest one and, unless the word is a codeword, 15 more.
    """
    return F.concat(*[_block_anchors(F.shiftrightunsigned(fp, at * BLOCK).bitwiseAND(F.lit((1 << BLOCK) - 1)), at) for at in range(2)])


def _block_anchors(x: Column, at: int) -> Column:
    masks = [sum(1 << (p - 1) for p in range(1, BLOCK + 1) if p >> k & 1) for k in range(5)]
    syndrome = sum((F.bit_count(x.bitwiseAND(F.lit(m))) % 2) * (1 << k) for k, m in enumerate(masks)).cast("int")

    def bit(p: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (p - 1).cast("int"))

    near = F.array(F.when(syndrome == 0, x).otherwise(x.bitwiseXOR(bit(syndrome))))
    pairs = F.filter(F.sequence(F.lit(1), F.lit(BLOCK)), lambda p: (syndrome != 0) & (p < p.bitwiseXOR(syndrome)))
    far = F.transform(pairs, lambda p: x.bitwiseXOR(bit(p)).bitwiseXOR(bit(p.bitwiseXOR(syndrome))))
    return F.transform(F.concat(near, far), lambda c: c + F.lit(at << BLOCK))


def _groups(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Cut sorted frames into whole groups of equal ``by``."""
    left: list[pd.DataFrame] = []
    for pdf in frames:
        if not len(pdf):
            continue
        pdf = pd.concat([*left, pdf], ignore_index=True)
        k = pdf[by].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
            if b - a > 1:
                yield pdf[a:b]
        left = [pdf[cuts[-1] if len(cuts) else 0 :]]
    if left and len(left[0]) > 1:
        yield left[0]


def _cross_links(matcher: Callable[[pd.Series], Callable[[int, np.ndarray], np.ndarray]]):
    """Links between the rows that ask (``ask``) and the other rows of each group, but only between different components.

    Components that link are one from then on, so a group of c components gives less than c rows, never all pairs.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(frames, ["key", "i", "j"]):
            comp, ask = g["comp"].to_numpy(), g["ask"].to_numpy(bool)
            label, near, out = np.unique(comp, return_inverse=True)[1], matcher(g["p"]), []
            members = np.flatnonzero(~ask)
            for u in np.flatnonzero(ask):
                v = members[label[members] != label[u]]
                hit = v[near(u, v)] if len(v) else v
                if len(hit):
                    found, first = np.unique(label[hit], return_index=True)
                    out.append(np.stack([np.full(len(first), comp[u]), comp[hit[first]]]))
                    label[np.isin(label, found)] = label[u]
            if out:
                a, b = np.concatenate(out, axis=1)
                yield pd.DataFrame({"a": a, "b": b})

    return run


def _components(at: DataFrame, points: DataFrame, alike: Callable[[Column, Column], Column], matcher: Callable, load: int) -> DataFrame:
    """``rep, component`` of the points that link; points ``rep, p`` meet at the keys of ``at`` (``rep, n, key``; ``n``: what a point weighs).

    Keys that bring the same points together are one. Each group's smallest point is first held against all others of
    its group (``alike``), which joins most copies without a pair between them. Only groups that still hold several
    components are compared further: the points outside of a group's largest component ask all points of the group,
    in blocks of at most about ``CHUNK`` points or the weight ``load``. So no pair of different components is missed,
    no task holds more than two blocks, and copies are not paired with copies.
    """
    held = at.groupBy("key").agg(F.count("*").alias("m"), F.min("rep").alias("pivot"), F.max("rep").alias("hi"), F.bit_xor(F.xxhash64("rep")).alias("x")).filter("m > 1")
    many = held.groupBy("m", "pivot", "hi", "x").agg(F.min("key").alias("key")).select("key", "pivot")
    met = at.join(many, "key").filter("rep <> pivot").select("key", "pivot", "rep", "n").checkpoint()

    def salted(weight: Column) -> Column:
        return F.pmod(F.xxhash64("rep"), weight).cast("int")

    stars = met.select("pivot", "rep").distinct()
    blocks = stars.groupBy("pivot").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("blocks"))
    asked = stars.join(blocks, "pivot").select("pivot", "rep", salted(F.col("blocks")).alias("block")).join(points, "rep")
    pivots = points.join(blocks, points["rep"] == blocks["pivot"]).select("pivot", F.col("p").alias("of"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    first = connected_components(asked.join(pivots, ["pivot", "block"]).filter(alike(F.col("p"), F.col("of"))), "pivot", "rep").withColumnRenamed("node", "rep")
    named = met.join(first, "rep", "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    sums = named.groupBy("key", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    split = sums.groupBy("key").agg(F.count("*").alias("comps"), F.sum("m").alias("m"), F.sum("w").alias("w"), F.max(F.struct("m", "w", "comp")).alias("top")).filter("comps > 1")
    need = lambda m, w: F.ceil(F.greatest(m / CHUNK, w / load)).cast("int")
    split = split.select("key", F.col("top.comp").alias("most"), need(F.col("m"), F.col("w")).alias("members"), need(F.col("m") - F.col("top.m"), F.col("w") - F.col("top.w")).alias("asks"))
    left = named.join(split, "key").checkpoint()
    member = left.select("key", "rep", "comp", F.lit(False).alias("ask"), F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("i"), salted(F.col("members")).alias("j"))
    asks = left.filter("comp <> most").select("key", "rep", "comp", F.lit(True).alias("ask"), salted(F.col("asks")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("members") - 1)).alias("j"))
    dealt = member.union(asks).join(points, "rep").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    again = connected_components(dealt.mapInPandas(_cross_links(matcher), "a long, b long"), "a", "b")
    both = first.join(again, first["component"] == again["node"], "left").select("rep", F.coalesce(again["component"], first["component"]).alias("component"))
    alone = again.join(first, again["node"] == first["rep"], "left_anti").select(F.col("node").alias("rep"), "component")
    return both.union(alone)


def _close_bits(most: int):
    def matcher(p: pd.Series):
        fp = p.to_numpy(np.int64).view(np.uint64)
        return lambda u, v: np.bitwise_count(fp[v] ^ fp[u]) <= most

    return matcher


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, shingle: int = 5, threshold: int = 3) -> DataFrame:
    """Class every row by near-equal text: ``id, fp, component`` (the smallest id reachable over links of at most ``threshold`` <= 3 bits).

    Equal fingerprints are one point, whatever their number. Points meet at anchors (see :func:`anchors`) and are
    compared as in :func:`_components`, so a crowded anchor is dealt in blocks and no link is missed.

    Null or empty text: fingerprint zero, linked like any other. A null id gets a fingerprint and links like any other;
    its component is the class's, null if the class has no id. Rows that repeat an id are judged by their own texts. An empty table gives an empty result.
    """
    if not 0 <= threshold <= 3:
        raise ValueError("two blocks with one differing bit each cover at most 3 differing bits")
    use_checkpoints(docs.sparkSession)
    fps = fingerprints(docs, doc_id, text, shingle).checkpoint()
    reps = fps.groupBy("fp").agg(F.min("id").alias("least")).checkpoint()
    points = reps.select(F.col("fp").alias("rep"), F.col("fp").alias("p"))
    at = points.select("rep", F.lit(1).cast("long").alias("n"), F.explode(anchors(F.col("p"))).alias("key"))
    linked = _components(at, points, lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= threshold, _close_bits(threshold), CHUNK)
    return fps.join(_named(reps, linked, "fp"), "fp").select("id", "fp", "component")


def _named(reps: DataFrame, linked: DataFrame, point: str) -> DataFrame:
    """``reps`` with ``at``, the name of the component of its point, and ``component``, the least of the ``least`` ids in it."""
    met = reps.join(linked, reps[point] == linked["rep"], "left").select(*reps.columns, F.coalesce("component", point).alias("at"))
    return met.drop("least").join(met.groupBy("at").agg(F.min("least").alias("component")), "at")


def _band_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of ``BANDS`` bands of ``ROWS`` minima each over the distinct shingle hashes; two sets share a band's key with odds of Jaccard ** ``ROWS``."""
    k = np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)
    times, plus = _mixed(k, 1) | np.uint64(1), _mixed(k, 2)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 256):  # a product of 256 x 120 stays in the cache
        least = np.minimum(least, (hashes[at : at + 256, None] * times + plus).min(axis=0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        keys = _mixed(keys ^ row, 1)
    return keys.view(np.int64)


def _similar_sets(similarity: float):
    """Exact Jaccard similarities of one set with others, over codes that count the distinct values of the group."""

    def matcher(p: pd.Series):
        n = p.str.len().to_numpy()
        codes = np.unique(np.concatenate(p.to_numpy()), return_inverse=True)[1].astype(np.int32)
        sets = np.split(codes, np.cumsum(n)[:-1])
        mark = np.zeros(int(codes.max()) + 1, bool)

        def near(u: int, v: np.ndarray) -> np.ndarray:
            hit = np.minimum(n[v], n[u]) >= similarity * np.maximum(n[v], n[u])  # others cannot be similar
            at = np.flatnonzero(hit)
            if len(at):
                mark[sets[u]] = True
                both = np.add.reduceat(mark[np.concatenate([sets[k] for k in v[at]])], np.cumsum(n[v[at]]) - n[v[at]], dtype=np.int64)
                mark[sets[u]] = False
                hit[at] = both >= similarity * (n[v[at]] + n[u] - both)
            return hit

        return near

    return matcher


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Class every row by Jaccard similarity of its word shingles: ``id, component`` (the smallest id reachable), see :func:`similar_rows`."""
    return similar_rows(docs, doc_id, text, shingle=shingle, similarity=similarity).select("id", "component")


def text_id(text: str = "text") -> Column:
    """Hash of a text, that of the empty one for null: with the id, the name of a row among rows that repeat ids or have none."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def similar_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Class every row by Jaccard similarity of its word shingles: ``id, tid`` (:func:`text_id`), ``at`` (the class) and ``component`` (the smallest id in it).

    A Jaccard similarity of 0.8 moves 15 % of the bits of a SimHash, which no covering of one 64-bit fingerprint can
    span. So documents meet at ``BANDS`` bands of ``ROWS`` minima of the hashed shingle set: whatever the kind of edit,
    a pair at similarity ``j`` meets with odds of ``1 - (1 - j**6)**20``, 99.8 % at 0.8 and more above. Every link is
    then decided by the exact Jaccard similarity of the sets of 64-bit shingle hashes.

    Equal shingle sets are one point. The sets are made again for points that meet, so the texts are read twice, and
    compared as in :func:`_components`: most copies just with the smallest of their group, others in blocks.

    Null or empty text: linked with its like. A null id links like any other; its component is the class's, null if the
    class has no id. Rows that repeat an id are judged by their own texts.
    """
    use_checkpoints(docs.sparkSession)

    def read(meet: bool, kept: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sizes, sums, lists = [], [], []
                for t in b.column("text"):
                    every = np.unique(np.concatenate([np.zeros(0, np.uint64), *_shingles((t.as_py() or b"").lower().split(), shingle)]))
                    sizes.append(len(every))
                    sums.append(np.frombuffer(xxhash.xxh3_128_digest(every.tobytes()), np.int64))
                    lists.append((_band_keys(every) if len(every) else every.view(np.int64)) if meet else every.view(np.int64))
                s = np.array(sums, np.int64).reshape(-1, 2).T.copy()
                offsets = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
                values = pa.array(np.concatenate([np.zeros(0, np.int64), *lists]))
                yield pa.RecordBatch.from_arrays([*map(b.column, kept), pa.array(s[0]), pa.array(s[1]), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, values)], names=[*kept, "s0", "s1", "n", last])

        last = "keys" if meet else "shingles"
        return run, f"{''.join(f'{c} long, ' for c in kept)}s0 long, s1 long, n long, {last} array<long>"

    texts = docs.select(F.col(doc_id).cast("long").alias("id"), text_id(text).alias("tid"), F.col(text).cast("binary").alias("text"))
    sig = ["s0", "s1"]
    # a row without an id goes by its text
    row = F.coalesce("id", "tid").alias("row")
    fps = texts.mapInArrow(*read(True, ["id", "tid"])).checkpoint()
    # an equal set has equal keys; points are named by the first half of their digest
    reps = fps.groupBy(*sig).agg(F.min("id").alias("least"), F.coalesce(F.min("id"), F.min("tid")).alias("row")).checkpoint()
    one = reps.select("row", *sig)
    reps = reps.drop("row")
    at = fps.withColumn("row", row).join(one, ["row", *sig]).select(F.col("s0").alias("rep"), "row", "n", F.explode("keys").alias("key")).distinct()
    # a point that meets no other has no set to make
    need = at.join(at.groupBy("key").count().filter("count > 1").select("key"), "key").select(F.col("row").alias("of")).distinct()
    keyed = texts.select(row, "text")
    sets = keyed.join(need, keyed["row"] == need["of"], "left_semi").mapInArrow(*read(False, ["row"])).join(one, ["row", *sig]).dropDuplicates(["row", *sig])
    sets = sets.select(F.col("s0").alias("rep"), F.col("shingles").alias("p")).checkpoint()

    def alike(a: Column, b: Column) -> Column:
        both = F.size(F.array_intersect(a, b))
        return both >= F.lit(similarity) * (F.size(a) + F.size(b) - both)

    linked = _components(at.drop("row"), sets, alike, _similar_sets(similarity), LOAD)
    return fps.select("id", "tid", *sig).join(_named(reps, linked, "s0"), sig).select("id", "tid", "at", "component")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits of the unsigned value."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
