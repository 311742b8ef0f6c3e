"""Approximate nearest neighbours: a forest of random-projection trees with exact reranking."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints


#: Points or queries of one leaf that a task holds.
CHUNK = 4096


@dataclass
class Tree:
    """Inner nodes split by a direction and a cut; a negative child ``-1 - k`` is leaf ``k``."""

    direction: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, all rows going down together."""
        at = np.zeros(len(x), np.int64) if len(self.cut) else np.full(len(x), -1)
        while (inner := at >= 0).any():
            k = at[inner]
            side = np.einsum("ij,ij->i", x[inner], self.direction[k]) > self.cut[k]
            at[inner] = np.where(side, self.right[k], self.left[k])
        return -1 - at


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """Halve the sample at the median along the difference of two of its points until at most ``leaf`` are left."""
    nodes: list[list] = []
    leaves = 0
    todo = [(np.arange(len(sample)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        if len(rows) <= leaf:
            at, leaves = -1 - leaves, leaves + 1
        else:
            a, b = sample[rng.choice(rows, 2, replace=False)]
            d = a - b
            if not d.any():
                d = rng.standard_normal(sample.shape[1])
            d = d / np.linalg.norm(d)
            p = sample[rows] @ d
            c = np.median(p)
            if not (p > c).any():
                c = (p.max() + p.min()) / 2 if p.max() > p.min() else c
            if not (p > c).any():
                at, leaves = -1 - leaves, leaves + 1  # all points are the same here
            else:
                at = len(nodes)
                nodes.append([d, c, 0, 0])
                todo += [(rows[p <= c], at, 2), (rows[p > c], at, 3)]
        if parent is not None:
            nodes[parent][side] = at
    d = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array([n[0] for n in nodes]).reshape(-1, d), np.array([n[1] for n in nodes]), np.array([n[2] for n in nodes], np.int64), np.array([n[3] for n in nodes], np.int64))


def search(forest: list[Tree], x: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """(tree, leaf) of the ``visits`` leaves that the trees' shared queue gives first; margins are its priorities."""
    projected = [t.direction @ x - t.cut if len(t.cut) else None for t in forest]
    queue = [(-np.inf, k, 0 if len(t.cut) else -1) for k, t in enumerate(forest)]
    heapq.heapify(queue)
    found: list[tuple[int, int]] = []
    while queue and len(found) < visits:
        margin, k, at = heapq.heappop(queue)
        while at >= 0:
            m, t = projected[k][at], forest[k]
            near, far = (t.right[at], t.left[at]) if m > 0 else (t.left[at], t.right[at])
            heapq.heappush(queue, (max(margin, abs(m)), k, far))
            at = near
        found.append((k, int(-1 - at)))
    return found


def visits_for(forest: list[Tree], sample: np.ndarray, k: int, recall: float, rng: np.random.Generator, ask: int = 256) -> int:
    """How many leaves a query must visit for ``recall`` of its ``k`` nearest: measured against brute force within the sample, for ``ask`` of its points."""
    leaves = [len(t.cut) + 1 for t in forest]
    if len(sample) <= k + 1:
        return sum(leaves)
    of = np.stack([t.leaves(sample) for t in forest])
    first = np.cumsum([0, *leaves[:-1]])
    positions = []
    for q in rng.choice(len(sample), min(ask, len(sample)), replace=False):
        near = sample @ sample[q]
        near[q] = -np.inf
        best = np.argpartition(-near, k)[:k]
        order = np.array(search(forest, sample[q], sum(leaves)))
        rank = np.empty(sum(leaves), np.int64)
        rank[first[order[:, 0]] + order[:, 1]] = np.arange(len(order))
        positions.append(rank[first[:, None] + of[:, best]].min(axis=0))
    every = np.sort(np.concatenate(positions))
    return max(len(forest), int(every[min(len(every), int(np.ceil(recall * len(every)))) - 1]) + 1)


def _cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """In double precision; each pair is summed in the same order wherever it meets. Infinite norms are scaled away first."""
    q, x = (v / np.abs(v).max(axis=1, keepdims=True) for v in (q, x))
    return (q * x).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)))


def nearest(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", *, k: int = 5, trees: int = 4, leaf: int = 512, recall: float = 0.96, fit_rows: int = 60_000, seed: int = 11) -> DataFrame:
    """The ``k`` nearest by cosine of each query row among all vectors but itself: ``query_id, rank, vec_id, score``.

    The forest is fitted on at most ``fit_rows`` vectors of unit length (a documented sample by hash of the vector),
    then indexes every vector. Each query visits as many leaves as points of the sample need for ``recall`` within the
    sample (:func:`visits_for`): few if the vectors have structure, a fair share of all leaves if they have none. Equal
    vectors are one point that keeps its ``k + 1`` smallest ids, which is all that any query can be given of it, so a
    vector that a third of all rows share is searched once and never fills a leaf. Leaves are joined with their queries
    in tasks, which return just the best points of each query and leaf; leaves beyond about ``CHUNK`` points or
    queries are dealt as chunks of either.

    Vectors that are null, zero, of another length than most or hold null or non-finite components take no part, as
    queries or candidates; null ids neither. Ties go to the smaller id. Repeated rows are repeated candidates with one id: they count once.
    An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    use_checkpoints(spark)

    def sound(df: DataFrame) -> DataFrame:
        v = F.col(embedding).cast("array<double>")
        good = F.col(vec_id).isNotNull() & v.isNotNull() & F.forall(v, lambda y: y.isNotNull() & (F.abs(y) < float("inf")) & ~F.isnan(y)) & F.exists(v, lambda y: y != 0)
        return df.filter(good).select(F.col(vec_id).cast("long").alias("id"), v.alias("v"))

    base = sound(vectors)
    width = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base = base.filter(F.size("v") == width["d"])
    ids = base.select("v", "id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("r") <= k + 1)
    points = ids.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("p"), "v", "ids").checkpoint()
    asked = sound(queries).filter(F.size("v") == width["d"]).distinct().join(points.select("p", "v"), "v").select("id", "p").checkpoint()
    n = points.count()
    fraction = fit_rows / max(n, 1)
    chosen = points.select("v", F.pmod(F.xxhash64("v"), F.lit(1 << 30)).alias("h")).filter(F.col("h") < int(min(1.0, fraction) * (1 << 30)))
    drawn = chosen.select("v").toArrow().column("v").combine_chunks()
    sample = np.asarray(drawn.flatten()).reshape(-1, width["d"])
    sample = sample[np.lexsort(sample.T)]
    sample = sample / np.linalg.norm(sample / np.abs(sample).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(sample).max(axis=1, keepdims=True)
    rng = np.random.default_rng(seed)
    forest = [grow(sample, leaf, rng) for _ in range(trees)]
    leaves = [len(t.cut) + 1 for t in forest]
    visits = visits_for(forest, sample, k, recall, rng)
    chunks = max(1, -(-n // (min(leaves) * CHUNK)))
    asks_a_leaf = -(-asked.count() * visits // sum(leaves))
    turns = max(1, -(-asks_a_leaf // CHUNK))
    # of the sample's bounded size; plain arrays, for broadcasts don't carry classes
    shared = spark.sparkContext.broadcast([(t.direction, t.cut, t.left, t.right) for t in forest])

    def unit(pdf: pd.DataFrame) -> np.ndarray:
        x = np.stack(pdf["v"].to_numpy())
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                x = unit(pdf)
                for t, arrays in enumerate(shared.value):
                    yield pd.DataFrame({"t": t, "leaf": Tree(*arrays).leaves(x), "p": pdf["p"], "v": pdf["v"], "q": False})

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees_ = [Tree(*arrays) for arrays in shared.value]
        for pdf in frames:
            for p, v, x in zip(pdf["p"], pdf["v"], unit(pdf) if len(pdf) else [], strict=True):
                at = np.array(search(trees_, x, visits)).reshape(-1, 2)
                yield pd.DataFrame({"t": at[:, 0], "leaf": at[:, 1], "p": p, "v": [v] * len(at), "q": True})

    def best(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        q, c = pdf[pdf["q"]], pdf[~pdf["q"]]
        if not len(q) or not len(c):
            return pd.DataFrame({"p": [], "c": [], "score": []})
        x, cx, out = unit(q), unit(c), []
        ids, raw, asks = c["p"].to_numpy(), np.stack(c["v"].to_numpy()), np.stack(q["v"].to_numpy())
        for start in range(0, len(x), 256):
            near = x[start : start + 256] @ cx.T
            least = np.partition(near, -(k + 1), axis=1)[:, -(k + 1)] - 1e-9 if len(cx) > k + 1 else np.full(len(near), -2.0)
            row, at = np.nonzero(near >= least[:, None])
            score = _cosines(asks[start + row], raw[at])
            keep = np.lexsort((ids[at], -score, row))
            row, at, score = row[keep], at[keep], score[keep]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            best_ = rank <= k
            out.append(pd.DataFrame({"p": q["p"].to_numpy()[start + row[best_]], "c": ids[at[best_]], "score": score[best_]}))
        return pd.concat(out)

    schema = "t int, leaf long, p long, v array<double>, q boolean"
    rows = points.select("p", "v").mapInPandas(index, schema)
    rows = rows.select("*", F.pmod(F.xxhash64("p"), F.lit(chunks)).alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))).alias("turn"))
    asks = points.join(asked.select("p").distinct(), "p", "left_semi").select("p", "v").mapInPandas(ask, schema)
    asks = asks.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"), F.pmod(F.xxhash64("p"), F.lit(turns)).alias("turn"))
    found = rows.union(asks).groupBy("t", "leaf", "chunk", "turn").applyInPandas(best, "p long, c long, score double").groupBy("p", "c").agg(F.max("score").alias("score"))
    near = found.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy(F.desc("score"), "c"))).filter(F.col("r") <= k + 1)
    cand = near.join(points.select(F.col("p").alias("c"), "ids"), "c").select("p", "score", F.explode("ids").alias("id"))
    cand = cand.groupBy("p").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k + 1).alias("best"))
    out = asked.distinct().join(cand, "p").select("id", F.slice(F.filter("best", lambda b: b["id"] != F.col("id")), 1, k).alias("best"))
    return out.select(F.col("id").alias("query_id"), F.posexplode("best").alias("r", "b")).select("query_id", (F.col("r") + 1).alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.s")).alias("score"))
