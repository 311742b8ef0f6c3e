"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statistics of a text, in this order.
STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_spread", "distinct_words", "lines_per_word", "line_length", "repeated_lines",
    "digits", "upper", "sentence_marks", "commas", "symbols", "bars", "non_ascii", "byte_entropy", "short_words", "long_words", "top_word", "capital_words",
)


def statistics(text: bytes) -> list[float]:
    """Numbers that describe the whole text; shares are smoothed so that an empty text has them too."""
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    total = int(n.sum())
    words = text.split()
    k = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.float64, k)
    distinct = Counter(words)
    p = n[n > 0] / max(total, 1)
    alnum = n[48:58].sum() + n[65:91].sum() + n[97:123].sum()
    marks, commas, blank = n[[33, 46, 63]].sum(), n[[44, 58, 59]].sum(), n[[9, 10, 11, 12, 13, 32]].sum()
    symbols = n[:128].sum() - alnum - marks - commas - blank - n[124]
    share = lambda x, of: (float(x) + 0.01) / (of + 1.0)
    top = max(distinct.values(), default=0) / max(1, k)
    capitals = sum(1 for w in words if 65 <= w[0] <= 90)
    return [
        np.log1p(total), np.log1p(k), float(lengths.mean()) if k else 0.0, float(lengths.std()) if k else 0.0, np.log(share(len(distinct), k)),
        np.log(share(len(lines), k)), np.log1p(total / max(1, len(lines))), np.log(share(len(lines) - len(set(lines)), len(lines))),
        np.log(share(n[48:58].sum(), total)), np.log(share(n[65:91].sum(), total)), np.log(share(marks, k)), np.log(share(commas, k)), np.log(share(symbols, k)),
        np.log(share(n[124], k)), np.log(share(n[128:].sum(), total)), float(-(p * np.log2(p)).sum()) if total else 0.0,
        np.log(share((lengths <= 3).sum(), k)), np.log(share((lengths >= 9).sum(), k)), np.log(share(top, 1)), np.log(share(capitals, k)),
    ]


def with_statistics(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id, x``: the statistics of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t.as_py() or b"") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text")).mapInArrow(run, "id long, x array<double>")


@dataclass
class Discriminant:
    """Per class: log prior, mean, inverse Cholesky factor and log determinant, over standardised statistics."""

    centre: np.ndarray
    spread: np.ndarray
    prior: np.ndarray
    mean: np.ndarray
    whiten: np.ndarray
    log_det: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """The odds of class 1 as a share of 1, from Mahalanobis log-density differences."""
        if not len(self.prior):
            return np.full(len(x), 0.5)
        if np.isinf(self.prior).any():
            return np.full(len(x), float(np.isinf(self.prior[0])))
        z = np.clip((x - self.centre) / self.spread, -8, 8)
        density = [p - 0.5 * (((z - m) @ w.T) ** 2).sum(axis=1) - 0.5 * d for p, m, w, d in zip(self.prior, self.mean, self.whiten, self.log_det, strict=True)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(rows: DataFrame, shrink: float = 0.2, ridge: float = 0.05) -> Discriminant:
    """Fit on ``x, y`` (y 0 or 1). Tasks send sums of 1, x and xx' per class: what the driver holds has a fixed size.

    Class covariances are shrunk to the pooled one by ``shrink`` and to its mean variance by ``ridge``.
    No labelled rows: scores of 0.5; one class only: its own label.
    """
    d = len(STATISTICS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, q = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for pdf in frames:
            for c in (0, 1):
                x = np.stack(pdf["x"][pdf["y"] == c].to_numpy()) if (pdf["y"] == c).any() else np.zeros((0, d))
                n[c] += len(x)
                s[c] += x.sum(axis=0)
                q[c] += x.T @ x
        yield pd.DataFrame({"y": [0, 1], "sums": [np.concatenate([[n[c]], s[c], q[c].ravel()]) for c in (0, 1)]})

    sums = rows.mapInPandas(run, "y int, sums array<double>").select("y", F.posexplode("sums").alias("k", "v")).groupBy("y", "k").agg(F.sum("v").alias("v")).collect()
    got = np.zeros((2, 1 + d + d * d))
    for r in sums:
        got[r["y"], r["k"]] = r["v"]
    n, s, q = got[:, 0], got[:, 1 : 1 + d], got[:, 1 + d :].reshape(2, d, d)
    if not n.sum():
        return Discriminant(np.zeros(d), np.ones(d), np.zeros(0), *[np.zeros(0)] * 3)
    centre = s.sum(axis=0) / n.sum()
    spread = np.sqrt(np.maximum(np.diag(q.sum(axis=0)) / n.sum() - centre**2, 1e-6))
    with np.errstate(divide="ignore"):
        prior = np.log(n / n.sum())
    if not n.all():
        return Discriminant(centre, spread, prior, *[np.zeros(0)] * 3)
    means = s / n[:, None]
    scatter = [(q[c] - n[c] * np.outer(means[c], means[c])) / np.outer(spread, spread) for c in (0, 1)]
    pooled = sum(scatter) / n.sum()
    mean, whiten, log_det = (means - centre) / spread, [], []
    for c in (0, 1):
        cov = (1 - shrink) * scatter[c] / n[c] + shrink * pooled
        cov = (1 - ridge) * cov + ridge * np.trace(cov) / d * np.eye(d)
        low = np.linalg.cholesky(cov + 1e-9 * np.eye(d))
        whiten.append(np.linalg.inv(low))
        log_det.append(2 * np.log(np.diag(low)).sum())
    return Discriminant(centre, spread, prior, mean, np.array(whiten), np.array(log_det))


def held_out(doc_id: Column) -> Column:
    """Whether labels of this id may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = 200_000) -> Discriminant:
    """Fit on labelled rows that aren't held out: of at most about ``fit_rows`` labels, a sample by hash of the id.

    The sampled labels are broadcast (16 bytes each), so statistics are made of labelled texts only and no text is
    shuffled. Rows with a null label or id teach nothing; labels that repeat teach once, documents that do once per row.
    """
    y = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")).distinct()
    y = y.filter(~held_out(F.col("id")))
    part = min(1.0, fit_rows / max(1, y.count()))
    y = y.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(part * (1 << 30))))
    known = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text")).join(F.broadcast(y), "id")
    return fit(with_statistics(known, "y", "text").select("x", F.col("id").cast("int").alias("y")))


def quality_score(model: Discriminant):
    """A column function of a text column cast to binary; null counts as empty."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = np.array([statistics(bytes(t) if t is not None else b"") for t in text]).reshape(len(text), len(STATISTICS))
        return pd.Series(model.score(x))

    return score


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``held_out, score, predicted`` (replaced if they exist), for every row.

    Only the texts are inputs of a score. Statistics take one linear pass over the whole text, however long; two
    passes over the table are made (learn, score) and no text is shuffled. Null or empty texts are scored as empty.
    An empty table gives an empty result.
    """
    score = quality_score(learn(docs, labels, doc_id, text))
    out = docs.withColumn("held_out", held_out(F.col(doc_id))).withColumn("score", score(F.col(text).cast("binary")))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
