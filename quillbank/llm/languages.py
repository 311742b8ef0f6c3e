"""Language identification with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components of a vector; bits of a letter's code point (0 is the border of a word).
SIZE, BITS = 2048, 21
#: Trigrams whose vectors exist at one time in a task; texts and characters that a task counts at one time.
BLOCK, TEXTS, CHARS = 2048, 64, 1 << 18


@lru_cache(4096)
def letter(point: int, size: int = SIZE) -> np.ndarray:
    """The letter's random vector of 1 and -1, the same everywhere: bits of a hash of its code point."""
    bits = np.unpackbits(np.frombuffer(hashlib.shake_256(b"letter:%d" % point).digest(size // 8), np.uint8))
    return (2 * bits.astype(np.int8) - 1).astype(np.int8)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Vectors of trigrams: the first letter's permuted (rolled) twice, the second's once, bound by products."""
    points = np.stack([grams >> (2 * BITS), (grams >> BITS) & ((1 << BITS) - 1), grams & ((1 << BITS) - 1)])
    known, at = np.unique(points, return_inverse=True)
    each = np.stack([letter(int(p)) for p in known])
    a, b, c = at.reshape(3, -1)
    out = np.roll(each, 2, axis=1)[a]
    out *= np.roll(each, 1, axis=1)[b]
    out *= each[c]
    return out


def trigrams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of several texts, and for each (trigram, text) that occurs: number of the trigram, text, count.

    Letters in lower case, with a border before and after each word. Texts are composed (NFC); what isn't a letter ends
    a word. Bytes that aren't UTF-8 count as no letter.
    """
    plain = [unicodedata.normalize("NFC", (t or b"").decode("utf-8", "replace").lower()) for t in texts]
    points = np.frombuffer(("\0" + "\0".join(plain) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(plain) + 1), [1] + [len(p) + 1 for p in plain]) - 1
    present = np.flatnonzero(np.bincount(points))
    alphabet = np.array([0] + [p for p in present if chr(p).isalpha()], np.int64)
    # letters by their rank in this alphabet; 0 for all else
    rank = np.zeros(present[-1] + 1, np.int64)
    rank[alphabet] = np.arange(len(alphabet))
    points = rank[points]
    stay = np.ones(len(points), bool)
    stay[1:] = (points[1:] != 0) | (points[:-1] != 0)
    points, text = points[stay], text[stay]
    inside = points[1:-1] != 0
    k, many = len(alphabet), len(texts)
    keys, n = np.unique((((points[:-2] * k + points[1:-1]) * k + points[2:]) * many + text[1:-1])[inside], return_counts=True)
    ranked = keys // many
    first = np.ones(len(ranked), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    known = ranked[first]
    grams = (alphabet[known // (k * k)] << (2 * BITS)) | (alphabet[known // k % k] << BITS) | alphabet[known % k]
    return grams, np.cumsum(first) - 1, keys % many, n


def chunks(texts: Iterable[bytes | None]) -> Iterator[list[bytes | None]]:
    """Neighbouring texts, of bounded count and length; a longer text stands alone."""
    held, size = [], 0
    for t in texts:
        n = len(t or b"")
        if held and (len(held) >= TEXTS or size + n > CHARS):
            yield held
            held, size = [], 0
        held.append(t)
        size += n
    if held:
        yield held


def bundles(texts: list[bytes | None]) -> np.ndarray:
    """A vector per text: the sum of its trigrams' vectors. Texts without letters have none (zeros)."""
    grams, at, text, n = trigrams(texts)
    out = np.zeros((len(texts), SIZE), np.float32)
    for k in range(0, len(grams), BLOCK):
        lo, hi = np.searchsorted(at, [k, k + BLOCK])
        counts = np.zeros((len(texts), min(BLOCK, len(grams) - k)), np.float32)
        counts[text[lo:hi], at[lo:hi] - k] = n[lo:hi]
        out += counts @ gram_vectors(grams[k : k + BLOCK]).astype(np.float32)
    return out


@dataclass
class Profiles:
    """Languages and their prototypes: unit vectors of what sets them apart from the mean of all languages."""

    names: list[str]
    mean: np.ndarray
    unit: np.ndarray

    def judge(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        """Language and cosine, 0 at the least, of each text; ties go to the first name; ``und`` without letters."""
        x = bundles(texts).astype(np.float64)
        size = np.sqrt((x**2).sum(axis=1))
        some = size > 0
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        x[some] /= size[some, None]
        y = x - self.mean
        cosine = (y @ self.unit.T) / np.maximum(np.sqrt((y**2).sum(axis=1)), 1e-12)[:, None]
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
        return [self.names[b] if s else "und" for b, s in zip(best, some, strict=True)], np.where(some, score, 0.0)


def held_out(doc_id: Column) -> Column:
    """Whether documents of this id may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang, gram, n`` over ``lang, text`` (binary): counts of all texts, added up in tasks before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], int] = {}

        def send() -> pa.RecordBatch:
            keys = list(held)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(held.values()), pa.int64())], names=["lang", "gram", "n"])

        for b in batches:
            lang = b.column(0).to_pylist()
            names = sorted(set(lang))
            number = {x: k for k, x in enumerate(names)}
            at = 0
            for part in chunks(t.as_py() for t in b.column(1)):
                grams, which, text, n = trigrams(part)
                of = np.array([number[x] for x in lang[at : at + len(part)]], np.int64)[text]
                at += len(part)
                # weights of at most CHARS or a text's length, so the sums are exact
                for k in np.unique(of):
                    sums = np.bincount(which[of == k], n[of == k], len(grams)).astype(np.int64)
                    some = np.flatnonzero(sums)
                    for g, m in zip(grams[some].tolist(), sums[some].tolist(), strict=True):
                        held[names[k], g] = held.get((names[k], g), 0) + m
                if len(held) > 1 << 18:
                    yield send()
                    held.clear()
        yield send()

    return rows.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(rows: DataFrame) -> Profiles:
    """Prototypes of ``lang, text`` (binary; no null ``lang``).

    A prototype is the bundle of all trigrams of the language, so it is made of their counts: whole numbers, in any
    order the same. Tasks send one vector per language; the driver holds ``SIZE`` numbers per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            lang, grams, n = np.array(b.column(0).to_pylist(), object), np.asarray(b.column(1)), np.asarray(b.column(2)).astype(np.float64)
            for name in set(lang):
                mine = np.flatnonzero(lang == name)
                for k in range(0, len(mine), BLOCK):
                    part = mine[k : k + BLOCK]
                    sums[name] = sums.get(name, np.zeros(SIZE)) + n[part] @ gram_vectors(grams[part]).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.astype(np.int64) for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    parts = gram_counts(rows).mapInArrow(run, "lang string, v array<long>").select("lang", F.posexplode("v").alias("k", "v")).groupBy("lang", "k").agg(F.sum("v").alias("v"))
    whole = {r["lang"]: r["v"] for r in parts.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("v")).collect()}
    names = sorted(k for k, v in whole.items() if any(v))
    if not names:
        return Profiles([], np.zeros(SIZE), np.zeros((0, SIZE)))
    each = np.array([whole[k] for k in names], np.float64)
    each /= np.sqrt((each**2).sum(axis=1))[:, None]
    # with one language nothing sets it apart, so it stands for itself
    mean = each.mean(axis=0) if len(names) > 1 else np.zeros(SIZE)
    apart = each - mean
    return Profiles(names, mean, apart / np.maximum(np.sqrt((apart**2).sum(axis=1)), 1e-12)[:, None])


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """All columns of ``docs`` and ``held_out, lang_pred, score`` (replaced if they exist), for every row.

    Letters have random vectors; a trigram's is the product of its letters' vectors, permuted by place; a text's is the
    sum of its trigrams'. The prediction is the language whose prototype has the largest cosine with the text's vector,
    both less the mean prototype; ``score`` is that cosine, 0 at the least. Learned from rows that aren't held out and
    have a ``lang``; only the text is an input of a prediction.

    Null texts and texts without a letter: ``und`` and 0, and so is everything if nothing could be learned. Texts are
    read whole in linear time: a long one is counted in one pass, its vectors are made ``BLOCK`` trigrams at a time.
    Rows that repeat an id are judged each by its text; a null id isn't held out. An empty table gives an empty result.
    The number of different languages is taken to be small (thousands).
    """
    known = docs.filter(F.col(f"`{lang}`").isNotNull() & ~held_out(F.col(f"`{doc_id}`")))
    model = learn(known.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("binary").alias("text")))

    @F.arrow_udf("lang_pred string, score double")
    def judged(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for part in chunks(t.as_py() for t in texts):
            a, b = model.judge(part)
            names += a
            scores.append(b)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["lang_pred", "score"])

    found = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "lang_pred", "score")], held_out(F.col(f"`{doc_id}`")).alias("held_out"), judged(F.col(f"`{text}`").cast("binary")).alias("__judged"))
    return found.select("*", F.col("__judged.lang_pred").alias("lang_pred"), F.col("__judged.score").alias("score")).drop("__judged")
