"""Personal data: patterns for protected entities, and terms that disclose them by corpus co-occurrence."""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints
from quillbank.llm.text import bit_filter, whole

#: Base kinds in their order, then the method's.
KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a number run that fails fails from each of its digits, so only its first is tried
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]{3,}")


def _luhn(digits: str) -> bool:
    twice = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def entities(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base matches, by start, then kind."""
    found = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.sub("", m[0])) <= 15]
    return sorted(found, key=lambda x: (x[1], x[0]))


def _hash(x: str) -> int:
    return xxhash.xxh64_intdigest(x) - (1 << 63)


def names_of(kind: int, value: str) -> tuple[str, str]:
    """An entity as it stands and generalised: the domain of an address, half of an ip, the issuer of a card, the area of a phone."""
    digits = _DIGIT.sub("", value)
    general = (value.rpartition("@")[2], ".".join(value.split(".")[:2]), digits[:6], digits[:5])[kind]
    return f"{kind}:{value.lower()}", f"{kind}~{general.lower()}"


def free_words(text: str, base: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """Words that overlap no base entity; both are in order, so each is looked at once."""
    k, end = 0, 0
    for m in _WORD.finditer(text):
        while k < len(base) and base[k][1] < m.end():
            end = max(end, base[k][2])
            k += 1
        if end <= m.start():
            yield m


def _neighbours(text: str, base: list[tuple[int, int, int]], reach: int) -> Iterator[tuple[int, int]]:
    """(entity, term) of up to ``reach`` free words on either side of each entity, in its line."""
    words = list(free_words(text, base))
    starts, keys = [m.start() for m in words], [_hash(m[0].lower()) for m in words]
    line, end = 0, -1
    for kind, s, e in base:
        if s > end:
            line, end = text.rfind("\n", 0, s) + 1, text.find("\n", s)
            end = len(text) if end < 0 else end
        named, k = [_hash(x) for x in names_of(kind, text[s:e])], bisect(starts, s)
        for near in (range(k - 1, max(k - reach, 0) - 1, -1), range(k, min(k + reach, len(words)))):
            for j in near:
                if not line <= starts[j] < end:
                    break
                yield from ((entity, keys[j]) for entity in named)


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, reach: int = 5, deviations: float = 2.33, disclosure: float = 0.75, certainty: float = 1 / 3) -> DataFrame:
    """``id, base, spans`` per row: arrays of ``(kind, start, end)`` in code points, end exclusive, by start, then kind.

    Base entities are found by pattern. Terms met within ``reach`` words of an entity are then weighed in the whole
    corpus, against the entity itself and against its generalisation (the domain, network, issuer or area), which
    recurs more often. Of entity ``c`` and term ``t``, ``p(c|t)`` is estimated from the different texts in which they
    stand together and the rows that hold the term: the lower bound of its confidence interval (Wilson's, at
    ``deviations`` standard deviations; 2.33: 99 % of cases lie above), so that what was seen once or twice discloses
    nothing, and copies of a text count once. The point-wise mutual information ``log p(c|t) / p(c)``, relative to the
    entity's own information ``-log p(c)``, says how far the term gives the entity away. Terms at ``disclosure`` or more
    that leave an entity a chance of ``certainty`` are spans of kind ``term`` wherever they occur outside of base
    spans, in rows without the entity too; base spans stay.

    A first pass reads the texts and returns spans, neighbours and per-task word counts; a second finds the words that
    pass a bit filter of the telling terms, which a join then decides. Texts are never shuffled, and what a row sends is
    linear in its length: pairs of an entity and the words beside it. Null text is empty. Null ids are kept, rows that
    repeat an id are read one by one and get their own spans. An empty table gives an empty result.
    """
    use_checkpoints(docs.sparkSession)
    span, near = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]), pa.struct([(n, pa.int64()) for n in ("entity", "term")])
    count, hashes = pa.struct([("term", pa.int64()), ("n", pa.int64())]), pa.list_(pa.int64())
    names = ["id", "tid", "base", "near", "held", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, around, held, words = [], [], [], Counter()
            for t in b.column(2):
                x = t.as_py() or ""
                base.append(entities(x))
                around.append([{"entity": e, "term": w} for e, w in set(_neighbours(x, base[-1], reach))])
                held.append(list({_hash(n) for k, s, e in base[-1] for n in names_of(k, x[s:e])}))
                words.update(set(_WORD.findall(x.lower())))
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in r] for r in base]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, pa.list_(span)), pa.array(around, pa.list_(near)), pa.array(held, hashes), pa.nulls(b.num_rows, pa.list_(count))], names=names)
            tally = [{"term": _hash(w), "n": n} for w, n in words.items()]
            yield pa.RecordBatch.from_arrays([pa.array([None], b.column(0).type), pa.array([None], pa.int64()), pa.nulls(1, pa.list_(span)), pa.nulls(1, pa.list_(near)), pa.nulls(1, hashes), pa.array([tally], pa.list_(count))], names=names)

    kinds = "array<struct<kind:int,start:bigint,end:bigint>>"
    schema = f"id long, tid long, base {kinds}, near array<struct<entity:bigint,term:bigint>>, held array<bigint>, words array<struct<term:bigint,n:bigint>>"
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(whole(text)).alias("tid"), F.col(text).cast("string").alias("text"))
    read = texts.mapInArrow(run, schema).checkpoint()
    rows = read.filter("base is not null")
    df = read.filter("words is not null").select(F.inline("words")).groupBy("term").agg(F.sum("n").alias("df"))
    total = max(rows.agg(F.count("*")).first()[0], 1)
    holders = rows.select(F.explode("held").alias("entity")).groupBy("entity").agg(F.count("*").alias("holders"))
    both = rows.select("tid", F.inline("near")).distinct().groupBy("entity", "term").agg(F.count("*").alias("both"))
    weighed = both.join(holders, "entity").join(df, "term")
    share = F.col("holders") / F.lit(total)
    p, n, z2 = F.least(F.lit(1.0), F.col("both") / F.col("df")), F.col("df"), F.lit(deviations**2)
    given = (p + z2 / (2 * n) - F.lit(deviations) * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    telling = weighed.filter((share < 1) & (given >= certainty) & (F.log(given / share) >= -disclosure * F.log(share))).select("term").distinct().checkpoint()
    bits = bit_filter(telling, "term")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, tid, t in zip(*(b.column(k).to_pylist() for k in range(2)), b.column(2), strict=True):
                x = t.as_py() or ""
                known = list(set(_WORD.findall(x.lower())))
                h = np.fromiter(map(_hash, known), np.int64, len(known))
                at = h & (8 * len(bits) - 1)
                hit = {known[k]: int(h[k]) for k in np.flatnonzero(bits[at >> 3] >> (at & 7) & 1)}
                if hit:
                    out += [(i, tid, hit[w], m.start(), m.end()) for m in free_words(x, entities(x)) if (w := m[0].lower()) in hit]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "tid", "term", "start", "end"])

    more = texts.mapInArrow(mark, "id long, tid long, term long, start long, end long").join(telling, "term")
    more = more.groupBy("id", "tid").agg(F.collect_set(F.struct(F.lit(KINDS.index("term")).alias("kind"), "start", "end")).alias("more")).select(F.col("id").alias("of"), F.col("tid").alias("same"), "more")
    out = rows.select("id", "tid", "base").join(more, F.col("id").eqNullSafe(F.col("of")) & (F.col("tid") == F.col("same")), "left")
    every = F.concat("base", F.coalesce("more", F.expr(f"cast(array() as {kinds})")))
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return out.select("id", "tid", "base", F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(text: Column, spans: Column) -> Column:
    """The text with entities and telling terms generalised to ``[kind]``; spans that overlap an earlier one go with it."""
    names = F.array(*map(F.lit, KINDS))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        cut = F.struct(F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), F.get(names, s["kind"]), F.lit("]")).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= acc["at"], cut).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at")))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
