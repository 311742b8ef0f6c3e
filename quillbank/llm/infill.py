"""Fill-in-middle transformation over texts kept as seekable compressed frames."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks before the prefix, the suffix and the middle.
P, S, M = b"<P>", b"<S>", b"<M>"
#: A unit: a word with the white space before it, or the white space at the end. A frame ends after a word or with the text.
UNIT = re.compile(rb"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
#: Bytes of UTF-8 that don't begin a code point.
INNER = bytes(range(0x80, 0xC0))

#: ``n``: units; ``marked``: whether a mark occurs in the text; ``frames``: units up to the frame's end, and its data.
STORED = pa.struct([("n", pa.int64()), ("marked", pa.bool_()), ("frames", pa.list_(pa.struct([("units", pa.int64()), ("data", pa.binary())])))])
STORED_SQL = "n long, marked boolean, frames array<struct<units: long, data: binary>>"


def pack(text: bytes, frame: int, level: int) -> dict:
    """Independent zstandard frames of about ``frame`` bytes that end between units."""
    press, frames, at, units = zstandard.ZstdCompressor(level=level), [], 0, 0
    while at < len(text):
        end = WORD_END.search(text, at + frame - 1) if at + frame < len(text) else None
        part = text[at : end.end()] if end else text[at:]
        units += len(UNIT.findall(part))
        frames.append({"units": units, "data": press.compress(part)})
        at += len(part)
    return {"n": units, "marked": any(m in text for m in (P, S, M)), "frames": frames}


class Frames:
    """A stored text: cuts look into one frame each, and reading holds one frame at a time."""

    def __init__(self, frames: list[dict]):
        self.data, self.ends, self.open = [f["data"] for f in frames], [f["units"] for f in frames], zstandard.ZstdDecompressor()

    def cut(self, units: int) -> tuple[int, int]:
        """Frame and byte in it after so many units."""
        k = bisect_right(self.ends, units)
        left = units - (self.ends[k - 1] if k else 0)
        if not left:
            return k, 0
        return k, next(islice(UNIT.finditer(self.open.decompress(self.data[k])), left - 1, None)).end()

    def read(self, begin: tuple[int, int], end: tuple[int, int]) -> Iterator[bytes]:
        """What stands between two cuts, frame by frame."""
        for k in range(begin[0], min(end[0] + 1, len(self.data))):
            if k < end[0] or end[1]:
                part = self.open.decompress(self.data[k])
                yield part[begin[1] if k == begin[0] else 0 : end[1] if k == end[0] else None]


def written(form: str, prefix: Callable, middle: Callable, suffix: Callable) -> Iterator[bytes]:
    """The output in pieces."""
    for part in {"plain": (prefix, middle, suffix), "psm": ([P], prefix, [S], suffix, [M], middle), "spm": ([S], suffix, [P], prefix, [M], middle)}[form]:
        yield from part if isinstance(part, list) else part()


def rebuilt(form: str, output: Callable[[], Iterable[bytes]]) -> Iterator[bytes]:
    """The text in pieces, from the output (which is read several times) and its form."""
    if form == "plain":
        yield from output()
        return
    at, past, tail = {}, 0, b""
    for part in output():  # each mark stands once; one may lie over the border of two pieces
        seen = tail + part
        at |= {m: past - len(tail) + seen.index(m) for m in (P, S, M) if m not in at and m in seen}
        past, tail = past + len(part), seen[-2:]
    order = sorted(at, key=at.get)
    for mark in (P, M, S):
        k = order.index(mark)
        begin, end, here = at[mark] + 3, at[order[k + 1]] if k < 2 else past, 0
        for part in output():
            if here < end and begin < here + len(part):
                yield part[max(0, begin - here) : end - here]
            here += len(part)


def _length(parts: Iterable[bytes]) -> int:
    return sum(len(p.translate(None, INNER)) for p in parts)


def _digest(parts: Iterable[bytes]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frame: int = 1 << 16, level: int = 3) -> DataFrame:
    """``id, n, marked, frames, row``: each whole text as independent zstandard frames with cumulative counts of units.

    Frames hold about ``frame`` bytes and end between units (a longer word makes a longer frame), so a reader of unit
    k opens one frame. The table can be written and read again. Null text: no frames, like an empty one. Rows that
    repeat an id stay rows of their own; other columns travel in ``row``, whatever their names.
    """

    @F.arrow_udf(STORED_SQL)
    def packed(texts: pa.Array) -> pa.Array:
        return pa.array([pack(t.as_py() or b"", frame, level) for t in texts], STORED)

    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    made = docs.select(F.col(f"`{doc_id}`").alias("id"), packed(F.col(f"`{text}`").cast("binary")).alias("s"), F.struct(*kept).alias("row"))
    return made.select("id", "s.n", "s.marked", "s.frames", "row")


def _draw(digest: Column, k: int) -> Column:
    return F.conv(F.substr(digest, F.lit(8 * k + 1), F.lit(8)), 16, 10).cast("long")


def fill_in_middle(stored: DataFrame, seed: int = 42, share: int = 50, spm: int = 80, with_output: bool = False) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256, row`` of stored texts, and ``output`` if asked for.

    Draws are digits of the sha256 of ``seed:id``: two cuts between units, then ``share`` percent are transformed,
    ``spm`` percent of these with the suffix first. Texts that are empty or hold a mark stay plain, with null lengths.
    Only the frames of the two cuts are opened to find them; output and restored text are streamed frame by frame to
    their digests, and the restored one is rebuilt from the output alone.

    A null id draws as an empty one. Rows that repeat an id have the same draws, each over its own count of units. An
    empty table gives an empty result. Only ``output`` holds a whole text in memory.
    """
    fields = [("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string()), ("output", pa.binary())]
    kind = pa.struct(fields if with_output else fields[:4])

    def one(frames: list[dict], form: str, first: int, second: int) -> dict:
        held = Frames(frames)
        a, b, none = held.cut(first) if form != "plain" else (0, 0), held.cut(second) if form != "plain" else (0, 0), (len(frames), 0)
        parts = [lambda p=p: held.read(*p) for p in (((0, 0), a), (a, b), (b, none))]
        out = lambda: written(form, *parts)
        sizes = [None, None] if form == "plain" else [_length(p()) for p in parts[:2]]
        got = {"prefix_chars": sizes[0], "middle_chars": sizes[1], "output_sha256": _digest(out()), "restored_sha256": _digest(rebuilt(form, out))}
        return got | ({"output": b"".join(out())} if with_output else {})

    @F.arrow_udf("prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string" + (", output binary" if with_output else ""))
    def cut(frames: pa.Array, form: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        return pa.array((one(*(x.as_py() for x in r)) for r in zip(frames, form, first, second, strict=True)), kind)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    drawn = stored.withColumn("h", digest)
    units = F.col("n") + 1
    form = F.when((F.col("n") == 0) | F.col("marked") | (_draw(F.col("h"), 2) % 100 >= share), "plain").when(_draw(F.col("h"), 3) % 100 < spm, "spm").otherwise("psm")
    drawn = drawn.select("id", "n", form.alias("form"), F.least(_draw(F.col("h"), 0) % units, _draw(F.col("h"), 1) % units).alias("a"), F.greatest(_draw(F.col("h"), 0) % units, _draw(F.col("h"), 1) % units).alias("b"), "frames", "row")
    made = drawn.select("id", "n", "form", cut("frames", "form", "a", "b").alias("c"), "row")
    more = [F.col("c.output").cast("string").alias("output")] if with_output else []
    return made.select("id", "n", "form", "c.prefix_chars", "c.middle_chars", "c.output_sha256", "c.restored_sha256", *more, "row")


def restore(output: Column, form: Column) -> Column:
    """The text of an output and its form, as a column expression."""
    part = lambda pattern, k: F.regexp_extract(output, pattern, k)
    psm, spm = r"(?s)^<P>(.*)<S>(.*)<M>(.*)$", r"(?s)^<S>(.*)<P>(.*)<M>(.*)$"
    return F.when(form == "psm", F.concat(part(psm, 1), part(psm, 3), part(psm, 2))).when(form == "spm", F.concat(part(spm, 2), part(spm, 3), part(spm, 1))).otherwise(output)
