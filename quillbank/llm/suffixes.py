"""Suffix-array dedup: remove bytes of long strings that start earlier, with induced sorting in content-dealt shards."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints
from quillbank.llm.text import whole

#: Bytes whose hash can anchor a window, bytes hashed at once, bytes of a shard, and runs at one anchor beyond which windows are dealt one by one.
GRAM, CHUNK, SHARD, CROWD = 24, 1 << 20, 1 << 21, 20_000
_ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


# --- suffix sorting of one shard ---


def _kinds(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one."""
    d = np.diff(t.astype(np.int32))
    settled = np.minimum.accumulate(np.where(d == 0, len(t), np.arange(len(d)))[::-1])[::-1]
    return np.append(d[settled] > 0, True)


def _spread(j: np.ndarray, t: np.ndarray, free: np.ndarray, out: np.ndarray, up: bool) -> None:
    """Put suffixes, in the given order, at the free end of the buckets of their first symbols."""
    c = t[j]
    o = np.argsort(c, kind="stable")
    c = c[o]
    n = np.bincount(c, minlength=len(free))
    rank = np.arange(len(c)) - (np.cumsum(n) - n)[c]
    out[free[c] + rank if up else free[c] - 1 - rank] = j[o]
    free += n if up else -n


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, buckets: int) -> np.ndarray:
    """Sort all suffixes from sorted leftmost-smaller ones: larger kinds left to right, then smaller kinds right to left, a bucket at a time."""
    n = np.bincount(t, minlength=buckets)
    ends = np.cumsum(n)
    starts = ends - n
    larger = np.bincount(t[~small], minlength=buckets)
    sa = np.full(len(t), -1, np.int64)
    tails = ends.copy()
    _spread(lms[::-1], t, tails, sa, False)
    heads = starts.copy()
    used = np.flatnonzero(n)
    for c in used:
        lo = starts[c]
        while lo < heads[c]:
            lo, j = heads[c], sa[lo : heads[c]] - 1
            _spread(j[(j >= 0) & ~small[j]], t, heads, sa, True)
        if tails[c] < ends[c]:
            j = sa[tails[c] : ends[c]] - 1
            _spread(j[(j >= 0) & ~small[j]], t, heads, sa, True)
    tails = ends.copy()
    tails[0] = 0  # the sentinel is the only one of its kind and stays
    sa[0] = len(t) - 1
    for c in used[::-1]:
        hi = ends[c]
        while tails[c] < hi:
            hi, j = tails[c], sa[tails[c] : hi][::-1] - 1
            _spread(j[(j >= 0) & small[j]], t, tails, sa, False)
        if larger[c]:
            j = sa[starts[c] : starts[c] + larger[c]][::-1] - 1
            _spread(j[(j >= 0) & small[j]], t, tails, sa, False)
    return sa


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``t`` (symbols >= 0, a single 0 at the end) sorted by their first ``depth`` symbols at least."""
    buckets = int(t.max()) + 1
    small = _kinds(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    # leftmost-smaller substrings, sorted by inducing from any order, get names
    sa = _induce(t, small, lms, buckets)
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    after = np.full(len(t), len(t) - 1, np.int64)
    after[lms[:-1]] = lms[1:]
    a, b = order[:-1], order[1:]
    differ = after[a] - a != after[b] - b
    live, k = np.flatnonzero(~differ), 0
    while len(live):
        live = live[a[live] + k <= after[a[live]]]
        off = t[a[live] + k] != t[b[live] + k]
        differ[live[off]] = True
        live, k = live[~off], k + 1
    name = np.zeros(len(t), np.int64)
    name[order] = np.concatenate([[0], np.cumsum(differ)])
    rank = name[lms]
    # names of names: each round sorts twice as many substrings, of two symbols at least, together
    width = 1
    while width * 2 <= 2 * depth and rank.max(initial=-1) + 1 < len(rank):
        right = np.append(rank[width:] + 1, np.zeros(min(width, len(rank)), np.int64))
        key = rank * (len(rank) + 1) + right
        o = np.argsort(key, kind="stable")
        rank = np.empty_like(rank)
        rank[o] = np.concatenate([[0], np.cumsum(np.diff(key[o]) != 0)])
        width *= 2
    return _induce(t, small, lms[np.argsort(rank, kind="stable")], buckets)


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """By text position: how long a prefix (at most ``most`` >= 8 bytes) a suffix shares with the one before it in the suffix array."""
    padded = np.concatenate([data, np.zeros(most + 8, np.uint8)])
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view(np.uint64).ravel()
    found = np.zeros(len(data), np.int64)
    a, b = sa[:-1], sa[1:]
    for at in [*range(0, most - 7, 8), *([most - 8] if most % 8 else [])]:
        same = words[a + at] == words[b + at]
        a, b = a[same], b[same]
        found[b] = at + 8
    return found


def repeated_windows(pieces: list[bytes], counts: np.ndarray, length: int) -> np.ndarray:
    """Of the first ``counts[k]`` windows of each piece, in order: whether the same window starts in an earlier piece, or earlier in its own."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    t = data.astype(np.uint16) + np.uint16(2)
    t[starts + sizes] = 1
    t[-1] = 0
    sa = suffix_array(t, length)
    prefix = common_prefixes(data, sa, length)
    window = np.zeros(len(data) + 1, np.int64)
    np.add.at(window, starts, 1)
    np.add.at(window, starts + counts, -1)
    window = np.cumsum(window)[:-1] > 0
    group = np.cumsum(prefix[sa] < length)[window[sa]]
    at = sa[window[sa]]
    o = np.lexsort((at, group))
    later = np.zeros(len(data), bool)
    later[at[o][1:]] = np.diff(group[o]) == 0
    return later[window]


# --- anchors: where windows are dealt to ---


def _runs(data: np.ndarray, bounds: list[tuple[int, int]], length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows within the bounds that share their anchor: first and last start, the anchor's hash, and a hash of all bytes of the run.

    A window's anchor is its gram with the least hash, the leftmost of equal ones: equal windows have equal anchors, at equal places.
    """
    span = length - GRAM + 1
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view(np.uint64).ravel()
    m = len(data) - GRAM + 1
    h = sum(words[k : k + m] * _ODD[k // 8] for k in range(0, GRAM, 8))
    h = (h ^ (h >> np.uint64(29))) * _ODD[5]
    h = (h ^ (h >> np.uint64(32))) * _ODD[6]
    h ^= h >> np.uint64(29)
    low, at, width = h, np.arange(m, dtype=np.int32), 1
    while width < span:
        step = min(width, span - width)
        left = low[:-step] <= low[step:]
        low, at, width = np.where(left, low[:-step], low[step:]), np.where(left, at[:-step], at[step:]), width + step
    valid = np.zeros(len(at), bool)
    for a, b in bounds:
        valid[a : max(a, b - length + 1)] = True
    edge = np.append(True, (at[1:] != at[:-1]) | ~valid[:-1])
    first = np.flatnonzero(valid & edge)
    last = np.flatnonzero(valid & np.append(edge[1:] | ~valid[1:], True))
    bytes_ = (last - first).astype(np.uint64) * _ODD[3] + (at[first] - first).astype(np.uint64) * _ODD[4]
    for k in range(-(-(2 * length) // GRAM)):
        bytes_ = (bytes_ ^ (bytes_ >> np.uint64(31))) * _ODD[5] + h[np.minimum(first + k * GRAM, last + length - GRAM)]
    return first, last, h[at[first]].view(np.int64), bytes_.view(np.int64)


def _parts(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Batches of (row, from, to) of about ``CHUNK`` bytes; a long text is cut with an overlap that keeps every window in one part."""
    part: list[tuple[int, int, int]] = []
    n = 0
    for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        while b - a >= length:
            e = min(b, a + CHUNK)
            part.append((k, int(a), int(e)))
            n += e - a
            if n >= CHUNK:
                yield part
                part, n = [], 0
            if e == b:
                break
            a = e - length + 1
    if part:
        yield part


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column, without a copy; nulls are empty."""
    column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return off, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _anchored(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, data = _bytes_of(b.column(2))
            ids, tids = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for part in _parts(offsets, length):
                size = np.array([e - a for _, a, e in part])
                start = np.cumsum(size) - size
                first, last, key, sign = _runs(np.concatenate([data[a:e] for _, a, e in part]), list(zip(start, start + size, strict=True)), length)
                k = np.searchsorted(start, first, side="right") - 1
                row = np.array([p[0] for p in part])[k]
                pos = first - start[k] + np.array([a for _, a, _ in part])[k] - offsets[row]
                who, tid = ids[row], tids[row]
                # equal runs of this part: all but the first are known to be repeats and needn't meet the anchor's other runs
                o = np.lexsort((pos, tid, who, sign, key))
                same = np.append(False, (key[o][1:] == key[o][:-1]) & (sign[o][1:] == sign[o][:-1]))
                twin = np.append(False, (who[o][1:] == who[o][:-1]) & (tid[o][1:] == tid[o][:-1]) & (pos[o][1:] == pos[o][:-1])) & same
                o, same = o[~twin], same[~twin]
                cols = [np.where(same, (pos[o] + 1) * 0x9E3779B1 ^ who[o], key[o]), sign[o], who[o], tid[o], pos[o], (last - first)[o] + 1]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(same)], names=["key", "sign", "id", "tid", "pos", "n", "known"])

    return run


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by anchor and bytes: later copies are repeats; the first of each kind must be compared if its anchor has several kinds."""
    names = ["key", "sign", "id", "tid", "pos", "n"]
    prev = np.zeros((6, 0), np.int64)  # the row before, for equality with it
    held = np.zeros((6, 0), np.int64)  # the last first of a kind, undecided
    held_mixed = False
    kinds = [("id", pa.int64()), ("tid", pa.int64()), ("key", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()), ("compare", pa.bool_())]

    def rows(x: np.ndarray, compare: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(x[k]) for k in (2, 3, 0, 4, 5)), pa.array(np.full(x.shape[1], compare))], schema=pa.schema(kinds))

    for b in batches:
        known = b.column(6).to_numpy(zero_copy_only=False)
        x = np.stack([b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])
        if known.any():
            yield rows(x[:, known], False)
            x = x[:, ~known]
        if not x.shape[1]:
            continue
        y = np.concatenate([prev, x], axis=1)
        first = np.append(np.ones(1 - prev.shape[1], bool), (y[:2, 1:] != y[:2, :-1]).any(axis=0))
        prev = x[:, -1:]
        if not first.all():
            yield rows(x[:, ~first], False)
        f = np.concatenate([held, x[:, first]], axis=1)
        if not f.shape[1]:
            continue
        near = f[0, 1:] == f[0, :-1]
        mixed = np.append(held_mixed if held.shape[1] else False, near) | np.append(near, False)
        if mixed[:-1].any():
            yield rows(f[:, :-1][:, mixed[:-1]], True)
        held, held_mixed = f[:, -1:], bool(mixed[-1])
    if held.shape[1] and held_mixed:
        yield rows(held, True)


def _pieces(length: int):
    """Bytes of the runs to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for i, tid, todo, t in zip(*(b.column(k) for k in range(4)), strict=True):
                data = t.as_py() or b""
                for r in todo.as_py():
                    values = (r["key"], i.as_py(), tid.as_py(), r["pos"], r["n"], data[r["pos"] : r["pos"] + r["n"] + length - 1])
                    for c, v in zip(out, values, strict=True):
                        c.append(v)
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["key", "id", "tid", "pos", "n", "piece"])

    return run


def _compared(length: int):
    """Sort the suffixes of whole anchors, some ``SHARD`` bytes at a time, and return the spans of repeated windows."""

    def shard(rows: pa.Table) -> pa.RecordBatch:
        i, tid, pos, n = (rows[c].to_numpy() for c in ("id", "tid", "pos", "n"))
        o = np.lexsort((pos, tid, i))
        pieces = rows["piece"].to_pylist()
        n = n[o]
        later = repeated_windows([pieces[k] for k in o], n, length)
        piece = np.repeat(np.arange(len(o)), n)
        at = np.arange(len(later)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(pos[o], n)
        cut = np.append(True, (piece[1:] != piece[:-1]) | ~later[:-1])
        first = np.flatnonzero(later & cut)
        last = np.flatnonzero(later & np.append(cut[1:] | ~later[1:], True))
        who = o[piece[first]]
        return pa.RecordBatch.from_arrays([pa.array(i[who]), pa.array(tid[who]), pa.array(at[first]), pa.array(at[last] + length)], names=["id", "tid", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for big in batches:
            for start in range(0, big.num_rows, 4096):
                b = big.slice(start, 4096)
                held.append(b)
                size += b.column(5).nbytes
                if size >= SHARD:
                    rows = pa.Table.from_batches(held)
                    key = rows["key"].to_numpy()
                    cut = int(np.searchsorted(key, key[-1]))  # the last anchor may go on
                    if cut:
                        yield shard(rows.slice(0, cut))
                        held = rows.slice(cut).combine_chunks().to_batches()
                        size = sum(x.column(5).nbytes for x in held)
        if held:
            yield shard(pa.Table.from_batches(held))

    return run


def _windows(length: int):
    """Each window of crowded runs by itself, as 128 bits of hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, tid, pos, n, piece in zip(*(b.column(k).to_pylist() for k in range(1, 6)), strict=True):
                for k in range(n):
                    d = hashlib.blake2b(piece[k : k + length], digest_size=16).digest()
                    rows.append((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), i, tid, pos + k))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["w1", "w2", "id", "tid", "s"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[], [], [], []]
        for t, spans in zip(b.column(1), b.column(2), strict=True):
            data, kept, at, removed, runs = t.as_py() or b"", [], 0, 0, 0
            end = -1
            for r in sorted((r["s"], r["e"]) for r in spans.as_py() or ()):
                if r[0] > end:
                    runs += 1
                    kept.append(data[at : r[0]])
                    removed += r[1] - r[0]
                elif r[1] > end:
                    removed += r[1] - end
                end = max(end, r[1])
                at = end
            kept.append(data[at:])
            for c, v in zip(out, (len(data), removed, runs, b"".join(kept)), strict=True):
                c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def _release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of what has been checkpointed, so that they don't add up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts earlier: ``id, n_bytes, n_removed, n_spans, kept`` (bytes).

    Earlier: in a smaller id, or earlier in the same document; strings are judged on the input.

    Every window of ``length`` bytes belongs to the anchor that its content chooses (a gram with the least hash), and
    neighbouring windows mostly share theirs, so the corpus becomes runs of windows, some 2.5 % as many as bytes. Equal
    windows have equal anchors. Only hashes of the runs are shuffled; equal runs need no comparison, and anchors with
    one kind of run are done. The bytes of the other runs meet by anchor: tasks sort the suffixes of a shard of whole
    anchors by induced sorting, and windows with a common prefix of ``length`` with an earlier one are repeats. Copies are
    reduced within a part of the input before the shuffle; an anchor with over ``CROWD`` different runs (a passage
    that very many documents hold in different surroundings) is dealt by single windows, whose minima are combined map-side.

    Null or empty text: nothing to remove. Shorter texts keep all. Rows that repeat an id are ordered by a hash of the
    text; equal rows aren't earlier than each other. A null id comes last. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    use_checkpoints(spark)
    last = (1 << 63) - 1
    base = docs.select(F.col(doc_id).cast("long").alias("own"), F.coalesce(F.col(doc_id).cast("long"), F.lit(last)).alias("id"), whole(text).alias("t"))
    again = not base.groupBy("id").count().filter("count > 1").isEmpty()
    base = base.select("own", "id", (F.xxhash64("t") if again else F.lit(0).cast("long")).alias("tid"), F.col("t").cast("binary").alias("t"))

    once = base.dropDuplicates(["id", "tid"]) if again else base
    runs = once.select("id", "tid", "t").mapInArrow(_anchored(length), "key long, sign long, id long, tid long, pos long, n long, known boolean")
    runs = runs.repartition("key").sortWithinPartitions("key", "sign", "id", "tid", "pos")
    judged = runs.mapInArrow(_sorted_runs, "id long, tid long, key long, pos long, n long, compare boolean")
    span = F.struct(F.col("pos").alias("s"), (F.col("pos") + F.col("n") - 1 + length).alias("e"))
    marks = judged.groupBy("id", "tid").agg(F.collect_list(F.when(~F.col("compare"), span)).alias("spans"), F.collect_list(F.when(F.col("compare"), F.struct("key", "pos", "n"))).alias("todo")).checkpoint()
    del runs, judged
    _release(spark)

    todo = marks.filter(F.size("todo") > 0).select("id", "tid", "todo")
    crowded = todo.select(F.explode("todo.key").alias("key")).groupBy("key").count().filter(F.col("count") > CROWD).select("key", F.lit(True).alias("crowded"))
    pieces = once.join(todo, ["id", "tid"]).select("id", "tid", "todo", "t").mapInArrow(_pieces(length), "key long, id long, tid long, pos long, n long, piece binary")
    found = None
    if crowded.isEmpty():
        plain = pieces
    else:
        told = pieces.join(crowded, "key", "left").checkpoint()
        plain = told.filter("crowded is null").drop("crowded")
        single = told.filter("crowded").select("key", "id", "tid", "pos", "n", "piece").mapInArrow(_windows(length), "w1 long, w2 long, id long, tid long, s long")
        least = single.groupBy("w1", "w2").agg(F.min(F.struct("id", "tid", "s")).alias("first"))
        found = single.join(least, ["w1", "w2"]).filter(F.struct("id", "tid", "s") != F.col("first")).select("id", "tid", "s", (F.col("s") + length).alias("e"))
    spans = plain.repartition("key").sortWithinPartitions("key").mapInArrow(_compared(length), "id long, tid long, s long, e long")
    spans = (spans if found is None else spans.union(found)).checkpoint()
    del pieces, plain
    _release(spark)

    every = marks.select("id", "tid", "spans").union(spans.groupBy("id", "tid").agg(F.collect_list(F.struct("s", "e"))))
    every = every.groupBy("id", "tid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    met = base.join(every, ["id", "tid"], "left").select("own", "t", "spans")
    return met.mapInArrow(_cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
