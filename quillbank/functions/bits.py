"""A bounded bit filter of hashes, for tasks to drop most other rows before a shuffle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def places_in(hashes: DataFrame, name: str, most: int = 1 << 27) -> Callable[[Column], Column]:
    """A function of an ``array<long>`` column: the places (from 0) of values that may be among ``hashes``.

    A bit for each hash, 32 or more times as many as there are hashes, but ``most`` (16 MB) at the most: beyond that
    more other values pass, none is lost. What passes has to be joined to be sure. Null values don't pass.
    """
    bits = min(most, 1 << max(16, (32 * hashes.count()).bit_length()))
    at = F.pmod(F.col(name), F.lit(bits))
    found = hashes.groupBy(F.shiftright(at, 3).alias("byte")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))).cast("short").alias("mask")).filter("byte is not null").toArrow()
    mask = np.zeros(bits // 8, np.uint8)
    mask[np.asarray(found.column("byte"), np.int64)] = np.asarray(found.column("mask"), np.int64)

    @F.arrow_udf("array<int>")
    def passing(values: pa.Array) -> pa.Array:
        flat = values.flatten()
        x = np.asarray(flat.fill_null(0)) % bits
        hit = np.flatnonzero((mask[x >> 3] >> (x & 7).astype(np.uint8)) & 1 & np.asarray(flat.is_valid()))
        ends = np.concatenate([[0], np.cumsum(np.asarray(values.value_lengths().fill_null(0), np.int64))])
        cuts = np.searchsorted(hit, ends)
        row = np.repeat(np.arange(len(values)), np.diff(cuts))
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hit - ends[row], pa.int32()))

    return passing
