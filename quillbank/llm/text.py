"""Text expressions that the operators share."""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of all contracts: blank and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(x: Column) -> Column:
    """Lower-case A-Z and nothing else; plain ``lower`` does that for pure ASCII and is faster than ``translate``."""
    plain = F.octet_length(x) == F.char_length(x)
    return F.when(plain, F.lower(x)).otherwise(F.translate(x, string.ascii_uppercase, string.ascii_lowercase))


def whole(text: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def bit_filter(terms: DataFrame, term: str, most: int = 1 << 27) -> np.ndarray:
    """Bits of the terms' 64-bit hashes, for tasks to leave out most other words before a join decides.

    32 or more bits for each term, but ``most`` (16 MB) at the most: the filter of more terms lets more words pass.
    """
    bits = min(most, 1 << max(16, (32 * terms.count()).bit_length()))
    at = F.pmod(F.col(term), F.lit(bits))
    found = terms.groupBy(F.shiftright(at, 3).alias("byte")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))).cast("short").alias("mask")).toArrow()
    out = np.zeros(bits // 8, np.uint8)
    out[np.asarray(found.column("byte"), np.int64)] = np.asarray(found.column("mask"), np.int64)
    return out
