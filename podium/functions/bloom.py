"""A Bloom filter of bounded size over a table of values, as a literal for other queries."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each value, between these powers of two (64 KB at most).
BITS_A_VALUE, LEAST, MOST = 16, 10, 19


class Bloom:
    """Which values a table may hold: never wrong about one that it holds.

    The bits come from one aggregate and are no larger than ``2 ** MOST``, whatever the
    size of the table; a table too large for them only lets more other values pass.
    """

    def __init__(self, values: DataFrame, col: str):
        self.power = min(MOST, max(LEAST, (values.count() * BITS_A_VALUE).bit_length()))
        found = values.select(F.explode(F.array(*self._probes(F.col(col)))).alias("p")) \
            .groupBy(F.shiftright("p", 6).cast("int").alias("at")).agg(F.bit_or(F.call_function(
                "shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).collect()
        words = np.zeros(1 << (self.power - 6), dtype=np.int64)
        for r in found:
            words[r["at"]] = r["bits"]
        self.bits = F.lit(words)

    def _probes(self, value: Column) -> list[Column]:
        h = F.xxhash64(value)
        return [F.shiftrightunsigned(h, s).bitwiseAND(F.lit((1 << self.power) - 1)) for s in (0, 32)]

    def may_hold(self, value: Column) -> Column:
        return reduce(and_, [F.bit_get(F.get(self.bits, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
                             for p in self._probes(value)])
