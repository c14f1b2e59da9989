"""A filter of fixed size over 64-bit keys: lets every wanted key through and few
others; what it lets through in excess is removed by a join afterwards."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

#: Two megabytes, whatever the number of keys.
BITS = 1 << 24
U = np.uint64


def bits_of(keys: DataFrame, col: str) -> np.ndarray:
    """The filter over a long column: BITS / 64 words, gathered as at most that many rows."""
    rows = keys.filter(f"{col} is not null").selectExpr(
        f"cast(pmod({col}, {BITS}) div 64 as int) as w", f"shiftleft(1L, cast(pmod({col}, 64) as int)) as m")
    table = rows.groupBy("w").agg({"m": "bit_or"}).toDF("w", "m").toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[table["w"].to_numpy()] = table["m"].to_numpy()
    return out.view(U)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.astype(np.int64) % BITS if keys.dtype != U else (keys % U(BITS)).astype(np.int64)
    return (bits[place >> 6] >> (place & 63).astype(U)) & U(1) == U(1)
