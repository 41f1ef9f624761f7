"""Fixed-size bitmaps of hashed numbers: a filter of proven size that may pass too much, never too little."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.llm.shingles import mix

BITS = 26         # 2^26 bits: 8 MB on the driver and on each executor, whatever the data
_BLOCK = 16       # bits of a position inside the piece that one group packs


def positions(values: np.ndarray) -> np.ndarray:
    return (mix(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def _place(batches):
    import pyarrow as pa

    for batch in batches:
        p = np.unique(positions(batch.column(0).to_numpy(zero_copy_only=False)))
        yield pa.RecordBatch.from_arrays([pa.array(p >> _BLOCK), pa.array(p & ((1 << _BLOCK) - 1))], names=["block", "bit"])


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(1 << _BLOCK, np.uint8)
    bits[group["bit"].to_numpy()] = 1
    return pd.DataFrame({"block": [group["block"].iloc[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def bitmap(values: DataFrame) -> np.ndarray:
    """Bitmap of the single non-null long column of ``values``; the driver receives 8 MB at most."""
    rows = (
        values.mapInArrow(_place, "block long, bit long").distinct()
        .groupBy("block").applyInPandas(_pack, "block long, bits binary").collect()
    )
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for row in rows:
        at = row["block"] << (_BLOCK - 3)
        out[at : at + (1 << (_BLOCK - 3))] = np.frombuffer(row["bits"], np.uint8)
    return out


def inside(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    p = positions(values)
    return (bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)


def in_bitmap(df: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """Rows whose column may be among the bitmap's values; NULL is not."""
    import pyarrow as pa

    held = df.sparkSession.sparkContext.broadcast(bits)

    def keep(batches):
        for batch in batches:
            c = batch.column(column)
            known = np.asarray(c.is_valid())
            yield batch.filter(pa.array(known & inside(held.value, np.asarray(c.fill_null(0)))))

    return df.where(F.col(column).isNotNull()).mapInArrow(keep, df.schema)
