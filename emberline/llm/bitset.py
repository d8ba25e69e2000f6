"""A set of numbers as bits of their hashes, of one size whatever it holds: it may say yes too often, never no."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from emberline.llm.text import mix

BITS = 1 << 24
ROWS = 64


def _places(values: np.ndarray) -> np.ndarray:
    return (mix(values.view(np.uint64)) % np.uint64(BITS)).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(BITS, bool)
    for batch in batches:
        bits[_places(np.asarray(batch.column(0).drop_null(), np.int64))] = True
    parts = np.split(np.packbits(bits), ROWS)
    yield pa.RecordBatch.from_arrays([pa.array(range(ROWS)), pa.array([p.tobytes() for p in parts])], ["part", "bits"])


def _either(rows: pd.DataFrame) -> pd.DataFrame:
    bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows["bits"]])
    return pd.DataFrame({"part": rows["part"].iloc[:1], "bits": [bits.tobytes()]})


def bitset(numbers: DataFrame) -> np.ndarray:
    """The bits of the only column of ``numbers`` (long; null is left out), as bytes."""
    kind = "part bigint, bits binary"
    parts = numbers.mapInArrow(_mark, kind).groupBy("part").applyInPandas(_either, kind).collect()
    # ROWS rows of BITS / 8 bytes in all
    return np.frombuffer(b"".join(r.bits for r in sorted(parts, key=lambda r: r.part)) or bytes(BITS // 8), np.uint8)


def holds(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values may be in the set."""
    where = _places(values)
    return bits[where >> 3] >> (7 - (where & 7)).astype(np.uint8) & 1 == 1


def only(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """``rows`` whose first column (long) may be among ``numbers``, and those without one; no shuffle of ``rows``."""
    held = rows.sparkSession.sparkContext.broadcast(bitset(numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column(0)
            keep = holds(held.value, np.asarray(first.fill_null(0), np.int64)) | np.asarray(first.is_null())
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(run, rows.schema)
