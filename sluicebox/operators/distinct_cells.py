"""Text cells of a table, equal ones of a stretch of rows put together, so that a test on text runs once for them.

Nothing has to repeat for a count to be right: a column whose cells differ passes through as it is.
Tests and casts stay with Spark; Arrow only tells cells apart, byte by byte.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F

#: A stretch ends after so many rows or bytes.
ROWS, BYTES = 1 << 16, 1 << 24
#: Cells looked at first, and the share of different ones from which on a column passes through.
LOOK, MOST_DIFFERENT = 1 << 14, 0.5

CELLS = "position int, txt string, n bigint"


def _put_together(positions: Sequence[int]):
    """Batches of text columns to batches of CELLS; self-contained, as it is sent to the workers."""
    positions, rows, size, look, most = list(positions), ROWS, BYTES, LOOK, MOST_DIFFERENT

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def batch(position, cells, counts):
            place = pa.array(np.full(len(cells), position, dtype=np.int32))
            return pa.RecordBatch.from_arrays([place, cells.cast(pa.string()), pa.array(counts)], ["position", "txt", "n"])

        def stretch(held):
            for i, position in enumerate(positions):
                parts = [b.column(i) for b in held]
                cells = pa.concat_arrays(parts) if len(parts) > 1 else parts[0]
                start = cells[:look]
                if len(start.unique()) > most * len(start) and len(start) == look:
                    yield batch(position, cells, np.ones(len(cells), dtype=np.int64))
                    continue
                coded = cells.dictionary_encode(null_encoding="encode")
                counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                yield batch(position, coded.dictionary, counts.astype(np.int64))

        held, n, total = [], 0, 0
        for one in batches:
            if one.num_rows:
                held.append(one)
                n, total = n + one.num_rows, total + one.nbytes
            if n >= rows or total >= size:
                yield from stretch(held)
                held, n, total = [], 0, 0
        if held:
            yield from stretch(held)

    return run


def distinct_cells(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """position, txt, n: the text columns in long form under their positions; n equal cells are one row, or several."""
    names = [F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in columns.items()]
    return df.select(*names).mapInArrow(_put_together(list(columns)), CELLS)


def weighted(test):
    """How many cells pass the test."""
    return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
