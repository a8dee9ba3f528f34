"""Cutting Arrow batches into pieces of bounded text, whatever the length of a row."""

import ctypes
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

TEXT_BYTES = 4 * 1024 * 1024
BATCH_BYTES, BATCH_ROWS = 8 * 1024 * 1024, 2000


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` in batches of bounded size: a session with larger ones is set to these."""
    conf = df.sparkSession.conf
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    for name, most in bounds.items():
        number, unit = re.fullmatch(r"(-?\d+)\s*([bkmgtp]?)b?", conf.get(name).lower()).groups()
        now = int(number) << 10 * "bkmgtp".index(unit or "b")
        if now <= 0 or now > most:
            conf.set(name, str(most))
    return df.mapInArrow(function, schema)


def give_back() -> None:
    """Return freed memory to the system: a worker goes on to other tasks and need not hold what one took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def plain_text(column: pa.Array) -> pa.Array:
    """Text with 64-bit offsets starting at zero; null becomes the empty text."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    return pa.concat_arrays([filled]) if filled.offset else filled


def bounded(batches, text: str, limit: int = TEXT_BYTES):
    """The rows of ``batches`` in order, cut so that a piece holds ``limit`` bytes of text.

    A row longer than that is a piece of its own.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.large_string())), 0).to_numpy(
            zero_copy_only=False
        )
        start, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


def text_buffers(column: pa.Array):
    """(offsets as int64 ndarray, data buffer) of a non-null large_string array."""
    import numpy as np

    array = plain_text(column)
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8) if len(array) else np.zeros(1, np.int64)
    data = array.buffers()[2] if len(array) and array.buffers()[2] is not None else pa.py_buffer(b"")
    base = offsets[0]
    return offsets - base, data.slice(int(base), int(offsets[-1] - base))
