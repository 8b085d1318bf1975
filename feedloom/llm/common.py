"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.scratch import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows once written to the shared folder, and read from there from now on.

    Later jobs see the same rows whatever is computed again, and an executor that is
    lost takes nothing with it.
    """
    path = new_path(frame.sparkSession, label)
    frame.write.mode("overwrite").options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def crc_mod(name: str, by: int) -> Column:
    """crc32 of a column as text, modulo ``by``; a null counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(by))


#: Bytes of texts that one slice may hold; a longer text is a slice of its own.
SLICE_BYTES = 8 << 20


def sliced(
    batches: Iterator[pa.RecordBatch], rows: int = 512, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut by rows and by bytes, so that what is computed of a slice stays small."""
    for batch in batches:
        texts = [c for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_binary(c.type)]
        sizes = sum((pc.binary_length(c).fill_null(0).to_numpy().astype(np.int64) for c in texts),
                    np.zeros(batch.num_rows, np.int64))
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            fits = int(np.searchsorted(ends, before + most, "right"))
            stop = max(start + 1, min(start + rows, fits))
            yield batch.slice(start, stop - start)
            start = stop
