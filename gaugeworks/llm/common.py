"""Small helpers shared by the text operators."""
from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.session import fresh_path

SLICE_BYTES = 1 << 21
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

# Between a non-space and a plain space or line feed every byte-level pattern of
# this family starts a new word, whatever stands on either side.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def typed(df: DataFrame, name: str, alias: str | None = None) -> T.StructField:
    """The field of one column, nullable, for the schema of a mapped frame."""
    return T.StructField(alias or name, df.schema[name].dataType, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several passes read to the shared folder, and read it back."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
           schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` with batches of about :data:`SLICE_BYTES`, whatever the length of the rows.

    Spark counts rows, 10,000 a batch: of texts of 2 kB that is 20 MB, held by the executor's JVM outside
    its heap and again by each Python worker, and neither gives such buffers back.  The setting is read when
    the frame runs, so it stays on the session.  It bounds memory and never changes rows.
    """
    df.sparkSession.conf.set(BATCH_SETTING, str(SLICE_BYTES))
    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], column: int,
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in parts of about ``size`` bytes of one text column.

    A worker that turns one part at a time into Python objects stays small even where the
    session's batches are larger than :func:`mapped` asks for.
    """
    for batch in batches:
        widths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = pc.cumulative_sum(widths.cast(pa.int64())).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        if not batch.num_rows:
            yield batch


def pieces(text: str, size: int) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut only where a word starts for certain."""
    start = 0
    while len(text) - start > size:
        found = _CUT.search(text, start + size)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:] if start else text


def hash_sample(df: DataFrame, key: str, size: int, salt: str) -> DataFrame:
    """About ``size`` rows, the same ones on every run: those whose key hashes below size / rows.

    For fitting models only.  The expected size is bounded whatever the table holds, and
    nothing is sorted or sent to one place.
    """
    rows = df.count()
    if rows <= size:
        return df
    share = F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return df.where(share < size / rows)
