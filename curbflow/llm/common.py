"""Shared helpers: stored intermediate tables, folds, and Arrow batches in slices of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Bytes of text that one slice of an Arrow batch holds at most (one row at least).
SLICE_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset on one machine (tests)."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder or tempfile.mkdtemp(prefix="curbflow-")


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: no lineage, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_parts(df: DataFrame, part: str, count: int) -> list[DataFrame]:
    """The frame stored in one folder per value 0 ... count - 1 of the column, each a frame that can be deleted by itself."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.partitionBy(part).parquet(path)
    schema = df.drop(part).schema
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f"{path}/{part}={k}" for k in range(count)]
    there = [store.exists(spark._jvm.org.apache.hadoop.fs.Path(folder)) for folder in folders]
    return [spark.read.schema(schema).parquet(f) if ok else spark.createDataFrame([], schema) for f, ok in zip(folders, there)]


def drop_stored(*frames: DataFrame | None) -> None:
    """Delete the files of stored frames that nothing reads any more."""
    for frame in frames:
        if frame is None:
            continue
        session = frame.sparkSession
        for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
            path = session._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def spent(*frames: DataFrame) -> None:
    """Delete stored frames as `drop_stored` does, and let Spark free the shuffle files of jobs that are done.

    Spark frees them when the driver's JVM collects the plans they belong to; unasked, that may be half an hour later.
    """
    drop_stored(*frames)
    frames[0].sparkSession._jvm.System.gc()


class Shared:
    """A value of bounded size that every task reads from one broadcast; its class travels by value."""

    def __init__(self, spark: SparkSession, value):
        self._broadcast, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self) -> dict:
        return {"_broadcast": self._broadcast, "_value": None}

    @property
    def value(self):
        if self._value is None:
            self._value = cloudpickle.loads(self._broadcast.value)
        return self._value


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether the id falls in the held-out part; a NULL id never does."""
    return F.coalesce(fold(doc_id, parts) == part, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in slices of at most `limit` bytes in the column."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def map_slices(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str | StructType, column: str = "text") -> DataFrame:
    """`function` over slices of the frame; it returns lists or arrays by column of the schema."""
    target = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches):
        for part in slices(batches, column):
            out = function(part)
            if out is not None:
                yield pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, target)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values if isinstance(values, pa.Array) else pa.array(values, kind)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The texts as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


# Bytes A-Z to a-z, everything else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lower_words(text: bytes | None) -> list[bytes]:
    """White-space separated words with A-Z lower-cased; none for NULL."""
    return text.translate(LOWER).split() if text else []
