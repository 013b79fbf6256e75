"""Helpers shared by the operators: Arrow-backed column makers and byte buffers of texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.session import scratch_path

#: Texts are taken in bites of about so many bytes, so that a task's arrays stay small
#: whatever the size of an Arrow batch. One text is never split here.
BITE = 1 << 20

#: Rows of an Arrow batch at most: texts are long, and both sides hold whole batches.
ARROW_ROWS = 2000

Make = Callable[[pa.RecordBatch], list]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, taken: list[str]) -> str:
    """``name``, with underscores behind it until it is none of ``taken``, in any case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever they were started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="starloom-code-")) / "starloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema):
    """``mapInArrow`` with this package at hand in the workers, which give memory back after each task."""
    ship(df.sparkSession)
    names = df.columns
    dotted = any("." in name or "`" in name for name in names)  # which mapInArrow would take for fields of structs

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run((b.rename_columns(names) for b in batches) if dotted else batches)
        finally:
            _give_back()

    return (df.toDF(*(f"column_{n}" for n in range(len(names)))) if dotted else df).mapInArrow(task, schema)


def _give_back() -> None:
    """Return freed memory to the system: workers live on between tasks of different operators."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def utf8(column) -> pa.Array:
    """The column as large strings, null as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    return pc.fill_null(column, "")


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large string array, and the offsets of its rows (one more than rows)."""
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def bites(batch: pa.RecordBatch, column: str, size: int = BITE) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about ``size`` bytes of text each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for row, n in enumerate(lengths.tolist()):
        if row > start and total + n > size:
            yield batch.slice(start, row - start)
            total, start = 0, row
        total += n
    if start < len(lengths):
        yield batch.slice(start)


def with_columns(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    make: Make,
    keep: list[str] | None = None,
    size: int = BITE,
    uses: tuple[str, ...] = (),
) -> DataFrame:
    """Columns that ``make`` computes from the text and ``uses``, behind ``keep`` (default: all columns).

    An input column whose name, in any case, is that of a new column is replaced by it.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bites(batch, text, size):
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + make(part), names)

    wanted = [*kept, *(c for c in dict.fromkeys((text, *uses)) if c not in kept)]
    return map_batches(df.select(*[f"`{c}`" for c in wanted]), run, schema)


def rows_from(
    df: DataFrame, text: str, schema: T.StructType, make: Callable[[pa.RecordBatch], pa.RecordBatch], size: int = BITE
) -> DataFrame:
    """Any number of rows for each bite of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bites(batch, text, size):
                yield make(part)

    return map_batches(df, run, schema)


class Scratch:
    """Tables written to the shared folder for the steps of one operator, and deleted after them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete all tables; only for results that are written and do not read them any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        self.paths.clear()
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def key_blocks(batches: Iterator[pa.RecordBatch], key: str, size: int) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by a number ``key``, in blocks of about ``size`` bytes that split no key."""
    held: list[pa.RecordBatch] = []
    weight = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        weight += batch.nbytes
        if weight >= size:
            block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            keys = block.column(key).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield block.slice(0, cut)
            held = [block.slice(cut)]
            weight = held[0].nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run after another, in the type of ``starts``."""
    ends = np.cumsum(lengths, dtype=starts.dtype)
    total = int(ends[-1]) if len(ends) else 0
    out = np.arange(total, dtype=starts.dtype)
    out += np.repeat(starts - (ends - lengths), lengths)
    return out
