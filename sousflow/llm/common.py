"""Tables, staging and small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
import gc
import inspect
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sousflow.session import ensure_checkpoint_dir

#: Texts handled together inside a task, so that numpy buffers stay small whatever the batch holds.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (the directory may be any path that Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share; a scratch one only where none is set."""
    folder = ensure_checkpoint_dir(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sousflow-llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


class Staging:
    """Owner of the tables staged within its ``with`` block: at the end those go that no kept frame reads.

    ``left`` are the folders that stay; a later owner may take them over. Any frame that is used
    after the block has to be kept.
    """

    _open: list[Staging] = []

    def __init__(self, spark: SparkSession, taken: Iterable[str] = ()):
        self.spark, self.left, self._kept = spark, list(taken), []

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, whose tables stay after the block."""
        self._kept.append(df)
        return df

    def __enter__(self) -> Staging:
        Staging._open.append(self)
        return self

    def __exit__(self, *error: object) -> None:
        Staging._open.remove(self)
        read = {part for df in self._kept for file in df.inputFiles() for part in file.split("/")}
        sc = self.spark.sparkContext
        for path in self.left:
            if path.rsplit("/", 1)[-1] not in read:
                folder = sc._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
        self.left = [path for path in self.left if path.rsplit("/", 1)[-1] in read]


def staged(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later jobs read the table, also after an executor is lost, and join
    it as a plain scan, so adaptive execution can split a hot key on either side. The table
    lies in this application's own checkpoint folder and goes with the innermost open
    :class:`Staging`; without one it goes when that folder is cleaned.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if Staging._open:
        Staging._open[-1].left.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column as a string, null counted as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def doc_key(column: Column) -> Column:
    """crc32 of a document id written as text: the contract's fold number before the modulus."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def give_back() -> None:
    """Hand freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, after which the worker gives freed memory back: Spark keeps workers waiting for further tasks."""
    @functools.wraps(run)
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()
    return within


def frugal_groups(run: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``run`` for applyInArrow, of (key, tables); the worker gives freed memory back after each group."""
    def grouped(key: tuple, part: pa.Table) -> pa.Table:
        try:
            return run(key, part)
        finally:
            give_back()

    def cogrouped(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(key, left, right)
        finally:
            give_back()
    return grouped if len(inspect.signature(run).parameters) == 2 else cogrouped


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value of this package's own classes; call the result in a task to get it back."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that the texts of each part add up to about ``limit`` bytes, a longer text alone."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)
