"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import martkit
from martkit.session import prepare, scratch_path

# Fixed: ASCII letters lower-cased, every other ASCII character that is no digit becomes a space.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def blobs(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null gives b''."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased words of letters, digits and any non-ASCII characters."""
    return text.translate(ALNUM).split()


def space_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words between ASCII white space."""
    return text.lower().split()


HELD: list[Callable[[], None]] = []  # what forgets a module's memory of a task


def hand_back() -> None:
    """Forget what modules remember and return Arrow's free memory: workers outlive their tasks and stages."""
    for forget in HELD:
        forget()
    pa.default_memory_pool().release_unused()


def map_stream(df: DataFrame, fn: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply a function to each task's Arrow batches; the worker hands its memory back when the task ends."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            hand_back()

    return df.mapInArrow(task, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function to every Arrow batch of the rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield out

    return map_stream(df, run, schema)


_SHIPPED: set[str] = set()
BATCH_BYTES = str(16 << 20)  # Arrow batches are bounded by bytes, not only by rows


def ready(spark: SparkSession) -> SparkSession:
    """Apply the library's settings and hand its code to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        root = os.path.dirname(os.path.abspath(martkit.__file__))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "martkit_code"), "zip", os.path.dirname(root), os.path.basename(root))
        spark.sparkContext.addPyFile(archive)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def joined_sha256(items: str) -> F.Column:
    """Hex SHA-256 of an array column's strings, sorted and comma-joined (empty array: of the empty text)."""
    return F.sha2(F.array_join(F.array_sort(F.col(items).cast("array<string>")), ",").cast("binary"), 256)


_SCOPES: list[list[Workspace]] = []


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Delete the tables of all workspaces opened inside when it ends; results must be written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for work in _SCOPES.pop():
            work.close()


class Workspace:
    """Tables written to the cluster's shared folder to cut lineage, dropped once nothing reads them.

    A lost executor costs a re-read of the files, never the whole chain. What is still there when
    the surrounding ``scratch_scope`` ends, or at the latest when the driver's JVM does, is deleted then.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.made = spark, scratch_path(spark, name), 0
        if _SCOPES:
            _SCOPES[-1].append(self)

    def _folder(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def put(self, df: DataFrame) -> DataFrame:
        if not self.made:
            files, root = self._folder(self.root)
            files.mkdirs(root)
            files.deleteOnExit(root)
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete all tables; later reads of them fail."""
        files, root = self._folder(self.root)
        files.delete(root, True)

    def drop(self, *frames: DataFrame) -> None:
        """Delete the files below tables made by ``put``; later reads of them fail."""
        for df in frames:
            for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
                files, path = self._folder(folder)
                files.delete(path, True)
