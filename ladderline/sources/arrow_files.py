"""Arrow IPC (Feather) files as a data source: a file a partition, written and read by the tasks.

``spark.dataSource.register(ArrowFiles)`` makes the format ``arrow_files``. A task streams its
batches into a file under a name of its own; the commit renames the files of the tasks that
count, so a job that fails, or a task that runs twice, leaves nothing to read. The path must be one
that all executors see. Executors import this package.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.ipc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

NAME, SUFFIX = "arrow_files", ".arrow"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    """A file, or those of a folder in the order of their names."""
    store, at = _place(path)
    if store.get_file_info(at).type == fs.FileType.File:
        return [at]
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(SUFFIX))


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: pa.Schema, overwrite: bool):
        self.path, self.schema, self.overwrite, self.job = path, schema, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, at = _place(self.path)
        store.create_dir(at)
        task = TaskContext.get()
        name = f"{at}/_{self.job}-{task.partitionId():05d}-{task.taskAttemptId()}"
        with store.open_output_stream(name) as out, pa.ipc.new_file(out, self.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as sink:
            for b in iterator:
                sink.write_batch(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, self.schema, strict=True)], schema=self.schema))
        return Written(name, f"{at}/part-{task.partitionId():05d}-{self.job}{SUFFIX}")

    def commit(self, messages: list[Written | None]) -> None:
        store, _ = _place(self.path)
        old = _files(self.path) if self.overwrite else []
        for m in messages:
            store.move(m.temporary, m.final)
        for f in old:
            store.delete_file(f)

    def abort(self, messages: list[Written | None]) -> None:
        store, at = _place(self.path)
        for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True)):
            if f.base_name.startswith(f"_{self.job}-"):
                store.delete_file(f.path)


@dataclass
class OneFile(InputPartition):
    path: str


class Reader(DataSourceReader):
    """A task a file, a batch at a time."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[OneFile]:
        return [OneFile(f) for f in _files(self.path)]

    def read(self, partition: OneFile) -> Iterator[pa.RecordBatch]:
        store, _ = _place(self.path)
        with store.open_input_file(partition.path) as f, pa.ipc.open_file(f) as got:
            for i in range(got.num_record_batches):
                yield got.get_batch(i)


class ArrowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        found = _files(self.options["path"])
        if not found:
            raise FileNotFoundError(f"no {SUFFIX} files in {self.options['path']}")
        with _place(self.options["path"])[0].open_input_file(found[0]) as f:
            return from_arrow_schema(pa.ipc.open_file(f).schema)

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], to_arrow_schema(schema), overwrite)


def write_arrow(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a frame as a folder of Arrow files, one for each of its partitions."""
    df.sparkSession.dataSource.register(ArrowFiles)
    df.write.format(NAME).mode(mode).save(path)


def read_arrow(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Arrow files, or one file; without any file it is an error."""
    spark.dataSource.register(ArrowFiles)
    return spark.read.format(NAME).load(path)
