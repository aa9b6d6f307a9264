"""A sink of label events as a Python data source (A11, A12), for tables and for streams.

Tasks write their rows as Parquet files under names of their own. A commit lists the files
of one batch in a small manifest, which appears in one step, and only listed files are
read. So files of a failed or repeated task are never seen, an aborted batch leaves
nothing, and a batch that is replayed under the same id is dropped: the first copy stays.

``path`` is a folder that driver and executors share, or a URI that Arrow can open.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

NAME = "label_events"


@dataclass
class Written(WriterCommitMessage):
    """The files of one task."""

    files: list[str]


class EventFolder:
    """Files and manifests in one folder."""

    def __init__(self, path: str):
        self.path = path

    def _open(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path:
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path.removeprefix("file:")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, root = self._open()
        store.create_dir(f"{root}/data", recursive=True)
        name, writer = f"data/{uuid.uuid4().hex}.parquet", None
        try:
            for batch in batches:
                if batch.num_rows:
                    if writer is None:
                        out = store.open_output_stream(f"{root}/{name}")
                        writer = pq.ParquetWriter(out, batch.schema)
                    writer.write_batch(batch)
        finally:
            if writer is not None:
                writer.close()
                out.close()
        return Written([name] if writer is not None else [])

    def commit(self, messages: list[Written | None], batch: str) -> None:
        """List the batch's files, unless the batch is listed already."""
        files = [f for m in messages if m is not None for f in m.files]
        store, root = self._open()
        store.create_dir(f"{root}/commits", recursive=True)
        manifest = f"{root}/commits/{batch}.json"
        if store.get_file_info(manifest).type != fs.FileType.NotFound:
            self.remove(files)
            return
        waiting = f"{root}/waiting-{uuid.uuid4().hex}.json"
        with store.open_output_stream(waiting) as out:
            out.write(json.dumps({"batch": batch, "files": files}).encode())
        store.move(waiting, manifest)

    def abort(self, messages: list[Written | None]) -> None:
        self.remove([f for m in messages if m is not None for f in m.files])

    def remove(self, files: list[str]) -> None:
        store, root = self._open()
        for name in files:
            store.delete_file(f"{root}/{name}")

    def files(self) -> list[str]:
        """The files of all committed batches: a name each, as many as tasks have written."""
        store, root = self._open()
        found = []
        for entry in store.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True)):
            with store.open_input_stream(entry.path) as manifest:
                found += json.loads(manifest.read())["files"]
        return [f"{self.path.rstrip('/')}/{name}" for name in found]


class EventWriter(DataSourceArrowWriter):
    """One batch: the option ``batch`` names it, else it is a batch of its own."""

    def __init__(self, folder: EventFolder, batch: str):
        self.folder, self.batch = folder, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.folder.write(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.folder.commit(messages, f"batch-{self.batch}")

    def abort(self, messages: list[Written | None]) -> None:
        self.folder.abort(messages)


class EventStreamWriter(DataSourceStreamArrowWriter):
    """Micro-batches: a batch id is committed once."""

    def __init__(self, folder: EventFolder):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.folder.write(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.folder.commit(messages, f"stream-{batchId}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.folder.abort(messages)


class LabelEventSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> EventWriter:
        if overwrite:
            raise ValueError("events are appended, never overwritten")
        return EventWriter(EventFolder(self.options["path"]), self.options.get("batch") or uuid.uuid4().hex)

    def streamWriter(self, schema, overwrite: bool) -> EventStreamWriter:
        return EventStreamWriter(EventFolder(self.options["path"]))


def write_batch(events: DataFrame, path: str, batch: str | None = None) -> None:
    """Append events as one batch; with a name, the batch is stored once however often it is written."""
    events.sparkSession.dataSource.register(LabelEventSink)
    writer = events.write.format(NAME).mode("append").option("path", path)
    (writer.option("batch", batch) if batch else writer).save()


def stored_events(spark: SparkSession, path: str, schema) -> DataFrame:
    """The events of all committed batches."""
    files = EventFolder(path).files()
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
