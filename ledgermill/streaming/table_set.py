"""A sink of several tables that a micro-batch reaches together or not at all.

Every column of the stream is a struct and stands for a table; a row adds its non-null structs to
their tables. Tasks write files and report them; the driver's commit publishes one manifest with all files of
the batch, which is the moment they exist for readers. An aborted batch leaves no manifest, and a batch that
is run again after its commit changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..files import exists, numbered, open_store, publish_json, read_json, remove


@dataclass
class Written(WriterCommitMessage):
    """Files that one task has written, as (table, file name)."""

    files: list[tuple[str, str]]


class TableSetWriter(DataSourceStreamArrowWriter):
    """Files lie below data/, manifests are commits/<batch>.json."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"].rstrip("/"), schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = open_store(self.path)
        open_files: dict[str, tuple[str, pq.ParquetWriter]] = {}
        try:
            for batch in iterator:
                for table, column in zip(batch.schema.names, batch.columns):
                    rows = column.filter(column.is_valid())
                    if not len(rows):
                        continue
                    rows = pa.RecordBatch.from_struct_array(rows)
                    if table not in open_files:
                        name = f"{uuid.uuid4().hex}.parquet"
                        store.create_dir(f"{root}/data/{table}", recursive=True)
                        file = f"{root}/data/{table}/{name}"
                        open_files[table] = name, pq.ParquetWriter(file, rows.schema, filesystem=store)
                    open_files[table][1].write_batch(rows)
        except BaseException:
            for table, (name, writer) in open_files.items():
                writer.close()
                store.delete_file(f"{root}/data/{table}/{name}")
            raise
        for _, writer in open_files.values():
            writer.close()
        return Written([(table, name) for table, (name, _) in open_files.items()])

    def _forget(self, messages: list[Written | None]) -> None:
        for message in filter(None, messages):
            for table, name in message.files:
                remove(f"{self.path}/data/{table}/{name}")

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        manifest = f"{self.path}/commits/{batchId}.json"
        if exists(manifest):
            self._forget(messages)  # this batch was committed before the engine could note it
            return
        tables: dict[str, list[str]] = {f.name: [] for f in self.schema}
        for message in filter(None, messages):
            for table, name in message.files:
                tables[table].append(name)
        schemas = {f.name: f.dataType.jsonValue() for f in self.schema}
        publish_json(manifest, {"files": tables, "schemas": schemas})

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._forget(messages)


class TableSet(DataSource):
    """Option: path. One stream per path, since micro-batches are told apart by their numbers."""

    @classmethod
    def name(cls) -> str:
        return "table_set"

    def streamWriter(self, schema: StructType, overwrite: bool) -> TableSetWriter:
        return TableSetWriter(self.options, schema)


def start(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Add a stream whose columns are structs, one per table, to the tables at ``path``."""
    stream.sparkSession.dataSource.register(TableSet)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stream.writeStream.format("table_set").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def read_table(spark: SparkSession, path: str, table: str, before: int | None = None) -> DataFrame | None:
    """The committed rows of a table, of batches below ``before`` if given; None before any commit."""
    path = path.rstrip("/")
    batches = [b for b in numbered(f"{path}/commits") if before is None or b < before]
    manifests = [read_json(f"{path}/commits/{b}.json") for b in batches]
    if not manifests:
        return None
    schema = StructType.fromJson(manifests[-1]["schemas"][table])
    files = [f"{path}/data/{table}/{name}" for m in manifests for name in m["files"].get(table, [])]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def clean(path: str) -> int:
    """Delete files that no manifest names, as a killed task leaves them; only while no stream writes. Returns how many."""
    path = path.rstrip("/")
    named = {
        f"{table}/{name}"
        for b in numbered(f"{path}/commits") for table, names in read_json(f"{path}/commits/{b}.json")["files"].items()
        for name in names
    }
    store, root = open_store(f"{path}/data")
    from pyarrow import fs

    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
    lost = [f.path for f in found if f.is_file and "/".join(f.path.split("/")[-2:]) not in named]
    for file in lost:
        store.delete_file(file)
    return len(lost)
