"""A paged mail feed as a data source: ``spark.read.format("mail_feed")`` and ``spark.readStream``.

A feed is a folder with one sub-folder per page, ``page=0``, ``page=1`` and so on, each holding a file with messages as
JSON, one per line. Pages are only ever added. A batch read plans one task per group of pages and reads only pages and columns
that are asked for; a stream keeps the next page as its offset.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..files import exists, open_store, publish_json, read_json, remove
from ..schemas import MESSAGES
from ..session import cut_lineage, discard

SCHEMA = f"{MESSAGES}, page long"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
# Messages of one Arrow batch.
_ROWS = 1000
# Tasks of one batch; with more pages than these take, each takes more pages.
_TASKS = 256


def pages_of(path: str) -> list[int]:
    """Numbers of the pages of a feed, ascending; a page is there once its file is."""
    store, root = open_store(path)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
    files = (re.search(r"/page=(\d+)/[^/_.][^/]*$", f.path) for f in found)
    return sorted({int(m[1]) for m in files if m})


def next_page(path: str) -> int:
    """Number of the first page that is not there yet; what comes after a gap waits until the gap is filled."""
    pages = pages_of(path)
    return next((k for k, page in enumerate(pages) if page != k), len(pages))


class Pages(InputPartition):
    """Pages that one task reads."""

    def __init__(self, pages: Sequence[int]):
        self.pages = list(pages)


def _groups(pages: Sequence[int], size: int) -> list[Pages]:
    """``size`` pages per task, or as many more as keep the tasks at ``_TASKS``: a task costs far more than a page."""
    size = max(size, -(-len(pages) // _TASKS))
    return [Pages(pages[k : k + size]) for k in range(0, len(pages), size)]


def _value(raw, kind: pa.DataType):
    if raw is None or not pa.types.is_timestamp(kind):
        return raw
    when = dt.datetime.fromisoformat(raw)
    return when if when.tzinfo else when.replace(tzinfo=dt.timezone.utc)


def read_pages(path: str, pages: Sequence[int], schema: StructType, since=None, before=None) -> Iterator[pa.RecordBatch]:
    """Messages of the pages with the columns of ``schema``; a line that is no message object is left out.

    ``since`` and ``before`` bound received_at (inclusive, either may be None).
    """
    store, root = open_store(path)
    arrow = to_arrow_schema(schema)
    kinds = {f.name: f.type for f in arrow}
    columns: dict[str, list] = {name: [] for name in kinds}

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)
        for values in columns.values():
            values.clear()
        return made

    held = 0
    for page in pages:
        files = store.get_file_info(fs.FileSelector(f"{root}/page={page}"))
        for file in sorted(f.path for f in files if not f.base_name.startswith(("_", "."))):
            with store.open_input_stream(file) as stream:
                for line in _lines(stream):
                    try:
                        message = json.loads(line)
                        if not isinstance(message, dict):
                            continue
                        received = message.get("received_at") if since or before else None
                        when = _value(received, pa.timestamp("us")) if received else None
                    except (ValueError, TypeError):
                        continue
                    if (since or before) and (when is None or since and when < since or before and when > before):
                        continue
                    for name, values in columns.items():
                        try:
                            value = page if name == "page" else _value(message.get(name), kinds[name])
                        except (ValueError, TypeError):
                            value = None
                        values.append(value)
                    held += 1
                    if held == _ROWS:
                        yield batch()
                        held = 0
    if held:
        yield batch()


def _lines(stream) -> Iterator[bytes]:
    """Lines of a file, read in blocks."""
    rest = b""
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from filter(None, whole)
    if rest:
        yield rest


class FeedReader(DataSourceReader):
    """Reads the pages and the time span that pushed filters leave."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema
        self.group = int(options.get("pagesPerTask", "8"))
        self.first, self.last, self.chosen = 0, None, None
        self.since = self.before = None

    def partitions(self) -> list[Pages]:
        pages = [
            p for p in pages_of(self.path)
            if p >= self.first and (self.last is None or p <= self.last) and (self.chosen is None or p in self.chosen)
        ]
        return _groups(pages, self.group) or [Pages([])]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return read_pages(self.path, partition.pages, self.schema, self.since, self.before)


class PushingFeedReader(FeedReader):
    """Also takes filters: on ``page`` for which pages are read, on ``received_at`` for which messages are kept."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("page",) and isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                self._pages(f)
            elif column == ("received_at",) and isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                value = f.value if f.value.tzinfo else f.value.replace(tzinfo=dt.timezone.utc)
                if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.since = max(self.since or value, value)
                else:
                    self.before = min(self.before or value, value)
                if isinstance(f, (GreaterThan, LessThan)):
                    yield f  # the bound itself is left to Spark
            else:
                yield f

    def _pages(self, f: Filter) -> None:
        if isinstance(f, (EqualTo, In)):
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.chosen = values if self.chosen is None else self.chosen & values
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.first = max(self.first, f.value + isinstance(f, GreaterThan))
        else:
            last = f.value - isinstance(f, LessThan)
            self.last = last if self.last is None else min(self.last, last)


class FeedStreamReader(DataSourceStreamReader):
    """Offsets are page numbers. ``pagesPerBatch`` bounds a micro-batch and needs ``cursor``, a file of its own.

    The engine does not say where a restarted stream stands before it asks how far to go, so the end of
    the last finished batch is kept in the cursor file too.
    """

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema
        self.group = int(options.get("pagesPerTask", "8"))
        self.most = int(options["pagesPerBatch"]) if "pagesPerBatch" in options else None
        self.cursor = options.get("cursor")
        if self.most is not None and not self.cursor:
            raise ValueError("pagesPerBatch needs the option cursor")
        self.at = self._cursor() if self.cursor else 0

    def _cursor(self) -> int:
        return read_json(self.cursor)["page"] if exists(self.cursor) else 0

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        there = next_page(self.path)
        return {"page": there if self.most is None else max(self.at, min(there, self.at + self.most))}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self.at = max(self.at, end["page"])
        return _groups(range(start["page"], end["page"]), self.group)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return read_pages(self.path, partition.pages, self.schema)

    def commit(self, end: dict) -> None:
        if self.cursor:
            publish_json(self.cursor, end)


class MailFeed(DataSource):
    """Options: path, pagesPerTask, and for streams pagesPerBatch with cursor."""

    @classmethod
    def name(cls) -> str:
        return "mail_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = PushingFeedReader if self.options.get("pushdown") == "true" else FeedReader
        return kind(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FeedStreamReader(self.options, schema)


def read_feed(spark: SparkSession, path: str, columns: str | StructType = SCHEMA, **options: str) -> DataFrame:
    """A feed as a frame. ``columns`` names what is read of each message; filters are pushed where the session allows it."""
    spark.dataSource.register(MailFeed)
    push = spark.conf.get(PUSHDOWN, "false").lower()
    return spark.read.format("mail_feed").schema(columns).options(**{"pushdown": push, **options}).load(path)


def stream_feed(spark: SparkSession, path: str, columns: str | StructType = SCHEMA, **options: str) -> DataFrame:
    """A feed as a stream, page after page."""
    spark.dataSource.register(MailFeed)
    return spark.readStream.format("mail_feed").schema(columns).options(**options).load(path)


def write_pages(messages: DataFrame, path: str, page: str = "page") -> None:
    """Add messages to a feed; the column ``page`` says where they go. No page appears before all are written.

    Tasks write a file per page beside the feed, where no reader looks, and a second job moves them. (Spark's own writer
    would make folder and file by page, and its driver would move every single file.)
    """
    rows = messages.withColumnRenamed(page, "page")
    columns = [c for c in rows.columns if c != "page"]
    line = F.to_json(F.struct(*columns), {
        "ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    })
    run = uuid.uuid4().hex
    staged = f"{path.rstrip('/')}.{run}"
    lines = rows.select("page", line.alias("line")).repartition("page").sortWithinPartitions("page")
    written = cut_lineage(lines.mapInArrow(_stage_writer(staged), "page long, file string"))
    # One file per page: of a task that ran twice only the file that was reported counts.
    cores = written.sparkSession.sparkContext.defaultParallelism
    written.repartition(cores, "page").mapInArrow(_mover(staged, path, run), "page long").write.format("noop").mode("overwrite").save()
    discard(written)
    remove(staged)


def _stage_writer(staged: str):
    """A function that writes the sorted rows (page, line) of a task, one file per page, and reports the files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(staged)
        store.create_dir(root, recursive=True)
        task, at, out, pages, files = uuid.uuid4().hex, None, None, [], []
        for batch in batches:
            for page, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out is None or page != at:
                    if out is not None:
                        out.close()
                    at = page
                    pages.append(page)
                    files.append(f"{task}-{page}.json")
                    out = store.open_output_stream(f"{root}/{files[-1]}")
                out.write(line.encode() + b"\n")
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), pa.array(files, pa.string())], names=["page", "file"])

    return write


def _mover(staged: str, path: str, run: str):
    """A function that moves reported files into the feed; a task that runs again passes over what is moved."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (store, source), (_, root) = open_store(staged), open_store(path)
        for batch in batches:
            for page, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder = f"{root}/page={'__HIVE_DEFAULT_PARTITION__' if page is None else page}"
                store.create_dir(folder, recursive=True)
                if store.get_file_info(f"{source}/{file}").type == fs.FileType.File:
                    store.move(f"{source}/{file}", f"{folder}/part-{run}.json")
            yield batch.select(["page"])

    return move
