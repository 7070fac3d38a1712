"""The itemset report written piece by piece.

The report puts all sets of one support on one line. :func:`write_itemset_report`
never builds that line: the sets are range-partitioned by support, sorted
within their task (Spark's sort spills), and a Python data source writes one set
after the other to the task's part file. A line of any length needs the
memory of one Arrow batch. The part files, read in name order, are
byte-equal to the lines that ``write_lines(itemset_report_lines(...))`` gives.

Files are written through ``pyarrow.fs`` to the location's file system, under a
name of the attempt's own; a part gets its final name when all have ended well,
so a task that is tried twice leaves nothing.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from basketry.functions.arrays import ITEM_SEPARATOR, SET_SEPARATOR, items_text
from basketry.session import ship

FORMAT = "basketry_itemset_report"


@dataclass
class Part(WriterCommitMessage):
    number: int
    draft: str | None


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a location (a URI or a local path) and the path there."""
    if path.startswith("file:"):
        path = path.removeprefix("file:")
        path = "/" + path.lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


class ReportWriter(DataSourceArrowWriter):
    """Writes rows ``(support, set)`` in the order they come."""

    def __init__(self, path: str):
        self.path = path
        self.drafts = f"{path.rstrip('/')}/_drafts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        task = TaskContext.get()
        fs, folder = _open(self.drafts)
        draft, out, last = f"{folder}/{task.partitionId()}-{task.taskAttemptId()}", None, None
        try:
            for batch in iterator:
                pieces = []
                for support, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if support != last:
                        pieces.append(f"{'' if last is None else chr(10)}{support}")
                        last = support
                    pieces.append(SET_SEPARATOR + text)
                if pieces and out is None:
                    fs.create_dir(folder, recursive=True)
                    out = fs.open_output_stream(draft)
                if pieces:
                    out.write("".join(pieces).encode())
            if out is not None:
                out.write(b"\n")
        finally:
            if out is not None:
                out.close()
        return Part(task.partitionId(), draft if out is not None else None)

    def commit(self, messages: list[Part | None]) -> None:
        fs, folder = _open(self.path)
        fs.create_dir(folder, recursive=True)
        for part in messages:
            if part is not None and part.draft is not None:
                fs.move(part.draft, f"{folder}/part-{part.number:05d}.txt")
        self._clean(fs)
        with fs.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[Part | None]) -> None:
        self._clean(_open(self.path)[0])

    def _clean(self, fs: pafs.FileSystem) -> None:
        drafts = _open(self.drafts)[1]
        if fs.get_file_info(drafts).type == pafs.FileType.Directory:
            fs.delete_dir(drafts)


class ReportSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "support bigint, text string"

    def writer(self, schema, overwrite: bool) -> ReportWriter:
        return ReportWriter(self.options["path"])


def write_itemset_report(itemsets: DataFrame, path: str) -> None:
    """Write ``(items, k, support)`` as the itemset report; ``path`` must not exist."""
    spark = itemsets.sparkSession
    ship(spark)
    fs, folder = _open(path)
    if fs.get_file_info(folder).type != pafs.FileType.NotFound:
        raise FileExistsError(f"{path} exists")
    spark.dataSource.register(ReportSource)
    falling = F.col("support").desc()
    sets = (itemsets.repartitionByRange(falling).sortWithinPartitions(falling, "k", "items")
            .select("support", items_text("items", ITEM_SEPARATOR).alias("text")))
    sets.write.format(FORMAT).mode("append").option("path", path).save()
