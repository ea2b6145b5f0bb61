"""CSV files that appear all at once or not at all.

A Python data source writer: each task writes its files into a staging folder
beside the target and reports their names; the driver's commit drops what
failed or doubled attempts left there and renames the folder to the target.  An
aborted write removes the staging folder and leaves the target as it was.  Files
can begin with a byte-order mark (``utf-8-sig``) and can be dealt into one folder
per value of a flag, as Spark's ``partitionBy`` does.

Paths go through ``pyarrow.fs``, so they may lie in any store that it knows; the
folder must be shared by driver and executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

BOM = "﻿".encode()
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def _filesystem(path: str):
    """The file system of a path and the path within it."""
    from pyarrow import fs
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


class CommittedCsvWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.by = options["path"].rstrip("/"), options.get("by")
        self.bom, self.overwrite = options.get("bom", "false").lower() == "true", overwrite
        self.names = [f.name for f in schema.fields if f.name != self.by]
        self.staging = f"{self.path}._staging-{uuid.uuid4().hex}"

    def _header(self) -> bytes:
        return (BOM if self.bom else b"") + ",".join('"' + n.replace('"', '""') + '"' for n in self.names).encode() + b"\n"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows come sorted by the flag, so one file is open at a time."""
        from pyarrow import csv
        fs, base = _filesystem(self.staging)
        plain = csv.WriteOptions(include_header=False)
        files, stream, folder = [], None, None
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                values = pc.unique(table.column(self.by)).to_pylist() if self.by else [None]
                for v in values:
                    part, to = table, ""
                    if self.by:
                        column = table.column(self.by)
                        part = table.filter(pc.is_null(column) if v is None else pc.equal(column, v))
                        to = f"{quote(self.by)}={NO_VALUE if v is None else quote(str(v), safe='')}/"
                    if stream is None or to != folder:
                        if stream is not None:
                            stream.close()
                        fs.create_dir(f"{base}/{to}", recursive=True)
                        files.append(f"{to}part-{uuid.uuid4().hex}.csv")
                        stream, folder = fs.open_output_stream(f"{base}/{files[-1]}"), to
                        stream.write(self._header())
                    csv.write_csv(part.select(self.names), stream, plain)
        finally:
            if stream is not None:
                stream.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow.fs import FileSelector, FileType
        fs, base = _filesystem(self.staging)
        target, old = _filesystem(self.path)[1], _filesystem(f"{self.path}._old-{uuid.uuid4().hex}")[1]
        named = {f"{base}/{f}" for m in messages if m for f in m.files}
        fs.create_dir(base, recursive=True)
        for info in fs.get_file_info(FileSelector(base, recursive=True)):
            if info.type == FileType.File and info.path not in named:
                fs.delete_file(info.path)
        if not named and not self.by:  # an empty table still has its header
            with fs.open_output_stream(f"{base}/part-{uuid.uuid4().hex}.csv") as stream:
                stream.write(self._header())
        there = fs.get_file_info(target).type != FileType.NotFound
        if there and not self.overwrite:
            fs.delete_dir(base)
            raise FileExistsError(f"{self.path} exists")
        if there:
            fs.move(target, old)
        try:
            fs.move(base, target)
        except Exception:
            if there:
                fs.move(old, target)
            raise
        if there:
            fs.delete_dir(old)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow.fs import FileType
        fs, base = _filesystem(self.staging)
        if fs.get_file_info(base).type != FileType.NotFound:
            fs.delete_dir(base)


class CommittedCsv(DataSource):
    """``df.write.format("committed_csv").option("path", ...)``: see :func:`write_committed`."""

    @classmethod
    def name(cls) -> str:
        return "committed_csv"

    def writer(self, schema: StructType, overwrite: bool) -> CommittedCsvWriter:
        return CommittedCsvWriter(dict(self.options), schema, overwrite)


def write_committed(df: DataFrame, path: str, by: str | None = None, bom: bool = False, overwrite: bool = True) -> None:
    """Write ``df`` as CSV files with a header into the folder ``path``, published
    as a whole; ``by`` makes one folder per value of that column, ``bom`` begins
    each file with a byte-order mark.  Without ``overwrite`` the folder must not
    exist."""
    df.sparkSession.dataSource.register(CommittedCsv)
    rows = df.sortWithinPartitions(by) if by else df
    w = rows.write.format("committed_csv").option("path", path).option("bom", str(bom).lower())
    (w.option("by", by) if by else w).mode("overwrite" if overwrite else "append").save()
