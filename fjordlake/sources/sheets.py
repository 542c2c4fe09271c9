"""Sheets with headers of their own: one CSV export a sheet, read row by row by header.

    spark.dataSource.register(SourceSheets)
    spark.read.format("source_sheets").option("path", folder).load()

A row gives its sheet (the file's name), its number in it (the header is row 1) and its cells by header, in the order of columns.
Headers are trimmed and lower-case, a blank one is named by its place, of equal ones the last counts. Cells are trimmed, blank ones
null; cells beyond the header go; rows without any filled cell go, but count. Each file is a partition and is read as a stream."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass
class Sheet(InputPartition):
    path: str


def header_names(cells: list[str]) -> list[str]:
    return [c.strip().lower() or f"column_{i}" for i, c in enumerate(cells)]


class SourceSheets(DataSource):
    @classmethod
    def name(cls) -> str:
        return "source_sheets"

    def schema(self) -> str:
        return "sheet string, row_no int, cells map<string,string>"

    def reader(self, schema) -> SheetReader:
        return SheetReader(self.options["path"])


class SheetReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def partitions(self) -> list[Sheet]:
        from pyarrow import fs

        store, root = self._store()
        one = store.get_file_info(root)
        found = [one] if one.is_file else store.get_file_info(fs.FileSelector(root))
        return [Sheet(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and f.path.lower().endswith(".csv")]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        store, _ = self._store()
        name = partition.path.rsplit("/", 1)[-1][: -len(".csv")]
        with store.open_input_stream(partition.path) as raw:
            rows = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", "replace", newline=""))
            header = header_names(next(rows, []))
            for row_no, row in enumerate(rows, 2):
                own = [row[i].strip() or None if i < len(row) else None for i in range(len(header))]
                if any(c is not None for c in own):
                    yield (name, row_no, dict(zip(header, own)))


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(SourceSheets)
    return spark.read.format("source_sheets").option("path", path).load()
