"""Many review workbooks at once: a data source ``workbooks`` that reads and writes files in parallel tasks.

Read and written rows are (workbook, sheet, row_number, cells): the file's path below the folder, and a
sheet's rows as texts, the first of which names the columns. Read rows also have ``error``.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from filingmill.operators.review import SHEETS
from filingmill.sources.workbook import sheet_rows, write_book

ROWS = "workbook string, sheet string, row_number int, cells array<string>"
STAGED = "_staged"
#: Files are packed into tasks of so many bytes, each counted with the second number besides its size.
TASK_BYTES, OPEN_BYTES = 128 << 20, 4 << 20


def _store(folder: str):
    """The Arrow file system of a folder, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


@dataclass
class Books(InputPartition):
    """Workbooks that a task reads one after another."""

    names: list[str]


@dataclass
class Written(WriterCommitMessage):
    """The workbooks of a task: where they lie, and where they belong."""

    files: list[tuple[str, str]]


class Reader(DataSourceReader):
    def __init__(self, folder: str, sheets: list[str]) -> None:
        self.folder, self.sheets = folder, sheets

    def partitions(self) -> list[Books]:
        from pyarrow import fs

        store, root = _store(self.folder)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((posixpath.relpath(f.path, root), f.size) for f in found if f.is_file and f.path.endswith(".xlsx"))
        packs, room = [Books([])], TASK_BYTES
        for name, size in files:
            if name.startswith(f"{STAGED}/"):
                continue
            if packs[-1].names and size + OPEN_BYTES > room:
                packs, room = [*packs, Books([])], TASK_BYTES
            packs[-1].names.append(name)
            room -= size + OPEN_BYTES
        return packs

    def read(self, partition: Books) -> Iterator[tuple]:
        store, root = _store(self.folder)
        for name in partition.names:
            for sheet in self.sheets:
                n = 0
                try:
                    with store.open_input_file(posixpath.join(root, name)) as file:
                        for cells in sheet_rows(file, sheet):
                            n += 1
                            yield name, sheet, n, cells, None
                except Exception as broken:  # whatever a file from outside is, the others are read
                    yield name, sheet, n + 1, None, f"{type(broken).__name__}: {broken}"[:2000]


class Writer(DataSourceWriter):
    """Files of a task are staged; only the commit of the whole job moves them to their places."""

    def __init__(self, folder: str) -> None:
        self.folder, self.job = folder, uuid.uuid4().hex

    def write(self, iterator) -> Written:
        store, root = _store(self.folder)
        staged = posixpath.join(root, STAGED, self.job, uuid.uuid4().hex)
        store.create_dir(staged)
        files = []
        for name, rows in groupby(iterator, lambda r: r["workbook"]):
            if not name or name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"not a path below the folder: {name}")
            at = posixpath.join(staged, f"{len(files)}.xlsx")
            with store.open_output_stream(at) as out:
                write_book(out, _sheets(rows))
            files.append((at, posixpath.join(root, name)))
        return Written(files)

    def commit(self, messages) -> None:
        store, root = _store(self.folder)
        for at, place in (f for m in messages if m for f in m.files):
            store.create_dir(posixpath.dirname(place))
            store.move(at, place)
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        store, root = _store(self.folder)
        staged = posixpath.join(root, STAGED)
        store.delete_dir(posixpath.join(staged, self.job))
        if not store.get_file_info(fs.FileSelector(staged)):
            store.delete_dir(staged)


def _sheets(rows):
    """(name, columns, rows) of a workbook's sheets; the first row of each names its columns."""
    for sheet, own in groupby(rows, lambda r: r["sheet"]):
        yield sheet, list(next(own)["cells"] or []), (r["cells"] or [] for r in own)


class Workbooks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def schema(self) -> str:
        return f"{ROWS}, error string"

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options.get("sheets", ",".join(SHEETS)).split(","))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"])


def read_books(spark: SparkSession, folder: str, *sheets: str) -> DataFrame:
    """Rows of the named sheets, or of all known ones, of every workbook below a folder.

    A workbook that can't be read, or lacks a sheet, gives a row with ``error`` in place of the rest; it doesn't stop the
    others. An empty folder gives no rows.
    """
    spark.dataSource.register(Workbooks)
    return spark.read.format("workbooks").option("sheets", ",".join(sheets or SHEETS)).load(folder)


def write_books(rows: DataFrame, folder: str) -> None:
    """Write (workbook, sheet, row_number, cells) as files below a folder; one of the same name is replaced.

    A workbook is one file, so its rows meet in one task, sorted by the shuffle and written as they come; a row is in
    memory at a time. If any task fails for good no file appears. Sheets keep their fixed order, others follow by name.
    """
    rows.sparkSession.dataSource.register(Workbooks)
    at = F.array_position(F.array(*[F.lit(s) for s in SHEETS]), F.col("sheet"))
    order = F.when(at > 0, at).otherwise(len(SHEETS) + 1)
    own = rows.select("workbook", "sheet", F.col("row_number").cast("int"), F.col("cells").cast("array<string>"))
    own.repartition("workbook").sortWithinPartitions("workbook", order, "sheet", "row_number").write.format("workbooks").mode("append").save(folder)
