"""A Spark data source whose write sends each class to files of its own columns.

Rows come sorted by class, section and report order. A task keeps one file open at a time, cuts the class's own columns
out of each Arrow batch, and reports its files with their rows. Files of tasks that failed or ran twice are in no
report, so nobody reads them. The driver's commit lists the files, in the order of the partitions, in ``_written.json``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME, WRITTEN = "termfold_sheets", "_written.json"
#: Rows that are held before they become a row group.
GROUP_ROWS = 65_536


@dataclass
class Files(WriterCommitMessage):
    part: int
    files: list          # [class, section, file below the run's folder, rows]


def file_system_of(path: str) -> tuple[pa.fs.FileSystem, str]:
    """A file system that Python workers can write to, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return pa.fs.LocalFileSystem(), path
    return pa.fs.FileSystem.from_uri(path)


class Sheet:
    """One open file of one class and section."""

    def __init__(self, fs: pa.fs.FileSystem, file: str, fmt: str, schema: pa.Schema):
        fs.create_dir(file.rsplit("/", 1)[0], recursive=True)
        self.held: list[pa.RecordBatch] = []
        self.rows = self.waiting = 0
        self.schema, self.stream = schema, fs.open_output_stream(file)
        if fmt == "csv":
            self.out = pa.csv.CSVWriter(self.stream, schema, write_options=pa.csv.WriteOptions(quoting_style="all_valid"))
        else:
            self.out = pa.parquet.ParquetWriter(self.stream, schema, compression="snappy")

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.rows += batch.num_rows
        self.waiting += batch.num_rows
        if self.waiting >= GROUP_ROWS:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.out.write_table(pa.Table.from_batches(self.held, self.schema))
            self.held, self.waiting = [], 0

    def close(self) -> int:
        self.flush()
        self.out.close()
        self.stream.close()
        return self.rows


class SheetWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.fmt = options["path"].rstrip("/"), options.get("fmt", "parquet")
        self.columns: dict[str, list[str]] = json.loads(options["columns"])

    def write(self, iterator) -> Files:
        part, sheet, of, name, done = TaskContext.get().partitionId(), None, None, None, []
        fs, base = file_system_of(self.path)

        def end() -> None:
            if sheet is not None:
                done.append([*of, name, sheet.close()])

        for batch in iterator:
            profiles, sections = (batch.column(batch.schema.get_field_index(c)) for c in ("profile", "section"))
            for start, stop in _stretches(profiles, sections):
                now = (profiles[start].as_py(), sections[start].as_py())
                own = batch.slice(start, stop - start).select(self.columns[now[0]])
                if now != of:
                    end()
                    of = now
                    name = f"profile={now[0]}/section={now[1]}/part-{part:06d}-{uuid.uuid4().hex}.{self.fmt}"
                    sheet = Sheet(fs, f"{base}/{name}", self.fmt, own.schema)
                sheet.add(own)
        end()
        return Files(part, done)

    def commit(self, messages: list[Files | None]) -> None:
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.part) for f in m.files]
        fs, base = file_system_of(self.path)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{WRITTEN}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Files | None]) -> None:
        fs, base = file_system_of(self.path)
        for m in messages:
            for f in m.files if m else []:
                fs.delete_file(f"{base}/{f[2]}")


def _stretches(*columns: pa.Array):
    """Bounds of runs of rows that are equal in all columns."""
    n = len(columns[0])
    edges = {0, n}
    for c in columns:
        codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        edges.update((codes[1:] != codes[:-1]).nonzero()[0] + 1)
    edges = sorted(int(e) for e in edges)
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


class Sheets(DataSource):
    """``df.write.format("termfold_sheets").option("path", run folder).option("columns", {class: [column]} as JSON)``"""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> SheetWriter:
        return SheetWriter(dict(self.options))
