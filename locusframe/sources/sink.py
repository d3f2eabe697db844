"""Delimited text files of given names, committed as a whole: ``df.write.format("named_files")``.

A task streams its rows, which come ordered by group, into files of a staging folder of its
own attempt, one open file at a time; the driver moves them to their names once all tasks are
done and removes the staging folder. A task that fails, is killed or runs twice leaves
nothing under a final name, and neither does a failed job.

Options: ``path`` (root), ``name`` (a path below root with the group's values in braces),
``by`` (the group's columns, as JSON; they are not written), ``header`` (whether files begin
with one), ``manifest`` (a file that gets one JSON line for each file: values, path, rows).
With ``parts`` a task's rows are one file ``<name>/part-<number>`` instead.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import IO

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .shared import store


def _text(pdf: pd.DataFrame, header: bool) -> bytes:
    return pdf.to_csv(sep="\t", index=False, header=header).encode()


class _File:
    """One file of a staging folder; ``.gz`` is compressed, with the same bytes for the same rows."""

    def __init__(self, system: fs.FileSystem, at: str, packed: bool) -> None:
        self.raw = system.open_output_stream(at, compression=None)
        self.out: IO = gzip.GzipFile("", "wb", 6, self.raw, mtime=0) if packed else self.raw
        self.rows = 0

    def close(self) -> None:
        if self.out is not self.raw:
            self.out.close()
        self.raw.close()


@dataclass
class Files(WriterCommitMessage):
    """(values, staged path, final path below root, rows) of a task's files."""

    made: list[tuple[dict, str, str, int]] = field(default_factory=list)


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.root, self.name = options["path"].rstrip("/"), options["name"]
        self.by: list[str] = json.loads(options.get("by", "[]"))
        self.header, self.parts = options.get("header", "true") == "true", options.get("parts", "false") == "true"
        self.manifest = options.get("manifest")
        self.columns = [f.name for f in schema.fields if f.name not in self.by]
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        task = TaskContext.get()
        system, root = store(self.root)
        own = f"{root}/{self.staging}/{task.partitionId()}-{task.taskAttemptId()}"
        system.create_dir(own, recursive=True)
        done, now, out = Files(), None, None
        for batch in iterator:
            pdf = batch.to_pandas(integer_object_nulls=True)
            groups = pdf.groupby(self.by, sort=False, dropna=False) if self.by else [((), pdf)]
            for key, rows in groups:
                values = {c: None if pd.isna(v) else v for c, v in zip(self.by, key, strict=True)}
                if out is None or values != now:
                    if out is not None:
                        out.close()
                        done.made[-1] = (*done.made[-1][:3], out.rows)
                    now = values
                    final = f"{self.name}/part-{task.partitionId():06d}" if self.parts else self.name.format(**values)
                    staged = f"{own}/{len(done.made)}"
                    done.made.append((values, staged, final, 0))
                    out = _File(system, staged, self.name.endswith(".gz"))
                    if self.header:
                        out.out.write(_text(rows[self.columns].iloc[:0], True))
                out.out.write(_text(rows[self.columns], False))
                out.rows += len(rows)
        if out is not None:
            out.close()
            done.made[-1] = (*done.made[-1][:3], out.rows)
        return done

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        made = sorted((x for m in messages if isinstance(m, Files) for x in m.made), key=lambda x: x[2])
        system, root = store(self.root)
        for folder in sorted({f"{root}/{final}".rpartition("/")[0] for _, _, final, _ in made}):
            system.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda x: system.move(x[1], f"{root}/{x[2]}"), made))
        if self.manifest:
            other, at = store(self.manifest)
            with other.open_output_stream(at, compression=None) as f:
                for values, _, final, rows in made:
                    f.write(json.dumps({**values, "file_path": f"{self.root}/{final}", "rows": rows}).encode() + b"\n")
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, root = store(self.root)
        if system.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.staging}")


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(dict(self.options), schema)


def joined(paths: list[str], target: str, header: bytes) -> int:
    """Put files under one another, as bytes, behind a header; compressed ones are members of one gzip file."""
    system, at = store(target)
    system.create_dir(at.rpartition("/")[0] or ".", recursive=True)
    staged, size = f"{at}.{uuid.uuid4().hex}", 0
    with system.open_output_stream(staged, compression=None) as out:
        out.write(gzip.compress(header, mtime=0) if target.endswith(".gz") else header)
        for path in paths:
            other, there = store(path)
            with other.open_input_stream(there, compression=None) as part:
                while data := part.read(1 << 20):
                    out.write(data)
                    size += len(data)
    if system.get_file_info(at).type == fs.FileType.Directory:
        system.delete_dir(at)
    system.move(staged, at)
    return size
