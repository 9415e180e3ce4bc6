"""Named files from rows (name, value), committed in two phases.

Tasks write beside the folder, each attempt in a folder of its own. Only when all
have succeeded are the files of their attempts moved to their names: into the
folder, where other files stay as they are (append), or into a new folder that
then takes the place of the old one (overwrite), so that none is left of a run
before. If a task fails, the folder stays as it was; what tasks that were still
running then leave beside it (``.writing-``) is never read. A name in two rows
ends the write. Files go through the file systems that Arrow knows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from entrygraph.plans.shipping import ship
from entrygraph.sources.dump import opened


#: Attempts to delete what a failed write left.
TRIES = 10


@dataclass
class Written(WriterCommitMessage):
    """Where an attempt wrote, and which names."""

    where: str
    names: list[str]


class FilesWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool):
        self.root, self.overwrite = options["path"].rstrip("/"), overwrite
        self.indent = int(options["indent"]) if "indent" in options else None
        self.beside = f"{self.root}.writing-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        system, beside = opened(self.beside)
        where, names = f"{beside}/{TaskContext.get().taskAttemptId()}", []
        system.create_dir(where, recursive=True)
        for name, value in rows:
            if not name or "/" in name or name in (".", ".."):
                raise ValueError(f"no name of a file: {name!r}")
            if self.indent is not None:
                value = json.dumps(json.loads(value), ensure_ascii=False, indent=self.indent) + "\n"
            with system.open_output_stream(f"{where}/{name}") as out:
                out.write((value or "").encode("utf-8"))
            names.append(name)
        return Written(where, names)

    def commit(self, messages: list[Written | None]) -> None:
        system, beside = opened(self.beside)
        _, root = opened(self.root)
        done = [m for m in messages if m is not None]
        listed = [n for m in done for n in m.names]
        if len(set(listed)) < len(listed):
            self.abort(messages)
            twice = next(n for n in listed if listed.count(n) > 1)
            raise ValueError(f"two rows for one file: {twice}")
        into = f"{beside}/whole" if self.overwrite else root
        system.create_dir(into, recursive=True)
        for m in done:
            for n in m.names:
                system.move(f"{m.where}/{n}", f"{into}/{n}")
        if self.overwrite:
            old = f"{beside}/old"
            if system.get_file_info(root).type == fs.FileType.Directory:
                system.move(root, old)
            system.move(into, root)
        system.delete_dir(beside)

    def abort(self, messages) -> None:
        system, beside = opened(self.beside)
        for _ in range(TRIES):
            try:
                if system.get_file_info(beside).type == fs.FileType.Directory:
                    system.delete_dir(beside)
                return
            except OSError:  # a task that still runs wrote into it meanwhile
                time.sleep(0.2)


class NamedFiles(DataSource):
    """Writes to ``path``; option indent: values are JSON and laid out with it."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, value string"

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        return FilesWriter(self.options, overwrite)


def named_files(df: DataFrame, path: str, mode: str = "overwrite", indent: int | None = None) -> None:
    """Write ``df`` (name, value): the folder anew (overwrite), or these files only (append)."""
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(NamedFiles)
    out = df.select("name", "value").write.format("named_files").mode(mode)
    (out if indent is None else out.option("indent", str(indent))).save(path)
