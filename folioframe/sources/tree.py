"""A tree of named files as a sink: each row (path, text) becomes one file, all of them or none.

    spark.dataSource.register(TreeSink)
    files.write.format("folio_tree").mode("append").save(folder)

Tasks write below a staging folder of their own attempt, in the folder's file system, which driver and executors share.
What the successful attempts wrote moves to its place when all are done; a failed job leaves nothing. Files of the same
path are replaced, others stay. Two rows of one path, an empty path or one that leads out of the folder fail the job.
"""

from __future__ import annotations

import posixpath
import re
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import dataclass

import pyarrow.fs as fs
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

MOVES_AT_ONCE = 16
CLEARINGS, PAUSE = 20, 0.25


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder in it."""
    if ":/" not in folder:
        return fs.LocalFileSystem(), posixpath.abspath(folder)
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


@dataclass
class Written(WriterCommitMessage):
    """The files of one attempt: where they are staged, and their paths."""

    stage: str
    paths: list[str]


def checked(path: str | None) -> str:
    clean = posixpath.normpath(path or "")
    if not path or clean != path or path.startswith(("/", "..")) or clean == ".":
        raise ValueError(f"no path of a file within the tree: {path!r}")
    return path


class TreeWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.staging = folder, f"_staging-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Written:
        system, root = opened(self.folder)
        stage, paths, made = f"{root}/{self.staging}/{uuid.uuid4().hex}", [], set()
        system.create_dir(stage, recursive=True)
        for row in rows:
            path = checked(row["path"])
            if system.get_file_info(stage).type == fs.FileType.NotFound:
                raise RuntimeError("the job was aborted")
            folder = posixpath.dirname(f"{stage}/{path}")
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            with system.open_output_stream(f"{stage}/{path}") as out:
                out.write((row["text"] or "").encode())
            paths.append(path)
        return Written(stage, paths)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = opened(self.folder)
        moves = [(m.stage, p) for m in messages if m for p in m.paths]
        try:
            if len({p for _, p in moves}) < len(moves):
                seen: set[str] = set()
                raise ValueError(f"more than one row for {next(p for _, p in moves if p in seen or seen.add(p))}")
            for folder in {posixpath.dirname(f"{root}/{p}") for _, p in moves}:
                system.create_dir(folder, recursive=True)
            with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
                list(pool.map(lambda m: system.move(f"{m[0]}/{m[1]}", f"{root}/{m[1]}"), moves))
        finally:
            self._clear(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*opened(self.folder))

    def _clear(self, system: fs.FileSystem, root: str) -> None:
        """Removes what is staged; again where a task that is being stopped still wrote meanwhile."""
        there = lambda: system.get_file_info(f"{root}/{self.staging}").type != fs.FileType.NotFound
        for _ in range(CLEARINGS):
            if there():
                with suppress(OSError):
                    system.delete_dir(f"{root}/{self.staging}")
            time.sleep(PAUSE)
            if not there():
                return


class TreeSink(DataSource):
    """The format ``folio_tree``."""

    @classmethod
    def name(cls) -> str:
        return "folio_tree"

    def writer(self, schema: StructType, overwrite: bool) -> TreeWriter:
        if not {"path", "text"} <= set(schema.fieldNames()):
            raise ValueError("a tree is written from rows of path and text")
        return TreeWriter(self.options["path"])


def write_tree(files: DataFrame, folder: str) -> None:
    """Writes the rows (path, text) as files below ``folder``."""
    system, root = opened(folder)
    system.create_dir(root, recursive=True)
    folder = folder if ":/" in folder else root
    files.sparkSession.dataSource.register(TreeSink)
    files.select("path", "text").write.format("folio_tree").mode("append").save(folder)
