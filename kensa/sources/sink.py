"""A file-tree sink: one file per row, all of them or none.

``FileTree`` is a Spark Python data source.  Each task writes its rows as files into
an own folder of a hidden staging area; only when all tasks have ended does
the driver move the folders of the attempts that count into place, one rename per
task.  A failed job removes the staging area, so no file of a failed or repeated
attempt is ever seen, and readers skip the staging area meanwhile (its name starts with
an underscore).

Files land at ``<root>/part=<task>/<key>``.  A folder named ``name=value`` is no part of
a key (``files.relative_key``), so keys come back as they were written.

Paths are opened with pyarrow (local and shared folders, and the stores it knows); on
stores without renames the move is not atomic.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from kensa.session import ship_package

FORMAT = "kensa_files"
STAGING = "_staging-"
PART = "part="


def filesystem(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


@dataclass
class FilesWritten(WriterCommitMessage):
    folder: str
    files: int


class FileTreeWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staging = f"{self.path}/{STAGING}{uuid.uuid4().hex}"
        fs, staging = filesystem(self.staging)
        fs.create_dir(staging, recursive=True)

    def write(self, iterator: Iterator) -> FilesWritten:
        fs, staging = filesystem(self.staging)
        folder = f"{PART}{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
        # Not recursive: once the job has been aborted and the area is gone, a task that
        # still runs fails here instead of making it anew.
        fs.create_dir(f"{staging}/{folder}", recursive=False)
        made, seen = {f"{staging}/{folder}"}, set()
        for row in iterator:
            key, content = row["key"], row["content"]
            steps = (key or "").split("/")
            if content is None or not all(steps) or set(steps) & {".", ".."} or any("=" in s for s in steps[:-1]) or any(s[0] in "_." for s in steps):
                raise ValueError(f"no file can be written for key {key!r}")
            if key in seen:
                raise ValueError(f"key {key!r} occurs twice")
            seen.add(key)
            parent = f"{staging}/{folder}"
            for step in steps[:-1]:
                parent = f"{parent}/{step}"
                if parent not in made:
                    fs.create_dir(parent, recursive=False)
                    made.add(parent)
            with fs.open_output_stream(f"{parent}/{steps[-1]}") as f:
                f.write(bytes(content))
        return FilesWritten(folder, len(seen))

    def commit(self, messages: list) -> None:
        fs, root = filesystem(self.path)
        staging = filesystem(self.staging)[1]
        fs.create_dir(root, recursive=True)
        from pyarrow.fs import FileSelector, FileType
        old = [f.path for f in fs.get_file_info(FileSelector(root)) if f.type == FileType.Directory and f.base_name.startswith(PART)] if self.overwrite else []
        for m in messages:
            if m is not None and m.files:
                fs.move(f"{staging}/{m.folder}", f"{root}/{m.folder}")
        for path in old:
            fs.delete_dir(path)
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow.fs import FileType
        fs, staging = filesystem(self.staging)
        for attempt in range(20):                # a task that is just being stopped may still add a file
            try:
                if fs.get_file_info(staging).type == FileType.Directory:
                    fs.delete_dir(staging)
                return
            except OSError:
                if attempt == 19:
                    raise
                time.sleep(0.2)


class FileTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "key string, content binary"

    def writer(self, schema, overwrite: bool) -> FileTreeWriter:
        return FileTreeWriter(self.options["path"], overwrite)


def write_files(df: DataFrame, path: str, key: str = "key", content: str = "content", overwrite: bool = False) -> None:
    """One file per row below ``path``, named by its relative key.

    The keys must be unique, without ``..``, hidden names or ``name=value`` folders, and content
    not null, else nothing is written.  ``overwrite`` replaces what earlier calls wrote;
    without it files are added.
    """
    spark: SparkSession = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(FileTree)
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(content).cast("binary").alias("content"))
    rows.write.format(FORMAT).mode("overwrite" if overwrite else "append").save(path)
