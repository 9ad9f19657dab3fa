"""Files of their own names as a sink: a Python data source with two-phase commit.

A task writes its files into an attempt folder below the job's hidden staging folder and sends
the attempt's name as its commit message.  When all tasks are done the driver deletes the
attempts that nobody committed (of lost executors, failed tasks and speculative twins) and
renames the staging folder once: readers see all files of a job or none.  An aborted job leaves
nothing.  Spark's readers skip names that begin with an underscore, so what is staged is never
read.

    folder/_job-<id>/<attempt>/<name>   while the job runs
    folder/job-<id>/<attempt>/<name>    after its commit

The store is what pyarrow.fs opens for the folder's URI: a mounted path, file, hdfs, s3, gs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "colloquy_files"


def store(folder: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


@dataclass
class Attempt(WriterCommitMessage):
    name: str
    files: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, replace: bool, build: Callable | None = None):
        self.folder, self.replace, self.build, self.job = folder.rstrip("/"), replace, build, uuid.uuid4().hex

    def write(self, iterator) -> Attempt:
        fs, base = store(self.folder)
        attempt, made, n = uuid.uuid4().hex, set(), 0
        for batch in self.build(iterator) if self.build else iterator:
            for name, content in zip(batch.column("name"), batch.column("content")):
                name = name.as_py()
                if not name or name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"{name!r} is no file name below the folder")
                path = f"{base}/_job-{self.job}/{attempt}/{name}"
                parent = path.rpartition("/")[0]
                if parent not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                with fs.open_output_stream(path) as out:
                    out.write(content.as_buffer() if content.is_valid else b"")
                n += 1
        return Attempt(attempt, n)

    def _attempts(self, fs, top: str) -> list[str]:
        from pyarrow.fs import FileSelector

        return [x.base_name for x in fs.get_file_info(FileSelector(top, allow_not_found=True))]

    def commit(self, messages) -> None:
        from pyarrow.fs import FileSelector

        fs, base = store(self.folder)
        kept = {m.name for m in messages if m is not None}
        staged, done = f"{base}/_job-{self.job}", f"{base}/job-{self.job}"
        old = [x.path for x in fs.get_file_info(FileSelector(base, allow_not_found=True)) if x.base_name.startswith("job-")] if self.replace else []
        fs.create_dir(staged, recursive=True)
        self._sweep(fs, staged, kept)
        fs.move(staged, done)
        self._sweep(fs, done, kept)  # of a twin that was still writing
        for path in old:
            fs.delete_dir(path)

    def _sweep(self, fs, top: str, kept: set[str]) -> None:
        for name in self._attempts(fs, top):
            if name not in kept:
                fs.delete_dir(f"{top}/{name}")

    def abort(self, messages) -> None:
        fs, base = store(self.folder)
        if self._attempts(fs, f"{base}/_job-{self.job}"):
            fs.delete_dir(f"{base}/_job-{self.job}")


def write_files(rows: DataFrame, folder: str, replace: bool = False, build: Callable | None = None) -> None:
    """rows(name, content) as files below the folder; replace: the files of earlier jobs go once the new ones are there.

    build maps an iterator of Arrow batches of rows to one of (name, content), in the worker that writes.
    """
    ddl = rows.schema.simpleString()

    class Files(DataSource):  # made here, so that build goes to the tasks with it
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> str:
            return ddl

        def writer(self, schema, overwrite: bool) -> _Writer:
            return _Writer(self.options["path"], overwrite, build)

    rows.sparkSession.dataSource.register(Files)
    rows.write.format(FORMAT).mode("overwrite" if replace else "append").option("path", folder).save()


def read_files(spark: SparkSession, folder: str, names: str = "*") -> DataFrame:
    """path, length and content of all committed files; content is read only if it is asked for."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(folder).select("path", "length", "content")
