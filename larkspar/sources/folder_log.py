"""A user-defined stream source and sink: a folder of parquet files read and written as a log.

Both keep a log of numbered manifests (see ``manifests``), so what a batch holds is fixed by file
names once and never again by listing order or time.

The source takes new files into its own log, at most ``max_files`` per batch, oldest first;
the offset is a number of that log. A file counts as new by its name, whatever its time, so late, equally old
and deleted files neither repeat nor hide others. A lost batch is read again from the same
files; if one of them has been deleted before it could be read, the batch fails. In a folder that the
sink has written, only files of committed batches are taken.

The sink lists the files of a batch in its log only on commit, so files of failed
attempts are never seen; a repeated batch replaces its manifest.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from larkspar.sources import manifests
from larkspar.sources.manifests import EVERY, ManifestLog, open_folder

#: The sink's log inside its folder.
COMMITTED = "_committed"


@dataclass
class OneFile(InputPartition):
    name: str


class FolderReader(DataSourceStreamReader):
    def __init__(self, path: str, log: str, max_files: int | None = None, every: int = EVERY):
        self.path = path
        self.log = ManifestLog(log, every)
        self.max_files = max_files

    def _candidates(self) -> list[str]:
        """Names of the files there are, oldest first."""
        system, root = open_folder(self.path)
        committed = ManifestLog(f"{self.path}/{COMMITTED}")
        if committed.last() >= 0:
            return [e["file"] for e in committed.entries()]
        infos = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        whole = [
            i for i in infos
            if i.type == fs.FileType.File and i.base_name.endswith(".parquet") and i.base_name[0] not in "._"
        ]
        return [i.base_name for i in sorted(whole, key=lambda i: (i.mtime_ns, i.base_name))]

    def initialOffset(self) -> dict:
        return {"batch": -1}

    def latestOffset(self) -> dict:
        """Write the next manifest if there are new files, and name the newest one."""
        known = {e["file"] for e in self.log.entries()}
        new = [n for n in self._candidates() if n not in known][: self.max_files]
        last = self.log.last()
        if new:
            last += 1
            self.log.add(last, [{"file": n} for n in new])
        return {"batch": last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [OneFile(e["file"]) for e in self.log.entries(start["batch"], end["batch"])]

    def read(self, partition: OneFile) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(self.path)
        with system.open_input_file(f"{root}/{partition.name}") as source:
            yield from pq.ParquetFile(source).iter_batches(batch_size=10_000)


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class FolderWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, every: int = EVERY):
        self.path = path
        self.every = every

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file per task; a task without rows writes none."""
        system, root = open_folder(self.path)
        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(root, recursive=True)
                writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=system)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        entries = [{"file": m.name, "rows": m.rows} for m in messages if m is not None and m.rows]
        ManifestLog(f"{self.path}/{COMMITTED}", self.every).add(batchId, entries)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        """Files without a manifest are ignored by readers."""


class FolderLog(DataSource):
    """Options: ``path``, ``snapshot_every``; to read ``ddl`` (the row schema), ``log`` (a folder of this query) and ``max_files``."""

    @classmethod
    def name(cls) -> str:
        return "folder_log"

    def schema(self) -> str:
        return self.options["ddl"]

    def _every(self) -> int:
        return int(self.options.get("snapshot_every", EVERY))

    def streamReader(self, schema) -> FolderReader:
        most = self.options.get("max_files")
        return FolderReader(self.options["path"], self.options["log"], int(most) if most else None, self._every())

    def streamWriter(self, schema, overwrite: bool) -> FolderWriter:
        return FolderWriter(self.options["path"], self._every())


def register(spark: SparkSession) -> None:
    """Make ``format("folder_log")`` known to the session.

    The classes travel by value: the process that plans a stream source does not
    see the files shipped to the workers.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(manifests)
    spark.dataSource.register(FolderLog)


def read_stream(
    spark: SparkSession, path: str, ddl: str, log: str, max_files: int | None = None, snapshot_every: int = EVERY
) -> DataFrame:
    """The files of a folder as a stream; ``log`` is a folder that only this query uses, kept like its checkpoint."""
    register(spark)
    reader = spark.readStream.format("folder_log").options(
        path=qualified(spark, path), ddl=ddl, log=qualified(spark, log), snapshot_every=str(snapshot_every)
    )
    return (reader.option("max_files", str(max_files)) if max_files else reader).load()


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches; only names of files come to the driver, from one snapshot and the manifests after it."""
    path = qualified(spark, path)
    names = [e["file"] for e in ManifestLog(f"{path}/{COMMITTED}").entries()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names])


def qualified(spark: SparkSession, path: str) -> str:
    """The path with a file system: a bare one is on that of ``spark.checkpoint.dir``, as the executors see it."""
    from larkspar.session import shared_root

    if "://" in path or path.startswith("file:"):
        return path
    root = shared_root(spark)
    if "://" in root:
        scheme, _, rest = root.partition("://")
        return f"{scheme}://{rest.partition('/')[0]}{path}"
    if root.startswith("file:"):
        return f"file:{path}"
    named = spark.conf.get("spark.hadoop.fs.defaultFS", "file:").rstrip("/")
    return f"{named}{path}"
