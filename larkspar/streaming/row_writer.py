"""Row-at-a-time stream writer with open, process and close."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from larkspar.sources.folder_log import qualified
from larkspar.sources.manifests import open_folder


class LineWriter:
    """Writes every row as a JSON line to one file per partition and batch.

    Rows go to a hidden file that takes its name when the partition has ended well, so a
    failed attempt leaves nothing to be read and a repeated one replaces the file.
    """

    def __init__(self, path: str):
        self.path = path

    @classmethod
    def into(cls, spark: SparkSession, path: str) -> LineWriter:
        """A writer on the file system that the executors share."""
        return cls(qualified(spark, path))

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.system, self.root = open_folder(self.path)
        self.system.create_dir(self.root, recursive=True)
        self.name = f"part-{epoch_id:05d}-{partition_id:05d}.json"
        self.hidden = f"{self.root}/.{self.name}.{uuid.uuid4().hex}"
        self.out = self.system.open_output_stream(self.hidden)
        return True

    def process(self, row) -> None:
        self.out.write((json.dumps(row.asDict(recursive=True), default=str) + "\n").encode())

    def close(self, error) -> None:
        self.out.close()
        if error is None:
            self.system.move(self.hidden, f"{self.root}/{self.name}")
        else:
            self.system.delete_file(self.hidden)
