"""A hash table as a data source for streams: each partition writes on its own, a batch commits as one.

``df.writeStream.format("clicklens_hash").option("path", ...)`` takes rows of
(hash_key, field, value). Every task opens a file of its own, writes its rows as
JSON lines and tells the driver its name. When all tasks of a batch are done the
driver commits: it writes the batch's list of files in one step. A batch that
fails is aborted and its files deleted; a batch that runs again replaces its own
list, so nothing counts twice, and files on no list are never read.

``read_hash`` gives the latest value of each field. Paths may be of any file
system that Arrow opens.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamWriter, InputPartition,
                                    WriterCommitMessage)

NAME = "clicklens_hash"
SCHEMA = "hash_key string, field string, value string, batch_id long"
LINES_AT_ONCE = 1000


def _opened(path: str):
    """(file system, path in it)."""
    from pyarrow import fs
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class HashWriter(DataSourceStreamWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator) -> Written:
        system, root = _opened(self.path)
        system.create_dir(f"{root}/data", recursive=True)
        name, rows, lines = f"{uuid.uuid4().hex}.json", 0, []
        with system.open_output_stream(f"{root}/data/{name}") as out:
            for row in iterator:
                lines.append(json.dumps([row["hash_key"], row["field"], row["value"]]))
                rows += 1
                if len(lines) >= LINES_AT_ONCE:
                    out.write(("\n".join(lines) + "\n").encode())
                    lines.clear()
            out.write("".join(x + "\n" for x in lines).encode())
        return Written(name, rows)

    def commit(self, messages, batchId: int) -> None:
        system, root = _opened(self.path)
        system.create_dir(f"{root}/commits", recursive=True)
        part = f"{root}/commits/.{batchId}-{uuid.uuid4().hex}"
        with system.open_output_stream(part) as out:
            out.write(json.dumps([[m.file, m.rows] for m in messages if m is not None]).encode())
        system.move(part, f"{root}/commits/{batchId:012d}.json")

    def abort(self, messages, batchId: int) -> None:
        system, root = _opened(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{root}/data/{m.file}")


@dataclass
class CommittedFile(InputPartition):
    file: str
    batch_id: int


class HashReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def partitions(self) -> list[CommittedFile]:
        from pyarrow import fs
        system, root = _opened(self.path)
        found = []
        for info in system.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True)):
            if info.base_name.endswith(".json"):
                with system.open_input_stream(info.path) as f:
                    found += [CommittedFile(name, int(info.base_name[:-5])) for name, rows in json.loads(f.read()) if rows]
        return found or [CommittedFile("", -1)]

    def read(self, partition: CommittedFile):
        if not partition.file:
            return
        system, root = _opened(self.path)
        with system.open_input_stream(f"{root}/data/{partition.file}") as f:
            rest = b""
            while block := f.read(1 << 20):
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    yield (*json.loads(line), partition.batch_id)


class HashSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HashReader:
        return HashReader(self.options["path"])

    def streamWriter(self, schema, overwrite: bool) -> HashWriter:
        return HashWriter(self.options["path"])


def use_hash_source(spark: SparkSession) -> None:
    spark.dataSource.register(HashSource)


def read_hash(spark: SparkSession, path: str) -> DataFrame:
    """(hash_key, field, value): each field's value in the last batch that wrote it."""
    use_hash_source(spark)
    rows = spark.read.format(NAME).option("path", path).load()
    return rows.groupBy("hash_key", "field").agg(F.max_by("value", "batch_id").alias("value"))
