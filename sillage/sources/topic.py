"""S1 on files: a landing folder read as a topic, with offsets per partition.

A topic is a folder of partitions (``p=0``, ``p=1``, ...; files directly in it are partition
0) whose JSON-lines files only ever come to the end: a file's place among its partition's
names, in order, is its offset.  ``startingOffsets`` means what it means for a broker:

* ``earliest`` starts at the first file of every partition,
* ``latest`` behind the files that are there when the stream starts for the first time,
* a JSON object ``{"0": 3, "1": -2}`` at those offsets (-2 earliest, -1 latest; partitions
  that it doesn't name start at the first file).

A restart goes on behind the last committed batch.  The first position is kept with the
topic under the ``group`` name, so files that land between a first start that found nothing
and the next start are read.  A partition that appears later is read from its first file.
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "sillage_topic"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class FileRange(InputPartition):
    """Files ``start`` to ``end`` (excluded) of one topic partition."""

    def __init__(self, partition: int, start: int, paths: list[str]):
        super().__init__(partition)
        self.partition, self.start, self.paths = partition, start, paths


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.starting = options.get("startingoffsets", options.get("startingOffsets", "latest"))
        self.group = re.sub(r"[^A-Za-z0-9._-]", "_", options.get("group", "default"))

    def _files(self) -> dict[int, list[str]]:
        """Paths of each partition's files in offset order; hidden and growing files don't count."""
        from pyarrow import fs

        system, base = _open(self.path)
        found: dict[int, list[str]] = {}
        for info in system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
            names = info.path[len(base) :].strip("/").split("/")
            if info.type != fs.FileType.File or any(n.startswith(("_", ".")) for n in names):
                continue
            m = re.fullmatch(r"p=(\d+)", names[0]) if len(names) == 2 else None
            if m or len(names) == 1:
                found.setdefault(int(m[1]) if m else 0, []).append(info.path)
        return {p: sorted(paths) for p, paths in sorted(found.items())}

    def _ends(self) -> dict[str, int]:
        return {str(p): len(paths) for p, paths in self._files().items()}

    def _first(self) -> dict[str, int]:
        ends = self._ends()
        if self.starting == "earliest":
            return {p: 0 for p in ends}
        if self.starting == "latest":
            return ends
        asked = json.loads(self.starting)
        return {p: 0 if (n := asked.get(p, -2)) == -2 else end if n == -1 else min(n, end) for p, end in ends.items()}

    def initialOffset(self) -> dict:
        system, base = _open(self.path)
        kept = f"{base}/_groups/{self.group}.json"
        try:
            with system.open_input_stream(kept) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            pass
        first = self._first()
        system.create_dir(f"{base}/_groups", recursive=True)
        with system.open_output_stream(f"{kept}.tmp") as f:
            f.write(json.dumps(first).encode())
        system.move(f"{kept}.tmp", kept)
        return first

    def latestOffset(self) -> dict:
        return self._ends()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = self._files()
        return [FileRange(int(p), start.get(p, 0), files[int(p)][start.get(p, 0) : n]) for p, n in end.items() if n > start.get(p, 0)]

    def read(self, partition: FileRange) -> Iterator[tuple]:
        system, _ = _open(self.path)
        for k, path in enumerate(partition.paths):
            with io.BufferedReader(system.open_input_stream(path)) as f:
                for line in f:
                    yield line.decode(errors="replace").rstrip("\r\n"), partition.partition, partition.start + k

    def commit(self, end: dict) -> None:
        pass


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string, partition int, offset bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TopicReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicSource)
