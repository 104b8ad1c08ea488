"""A stream source of log files: what a folder holds, in manifests.

Every look at the folder writes one Parquet file with what is new since the last: files, whatever their names and
times, logs that have grown, and folders that cannot be listed. An offset is the number of the last manifest, so a
restarted query reads exactly what it read before. Tasks read the manifests; the driver hands out their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources.files import name_pattern
from ..sources.storage import list_folder, resolve

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ``seen`` is the length up to which a log was there before; ``problem`` is NULL for a file.
FOLDER_SCHEMA = "path string, length bigint, seen bigint, problem string"
_ARROW = pa.schema([("path", pa.string()), ("length", pa.int64()), ("seen", pa.int64()), ("problem", pa.string())])


class Slice(InputPartition):
    """Some rows of one manifest."""

    def __init__(self, manifest: str, first: int, stop: int):
        self.manifest, self.first, self.stop = manifest, first, stop


class LogFolder(DataSource):
    """Options: path, manifests (a folder that outlives the query), glob, files_per_task."""

    @classmethod
    def name(cls) -> str:
        return "logfolder"

    def schema(self) -> str:
        return FOLDER_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogFolderReader(dict(self.options))


class LogFolderReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.manifests = options["path"], options["manifests"].rstrip("/")
        self.glob, self.files_per_task = options.get("glob"), int(options.get("files_per_task", 1000))
        self.known: dict[str, int | str] | None = None  # length of each file, problem of each folder
        self.count = 0

    def initialOffset(self) -> dict:
        return {"manifest": 0}

    def latestOffset(self) -> dict:
        if self.known is None:
            self._recover()
        new = list(self._new())
        if new:
            self._write(self.count + 1, new)
            self.count += 1
            self._learn(new)
        return {"manifest": self.count}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        import pyarrow.parquet as pq

        slices = []
        for number in range(start["manifest"] + 1, end["manifest"] + 1):
            path = self._path(number)
            system, location = resolve(path)
            with system.open_input_file(location) as file:
                rows = pq.ParquetFile(file).metadata.num_rows
            slices += [Slice(path, at, min(at + self.files_per_task, rows)) for at in range(0, rows, self.files_per_task)]
        return slices

    def read(self, partition: Slice) -> Iterator[tuple]:
        for row in _rows(partition.manifest)[partition.first : partition.stop]:
            yield tuple(row[name] for name in _ARROW.names)

    def commit(self, end: dict) -> None:
        """Manifests stay: they are what was seen."""

    # -- the folder ------------------------------------------------------------------------------

    def _path(self, number: int) -> str:
        return f"{self.manifests}/{number:09d}.parquet"

    def _recover(self) -> None:
        self.known = {}
        try:
            names = sorted(path for path, kind, _, _ in list_folder(self.manifests) if kind == "file" and path.endswith(".parquet"))
        except FileNotFoundError:
            names = []
        for path in names:
            self._learn(_rows(path))
            self.count = int(path.rpartition("/")[2].removesuffix(".parquet"))

    def _learn(self, rows: list[dict]) -> None:
        for row in rows:
            self.known[row["path"]] = row["length"] if row["problem"] is None else row["problem"]

    def _new(self) -> Iterator[dict]:
        matches, open_ = name_pattern(self.glob), [self.folder]
        while open_:
            folder = open_.pop()
            try:
                for path, kind, length, _ in list_folder(folder):
                    if kind == "folder":
                        open_.append(path)
                    elif kind == "link":
                        yield from self._trouble(path, "a link to a folder is not followed")
                    elif matches.match(path.rpartition("/")[2]):
                        seen = self.known.get(path)
                        if not isinstance(seen, int) or length > seen:
                            yield {"path": path, "length": length, "seen": seen if isinstance(seen, int) else 0, "problem": None}
            except OSError as problem:
                yield from self._trouble(folder, str(problem))

    def _trouble(self, path: str, problem: str) -> Iterator[dict]:
        if self.known.get(path) != problem:  # reported once
            yield {"path": path, "length": None, "seen": None, "problem": problem}

    def _write(self, number: int, rows: list[dict]) -> None:
        import pyarrow.parquet as pq

        path = self._path(number)
        system, location = resolve(path)
        system.create_dir(location.rpartition("/")[0], recursive=True)
        with system.open_output_stream(f"{location}.writing") as out:
            pq.write_table(pa.Table.from_pylist(rows, schema=_ARROW), out)
        system.move(f"{location}.writing", location)  # a manifest is there as a whole or not


def _rows(path: str) -> list[dict]:
    import pyarrow.parquet as pq

    system, location = resolve(path)
    with system.open_input_file(location) as file:
        return pq.read_table(file).to_pylist()
