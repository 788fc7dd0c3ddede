"""Arrow IPC (feather) files as a Spark data source.

``spark.dataSource.register(ArrowIpcDataSource)`` and then ``spark.read.format("arrow_ipc").load(path)``. A file is
split at its record batches, so one large file is read by several tasks, and batches cross to the JVM as Arrow.
"""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

BATCHES_PER_TASK = 16
SUFFIXES = (".arrow", ".feather", ".ipc")


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def _data_files(path: str):
    from pyarrow import fs

    filesystem, root = _filesystem(path)
    info = filesystem.get_file_info(root)
    if info.type == fs.FileType.File:
        return filesystem, [root]
    found = filesystem.get_file_info(fs.FileSelector(root, recursive=True))
    return filesystem, sorted(f.path for f in found if f.is_file and f.path.endswith(SUFFIXES))


class BatchRange(InputPartition):
    """Some consecutive record batches of one file."""

    def __init__(self, file: str, first: int, last: int):
        self.file, self.first, self.last = file, first, last


class ArrowIpcReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        import pyarrow as pa

        filesystem, files = _data_files(self.path)
        ranges = []
        for file in files:
            with filesystem.open_input_file(file) as source:
                batches = pa.ipc.open_file(source).num_record_batches
            for first in range(0, batches, BATCHES_PER_TASK):
                ranges.append(BatchRange(file, first, min(first + BATCHES_PER_TASK, batches)))
        return ranges

    def read(self, partition):
        import pyarrow as pa

        filesystem, _ = _filesystem(self.path)
        with filesystem.open_input_file(partition.file) as source:
            reader = pa.ipc.open_file(source)
            for index in range(partition.first, partition.last):
                yield reader.get_batch(index)


class ArrowIpcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def schema(self):
        import pyarrow as pa

        filesystem, files = _data_files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no Arrow file below {self.options['path']}")
        with filesystem.open_input_file(files[0]) as source:
            return from_arrow_schema(pa.ipc.open_file(source).schema)

    def reader(self, schema) -> DataSourceReader:
        return ArrowIpcReader(self.options["path"])
