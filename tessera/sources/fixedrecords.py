"""The data source ``fixed_records``: files of fixed-length binary records after a header, read in byte
ranges that end at record bounds, so one large file is many input partitions and a task holds a few
megabytes of it.  Files are opened through Arrow's file systems."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of an input partition, and of what is read at once.
SPLIT_BYTES, READ_BYTES = 32 << 20, 1 << 20


@dataclass
class RecordRange(InputPartition):
    """Records first..last - 1 of one file."""

    path: str
    first: int
    last: int

    def __post_init__(self):
        super().__init__(None)


class _RecordReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.record, self.header = int(options["recordBytes"]), int(options["headerBytes"])
        self.trailer, self.magic = int(options.get("trailerBytes", 0)), int(options["magic"])
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        if self.record < 1 or self.header < 4:
            raise ValueError("records need a byte, headers the four of the magic number")

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root)

    def partitions(self) -> list[RecordRange]:
        from pyarrow import fs

        files, path = self._files()
        info = files.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(path, recursive=True))
        step, out = max(1, self.split // self.record), []
        for f in sorted(found, key=lambda x: x.path):
            if f.type != fs.FileType.File or f.base_name[0] in "._":
                continue
            count, rest = divmod(f.size - self.header - self.trailer, self.record)
            if count < 0 or rest:
                raise ValueError(f"truncated record at the end of {f.path}")
            # a file without a record is opened too: its magic number counts
            out += [RecordRange(f.path, s, min(s + step, count)) for s in range(0, max(count, 1), step)]
        return out or [RecordRange("", 0, 0)]

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, _ = self._files()
        with files.open_input_file(partition.path) as f:
            if partition.first == 0:
                magic = int.from_bytes(f.read_at(4, 0), "big", signed=True)
                if magic != self.magic:
                    raise ValueError(f"invalid magic number {magic} in {partition.path}")
            step = max(1, READ_BYTES // self.record)
            for s in range(partition.first, partition.last, step):
                n = min(step, partition.last - s)
                body = f.read_at(n * self.record, self.header + s * self.record)
                if len(body) != n * self.record:
                    raise ValueError(f"truncated record at the end of {partition.path}")
                pixels = np.frombuffer(body, np.uint8).astype(np.float64) / 255.0
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * self.record)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.path] * n), pa.array(np.arange(s, s + n)), pa.ListArray.from_arrays(ends, pa.array(pixels))],
                    names=["path", "record", "pixels"],
                )


class FixedRecordSource(DataSource):
    """Format ``fixed_records``; options: path, recordBytes, headerBytes, magic, trailerBytes, splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "fixed_records"

    def schema(self) -> str:
        return "path string, record long, pixels array<double>"

    def reader(self, schema) -> DataSourceReader:
        return _RecordReader(self.options)
