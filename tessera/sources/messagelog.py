"""A message log in files and the data source ``message_log`` that reads it by offset.

The log holds ``topic=<t>/partition=<p>/base=<b>/`` folders, each with the messages whose offsets are in
``[b, b + rows)``.  So the folder names are the index: a read of an offset range plans one input
partition a segment that the range touches (a stream: small neighbours together), without opening other
segments; only the end of the
log (the last offset of each topic partition) comes from the statistics in the footers of the last
segments.  Files are opened through Arrow's file systems, so the log may lie wherever driver and
executors reach it (a shared folder, an object store).

Batch: ranges of offsets for each topic (for all or some of its partitions), inclusive, -1 meaning to the
end.  Stream: the offset of a micro-batch is the next offset of each topic partition, kept in the
checkpoint of the query, so a stopped query goes on where it stood."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Offsets of a segment, and of the segments that one task of a stream reads.
SEGMENT_ROWS = 1 << 16

SCHEMA = "topic string, partition int, offset long, value string, range_idx int"
_ARROW = pa.schema(
    [("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string()), ("range_idx", pa.int32())]
)
_SEGMENT = re.compile(r"topic=([^/]*)/partition=(\d+)/base=(\d+)/([^/_.][^/]*\.parquet)$")

Ranges = Mapping[str, Sequence[tuple[int, int]] | Mapping[int, Sequence[tuple[int, int]]]]


def write_log(messages: DataFrame, path: str, rows: int = SEGMENT_ROWS) -> None:
    """Append messages (topic, partition, offset, value) to the log at ``path``; topic, partition and
    offset must be given.  A task writes one segment, however many messages a topic has."""
    m = messages.select(
        F.coalesce("topic", F.raise_error(F.lit("a message needs a topic")).cast("string")).alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        (F.floor(F.col("offset") / rows) * rows).cast("long").alias("base"),
        F.col("offset").cast("long").alias("offset"),
        F.col("value").cast("string").alias("value"),
    )
    dealt = m.repartition("topic", "partition", "base").sortWithinPartitions("topic", "partition", "base", "offset")
    dealt.write.mode("append").partitionBy("topic", "partition", "base").parquet(path)


@dataclass
class Slice(InputPartition):
    """Offsets first..last (inclusive) of one segment or of several in a row."""

    root: str
    topic: str
    number: int
    files: list[str]
    first: int
    last: int
    range_idx: int

    def __post_init__(self):
        super().__init__(None)


class MessageLog:
    """The segments of the log at ``root``."""

    def __init__(self, root: str):
        from pyarrow import fs

        self.root = root
        self.files, folder = fs.FileSystem.from_uri(root)
        found = self.files.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        parts: dict[tuple[str, int], dict[int, list[str]]] = defaultdict(lambda: defaultdict(list))
        for info in found:
            m = _SEGMENT.search(info.path)
            if m and info.type == fs.FileType.File:
                parts[unquote(m[1]), int(m[2])][int(m[3])].append(info.path)
        #: topic and partition to its segments (first offset, files) in order
        self.segments = {k: sorted((b, sorted(f)) for b, f in v.items()) for k, v in sorted(parts.items())}

    def end(self, key: tuple[str, int]) -> int:
        """The offset after the last message."""
        import pyarrow.parquet as pq

        last = -1
        for path in self.segments[key][-1][1]:
            meta = pq.read_metadata(path, filesystem=self.files)
            at = meta.schema.to_arrow_schema().get_field_index("offset")
            last = max([last, *(meta.row_group(k).column(at).statistics.max for k in range(meta.num_row_groups))])
        return last + 1

    def slices(self, key: tuple[str, int], first: int, last: int, range_idx: int = 0, span: int = 0) -> Iterator[Slice]:
        """The segments that hold offsets of first..last, one slice for each; neighbours are one slice as
        long as they have at most ``span`` offsets."""
        segments = self.segments.get(key, [])
        open_: Slice | None = None
        for k, (base, paths) in enumerate(segments):
            top = min(last, segments[k + 1][0] - 1) if k + 1 < len(segments) else last
            if max(base, first) > top:
                continue
            if open_ is not None and top - open_.first < span:
                open_.files, open_.last = [*open_.files, *paths], top
                continue
            if open_ is not None:
                yield open_
            open_ = Slice(self.root, key[0], key[1], list(paths), max(base, first), top, range_idx)
        if open_ is not None:
            yield open_


def _read(part: Slice) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    from pyarrow import fs

    files, _ = fs.FileSystem.from_uri(part.root)
    for path in part.files:
        with files.open_input_file(path) as f:
            source = pq.ParquetFile(f)
            at = source.schema_arrow.get_field_index("offset")
            groups = []
            for k in range(source.num_row_groups):
                s = source.metadata.row_group(k).column(at).statistics
                if s is None or (s.min <= part.last and s.max >= part.first):
                    groups.append(k)
            for batch in source.iter_batches(batch_size=10_000, row_groups=groups, columns=["offset", "value"]):
                inside = pc.and_(pc.greater_equal(batch["offset"], part.first), pc.less_equal(batch["offset"], part.last))
                b = batch.filter(inside)
                n = b.num_rows
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.topic] * n), pa.array([part.number] * n, pa.int32()), b["offset"], b["value"].cast(pa.string()), pa.array([part.range_idx] * n, pa.int32())],
                        schema=_ARROW,
                    )


class _RangeReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.ranges = options["path"], json.loads(options.get("ranges", "null"))

    def partitions(self) -> list[Slice]:
        log = MessageLog(self.root)
        wanted = self.ranges if self.ranges is not None else {t: [[0, -1]] for t, _ in log.segments}
        out, idx = [], 0
        for topic, spec in wanted.items():
            keys = [k for k in log.segments if k[0] == topic]
            # a list holds for every partition of the topic
            by_range = [(r, keys) for r in spec] if isinstance(spec, list) else [(r, [(topic, int(p))]) for p, rs in spec.items() for r in rs]
            for (first, last), on in by_range:
                if first < 0 or last < -1:
                    raise ValueError(f"offset range {first}..{last} of {topic}: offsets are 0 or more, or -1 for the end")
                for key in on:
                    if key in log.segments:
                        out += log.slices(key, first, log.end(key) - 1 if last == -1 else last, idx)
                idx += 1
        # a read without a segment still needs a partition
        return out or [Slice(self.root, "", 0, [], 0, -1, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class _LogStream(DataSourceStreamReader):
    def __init__(self, options):
        self.root = options["path"]
        self.topics = [t for t in options.get("topics", "").split(",") if t]

    def _ends(self) -> dict[str, dict[str, int]]:
        log = MessageLog(self.root)
        out: dict[str, dict[str, int]] = {}
        for topic, number in log.segments:
            if not self.topics or topic in self.topics:
                out.setdefault(topic, {})[str(number)] = log.end((topic, number))
        return out

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self._ends()

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        log = MessageLog(self.root)
        out = []
        for topic, parts in end.items():
            for number, upto in parts.items():
                # a whole log of small segments is read here: no task for each
                out += log.slices((topic, int(number)), start.get(topic, {}).get(number, 0), upto - 1, span=SEGMENT_ROWS)
        return out or [Slice(self.root, "", 0, [], 0, -1, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class MessageLogSource(DataSource):
    """Format ``message_log``; options: path, and ``ranges`` (JSON) for a batch or ``topics`` (a list
    with commas, all if not given) for a stream."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _RangeReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _LogStream(self.options)


def read_log(spark: SparkSession, path: str, ranges: Ranges | None = None) -> DataFrame:
    """Messages of the given offset ranges (all, if none are given), with the number of the range in
    the order listed: topic, partition, offset, value, range_idx.  Ranges may overlap; offsets that
    are not in the log give no row."""
    spark.dataSource.register(MessageLogSource)
    r = spark.read.format("message_log").option("path", path)
    if ranges is not None:
        r = r.option("ranges", json.dumps({t: {str(p): list(x) for p, x in s.items()} if isinstance(s, Mapping) else list(s) for t, s in ranges.items()}))
    return r.load()


def stream_log(spark: SparkSession, path: str, topics: Sequence[str] = ()) -> DataFrame:
    """Stream of all messages of the topics, from the offsets that the query's checkpoint holds."""
    spark.dataSource.register(MessageLogSource)
    return spark.readStream.format("message_log").option("path", path).option("topics", ",".join(topics)).load().drop("range_idx")
