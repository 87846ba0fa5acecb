"""Following log files that grow in place, by byte ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradloom.sources.journals import LOG_GLOB

SOURCE = "growing_logs"
# Bytes that one task reads, of one file or of many short ones.
RANGE_BYTES = 32 * 1024 * 1024
# What opening a file counts for among these bytes.
OPEN_BYTES = 64 * 1024
# Step in which a task looks back for the start of its first line.
LOOK_BACK_BYTES = 64 * 1024


def growing_source() -> type:
    """The data source class; made here, so that it travels by value to every kind of worker."""
    import fnmatch
    import posixpath

    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    range_bytes, open_bytes, look_back, glob = RANGE_BYTES, OPEN_BYTES, LOOK_BACK_BYTES, LOG_GLOB

    def opened(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    class Range:
        def __init__(self, file: str, low: int, high: int):
            self.file, self.low, self.high = file, low, high

    class Ranges(InputPartition):
        """What one task reads: ``range_bytes`` at most, of one file or of many short ones."""

        def __init__(self, ranges: list):
            self.ranges = ranges

    class GrowingReader(DataSourceStreamReader):
        """Offsets are file sizes. A batch holds the lines whose ends lie between two sizes, so a line that is still
        being written waits for a later batch, and a batch that is repeated holds the same lines."""

        def __init__(self, path: str):
            self.path = path

        def initialOffset(self) -> dict:
            return {}

        def latestOffset(self) -> dict:
            from pyarrow import fs

            store, place = opened(self.path)
            info = store.get_file_info(place)
            if info.type == fs.FileType.File:
                return {info.path: info.size}
            found = store.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
            files = {f.path: f.size for f in found if f.type == fs.FileType.File}
            named = {p: n for p, n in files.items() if fnmatch.fnmatch(posixpath.basename(p), glob)}
            return named or files

        def partitions(self, start: dict, end: dict) -> list:
            out, held = [], 0
            for file, high in sorted(end.items()):
                for at in range(start.get(file, 0), high, range_bytes):
                    part = Range(file, at, min(at + range_bytes, high))
                    cost = part.high - part.low + open_bytes
                    if not out or held + cost > range_bytes + open_bytes:
                        out.append([])
                        held = 0
                    out[-1].append(part)
                    held += cost
            return [Ranges(ranges) for ranges in out]

        def read(self, partition):
            store, _ = opened(self.path)
            for part in partition.ranges:
                yield from self.lines(store, part)

        def lines(self, store, part):
            with store.open_input_file(part.file) as file:
                begin = part.low
                while begin > 0:  # back to the line that part.low lies in
                    step = min(look_back, begin)
                    file.seek(begin - step)
                    cut = file.read(step).rfind(b"\n")
                    begin = begin - step + cut + 1
                    if cut >= 0:
                        break
                file.seek(begin)
                data = file.read(part.high - begin)
            at = begin
            for line in data.split(b"\n")[:-1]:
                end = at + len(line)
                if end >= part.low:
                    yield (part.file, part.file, at, line.decode("utf-8", "replace").rstrip("\r"))
                at = end + 1

        def commit(self, end: dict) -> None:
            pass

    class GrowingLogs(DataSource):
        @classmethod
        def name(cls) -> str:
            return "growing_logs"

        def schema(self) -> str:
            return "log string, file_path string, line_no bigint, value string"

        def streamReader(self, schema):
            return GrowingReader(self.options["path"])

    return GrowingLogs


def stream_growing_logs(spark: SparkSession, path: str) -> DataFrame:
    """``log``, ``file_path``, ``line_no``, ``value`` of every line that is complete, as files grow or appear.

    ``path`` is a file or a folder; a file is a log, and ``line_no`` is the byte its line starts at, which orders
    lines as a number does. How far each file was read lies in the stream's checkpoint. Large growth is read by many
    tasks. Files must grow only; where a file is cut and written anew, give it another name.
    """
    spark.dataSource.register(growing_source())
    return spark.readStream.format(SOURCE).load(path)
