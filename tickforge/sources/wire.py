"""Wire formats as data sources: growing files of messages by byte offsets, and line protocol with committed files.

`message_lines` gives the lines of files under a path as rows (file, offset, value), to be parsed by
sources.messages in the JVM.  As a stream it follows files that grow, which whole-file
sources don't: an offset is each file's number of bytes up to its last whole line, and a
trigger reads what lies between two offsets, in ranges that tasks read on their own.
`line_protocol` writes lines (column value) as files that are valid only once the job's
manifest names them: what a lost task or job leaves is in no manifest.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

RANGE_BYTES, TAIL_BYTES = 64 << 20, 1 << 16


def _store(uri: str):
    """(file system, path in it), by pyarrow, for any store it knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class Range(InputPartition):
    """Lines that start in bytes lo to hi of a file."""

    def __init__(self, file: str, lo: int, hi: int):
        self.file, self.lo, self.hi = file, lo, hi


class _Lines:
    def __init__(self, options: dict):
        self.uri, self.range_bytes = options["path"], int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))

    def sizes(self) -> dict[str, int]:
        """Files under the path, and their bytes up to the last whole line."""
        from pyarrow import fs

        store, path = _store(self.uri)
        out = {}
        for info in store.get_file_info(fs.FileSelector(path, recursive=False, allow_not_found=True)):
            if info.type == fs.FileType.File and not info.base_name.startswith(("_", ".")):
                out[info.base_name] = self._whole_lines(store, info.path, info.size)
        return out

    def _whole_lines(self, store, path: str, size: int) -> int:
        with store.open_input_file(path) as src:
            hi = size
            while hi:
                lo = max(0, hi - TAIL_BYTES)
                src.seek(lo)
                if (at := src.read(hi - lo).rfind(b"\n")) >= 0:
                    return lo + at + 1
                hi = lo
        return 0

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Range]:
        return [Range(f, lo, min(hi, lo + self.range_bytes)) for f, hi in sorted(end.items()) for lo in range(start.get(f, 0), hi, self.range_bytes)]

    def read(self, partition: Range) -> Iterator[tuple[str, int, str]]:
        store, path = _store(self.uri)
        with io.BufferedReader(store.open_input_file(f"{path}/{partition.file}"), 1 << 20) as src:
            at = partition.lo
            if at:  # a line that started before is the range's before
                src.seek(at - 1)
                at += len(src.readline()) - 1
            src.seek(at)
            while at < partition.hi and (line := src.readline()):
                yield partition.file, at, line.rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(line)


class LinesReader(_Lines, DataSourceReader):
    def partitions(self) -> list[Range]:
        return self.ranges({}, self.sizes())


class LinesStream(_Lines, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return self.sizes()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.ranges(start, end)

    def commit(self, end: dict) -> None:
        pass


class MessageLines(DataSource):
    """Option path: a folder; rangeBytes: bytes that a task reads at most."""

    @classmethod
    def name(cls) -> str:
        return "message_lines"

    def schema(self) -> str:
        return "file string, offset long, value string"

    def reader(self, schema) -> LinesReader:
        return LinesReader(self.options)

    def streamReader(self, schema) -> LinesStream:  # noqa: N802
        return LinesStream(self.options)


class Written(WriterCommitMessage):
    def __init__(self, file: str | None, lines: int):
        self.file, self.lines = file, lines


class LineWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.uri = options["path"]

    def write(self, rows) -> Written:
        store, path = _store(self.uri)
        store.create_dir(path, recursive=True)
        name, lines, out = f"part-{uuid.uuid4().hex}.lp", 0, None
        try:
            for row in rows:
                if row[0] is not None:
                    out = out or store.open_output_stream(f"{path}/{name}")
                    out.write(row[0].encode() + b"\n")
                    lines += 1
        finally:
            if out:
                out.close()
        return Written(name if lines else None, lines)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = _store(self.uri)
        files = {m.file: m.lines for m in messages if m and m.file}
        store.create_dir(path, recursive=True)
        mark = uuid.uuid4().hex
        with store.open_output_stream(f"{path}/_staged-{mark}") as out:
            out.write(json.dumps(files).encode())
        store.move(f"{path}/_staged-{mark}", f"{path}/_manifest-{mark}.json")  # a manifest is there whole or not at all

    def abort(self, messages: list[Written | None]) -> None:
        store, path = _store(self.uri)
        for m in messages:
            if m and m.file:
                store.delete_file(f"{path}/{m.file}")


class CommittedLines(_Lines, DataSourceReader):
    """Lines of the files that manifests name."""

    def partitions(self) -> list[Range]:
        from pyarrow import fs

        store, path = _store(self.uri)
        named: set[str] = set()
        for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if info.base_name.startswith("_manifest-"):
                with store.open_input_file(info.path) as src:
                    named |= set(json.loads(src.read()))
        return self.ranges({}, {f: store.get_file_info(f"{path}/{f}").size for f in named})


class LineProtocol(DataSource):
    """Option path: a folder.  Written rows have one column, value; read rows are as those of message_lines."""

    @classmethod
    def name(cls) -> str:
        return "line_protocol"

    def schema(self) -> str:
        return "file string, offset long, value string"

    def reader(self, schema) -> CommittedLines:
        return CommittedLines(self.options)

    def writer(self, schema, overwrite: bool) -> LineWriter:
        if overwrite:
            raise ValueError("line protocol is only appended")
        return LineWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make both formats known to a session."""
    spark.dataSource.register(MessageLines)
    spark.dataSource.register(LineProtocol)


def write_lines(lines: DataFrame, path: str) -> None:
    """Append lines (value), as to_line_protocol gives them."""
    register(lines.sparkSession)
    lines.select("value").write.format("line_protocol").mode("append").option("path", path).save()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("line_protocol").option("path", path).load()


def message_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of (file, offset, value) of files that grow."""
    register(spark)
    return spark.readStream.format("message_lines").option("path", path).load()
