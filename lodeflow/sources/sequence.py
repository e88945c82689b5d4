"""Random access to sequence files: an index of offsets, and a data source that reads the byte ranges of the chunks that are asked for."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

#: Bytes of the file that one task scans for the index, or reads at once.
RANGE = 64 << 20
SCHEMA = "chrom string, chunk bigint, seq string"


@dataclass
class Entry:
    """Where a sequence lies: its bases, the offset of the first one, and bases and bytes of each of its lines but the last."""

    chrom: str
    length: int
    offset: int
    line_bases: int
    line_bytes: int

    def byte_of(self, base: int) -> int:
        lines, rest = divmod(base, self.line_bases)
        return self.offset + lines * self.line_bytes + rest


def _open(path: str):
    """A file for random reads: local, or through a file system that pyarrow knows by the path's scheme."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or "/" in scheme or not rest:
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/") if scheme == "file" else path)
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _lines(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes with the line end) of the lines that begin in a byte range."""
    f.seek(max(start - 1, 0))
    if start:
        before = f.read(1)
        while before and before != b"\n":  # the line that crosses the start belongs to the range before
            part = f.read(4096)
            cut = part.find(b"\n")
            if cut >= 0:
                f.seek(f.tell() - len(part) + cut + 1)
                before = b"\n"
            elif not part:
                return
    at, rest = f.tell(), b""
    while at < end:
        part = f.read(1 << 20)
        rest += part
        lines = rest.split(b"\n")
        rest = lines.pop()
        for line in lines:
            if at >= end:
                return
            yield at, line + b"\n"
            at += len(line) + 1
        if not part:
            if rest and at < end:
                yield at, rest
            return


def offset_index(spark: SparkSession, path: str, step: int = RANGE) -> list[Entry]:
    """The offsets of every sequence of a file with headers ``>name ...``, scanned in byte ranges by as many tasks.

    A range gives a row for each header in it and one for what stands before the first, so what comes back grows with the sequences and ranges, not the bases.
    Lines of one sequence must be equally long but for its last one, else ValueError.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen()

    def scan(batches):
        for g in batches:
            out = []
            for k in g["id"]:
                with _open(path) as f:
                    row = {"at": int(k) * step, "name": None, "begin": -1, "bases": 0, "lines": 0, "first": -1, "width": -1, "even": True, "last": -1, "end": -1}
                    for at, line in _lines(f, int(k) * step, min((int(k) + 1) * step, size)):
                        if line.startswith(b">"):
                            out.append(row)
                            name = line[1:].split()
                            row = {**row, "at": at, "name": name[0].decode() if name else "", "begin": at + len(line), "bases": 0, "lines": 0, "first": -1, "width": -1, "even": True, "last": -1, "end": -1}
                            continue
                        n, body = len(line), len(line.strip())
                        if not body:
                            continue
                        if row["lines"]:
                            row["even"] &= row["last"] == row["first"] and at == row["end"]
                        else:
                            row.update(first=body, width=n, begin=at if row["begin"] < 0 else row["begin"])
                        row.update(lines=row["lines"] + 1, bases=row["bases"] + body, last=body, end=at + n)
                    out.append(row)
            yield pd.DataFrame(out)

    ranges = spark.range(0, max(1, math.ceil(size / step)), numPartitions=max(1, math.ceil(size / step)))
    rows = ranges.mapInPandas(scan, "at bigint, name string, begin bigint, bases bigint, lines bigint, first bigint, width bigint, even boolean, last bigint, end bigint").orderBy("at", F.col("name").isNotNull()).collect()
    entries: list[Entry] = []
    short = False
    for r in rows:
        if r["name"] is not None:
            entries.append(Entry(r["name"], r["bases"], r["begin"], max(r["first"], 0), max(r["width"], 0)))
        elif r["lines"] and not entries:
            raise ValueError(f"{path}: bases before the first header")
        elif r["lines"]:
            e = entries[-1]
            if not e.line_bases:
                e.line_bases, e.line_bytes = r["first"], r["width"]
            elif short or (r["first"] > e.line_bases):
                raise ValueError(f"{path}: lines of {e.chrom} are not equally long")
            e.length += r["bases"]
        if r["lines"]:
            e = entries[-1]
            if not r["even"] or r["first"] != e.line_bases and r["lines"] > 1:
                raise ValueError(f"{path}: lines of {e.chrom} are not equally long")
            short = r["last"] < e.line_bases
        elif r["name"] is not None:
            short = False
    return entries


def save_index(spark: SparkSession, entries: list[Entry], path: str) -> None:
    """The index as one small file of JSON lines."""
    spark.createDataFrame([(json.dumps(asdict(e)),) for e in entries], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_index(spark: SparkSession, path: str) -> list[Entry]:
    return [Entry(**json.loads(r[0])) for r in spark.read.text(path).collect()]


@dataclass
class _Range(InputPartition):
    """Chunks ``low`` to ``high`` - 1 of a sequence."""

    entry: dict
    low: int
    high: int


class SequenceReader(DataSourceReader):
    """Plans a partition for each range of chunks that the pushed filters leave; each reads its own bytes."""

    def __init__(self, options: dict):
        self.path, self.size, self.step = options["path"], int(options["size"]), int(options.get("bytes", RANGE))
        self.entries = [Entry(**e) for e in json.loads(options["entries"])]
        self.names: set[str] | None = None
        self.low, self.high = 0, 1 << 62

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality and membership of chrom, bounds of chunk; others stay with Spark."""
        for f in filters:
            at = getattr(f, "attribute", None)
            if at == ("chrom",) and isinstance(f, (EqualTo, In)):
                names = set(f.value if isinstance(f, In) else [f.value])
                self.names = names if self.names is None else self.names & names
            elif at == ("chunk",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, f.value + (not isinstance(f, LessThan)))
            else:
                yield f

    def partitions(self) -> list[_Range]:
        out, each = [], max(1, self.step // self.size)
        for e in self.entries:
            if self.names is None or e.chrom in self.names:
                end = min(self.high, -(-e.length // self.size))
                out += [_Range(asdict(e), a, min(a + each, end)) for a in range(self.low, end, each)]
        return out or [_Range(asdict(Entry("", 0, 0, 1, 1)), 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        e, size = Entry(**partition.entry), self.size
        if partition.low >= partition.high:
            return
        with _open(self.path) as f:
            step = max(1, (8 << 20) // size)
            for a in range(partition.low, partition.high, step):
                b = min(a + step, partition.high)
                first, last = a * size, min(b * size, e.length)
                f.seek(e.byte_of(first))
                seq = f.read(e.byte_of(last - 1) + 1 - e.byte_of(first)).translate(None, b"\r\n \t").decode("ascii", "replace")
                parts = [seq[k : k + size] for k in range(0, len(seq), size)]
                yield pa.RecordBatch.from_arrays([pa.array([e.chrom] * len(parts)), pa.array(range(a, a + len(parts)), pa.int64()), pa.array(parts)], names=["chrom", "chunk", "seq"])


class SequenceSource(DataSource):
    """Format ``lode_sequence``: chunks of the sequences of one file. Options: path, entries (the index as JSON), size (bases of a chunk), bytes (of a partition)."""

    @classmethod
    def name(cls) -> str:
        return "lode_sequence"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> SequenceReader:
        return SequenceReader(dict(self.options))


def sequence_chunks(spark: SparkSession, path: str, entries: list[Entry], size: int, step: int = RANGE) -> DataFrame:
    """chrom, chunk, seq of a file, as ``genome_chunks`` gives them: filters on chrom and chunk choose the byte ranges that are read, so a small slice reads one small range."""
    spark.dataSource.register(SequenceSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("lode_sequence").option("path", path).option("entries", json.dumps([asdict(e) for e in entries])).option("size", size).option("bytes", step).load()
