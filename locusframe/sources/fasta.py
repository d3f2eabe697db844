"""Reference sequences in blocks, from FASTA files of any size.

``spark.read.format("fasta_pieces")`` cuts files into ranges of ``splitBytes`` and gives
pieces of records: a range knows the contig of what follows the first header in it;
what precedes it belongs to a record that an earlier range has opened. ``read_reference``
resolves that from one row for each range, and cuts the sequences into blocks of ``width``
letters, so no row, task or window holds a record, whether its letters stand on one line or
on many. gzip files are one range, read as a stream.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .shared import listed, store

PIECES = "path string, range bigint, contig string, piece bigint, place bigint, letters binary"
SPLIT = 64 << 20
READ = 1 << 20
#: Bytes of ranges that one task reads at least, one range after the other: in a small file and in a large one.
TASKS = 1 << 18, 8 << 20
#: Bytes that a header line may have.
HEADER = 1 << 16
WIDTH = 1 << 14
_BLANK = b" \t\r\n\v\f"


def _plain(file: BinaryIO, until: int | None = None) -> Iterator[bytes]:
    """The file from here on; behind byte ``until`` only little at a time, as for the end of a header."""
    while until is None or until > 0:
        data = file.read(READ if until is None else min(READ, until))
        if not data:
            return
        yield data
        until = None if until is None else until - len(data)
    while data := file.read(1 << 12):
        yield data


def _before(file: BinaryIO, start: int) -> bytes:
    """The bytes before a place as far as the last line's beginning needs them, HEADER at most."""
    back = 1 << 9
    while True:
        back = min(back, start, HEADER)
        file.seek(start - back)
        before = file.read(back)
        if b"\n" in before or back == min(start, HEADER):
            return before
        back *= 4


def _inflated(file: BinaryIO) -> Iterator[bytes]:
    unpack = zlib.decompressobj(31)
    for data in _plain(file):
        while data:
            yield unpack.decompress(data)
            data = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(31)


def opening(before: bytes, whole: bool) -> bytes:
    """What a range continues, by the bytes before it: the start of a header line, else nothing.

    ``whole``: the bytes reach back to the file's start. Letters may go on for longer than a
    header line is allowed to.
    """
    at = before.rfind(b"\n") + 1
    return before[at:] if (at or whole) and before[at : at + 1] == b">" else b""


def pieces(chunks: Iterator[bytes], first: bool, head: bytes, until: int | None = None) -> Iterator[tuple[str | None, int, bytes]]:
    """(contig, place, letters) of a range; contig None and places from 0 before its first header.

    ``first``: the range starts a line. ``head``: the header line it starts in, as far as it
    is before the range; the record is that of the range in which the line starts, so the
    line's end is skipped. A header that starts before byte ``until`` is read to its end
    beyond it, and is the last thing in the range.
    """
    contig, place, seen = None, 0, 0
    skip, open_head, at_line = bool(head), None, first
    for data in chunks:
        start = 0
        while start < len(data):
            if skip or open_head is not None:
                end = data.find(b"\n", start)
                stop = len(data) if end < 0 else end
                if open_head is not None:
                    open_head += data[start:stop]
                if end < 0:
                    break
                if open_head is not None:
                    words = open_head.split(None, 1)
                    contig, place, open_head = words[0].decode() if words and not open_head[:1].isspace() else "", 0, None
                    yield contig, 0, b""
                skip, at_line, start = False, True, end + 1
                continue
            if until is not None and seen + start >= until:
                return
            if at_line and data[start : start + 1] == b">":
                open_head, at_line, start = b"", False, start + 1
                continue
            found = data.find(b"\n>", start)
            stop = len(data) if found < 0 else found + 1
            if until is not None:
                stop = min(stop, until - seen)
            letters = data[start:stop].translate(None, _BLANK)
            if letters:
                yield contig, place, letters
                place += len(letters)
            at_line, start = data[stop - 1 : stop] == b"\n", stop
        seen += len(data)
    if open_head is not None:
        words = open_head.split(None, 1)
        yield words[0].decode() if words and not open_head[:1].isspace() else "", 0, b""


class _Ranges(InputPartition):
    """Ranges of ``step`` bytes of a file, from ``start`` to ``end``."""

    def __init__(self, path: str, start: int, end: int, step: int) -> None:
        self.path, self.start, self.end, self.step = path, start, end, step


class FastaReader(DataSourceReader):
    def __init__(self, path: str, split: int) -> None:
        self.path, self.split = path, split

    def partitions(self) -> list[_Ranges]:
        """Ranges are what is resolved on its own; short ones share a task, so tasks follow the bytes and not the ranges."""
        found = listed(self.path, "*")
        if not found:
            raise FileNotFoundError(self.path)
        out = []
        for path, size in found:
            step = size + 1 if path.endswith(".gz") else self.split
            task = step * -(-max(TASKS[0], min(TASKS[1], size // 64)) // step)
            out += [_Ranges(path, a, min(a + task, size), step) for a in range(0, max(size, 1), task)]
        return out

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        system, at = store(partition.path)
        rows, size = [], 0
        with system.open_input_file(at) as file:
            for start in range(partition.start, max(partition.end, partition.start + 1), partition.step):
                for n, (contig, place, letters) in enumerate(self._range(file, partition, start)):
                    rows.append((start, contig, n, place, letters))
                    size += len(letters) + 64
                    if size > 4 * READ:
                        yield self._batch(partition.path, rows)
                        rows, size = [], 0
        yield self._batch(partition.path, rows)

    def _range(self, file: BinaryIO, partition: _Ranges, start: int) -> Iterator[tuple[str | None, int, bytes]]:
        if partition.path.endswith(".gz"):
            return pieces(_inflated(file), True, b"")
        until = min(start + partition.step, partition.end) - start
        before = _before(file, start)
        file.seek(start)
        return pieces(_plain(file, until), not before or before.endswith(b"\n"), opening(before, len(before) == start), until)

    def _batch(self, path: str, rows: list[tuple]) -> pa.RecordBatch:
        start, contig, piece, place, letters = zip(*rows, strict=True) if rows else ((), (), (), (), ())
        columns = [pa.array([path] * len(rows), pa.string()), pa.array(start, pa.int64()), pa.array(contig, pa.string()), pa.array(piece, pa.int64()), pa.array(place, pa.int64()), pa.array(letters, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["path", "range", "contig", "piece", "place", "letters"])


class FastaPieces(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta_pieces"

    def schema(self) -> str:
        return PIECES

    def reader(self, schema: object) -> FastaReader:
        return FastaReader(self.options["path"], int(self.options.get("splitBytes", SPLIT)))


def _cut(contig: Column, place: Column, letters: Column, width: int) -> Column:
    """The parts of a piece that fall into one block each."""
    n = F.octet_length(letters)
    first, last = F.floor(place / width), F.floor((place + F.greatest(n, F.lit(1)) - 1) / width)

    def part(block: Column) -> Column:
        begin = F.greatest(block * width - place, F.lit(0))
        return F.struct(contig.alias("contig"), block.alias("block"), (place + begin).alias("place"), F.substring(letters, (begin + 1).cast("int"), (F.least((block + 1) * width - place, n.cast("bigint")) - begin).cast("int")).alias("letters"))

    return F.explode(F.transform(F.sequence(first, last), part))


def read_reference(spark: SparkSession, path: str, width: int = WIDTH, split: int = SPLIT) -> DataFrame:
    """(contig, block, seq): ``width`` letters of a contig in each block, as bytes; the last one has the rest.

    A contig without letters has one empty block. Names are taken as unique, as they are in
    an indexed file; of headers without a name the contig is the empty string.
    """
    spark.dataSource.register(FastaPieces)
    found = spark.read.format("fasta_pieces").option("splitBytes", split).load(path)
    # One row for each range: its letters, and the last contig it opens with the letters before that.
    n = F.octet_length("letters").cast("bigint")
    opened = F.max(F.when(F.col("contig").isNotNull(), F.struct("piece", "contig", "place", n.alias("n"))))
    ranges = found.groupBy("path", "range").agg(F.sum(n).alias("n"), opened.alias("last"))
    here = W.partitionBy("path").orderBy("range")
    ranges = ranges.withColumn("until", F.sum("n").over(here.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # Letters of the file before the last contig's first one.
    began = F.when(F.col("last").isNotNull(), F.struct(F.col("last.contig").alias("contig"), (F.col("until") - F.col("last.place") - F.col("last.n")).alias("began")))
    carried = F.last(began, ignorenulls=True).over(here.rowsBetween(W.unboundedPreceding, -1))
    ranges = ranges.select(F.col("path").alias("r_path"), F.col("range").alias("r_range"), (F.col("until") - F.col("n")).alias("before"), carried.alias("carried"))
    met = found.join(ranges, (F.col("path") == F.col("r_path")) & (F.col("range") == F.col("r_range")))
    own = F.col("contig").isNotNull()
    placed = met.select(
        F.when(own, F.col("contig")).otherwise(F.col("carried.contig")).alias("contig"),
        F.when(own, F.col("place")).otherwise(F.col("before") + F.col("place") - F.col("carried.began")).alias("place"),
        "letters",
    ).where("contig is not null")
    return _gathered(placed, width)


def _gathered(placed: DataFrame, width: int) -> DataFrame:
    parts = placed.select(_cut(F.col("contig"), F.col("place"), F.col("letters"), width).alias("p")).select("p.*")
    listed = F.array_sort(F.collect_list(F.when(F.octet_length("letters") > 0, F.struct("place", "letters"))))
    joined = F.aggregate(listed, F.lit(b""), lambda a, x: F.concat(a, x["letters"]))
    return parts.groupBy("contig", "block").agg(joined.alias("seq"))


def blocked(contigs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The same blocks of a relation (contig, seq) of whole sequences."""
    seq = contigs.select("contig", F.encode("seq", "UTF-8").alias("letters"))
    return seq.select(_cut(F.col("contig"), F.lit(0).cast("bigint"), F.col("letters"), width).alias("p")).select("p.contig", "p.block", F.col("p.letters").alias("seq"))
