"""Alignment files as a Spark data source: ``spark.read.format("bam").load(path)``.

BGZF files are cut into ranges of ``splitBytes`` (an option) that are read on their own: a
task starts at the first block in its range and at the first record that begins there,
which is told by a chain of records that fit the header. Blocks are inflated one after the
other, so memory does not depend on the file size; a block's records are decoded together.
Plain gzip files are one range. The driver lists the folder and opens no file.

Where a query filters on ``contig`` and ``pos`` and a file has an index (``.bai``), only the
parts of the file that the index names for those places are read. Filters are pushed down
once ``register`` has set ``spark.sql.python.filterPushdown.enabled``; Spark applies them
again to what is read, so files without an index give the same rows.
"""

from __future__ import annotations

import io
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..schemas import READS
from .baindex import FINEST, Index, IndexWriter, ranges_of
from .shared import fresh, listed, store

_SEQ = "=ACMGRSVTWYHKDBN"
_OPS = "MIDNSHP=X"
#: The two letters of a packed byte.
_PAIRS = np.array([[ord(a), ord(b)] for a in _SEQ for b in _SEQ], np.uint8)
BLOCK = 1 << 18
SPLIT = 64 << 20
#: Inflated bytes that are decoded together.
TOGETHER = 1 << 20
#: Records that must follow one another for a start to be taken as one.
CHAIN = 6
_NAMES = [c.split()[0] for c in READS.split(", ")]


def block_size(head: bytes) -> int:
    """The whole size of the BGZF block that starts with these bytes; 0 if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return 0
    extra = struct.unpack_from("<H", head, 10)[0]
    at, end = 12, min(12 + extra, len(head))
    while at + 6 <= end:
        n = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and n == 2:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return 0


class Stream:
    """Exact reads from a BGZF (or plain gzip) file, from a block on; it knows which bytes are of which block."""

    def __init__(self, file: BinaryIO, start: int = 0) -> None:
        self.file, self.held, self.taken = file, bytearray(), 0
        file.seek(start)
        self.next = start
        self.blocks: list[tuple[int, int]] = []  # end in the inflated bytes, place in the file
        self.end = self.origin = 0
        head = file.read(64)
        file.seek(start)
        self.plain = None if block_size(head) or not head else zlib.decompressobj(31)
        self.rest = b""

    def _more(self) -> bool:
        """Inflate one more block (or part of a plain file); False at the end."""
        if self.plain is not None:
            data = self.rest or self.file.read(BLOCK)
            if not data:
                return False
            out = self.plain.decompress(data)
            self.rest = self.plain.unused_data
            if self.plain.eof:
                self.plain = zlib.decompressobj(31)
            place = 0
        else:
            head = self.file.read(18)
            if not head:
                return False
            size = block_size(head + self.file.read(46)) if len(head) == 18 else 0
            if not size:
                raise ValueError("not a BGZF block")
            self.file.seek(self.next)
            data = self.file.read(size)
            skip = 12 + struct.unpack_from("<H", data, 10)[0]
            out, place = zlib.decompress(data[skip:-8], -15), self.next
            self.next += size
        self.held += out
        self.end += len(out)
        if out:
            self.blocks.append((self.end, place))
        return True

    def limit(self, until: tuple[int, int] | None) -> float:
        """How many of the held bytes are before a place (block, offset in it) of the file."""
        first = self.origin
        while self.blocks and self.blocks[0][0] <= self.taken:
            first = self.blocks.pop(0)[0]
        self.origin = first
        if until is None:
            return float("inf")
        for end, place in self.blocks:
            if place >= until[0]:
                return first - self.taken + (until[1] if place == until[0] else 0)
            first = end
        return float("inf")

    def peek(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        return bytes(self.held[:n])

    def read(self, n: int) -> bytes:
        out = self.peek(n)
        del self.held[:n]
        self.taken += len(out)
        return out

    def close(self) -> None:
        self.file.close()


def header(stream: Stream) -> list[tuple[str, int]]:
    """Names and lengths of the reference contigs."""
    if stream.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    stream.read(struct.unpack("<i", stream.read(4))[0])
    out = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        name = stream.read(struct.unpack("<i", stream.read(4))[0])[:-1].decode()
        out.append((name, struct.unpack("<i", stream.read(4))[0]))
    return out


def record_chunks(stream: Stream, until: tuple[int, int] | None = None) -> Iterator[tuple[bytes, np.ndarray]]:
    """Inflated bytes and the places of the whole records in them, of those that begin before ``until`` (block, offset in it)."""
    most = TOGETHER
    while True:
        data = stream.peek(most)
        limit = stream.limit(until)
        places, at, n = [], 0, len(data)
        while at + 4 <= n and at < limit:
            end = at + 4 + int.from_bytes(data[at : at + 4], "little")
            if end > n:
                break
            places.append(at)
            at = end
        if places:
            stream.read(at)
            yield data, np.array(places, np.int64)
            most = TOGETHER
        elif n < most or limit <= 0:
            return
        else:
            most *= 2


def _gathered(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all runs, one after the other, and their offsets."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return raw[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)], offsets


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def decoded(data: bytes, places: np.ndarray, names: pa.Array, sample: str, cigars: dict[bytes, str]) -> pa.RecordBatch:
    """READS of the records at these places, all columns by offsets; ``cigars`` keeps texts of CIGARs seen before."""
    raw = np.frombuffer(data, np.uint8)
    head = np.ascontiguousarray(raw[places[:, None] + np.arange(36)])
    word = lambda at, kind: head[:, at : at + np.dtype(kind).itemsize].copy().view(kind).ravel()
    ref, pos, length = word(4, "<i4"), word(8, "<i4"), word(20, "<i4").astype(np.int64)
    name_len, mapq, n_ops, flag = head[:, 12].astype(np.int64), head[:, 13], word(16, "<u2").astype(np.int64), word(18, "<u2")
    at = places + 36
    read_name = _strings(*_gathered(raw, at, name_len - 1))
    at = at + name_len
    ops = [data[a : a + 4 * n] for a, n in zip(at.tolist(), n_ops.tolist(), strict=True)]
    for kind in set(ops) - cigars.keys():
        cigars[kind] = "".join(f"{c >> 4}{_OPS[c & 15]}" for c in struct.unpack(f"<{len(kind) // 4}I", kind))
    at = at + 4 * n_ops
    packed_len = (length + 1) // 2
    packed, offsets = _gathered(raw, at, packed_len)
    letters = _PAIRS[packed].reshape(-1)
    seq = _strings(*_gathered(letters, 2 * offsets[:-1], length))
    qual, offsets = _gathered(raw, at + packed_len, length)
    quality = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(qual.astype(np.int32)))
    n = len(places)
    contig = names.take(pa.array(ref, mask=ref < 0)) if len(names) else pa.nulls(n, pa.string())
    columns = [pa.array([sample] * n, pa.string()), read_name, pa.array(flag.astype(np.int32)), contig, pa.array(pos.astype(np.int64)), pa.array(mapq.astype(np.int32)), pa.array([cigars[x] for x in ops], pa.string()), seq, quality]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def batches(stream: Stream, contigs: list[tuple[str, int]], sample: str, until: tuple[int, int] | None = None) -> Iterator[pa.RecordBatch]:
    """READS of the records that begin before ``until``."""
    names = pa.array([name for name, _ in contigs], pa.string())
    cigars: dict[bytes, str] = {}
    for data, places in record_chunks(stream, until):
        yield decoded(data, places, names, sample, cigars)
        if len(cigars) > 100_000:
            cigars.clear()


def _fits(data: bytes, at: int, contigs: list[tuple[str, int]]) -> int:
    """The end of a plausible record at a place; 0 if there is none, -1 if more bytes are needed."""
    if at + 36 > len(data):
        return -1
    size, ref, pos, name_len, _, _, n_cigar, _, length, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    need = 32 + name_len + 4 * n_cigar + (length + 1) // 2 + length
    if not (0 <= length and name_len >= 2 and need <= size < 1 << 28 and -1 <= ref < len(contigs) and -1 <= mate < len(contigs)):
        return 0
    for r, p in ((ref, pos), (mate, mate_pos)):
        if p < -1 or (r >= 0 and p >= contigs[r][1]):
            return 0
    body = at + 36
    if body + name_len + 4 * n_cigar > len(data):
        return -1
    name = data[body : body + name_len]
    if name[-1] or not all(33 <= c <= 126 for c in name[:-1]):
        return 0
    ops = struct.unpack_from(f"<{n_cigar}I", data, body + name_len)
    if any(c & 15 > 8 for c in ops) or (n_cigar and length and sum(c >> 4 for c in ops if c & 15 in (0, 1, 4, 7, 8)) != length):
        return 0
    return at + 4 + size


def first_record(stream: Stream, contigs: list[tuple[str, int]]) -> bool:
    """Skip to the first record of a stream that starts in the middle; False if none begins."""
    most = 1 << 16
    at = 0
    while True:
        data = stream.peek(most)
        done = len(data) < most
        while at < len(data):
            end, n = at, 0
            while n < CHAIN and end < len(data) and (step := _fits(data, end, contigs)) > 0:
                end, n = step, n + 1
            if n == CHAIN or (n and done and end == len(data)):
                stream.read(at)
                return True
            if not done and end < len(data) + 1 and (end >= len(data) or _fits(data, end, contigs) < 0):
                break  # more bytes decide
            at += 1
        if done:
            return False
        most *= 2


def first_block(file: BinaryIO, start: int, size: int) -> int | None:
    """The place of the first block at or behind ``start``: one whose size leads to another or to the end."""
    at = start
    while at < size:
        file.seek(at)
        data = file.read(1 << 17)
        for m in re.finditer(rb"\x1f\x8b\x08\x04", data):
            if m.start() >= 1 << 16:
                break
            place = at + m.start()
            n = block_size(data[m.start() : m.start() + 64])
            if n:
                file.seek(place + n)
                if place + n == size or block_size(file.read(64)):
                    return place
        at += 1 << 16
    return None


class _Range(InputPartition):
    """Parts of a file: blocks from ``start`` (and the record at ``offset`` in the first, or one to be found) to a place."""

    def __init__(self, path: str, *parts: tuple[int, int | None, tuple[int, int] | None]) -> None:
        self.path, self.parts = path, parts


class Places:
    """What filters say of contig and pos: names (None: all) and the least and greatest place."""

    def __init__(self) -> None:
        self.contigs: set[str] | None = None
        self.least, self.most = 0, (1 << 31) - 2

    def narrow(self, given: Filter) -> None:
        column, value = getattr(given, "attribute", None), getattr(given, "value", None)
        if column == ("contig",) and isinstance(given, EqualTo | In):
            names = {value} if isinstance(given, EqualTo) else set(value)
            self.contigs = names if self.contigs is None else self.contigs & names
        elif column == ("pos",) and isinstance(value, int):
            if isinstance(given, EqualTo | GreaterThanOrEqual | GreaterThan):
                self.least = max(self.least, value + isinstance(given, GreaterThan))
            if isinstance(given, EqualTo | LessThanOrEqual | LessThan):
                self.most = min(self.most, value - isinstance(given, LessThan))


class BamReader(DataSourceReader):
    def __init__(self, path: str, only_header: bool, split: int) -> None:
        self.path, self.only_header, self.split = path, only_header, split
        self.places = Places()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """All filters stay with Spark; those on places say which parts of a file to read."""
        for given in filters:
            self.places.narrow(given)
            yield given

    def partitions(self) -> list[_Range]:
        found = listed(self.path, "*.bam")
        if not found:
            raise FileNotFoundError(self.path)
        if self.only_header:
            return [_Range(path, (0, None, None)) for path, _ in found]
        # Without names the places of all contigs would be asked for, which is no less than the file.
        folders = set() if self.places.contigs is None else {os.path.dirname(path) for path, _ in found}
        indexed = {path for folder in folders for path, _ in listed(folder or ".", "*.bam.bai")}
        with ThreadPoolExecutor(16) as pool:
            wanted = dict(pool.map(self._wanted, [path for path, _ in found if path + ".bai" in indexed]))
        out = []
        for path, size in found:
            if path in wanted:
                out += self._dealt(path, wanted[path])
            else:
                cuts = list(range(0, max(size, 1), self.split))
                out += [_Range(path, (a, None, None if b is None else (b, 0))) for a, b in zip(cuts, [*cuts[1:], None], strict=True)]
        return out

    def _wanted(self, path: str) -> tuple[str, list[tuple[int, int]]]:
        """The file and its ranges of virtual places; header and index are all that is read."""
        system, at = store(path)
        with system.open_input_file(at) as file:
            names = [name for name, _ in header(Stream(file))]
        with system.open_input_file(at + ".bai") as file:
            index = Index(file.read())
        wanted = [(k, self.places.least, self.places.most + 1) for k, name in enumerate(names) if name in self.places.contigs]
        return path, ranges_of(index, wanted)

    def _dealt(self, path: str, ranges: list[tuple[int, int]]) -> Iterator[_Range]:
        """Partitions of about the split size: long ranges are cut, short ones are read by one task."""
        parts, held = [], 0
        for begin, end in ranges:
            start, offset, last = begin >> 16, begin & 0xFFFF, (end >> 16, end & 0xFFFF)
            while last[0] - start > self.split:
                yield _Range(path, (start, offset, (start + self.split, 0)))
                start, offset = start + self.split, None
            parts.append((start, offset, last))
            held += last[0] - start
            if held >= self.split:
                yield _Range(path, *parts)
                parts, held = [], 0
        if parts:
            yield _Range(path, *parts)

    def read(self, partition: _Range | None) -> Iterator:
        if partition is None:  # no range of any file is wanted
            return
        system, at = store(partition.path)
        size = system.get_file_info(at).size
        sample = os.path.basename(at).split(".")[0]
        with system.open_input_file(at) as file:
            stream = Stream(file)
            contigs = header(stream)
            if self.only_header:
                yield from ((sample, name, length) for name, length in contigs)
                return
            for start, offset, until in partition.parts:
                found = self._at(file, size, stream, contigs, start, offset, until)
                if found is not None:
                    yield from batches(found, contigs, sample, None if stream.plain is not None else until)

    def _at(self, file: BinaryIO, size: int, whole: Stream, contigs: list[tuple[str, int]], start: int, offset: int | None, until: tuple[int, int] | None) -> Stream | None:
        """A stream from the first record of a part on; None if it has none. ``whole`` is behind the header."""
        if offset is not None:
            found = Stream(file, start)
            found.read(offset)
            return found
        if not start:
            return whole
        # A file that isn't made of blocks is read by its first part.
        place = None if whole.plain is not None else first_block(file, start, size)
        if place is None or (until is not None and (place, 0) >= until):
            return None
        found = Stream(file, place)
        return found if first_record(found, contigs) else None


class Bam(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return READS

    def reader(self, schema: object) -> BamReader:
        return BamReader(self.options["path"], False, int(self.options.get("splitBytes", SPLIT)))


class BamHeader(Bam):
    @classmethod
    def name(cls) -> str:
        return "bam_header"

    def schema(self) -> str:
        return "sample_id string, contig string, length bigint"

    def reader(self, schema: object) -> BamReader:
        return BamReader(self.options["path"], True, SPLIT)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Bam)
    spark.dataSource.register(BamHeader)


def _parse_contents(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in given:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            stream = Stream(io.BytesIO(content.as_py()))
            yield from batches(stream, header(stream), os.path.basename(path.as_py()).split(".")[0])


def read_anywhere(spark: SparkSession, path: str) -> DataFrame:
    """READS of files in a store that only Spark opens; a compressed file must fit an executor (2 GB at most).

    The data source above reads files of any size, in every store that pyarrow opens.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bam").load(path).select("path", "content")
    return files.mapInArrow(_parse_contents, READS)


def _bgzf(part: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = packer.compress(part) + packer.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(part), len(part))


def _head(contigs: list[tuple[str, int]]) -> bytes:
    out = bytearray(b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", len(contigs)))
    for name, length in contigs:
        raw = name.encode() + b"\0"
        out += struct.pack("<i", len(raw)) + raw + struct.pack("<i", length)
    return bytes(out)


#: Codes of letters, upper and lower case; others are N.
_CODES = np.array([_SEQ.index(c) if (c := chr(k).upper()) in _SEQ else 15 for k in range(256)], np.uint8)
_READS = pa.schema([("sample_id", pa.string()), ("read_name", pa.string()), ("flag", pa.int32()), ("contig", pa.string()), ("pos", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("seq", pa.string()), ("qual", pa.list_(pa.int32()))])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, one after the other, and their lengths."""
    whole = column.cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(whole) else np.zeros(0, np.uint8)
    return data, np.diff(offsets)


def _put(out: np.ndarray, at: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> None:
    """Runs of bytes, which follow one another in ``data``, to their places."""
    out[np.arange(len(data)) + np.repeat(at - (np.cumsum(lengths) - lengths), lengths)] = data


def encoded(batch: pa.RecordBatch, numbers: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Records of READS, all columns by offsets: bytes, offsets, contigs' numbers, and the places over which they lie."""
    n = batch.num_rows
    ref = pc.index_in(batch["contig"], numbers)
    if ref.null_count or batch["qual"].null_count or any(batch[c].null_count for c in ("read_name", "cigar", "seq")):
        raise ValueError("a read without name, CIGAR, letters or qualities, or on a contig that the header lacks")
    name, name_len = _flat(batch["read_name"])
    letters, length = _flat(batch["seq"])
    if (letters > 127).any():
        letters, length = _flat(pa.array([x.encode("ascii", "replace").decode() for x in batch["seq"].to_pylist()], pa.string()))
    if n and name_len.max() > 254:
        raise ValueError("a read's name has more than 254 bytes")
    kinds = batch["cigar"].dictionary_encode()
    ops = [[(int(k) << 4) | _OPS.index(o) for k, o in re.findall(r"(\d+)([MIDNSHP=X])", text)] for text in kinds.dictionary.to_pylist()]
    kind = kinds.indices.to_numpy()
    n_ops = np.array([len(x) for x in ops], np.int64)[kind]
    span = np.array([sum(k >> 4 for k in x if k & 15 in (0, 2, 3, 7, 8)) for x in ops], np.int64)[kind]
    flat = np.frombuffer(b"".join(struct.pack(f"<{len(x)}I", *x) for x in ops), np.uint8)
    first = np.cumsum([0, *(4 * len(x) for x in ops)])[:-1]
    packed_len = (length + 1) // 2
    halves = np.zeros(2 * packed_len.sum(), np.uint8)
    _put(halves, 2 * (np.cumsum(packed_len) - packed_len), _CODES[letters], length)
    qual = batch["qual"].flatten().cast(pa.uint8()).to_numpy()
    qual_len = pc.list_value_length(batch["qual"]).to_numpy().astype(np.int64)
    size = 36 + name_len + 1 + 4 * n_ops + packed_len + qual_len
    at = np.cumsum(size) - size
    pos = batch["pos"].to_numpy()
    head = np.zeros(n, [("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("length", "<i4"), ("mate", "<i4"), ("mate_pos", "<i4"), ("over", "<i4")])
    for field, values in {"size": size - 4, "ref": ref.to_numpy(), "pos": pos, "name": name_len + 1, "mapq": batch["mapq"].to_numpy(), "ops": n_ops, "flag": batch["flag"].to_numpy(), "length": length, "mate": -1, "mate_pos": -1}.items():
        head[field] = values
    out = np.zeros(int(size.sum()), np.uint8)
    out[at[:, None] + np.arange(36)] = head.view(np.uint8).reshape(n, 36)
    _put(out, at + 36, name, name_len)
    own, _ = _gathered(flat, first[kind], 4 * n_ops)
    place = at + 37 + name_len
    _put(out, place, own, 4 * n_ops)
    place = place + 4 * n_ops
    _put(out, place, halves[::2] << 4 | halves[1::2], packed_len)
    _put(out, place + packed_len, qual, qual_len)
    return out.tobytes(), np.append(at, len(out)), ref.to_numpy().astype(np.int64), pos, pos + np.maximum(1, span)


class BamWriter:
    """A BAM file and its index from reads in the order of their places; BGZF, with its end mark. Holds one batch.

    With ``part`` it is a stretch of such a file, without header and end mark, whose index
    takes the stretch to begin at byte 1 (place 0 says that there is none).
    """

    def __init__(self, path: str, contigs: list[tuple[str, int]], block: int = 60_000, part: bool = False) -> None:
        self.path, self.block, self.part, self.numbers = path, block, part, pa.array([name for name, _ in contigs], pa.string())
        self.system, at = store(path)
        self.file = self.system.open_output_stream(at, compression=None)
        self.held, self.begun = bytearray(b"" if part else _head(contigs)), int(part)
        self.index, self.rows = IndexWriter(len(contigs)), 0

    def _write(self, part: bytes) -> None:
        data = _bgzf(part)
        self.file.write(data)
        self.begun += len(data)

    def add(self, batch: pa.RecordBatch) -> None:
        if not batch.num_rows:
            return
        data, offsets, ref, begin, end = encoded(batch, self.numbers)
        offsets = offsets + len(self.held)
        self.held += data
        begun, at = [self.begun], 0
        while len(self.held) - at >= self.block:
            self._write(bytes(self.held[at : at + self.block]))
            begun.append(self.begun)
            at += self.block
        del self.held[:at]
        # The virtual place of each record, and of what follows the last one.
        places = np.array(begun, np.int64)[offsets // self.block] << 16 | offsets % self.block
        # Records of a bin that reach into the same windows follow one another: the index gets them as one.
        same = np.stack([ref, begin >> FINEST, (end - 1) >> FINEST])
        cuts = np.flatnonzero(np.append(True, (same[:, 1:] != same[:, :-1]).any(axis=0)))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ref)], strict=True):
            self.index.add(int(ref[a]), int(begin[a]), int(end[a]), int(places[a]), int(places[b]))
        self.rows += batch.num_rows

    def close(self) -> None:
        if self.held:
            self._write(bytes(self.held))
            self.held.clear()
        if not self.part:
            self._write(b"")
        self.file.close()
        _save(self.path + ".bai", self.index.content())


def _save(path: str, data: bytes) -> None:
    system, at = store(path)
    with system.open_output_stream(at, compression=None) as f:
        f.write(data)


def _load(path: str) -> bytes:
    system, at = store(path)
    with system.open_input_file(at) as f:
        return f.read()


def _joined(paths: list[str], target: str, contigs: list[tuple[str, int]], block: int = 60_000) -> None:
    """One file and its index from stretches in their order, copied as bytes; it appears when it is whole."""
    system, at = store(target)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    index, staged, head = IndexWriter(len(contigs)), f"{at}.{uuid.uuid4().hex}", _head(contigs)
    with system.open_output_stream(staged, compression=None) as out:
        size = 0
        for a in range(0, len(head), block):
            size += out.write(_bgzf(head[a : a + block]))
        for path in paths:
            index.extend(Index(_load(path + ".bai")), size - 1 << 16)
            other, there = store(path)
            with other.open_input_stream(there, compression=None) as part:
                while data := part.read(1 << 20):
                    size += out.write(data)
        out.write(_bgzf(b""))
    _save(target + ".bai", index.content())
    system.move(staged, at)


#: Reads in a stretch that one task sorts and writes.
PART = 500_000


def write_bams(reads: DataFrame, root: str, contigs: list[tuple[str, int]]) -> DataFrame:
    """``<sample>.sorted.bam`` of each sample below root, by place, with ``.bai``; (sample_id, file_path, rows).

    Reads are cut into ranges of their order, of about ``PART`` each, whatever the samples:
    a task sorts and writes a stretch of a file to the shared folder; stretches are then
    copied under one another, a file by one task, which holds its index and no reads.
    """
    spark = reads.sparkSession
    folder = fresh(spark, "stretches")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, now = TaskContext.get(), None, None
        number, made = task.partitionId(), []

        def close() -> None:
            if out is not None:
                out.close()
                made.append({"sample_id": now, "part": number, "path": out.path, "rows": out.rows})

        for batch in batches:
            sample = batch["sample_id"]
            runs = pc.run_end_encode(sample)
            begin = 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if out is None or name != now:
                    close()
                    system, at = store(folder)
                    system.create_dir(at, recursive=True)
                    now, out = name, BamWriter(f"{folder}/{number}-{task.taskAttemptId()}-{len(made)}", contigs, part=True)
                out.add(batch.slice(begin, end - begin))
                begin = end
        close()
        yield pa.RecordBatch.from_pylist(made, pa.schema([("sample_id", pa.string()), ("part", pa.int32()), ("path", pa.string()), ("rows", pa.int64())]))

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for sample, parts in zip(pdf["sample_id"], pdf["parts"], strict=True):
                path = f"{root.rstrip('/')}/{sample}.sorted.bam"
                _joined([p["path"] for p in parts], path, contigs)
                yield pd.DataFrame([{"sample_id": sample, "file_path": path, "rows": sum(p["rows"] for p in parts)}])

    order = {name: k for k, (name, _) in enumerate(contigs)}
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in order.items() for x in pair]), F.col("contig"))
    by = ["sample_id", rank, "pos", "read_name", "flag"]
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = reads.select(*_NAMES).repartitionByRange(max(shuffled, -(-reads.count() // PART)), *by).sortWithinPartitions(*by)
    made = placed.mapInArrow(write, "sample_id string, part int, path string, rows bigint")
    whole = made.repartition(shuffled, "sample_id").groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("part", "path", "rows"))).alias("parts"))
    return whole.mapInPandas(join, "sample_id string, file_path string, rows bigint")


def write_bam(path: str, contigs: list[tuple[str, int]], rows: list[dict], block: int = 60_000) -> None:
    """A small BAM file from read rows, for tests and exports of few reads."""
    out = BamWriter(path, contigs, block)
    out.add(pa.RecordBatch.from_pylist(rows, _READS))
    out.close()
