"""Shared helpers: tables, the shared folder, and byte-level text kernels in numpy.

The kernels work on the UTF-8 buffers that Arrow hands over, in chunks of about
``CHUNK_BYTES``, so a worker's memory does not depend on the batch or table size
(only on its longest single text).
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
U64 = np.uint64
MASK64 = (1 << 64) - 1

#: Rows, and bytes written as JSON, up to which a side may be broadcast; beyond either, joins shuffle.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 48 << 20
UNKNOWN_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; an own local one only where none is set and all runs on this machine."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="locusframe-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def written(df: DataFrame, name: str, clean: bool = True) -> DataFrame:
    """Cut the lineage: write to the shared folder and read again.

    The shuffles behind it are not needed any more; a collection on the driver lets
    Spark's cleaner delete their files, which else stay until it happens to run. Small
    tables can do without.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    del df
    if clean:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def given_back(spark: SparkSession) -> None:
    """Let the executors give back what earlier stages left: JVM heaps shrink, Python workers drop broadcasts.

    A heap that a shuffle has grown stays at its greatest size, and a worker keeps the
    broadcasts of its last task until the next one; both count against the executor while
    other stages run. Nothing depends on whether every executor gets a task.
    """
    n = 4 * spark.sparkContext.defaultParallelism
    swept = spark.range(0, n, 1, n).where(F.coalesce(F.java_method(F.lit("java.lang.System"), F.lit("gc")), F.lit("")) != "-")
    swept.mapInArrow(released(lambda batches: batches), "id long").count()


def shards_for(df: DataFrame, bytes_each: int, least: int = 16) -> int:
    """Number of hash-range shards, in proportion to the scanned input's files.

    Where Spark doesn't know a size, ``UNKNOWN_BYTES`` are taken for every partition.
    """
    size = 0
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    for i in range(leaves.size()):
        own = int(str(leaves.apply(i).stats().sizeInBytes()))
        size += own if own < 1 << 60 else UNKNOWN_BYTES * df.rdd.getNumPartitions()
    return int(min(max(least, -(-size // bytes_each)), 1 << 20))


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a side has at most so many rows and bytes; reads no more rows than that."""
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()
    return found["n"] <= rows and (found["b"] or 0) <= most_bytes


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if small(df, rows) else df


def own_names(df: DataFrame, *names: str) -> list[str]:
    """Names for columns that are added to df meanwhile: none that it has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def released(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """f for mapInArrow, giving the memory it has freed back to the system as a task ends.

    Workers are used again and wait between tasks; what their allocators keep would count
    against the executor while other stages run.
    """

    def run(batches: Iterator) -> Iterator:
        try:
            yield from f(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass

    return run


# ---------------------------------------------------------------- byte kernels


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as (bytes, offsets); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offs, data = column.buffers()
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, grown on demand."""
    if not _POW or len(_POW["p"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("p", _BASE), ("q", _BASE_INV)):
            out = np.ones(size, U64)
            filled, step = 1, base
            while filled < size:
                take = min(filled, size - filled)
                out[filled : filled + take] = out[:take] * U64(step)
                filled, step = filled + take, step * step & MASK64
            _POW[name] = out
    return _POW["p"], _POW["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A random 64-bit value for each byte; in LOWER_VALUES A-Z count as a-z.
BYTE_VALUES = mix((np.arange(256, dtype=U64) + U64(1)) * U64(0xD6E8FEB86659FD93)) | U64(1)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """P with P[k] = sum of values[j] * BASE**j for j < k."""
    p, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hashes of values[start:end]."""
    _, q = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * q[start] + (end - start).astype(U64))


def spans_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ``mask`` that do not cross a text's end: starts and ends."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(mask & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """White-space separated words: starts, ends and the number in each text."""
    starts, ends = spans_of(~SPACE[raw], offsets)
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, an index of each, and the place of every key among them."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.empty(len(keys), bool)
    first[0] = True
    np.not_equal(ranked[1:], ranked[:-1], out=first[1:])
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(first) - 1
    return ranked[first], order[first], inverse


LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z and the capital letters of Latin-1 in lower case."""
    out = raw.copy()
    out[(raw >= 65) & (raw <= 90)] += 32
    capital = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) + 1
    out[capital] += 32
    return out
